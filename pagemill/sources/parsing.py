"""Parsing files into pages, with fallback and per-file failure capture.

A parser is any function from a file's bytes and path to a list of pages
``{"md", "text", "layout", "structured_data", "images"}``; missing keys become NULL.
Two are included for HTML, which decode the bytes themselves. Other formats, binary ones
too, and services plug in the same way.
"""

from __future__ import annotations

import contextlib
import html
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.functions.slabs import slabs
from pagemill.functions.text import basename
from pagemill.operators.documents import PAGE_TYPE
from pagemill.operators.failures import outcome
from pagemill.sources.limits import ItemFailed, LimitedWorker

Parser = Callable[[bytes, str], list[dict]]

SKIPPED = {"script", "style", "head"}
BLOCK_TAGS = {
    "address", "article", "aside", "blockquote", "body", "dd", "div", "dl", "dt", "figure",
    "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header", "html", "li", "main", "nav", "ol",
    "p", "pre", "section", "table", "td", "th", "tr", "ul",
}
PAGE_KEYS = ("md", "text", "layout", "structured_data", "images")


# The largest spans that the HTML standard allows.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


@dataclass
class _Cell:
    text: list[str]
    columns: int
    rows: int
    heads: bool


def _span(value: str | None, most: int, zero: int) -> int:
    digits = re.match(r"\s*(\d+)", value or "")
    number = int(digits[1]) if digits else 1
    return zero if number == 0 else min(number, most)


def resolve_grid(rows: list[list[_Cell]]) -> list[list[str]]:
    """Rows of equal width; a cell that spans rows or columns stands in all of its places."""
    taken: dict[tuple[int, int], str] = {}
    width = 0
    for r, row in enumerate(rows):
        column = 0
        for cell in row:
            while (r, column) in taken:
                column += 1
            text = " ".join("".join(cell.text).split())
            for down in range(min(cell.rows, len(rows) - r)):
                for right in range(cell.columns):
                    taken.setdefault((r + down, column + right), text)
            column += cell.columns
            width = max(width, column)
    return [[taken.get((r, c), "") for c in range(width)] for r in range(len(rows))]


def markdown_table(grid: list[list[str]]) -> str:
    """The first row is the head, as the format asks for one."""
    lines = ["| " + " | ".join(cell.replace("|", "\\|") for cell in row) + " |" for row in grid]
    return "\n".join([lines[0], "|" + " --- |" * len(grid[0]), *lines[1:]])


class _Blocks(HTMLParser):
    """Collects headings, paragraphs, list items, tables and image sources."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[dict] = []
        self.images: list[str] = []
        self.tables: list[dict] = []
        # Rows of the table that is open; tables inside of its cells are text of the cell.
        self._rows: list[list[_Cell]] | None = None
        self._inner = 0
        self._kind, self._level, self._text, self._skip = "paragraph", 0, [], 0

    def _flush(self):
        text = " ".join("".join(self._text).split())
        if text:
            self.blocks.append({"kind": self._kind, "level": self._level, "text": text})
        self._kind, self._level, self._text = "paragraph", 0, []

    def _table_tag(self, tag: str, attributes: dict[str, str | None]) -> None:
        if tag == "table":
            self._inner += 1
        elif self._inner:
            pass
        elif tag == "tr":
            self._rows.append([])
        elif tag in ("td", "th"):
            if not self._rows:
                self._rows.append([])
            spans = _span(attributes.get("colspan"), MOST_COLUMNS, 1), _span(attributes.get("rowspan"), MOST_ROWS, MOST_ROWS)
            self._rows[-1].append(_Cell([], *spans, tag == "th"))
        if self._rows and self._rows[-1]:
            self._rows[-1][-1].text.append(" ")

    def _end_table(self) -> None:
        rows = [row for row in self._rows or [] if row]
        self._rows, self._inner = None, 0
        grid = resolve_grid(rows)
        if any(cell for row in grid for cell in row):
            self.blocks.append({"kind": "table", "level": 0, "text": markdown_table(grid)})
            self.tables.append({"header": all(cell.heads for cell in rows[0]), "rows": grid})

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self._skip += 1
        elif tag == "img":
            self.images.append(dict(attrs).get("src") or "")
        elif self._rows is not None and (tag in BLOCK_TAGS or tag == "br"):
            self._table_tag(tag, dict(attrs))
        elif tag == "table":
            self._flush()
            self._rows = []
        elif tag in BLOCK_TAGS:
            if tag == "body":
                self._skip = 0  # the end tag of the head may be missing
            self._flush()
            if tag == "li":
                self._kind = "list_item"
            elif re.fullmatch("h[1-6]", tag):
                self._kind, self._level = "heading", int(tag[1])
        elif tag == "br":
            self._text.append(" ")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self._skip = max(0, self._skip - 1)
        elif self._rows is not None:
            if tag == "table" and self._inner:
                self._inner -= 1
            elif tag in ("table", "body", "html"):
                self._end_table()
        elif tag in BLOCK_TAGS:
            self._flush()

    def handle_data(self, data):
        if self._skip:
            return
        if self._rows is None:
            self._text.append(data)
        elif self._rows and self._rows[-1]:
            self._rows[-1][-1].text.append(data)

    def close(self):
        super().close()
        if self._rows is not None:
            self._end_table()
        self._flush()


def _markdown(block: dict) -> str:
    marks = {"heading": "#" * block["level"] + " ", "list_item": "- "}
    return marks.get(block["kind"], "") + block["text"]


def decoded(content: bytes) -> str:
    """Bytes as text; what is not UTF-8 becomes U+FFFD instead of failing the file."""
    return content.decode("utf-8", "replace")


def layout_parser(content: bytes, path: str = "") -> list[dict]:
    """HTML to one page with block layout, markdown, plain text, and the grids of its tables as JSON."""
    reader = _Blocks()
    reader.feed(decoded(content))
    reader.close()
    if not reader.blocks:
        return []
    return [
        {
            "md": "\n\n".join(_markdown(b) for b in reader.blocks),
            "text": "\n".join(b["text"] for b in reader.blocks),
            "layout": reader.blocks,
            "images": reader.images,
            "structured_data": json.dumps(reader.tables, ensure_ascii=False) if reader.tables else None,
        }
    ]


def text_parser(content: bytes, path: str = "") -> list[dict]:
    """Fallback: visible text only, no layout and no markdown."""
    visible = re.sub(r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", " ", decoded(content))
    text = " ".join(html.unescape(re.sub(r"(?s)<[^>]*>", " ", visible)).split())
    return [{"text": text}] if text else []


def _attempt(content: bytes | None, path: str, parsers: Sequence[tuple[str, Parser]]):
    errors = []
    for name, parser in parsers:
        try:
            pages = parser(None if content is None else bytes(content), path)
        except Exception as error:  # one bad file must not stop the run
            errors.append(f"{name}: {error}")
            continue
        return [{k: p.get(k) for k in PAGE_KEYS} for p in pages], name, None
    return [], None, "; ".join(errors)


def _limited(worker: LimitedWorker, content: bytes | None, path: str):
    try:
        return worker(content, path)
    except ItemFailed as error:
        return [], None, str(error)


def parse_files(
    files: DataFrame,
    parsers: Sequence[tuple[str, Parser]],
    processed_at: Column,
    seconds_per_file: float | None = None,
) -> DataFrame:
    """One outcome row per file: pages, the parser that worked, or the error.

    ``files`` has ``file_path`` and the bytes ``content``.
    Parsers are tried in order until one does not raise. Files with no page at all are
    failures. The work is narrow, and the pages of a slab of files leave before the next is parsed; write the
    result before reading it more than once. With
    ``seconds_per_file``, parsers run in a process of their own, and a file that takes longer or ends that process has failed.
    """
    parsers = list(parsers)

    def attempt(content: bytes | None, path: str):
        return _attempt(content, path, parsers)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with contextlib.ExitStack() as stack:
            run = attempt
            if seconds_per_file is not None:
                worker = stack.enter_context(LimitedWorker(attempt, seconds_per_file))
                run = lambda content, path: _limited(worker, content, path)
            for batch in batches:
                for first, rows in slabs(0 if c is None else len(c) for c in batch["content"]):
                    slab = batch.iloc[first : first + rows]
                    results = [run(c, p) for c, p in zip(slab["content"], slab["file_path"])]
                    yield pd.DataFrame(
                        {
                            "file_path": slab["file_path"].to_numpy(),
                            "pages": [r[0] for r in results],
                            "loader_used": [r[1] for r in results],
                            "error": [r[2] for r in results],
                        }
                    )

    schema = f"file_path string, pages array<{PAGE_TYPE}>, loader_used string, error string"
    parsed = outcome(files.select("file_path", "content").mapInPandas(parse, schema), F.size("pages"))
    return parsed.select(
        "file_path",
        basename(F.col("file_path")).alias("file_name"),
        F.when(F.col("status") == "ok", F.col("loader_used")).alias("loader_used"),
        "status",
        "error",
        F.size("pages").alias("n_pages"),
        "pages",
        processed_at.alias("processed_at"),
    )


HTML_PARSERS: list[tuple[str, Parser]] = [("layout", layout_parser), ("text", text_parser)]


def first_loader(primary: Column, fallback: Column) -> tuple[Column, Column]:
    """Column form of the fallback: the content that is there, and where it came from."""
    content = F.coalesce(primary, fallback)
    loader = F.when(primary.isNotNull(), F.lit("layout")).when(fallback.isNotNull(), F.lit("text"))
    return content, loader
