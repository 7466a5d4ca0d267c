"""Fixed, recursive and structure-aware chunking. All of them are narrow: a document
is one row and its chunks are built from that row alone, so nothing is shuffled."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.functions.slabs import slabs
from pagemill.functions.text import strip


# Level of a heading that has none.
DEEPEST = 1 << 30


def _explode_chunks(df: DataFrame, chunks: Column, text: str) -> DataFrame:
    """One row per chunk; every other column of the document is inherited."""
    inherited = [c for c in df.columns if c != text]
    exploded = df.select(*inherited, F.posexplode(chunks).alias("chunk_index", "chunk"))
    return exploded.withColumn("chunk_length", F.length("chunk"))


def char_window_chunks(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the last.

    One linear pass cuts the text into strides; a window is its stride plus the head of
    the following ones. Windows are stripped and blank ones dropped.
    """
    stride = size - overlap
    followers = -(-overlap // stride)
    strides = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    # Every stride would start a window, but the last windows add nothing once one of
    # them has reached the end of the text.
    windows = F.greatest(F.lit(1), F.ceil((F.length(text) - F.lit(overlap)) / F.lit(stride)))
    with_strides = df.withColumn("_strides", strides).withColumn("_windows", windows.cast("int"))

    def window(i: Column) -> Column:
        joined = F.array_join(F.slice("_strides", i, F.lit(followers + 1)), "")
        return strip(F.left(joined, F.lit(size)))

    chunks = F.filter(
        F.transform(F.sequence(F.lit(1), F.col("_windows")), window), lambda c: F.length(c) > 0
    )
    return _explode_chunks(with_strides, chunks, text).drop("_strides", "_windows")


def _cuts(text: str, start: int, end: int, separator: str) -> list[int]:
    """Borders of the pieces of ``text[start:end]``; a separator opens the next piece."""
    borders = [start]
    at = text.find(separator, start, end)
    while at >= 0:
        if at > start:
            borders.append(at)
        at = text.find(separator, at + len(separator), end)
    borders.append(end)
    return borders


class Units:
    """What the length of a piece of text is counted in: characters, or units that start at known places.

    The length of a span is a difference of two prefix counts, found by binary search among the starts, so no candidate
    is ever counted or encoded by itself.
    """

    def __init__(self, starts: Sequence[int] | None = None):
        self.starts = starts

    def before(self, at: int) -> int:
        """Units that start before a place."""
        return at if self.starts is None else bisect_left(self.starts, at)

    def windows(self, start: int, end: int, size: int, overlap: int) -> list[tuple[int, int]]:
        """Spans of ``size`` units that share ``overlap`` units with the next."""
        if self.starts is None:
            return _windows(start, end, size, overlap)
        first, last = self.before(start), self.before(end)
        edges = [start, *self.starts[first + 1 : last], end] if last > first else [start, end]
        return [(edges[a], edges[b]) for a, b in _windows(0, len(edges) - 1, size, overlap)]


CHARACTERS = Units()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def unit_finder(count: str) -> Callable[[str], Units]:
    """Units of a text by ``chars``, by white-space separated ``words``, or by tokens of the vocabulary file at a path."""
    if count == "chars":
        return lambda text: CHARACTERS
    if count == "words":
        return lambda text: Units([m.start() for m in WORD.finditer(text)])
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(count)

    def tokens(text: str) -> Units:
        # Several tokens may share a character; each counts.
        return Units([start for start, _ in tokenizer.encode(text, add_special_tokens=False).offsets])

    return tokens


def _pack(borders: list[int], size: int, overlap: int, units: Units) -> list[tuple[int, int]]:
    """Longest runs of neighbouring pieces within ``size``, sharing up to ``overlap``.

    Pieces are contiguous, so a run is a span and its length a difference of counts at borders.
    """
    spans = []
    first = 0
    counts = [units.before(b) for b in borders]
    for last in range(1, len(borders)):
        if counts[last] - counts[first] > size and last - 1 > first:
            spans.append((borders[first], borders[last - 1]))
            while first < last - 1 and (
                counts[last - 1] - counts[first] > overlap
                or counts[last] - counts[first] > size
            ):
                first += 1
    if borders[-1] > borders[first]:
        spans.append((borders[first], borders[-1]))
    return spans


def _windows(start: int, end: int, size: int, overlap: int) -> list[tuple[int, int]]:
    stride = size - overlap
    stop = max(start + 1, end - overlap)
    return [(at, min(at + size, end)) for at in range(start, stop, stride)]


def _split_span(
    text: str, start: int, end: int, separators: list[str], size: int, overlap: int, units: Units
) -> list[tuple[int, int]]:
    level = next(
        (i for i, s in enumerate(separators) if s == "" or text.find(s, start, end) >= 0), None
    )
    if level is None:
        return [(start, end)]
    if separators[level] == "":
        return units.windows(start, end, size, overlap)
    finer = separators[level + 1 :]
    borders = _cuts(text, start, end, separators[level])
    spans: list[tuple[int, int]] = []
    run = [start]
    for left, right in zip(borders, borders[1:]):
        if units.before(right) - units.before(left) < size:
            run.append(right)
            continue
        spans += _pack(run, size, overlap, units)
        spans += _split_span(text, left, right, finer, size, overlap, units) if finer else [(left, right)]
        run = [right]
    return spans + _pack(run, size, overlap, units)


def _after_separator(text: str, at: int, separators: list[str]) -> int:
    """Where a chunk starts if the separator that opens it is left out."""
    opening = next((s for s in separators if s and at and text.startswith(s, at)), "")
    return at + len(opening)


def split_text(
    text: str, separators: list[str], size: int, overlap: int, keep_separator: bool = True, units: Units = CHARACTERS
) -> list[str]:
    """Recursive splitting of one text by ever finer separators.

    Lengths are measured with separators; without ``keep_separator`` the one that opens a chunk is left out.
    """
    spans = _split_span(text, 0, len(text), separators, size, overlap, units)
    if not keep_separator:
        spans = [(min(_after_separator(text, a, separators), b), b) for a, b in spans]
    return [chunk for chunk in (text[a:b].strip() for a, b in spans) if chunk]


def recursive_chunks(
    df: DataFrame, text: str, size: int, overlap: int, separators: list[str], keep_separator: bool = True, count: str = "chars"
) -> DataFrame:
    """Recursive splitting; only the text column travels to Python.

    ``size`` and ``overlap`` are numbers of ``count``: ``chars``, ``words``, or tokens of a vocabulary file, whose path all executors
    can open. A text is encoded once. The chunks of a slab of texts leave before the next is split.
    """
    separators = list(separators)

    @F.arrow_udf("array<string>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        units = unit_finder(count)
        for texts in batches:
            for first, rows in slabs(np.asarray(pc.binary_length(texts).fill_null(0)).tolist()):
                chunks = [
                    split_text(t, separators, size, overlap, keep_separator, units(t)) if t else []
                    for t in texts.slice(first, rows).to_pylist()
                ]
                yield pa.array(chunks, pa.list_(pa.string()))

    return _explode_chunks(df, split(F.col(text)), text)


def with_chunk_id(chunks: DataFrame, key: str) -> DataFrame:
    """A reproducible identifier from the document key and the chunk's position."""
    source = F.concat_ws("|", F.col(key).cast("string"), F.col("chunk_index").cast("string"))
    return chunks.withColumn("chunk_id", F.sha2(source, 256))


def structure_chunks(df: DataFrame, layout: str, max_chars: int, paths: bool = False) -> DataFrame:
    """Neighbouring blocks of the same section, merged while they fit ``max_chars``.

    ``layout`` is an array of ``(kind, level, text)`` blocks. A heading opens a section
    and stands beside the chunks of its section as context; with ``paths`` so does the whole way to it, ``heading_path``:
    the headings that are open, from the outermost on. A heading closes those of its own and of deeper levels; one without a level
    is of the deepest. One fold over kinds, levels and lengths finds where chunks start and what is open there, all
    inside the JVM.
    """
    blocks = F.col(layout)
    inherited = [c for c in df.columns if c != layout]
    sizes = F.transform(
        blocks,
        lambda b, i: F.struct(
            i.alias("at"), (F.coalesce(b["kind"], F.lit("")) == "heading").alias("opens"),
            F.coalesce(F.length(b["text"]), F.lit(0)).alias("n"),
            F.coalesce(b["level"], F.lit(DEEPEST)).alias("level"),
        ),
    )
    nothing = F.struct(
        F.array().cast("array<struct<first:int,open:array<int>>>").alias("found"),
        F.lit(0).alias("used"),
        F.array().cast("array<struct<at:int,level:int>>").alias("open"),
    )

    def step(state: Column, block: Column) -> Column:
        own = F.array(F.struct(block["at"].alias("at"), block["level"].alias("level")))
        above = F.filter(state["open"], lambda h: h["level"] < block["level"])
        stack = F.when(block["opens"], F.concat(above, own)).otherwise(state["open"])
        new = (F.size(state["found"]) == 0) | block["opens"] | (state["used"] + 1 + block["n"] > max_chars)
        start = F.struct(block["at"].alias("first"), F.transform(stack, lambda h: h["at"]).alias("open"))
        return F.struct(
            F.when(new, F.concat(state["found"], F.array(start))).otherwise(state["found"]).alias("found"),
            F.when(new, block["n"]).otherwise(state["used"] + 1 + block["n"]).alias("used"),
            stack.alias("open"),
        )

    with_starts = df.withColumn("_starts", F.aggregate(sizes, nothing, step, lambda state: state["found"]))

    def chunk(start: Column, i: Column) -> Column:
        following = F.coalesce(F.get("_starts", i + 1)["first"], F.size(blocks))
        members = F.slice(blocks, start["first"] + 1, following - start["first"])
        return F.struct(
            F.array_join(F.transform(members, lambda b: b["text"]), "\n").alias("chunk"),
            F.size(members).alias("block_count"),
            F.get(F.transform(F.slice(F.reverse(start["open"]), 1, 1), lambda at: F.get(blocks, at)["text"]), F.lit(0)).alias("heading"),
            F.transform(start["open"], lambda at: F.get(blocks, at)["text"]).alias("heading_path"),
        )

    exploded = with_starts.select(
        *inherited, F.posexplode(F.transform("_starts", chunk)).alias("chunk_index", "c")
    )
    columns = ["c.chunk", "c.block_count", "c.heading", *(["c.heading_path"] if paths else [])]
    return exploded.select(*inherited, "chunk_index", *columns).withColumn(
        "chunk_length", F.length("chunk")
    )
