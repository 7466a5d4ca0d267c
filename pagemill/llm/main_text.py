"""Main text of web pages by a style tree per site.

The block elements of a page form a tree; inline elements are part of the text around them. The trees of one host are merged: a
node is the path of element names, classes and places from the root, where equal neighbours count as one. Every
node has the entropy of its presentations (which children it shows on the pages) and of its contents (which texts and
links it holds, and on how many pages the same ones). What looks and reads alike on all pages of a site is of low importance;
a page drops the branches in which nothing is important. Elements that say what they are (``article``, ``nav``, a class
``advert``) have a fixed importance, which is what single pages of a host are judged by.

Trees are never moved: pages post their nodes' presentations and contents as hashes, which are counted, and the
importance of a node goes to the bucket of pages that holds it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.llm.url_rules import url_host
from pagemill.session import written

# Elements by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset("script style noscript template svg math object iframe canvas audio video map title".split())
NOISE = frozenset("nav aside footer form button select textarea input dialog menu fieldset datalist".split())
MAIN = frozenset("article main".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote dl dt dd figcaption caption".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split()
)
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices popup modal overlay comment comments "
    "respond disqus share sharing social related newsletter subscribe subscription pagination pager widget masthead".split()
)
# A start tag ends open elements of these names, up to the nearest of the second kind.
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr"), "th": ("td th", "tr"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tr td th", "table"),
}
CLOSES = {name: (frozenset(ends.split()), frozenset(stops.split())) for name, (ends, stops) in CLOSES.items()}
# Weight of the children in the importance of a node, by the number of its presentations.
GAMMA = 0.9
# Branches below are noise, on hosts of at least so many pages.
MIN_IMPORTANCE = 0.4
MIN_PAGES = 3
# Logarithms are summed as whole numbers, in the same way by any number of tasks.
LOG_UNIT = 1 << 20
BUCKET_BYTES = 8 << 20


class Node:
    """A block element, or a run of text in one: ``text`` is None for elements."""

    __slots__ = ("tag", "names", "parent", "children", "text", "links", "fixed", "key", "words", "linked")

    def __init__(self, tag: str, names: str = "", parent: Node | None = None, text: list[str] | None = None):
        self.tag, self.names, self.parent, self.text = tag, names, parent, text
        self.children: list[Node] = []
        self.links: list[str] = []
        # 0 or 1 where the element says what it is.
        self.fixed: int | None = None
        self.key = 0
        # Characters, and those inside links.
        self.words = self.linked = 0


def _fixed(tag: str, attributes: dict[str, str | None]) -> int | None:
    role = (attributes.get("role") or "").strip().lower()
    hidden = "hidden" in attributes or (attributes.get("aria-hidden") or "").lower() == "true"
    if tag in ("html", "body"):
        return None
    if hidden or re.search(r"display\s*:\s*none", attributes.get("style") or "", re.I):
        return 0
    names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".lower()
    if tag in NOISE or role in NOISE_ROLES or NOISE_NAMES.intersection(re.split(r"[^a-z0-9]+", names)):
        return 0
    return 1 if tag in MAIN or role in MAIN else None


class _Reader(HTMLParser):
    """The tree of block elements; markup that is not well-formed is closed as browsers do in the common cases."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.node = Node("")
        self.run: Node | None = None
        self.unseen: list[str] = []
        self.link = False

    def _close(self, node: Node) -> None:
        self.node, self.run = node.parent, None

    def _open_ends(self, tag: str) -> None:
        node = self.node
        if node.tag == "p" and tag not in INLINE:
            self._close(node)
        elif tag in CLOSES:
            ends, stops = CLOSES[tag]
            last = None
            while node.parent is not None and node.tag not in stops:
                last, node = node if node.tag in ends else last, node.parent
            if last is not None:
                self._close(last)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.unseen:
            if tag == "body":
                self.unseen.clear()
            elif tag == self.unseen[-1]:
                self.unseen.append(tag)
        if self.unseen:
            return
        if tag in UNSEEN:
            self.unseen.append(tag)
            return
        attributes = dict(attrs)
        if tag in INLINE:
            if tag == "a":
                self.link = True
                self._run().links.append(attributes.get("href") or "")
            elif tag == "br":
                self._run().text.append(" ")
            return
        self._open_ends(tag)
        names = " ".join(sorted(f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split()))
        node = Node(tag, names, self.node)
        node.fixed = _fixed(tag, attributes)
        self.node.children.append(node)
        self.run = None
        if tag not in VOID:
            self.node = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash has no meaning in HTML, but in the foreign elements that are unseen here.
        if tag not in UNSEEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.unseen:
            if tag == self.unseen[-1]:
                self.unseen.pop()
            elif tag in ("body", "html"):
                self.unseen.clear()
            return
        if tag in INLINE:
            self.link = self.link and tag != "a"
            return
        node = self.node
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None and tag not in ("html", "body"):
            self._close(node)

    def _run(self) -> Node:
        if self.run is None:
            self.run = Node("#text", "", self.node, [])
            self.node.children.append(self.run)
        return self.run

    def handle_data(self, data: str) -> None:
        if self.unseen:
            return
        if self.run is None and not data.strip():
            return
        run = self._run()
        run.text.append(data)
        if self.link:
            run.linked += len(data.strip())


def read_tree(html: str) -> Node:
    """The tree of a page; the text of a run is its words with single spaces."""
    reader = _Reader()
    try:
        reader.feed(html)
        reader.close()
    except AssertionError:  # the standard parser's answer to some broken declarations; what was read stays
        pass
    for node in reversed(list(nodes_of(reader.root))):
        if node.text is not None:
            node.text = " ".join("".join(node.text).split())
            node.words = len(node.text)
        if node.parent is not None:
            node.parent.words += node.words
            node.parent.linked += node.linked
        node.children = [c for c in node.children if c.words or c.text is None]
        # A list of nothing but links, outside of what is known as main text, is a menu.
        if node.tag in ("ul", "ol") and node.words and node.linked >= 0.9 * node.words and node.fixed is None:
            if not any(n.fixed == 1 for n in _above(node)):
                node.fixed = 0
    return reader.root


def _above(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def nodes_of(root: Node) -> Iterator[Node]:
    """All nodes in page order, without recursion."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(reversed(node.children))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _presentation(node: Node) -> list[str]:
    """Names of the children; equal neighbours count as one."""
    shown: list[str] = []
    for child in node.children:
        name = f"{child.tag}.{child.names}"
        if not shown or shown[-1] != name:
            shown.append(name)
    return shown


def place(root: Node, host: str) -> list[tuple[int, int, int, int]]:
    """Give every node its key in the tree of the host; what it posts: ``key, kind, value, times on this page``.

    Kind 0 is the presentation of a node on this page, one row a page; kind 1 are its contents. The key follows from
    names and places alone, so that all pages of a host agree on it.
    """
    root.key = _hash(host)
    contents: Counter[tuple[int, int]] = Counter()
    presentations: dict[int, set[str]] = {}
    for node in nodes_of(root):
        shown = _presentation(node)
        presentations.setdefault(node.key, set()).add("\n".join(shown))
        if node.text is not None:
            contents[node.key, _hash(node.text)] += 1
            for link in node.links:
                contents[node.key, _hash("href " + link)] += 1
        at, last, nth = -1, None, 0
        for child in node.children:
            name = f"{child.tag}.{child.names}"
            if name != last:
                # A place counts the earlier places of the same name, so that other children move no key.
                at, last = at + 1, name
                nth = shown[:at].count(name)
            child.key = _hash(f"{node.key} {name} {nth}")
    posts = [(key, 0, _hash("\n\n".join(sorted(each))), 1) for key, each in presentations.items()]
    return posts + [(key, 1, value, times) for (key, value), times in contents.items()]


def kept_texts(root: Node, importance: dict[int, tuple[float, int]]) -> list[str]:
    """The texts of the main branches in page order.

    ``importance`` has the importance and the number of presentations of a node by its key; nodes of which it
    has nothing are important. A branch is worth what its nodes are worth as this page shows them.
    """
    every = list(nodes_of(root))
    value: dict[int, float] = {}
    best: dict[int, float] = {}
    for node in reversed(every):
        worth, styles = importance.get(node.key, (1.0, 1))
        if node.fixed is not None:
            worth = float(node.fixed)
        elif node.children:
            share = GAMMA**styles
            worth = (1 - share) * worth + share * sum(value[id(c)] for c in node.children) / len(node.children)
        value[id(node)] = worth
        best[id(node)] = max([worth, *(best[id(c)] for c in node.children)])

    def texts(by_importance: bool, main_only: bool) -> list[str]:
        found, stack = [], [(root, not main_only, False)]
        while stack:
            node, wanted, main = stack.pop()
            if node.fixed == 0 or node.tag == "header" and not main:
                continue
            main = main or node.fixed == 1
            guarded = node.fixed == 1 or main and (node.tag in TEXTUAL or node.text is not None)
            if by_importance and not guarded and best[id(node)] < MIN_IMPORTANCE:
                continue
            if node.text and (wanted or main):
                found.append(node.text)
            stack.extend((c, wanted, main) for c in reversed(node.children))
        return found

    # A site whose pages are all alike must not lose everything.
    has_main = any(n.fixed == 1 and n.words for n in every)
    return (texts(True, True) if has_main else []) or texts(True, False) or texts(False, False)


_POSTS = "bucket long, key long, kind int, value long, times long"
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[tuple] = []
        for bucket, host, html in zip(*(batch.column(n) for n in ("bucket", "host", "html")), strict=True):
            # Pages without a host have no site.
            if host.as_py():
                found += [(bucket.as_py(), *post) for post in place(read_tree(html.as_py()), host.as_py())]
        columns = list(zip(*found, strict=True)) or [()] * len(_KINDS)
        arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "key", "kind", "value", "times"])


def node_importance(posts: DataFrame) -> DataFrame:
    """``key, importance, styles`` of the nodes that enough pages have.

    Contents that are spread evenly over the pages, and a node that always shows the same children, are worth 0;
    contents of one page only are worth 1. Sums are made before the shuffle, and of whole numbers, so that they are the same
    in any order.
    """
    def logs(n: Column) -> Column:
        return F.round(n * F.log2(n) * LOG_UNIT).cast("long")

    times = F.col("times")
    values = posts.groupBy("key", "kind", "value").agg(F.sum("times").alias("times"), F.sum(logs(times)).alias("logs"))
    shown, held = F.col("kind") == 0, F.col("kind") == 1
    evenness = F.round(F.log2(times) * LOG_UNIT - F.col("logs") / times).cast("long")
    nodes = values.groupBy("key").agg(
        F.sum(F.when(shown, times)).alias("pages"),
        F.count_if(shown).alias("styles"),
        F.sum(F.when(shown, logs(times))).alias("logs"),
        F.count_if(held).alias("contents"),
        F.sum(F.when(held, evenness)).alias("evenness"),
    )
    base = F.log2("pages") * LOG_UNIT
    entropy = (base - F.col("logs") / F.col("pages")) / base
    worth = F.when(F.col("contents") > 0, 1 - F.col("evenness") / F.col("contents") / base).otherwise(entropy)
    return nodes.where(F.col("pages") >= MIN_PAGES).select("key", worth.alias("importance"), "styles")


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, the importance of its nodes before its pages."""
    bucket, importance, seen, text = None, {}, None, ""
    for batch in batches:
        pages = []
        for row in range(batch.num_rows):
            here = batch.column("bucket")[row].as_py()
            if here != bucket:
                bucket, importance, seen = here, {}, None
            if batch.column("side")[row].as_py() == 0:
                key, *worth = (batch.column(n)[row].as_py() for n in ("key", "importance", "styles"))
                importance[key] = tuple(worth)
                continue
            page, url, host, html = (batch.column(n)[row].as_py() for n in ("page_id", "url", "host", "html"))
            # Repeated pages follow each other.
            if seen != (host, html):
                seen, root = (host, html), read_tree(html)
                if host:
                    place(root, host)
                text = "\n".join(kept_texts(root, importance if host else {}))
            pages.append((page, url, text, len(text)))
        columns = list(zip(*pages, strict=True)) or [()] * len(_TEXT)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TEXT, strict=True)], schema=_TEXT)


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page, its blocks joined by line feeds.

    NULL and empty pages have an empty text. Pages without a host (NULL or relative URLs) are judged alone, like
    those of hosts with few pages: by elements and names that state their role. Where a page has ``article`` or ``main``, its text
    is there. Branches are dropped for low importance; paragraphs and headings inside the main element never are, so copies
    of an article on one site keep it, and a page of which nothing would be left keeps what no stated role forbids.
    Repeated rows get the same answer, other columns are passed over, an empty table gives no rows. A page is held whole while
    it is read, however long; a bucket never is.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()[0]
    partitions = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, -(-size // BUCKET_BYTES))
    # The number of a row follows from what it holds, since both passes need it.
    row = F.xxhash64("page_id", "url", "html")
    rows = rows.select("*", url_host(F.col("url")).alias("host"), row.alias("row"))
    rows = rows.withColumn("bucket", F.pmod("row", F.lit(buckets)))
    posts = written(rows.select("bucket", "host", "html").mapInArrow(_post, _POSTS), "posts")
    # A bucket gets what it holds: no more rows than were posted.
    held = posts.where("kind = 0").select("bucket", "key").distinct()
    none = {"page_id": "long", "url": "string", "host": "string", "html": "string", "row": "long"}
    worth = held.join(node_importance(posts), "key").select(
        "bucket", F.lit(0).alias("side"), "key", "importance", "styles",
        *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()],
    )
    shown = rows.select(
        "bucket", F.lit(1).alias("side"), F.lit(None).cast("long").alias("key"),
        F.lit(None).cast("double").alias("importance"), F.lit(None).cast("long").alias("styles"), *none,
    )
    dealt = worth.union(shown).repartition("bucket").sortWithinPartitions("bucket", "side", "row")
    return dealt.drop("row").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
