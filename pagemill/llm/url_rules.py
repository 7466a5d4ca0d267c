"""Prefix rules for URLs as a sort-merge range join.

A host is written in reverse (``com.example.www.``), so that a host with all its subdomains is one interval of
sorted keys. URLs and rules are dealt to the same key ranges, a rule to every range its interval meets, and
each task sweeps its range in order with a stack of the rules that are open; the intervals are nested, so the
top of the stack is the longest host. Paths are matched at each level of the stack.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.llm.columns import ascii_lower

ROWS_PER_RANGE = 200_000
SAMPLE_PER_RANGE = 4
HASH_STEPS = 1 << 30
# Bounds of what the driver collects and every task gets: ranges, and characters of a host and of a path at a cut.
MAX_RANGES = 1 << 14
CUT_CHARS = 64
RULE_SCHEMA = "host string, path string, verdict string"
# Above every character that a key can hold.
KEY_END = "\U0010ffff"


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels in reverse, each followed by a dot; an empty host has an empty key."""
    labels = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    return F.when(host == "", F.lit("")).otherwise(F.concat(labels, F.lit(".")))


def _cuts(urls: DataFrame) -> list[tuple[str, str, int]]:
    """Keys between ranges, from a sample by hash that is as large as the number of ranges asks for.

    A very common host is cut by path and a common URL by its number, so no key fills a range. Any cuts give the same
    verdicts, so hosts and paths are cut short there, and very many rows make ranges longer instead of more.
    """
    rows = urls.count()
    partitions = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, max(2 * partitions, -(-rows // ROWS_PER_RANGE)))
    wanted = ranges * SAMPLE_PER_RANGE
    keys = urls.select("key", "path", "number")
    if rows > wanted:
        step = F.pmod(F.xxhash64("number", "key", "path"), F.lit(HASH_STEPS))
        keys = keys.where(step < int(HASH_STEPS * wanted / rows) + 1)
    short = keys.select(F.substring("key", 1, CUT_CHARS).alias("key"), F.substring("path", 1, CUT_CHARS).alias("path"), "number")
    sample = sorted((r["key"], r["path"], r["number"]) for r in short.collect())
    return sample[SAMPLE_PER_RANGE // 2 :: SAMPLE_PER_RANGE]


def _deal_urls(cuts: list[tuple[str, str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("key", "path", "number")), strict=True)
            part = pa.array([bisect.bisect_right(cuts, row) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([part, *batch.columns], names=["part", *batch.schema.names])

    return run


def _deal_rules(cuts: list[tuple[str, str, int]]):
    """A rule goes to all ranges that its interval of hosts meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, parts = [], []
            for row, key in enumerate(batch.column("key").to_pylist()):
                low = bisect.bisect_left(cuts, (key,))
                high = bisect.bisect_left(cuts, (key + KEY_END,))
                parts += range(low, high + 1)
                copies += [row] * (high + 1 - low)
            dealt = batch.take(pa.array(copies, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), *dealt.columns], names=["part", *batch.schema.names]
            )

    return run


class _Level:
    """The open rules of one host, by path."""

    def __init__(self, key: str):
        self.key, self.rules, self.lengths = key, {}, []

    def add(self, path: str, rule: tuple[str, str]) -> None:
        # Of equal rules the one that blocks decides.
        if path not in self.rules or rule[1] == "block":
            self.rules[path] = rule
            self.lengths = sorted({len(p) for p in self.rules}, reverse=True)

    def match(self, path: str) -> tuple[str, str] | None:
        return next((self.rules[path[:n]] for n in self.lengths if path[:n] in self.rules), None)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, key and kind, rules first."""
    part, stack = None, []
    for batch in batches:
        ids, rules, verdicts = [], [], []
        for row in batch.to_pylist():
            if row["part"] != part:
                part, stack = row["part"], []
            while stack and not row["key"].startswith(stack[-1].key):
                stack.pop()
            if row["kind"] == 0:
                if not stack or stack[-1].key != row["key"]:
                    stack.append(_Level(row["key"]))
                stack[-1].add(row["path"], (row["rule"], row["verdict"]))
            else:
                found = next((m for level in reversed(stack) if (m := level.match(row["path"]))), (None, None))
                ids.append(row["payload"])
                rules.append(found[0])
                verdicts.append(found[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field("payload").type), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            names=["payload", "rule", "verdict"],
        )


def judge_urls(
    df: DataFrame, rules: DataFrame, id_column: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row, ``id`` under its own name.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains if the path of the URL
    starts with the rule's. The longest host decides, then the longest path; of rules that are equal but for
    the verdict, the one that blocks. Without a fitting rule the verdict is ``default``, and block for a URL
    that has no host at all.

    A NULL URL and one without ``://`` have an empty host and path and fit no rule. Repeated rows are judged alike.
    Rules with a NULL or without a host are left out. URLs of any length are judged whole, other columns are passed over. An empty
    table gives no rows; without rules all verdicts are the default.
    """
    spark = df.sparkSession
    urls = df.select(
        F.col(id_column).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    urls = urls.select("id", "host", "path", host_key(F.col("host")).alias("key"), F.xxhash64("id").alias("number"))
    named = rules.select("host", "path", "verdict").dropna()
    named = named.select(
        host_key(ascii_lower(F.col("host"))).alias("key"),
        "path",
        F.concat(F.col("host"), F.col("path")).alias("rule"),
        "verdict",
    ).distinct().where("key <> ''")
    cuts = _cuts(urls)
    payload = urls.select("key", "path", "number", F.struct("id", "host", "path").alias("payload"))
    kind = payload.schema["payload"].dataType.simpleString()
    left = payload.mapInArrow(_deal_urls(cuts), f"part int, key string, path string, number long, payload {kind}")
    right = named.mapInArrow(_deal_rules(cuts), "part int, key string, path string, rule string, verdict string")
    events = left.select(
        "part", "key", F.lit(1).alias("kind"), "path", "number", "payload",
        *[F.lit(None).cast("string").alias(c) for c in ("rule", "verdict")],
    ).unionByName(right.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    dealt = events.repartition("part").sortWithinPartitions("part", "key", "kind", "path", "number")
    swept = dealt.mapInArrow(_sweep, f"payload {kind}, rule string, verdict string")
    fallback = F.when(F.col("payload.host") == "", F.lit("block")).otherwise(F.lit(default))
    return swept.select(
        F.col("payload.id").alias(id_column), "payload.host", "payload.path", "rule",
        F.coalesce("verdict", fallback).alias("verdict"),
    )
