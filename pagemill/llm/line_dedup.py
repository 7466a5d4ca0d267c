"""Line deduplication with per-document keep bitmaps.

Lines become 16-byte hashes of their keys. The hashes are dealt by range, hot ones split by a
salt of the document, and sorted by document and position inside a range; streaming over that
order yields the first occurrence of every (line, document), and partial counts of those
decide which lines repeat. What returns to a document is a run-length coded bitmap of its dropped
lines, never text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.llm.columns import WHITE, ascii_lower, let, salt_of, whole_text
from pagemill.session import written

MIN_LENGTH = 40
MIN_DOCUMENTS = 5


def line_keys(text: Column) -> Column:
    """The lines of a text; an empty text is one empty line."""
    return F.split(text, "\n", -1)


def _occurrences(documents: DataFrame, min_length: int) -> DataFrame:
    """``key, _salt, doc, row, line``: every line that is long enough to be judged."""
    lines = documents.select("doc", "row", F.posexplode(line_keys(F.col("text"))).alias("line", "value"))
    trimmed = lines.select("doc", "row", "line", F.btrim("value", F.lit(WHITE)).alias("value"))
    return trimmed.where(F.length("value") >= min_length).select(
        F.unhex(F.md5(ascii_lower(F.col("value")))).alias("key"), salt_of("doc").alias("_salt"), "doc", "row", "line"
    )


def _runs(lines: Column) -> Column:
    """Sorted line numbers as runs ``(first, last)``."""
    def build(numbers: Column) -> Column:
        starts = F.filter(numbers, lambda x, i: (i == 0) | (F.get(numbers, i - 1) != x - 1))
        ends = F.filter(numbers, lambda x, i: (i == F.size(numbers) - 1) | (F.get(numbers, i + 1) != x + 1))
        return F.arrays_zip(starts.alias("first"), ends.alias("last"))

    return let(F.array_sort(lines), build)


def keep_bitmaps(documents: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``doc, row, dropped``: the dropped lines of each document that loses any, as runs.

    ``documents`` has ``doc``, ``row`` (tells rows of one id apart) and ``text``.
    """
    order = [F.col("doc").desc_nulls_last(), "row", "line"]
    # Written once: the range cuts, the stream and the way back to the documents all read the hashes.
    dealt = (
        written(_occurrences(documents, min_length), "line_hashes")
        .repartitionByRange("key", "_salt")
        .sortWithinPartitions("key", "_salt", *order)
    )
    stream = Window.partitionBy("key", "_salt").orderBy(*order)
    first = (F.row_number().over(stream) == 1) | ~F.lag("doc").over(stream).eqNullSafe(F.col("doc"))
    firsts = dealt.withColumn("first", first).where("first")
    repeated = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("keeper"))
    repeated = repeated.where(F.col("n") >= min_documents).select("key", "keeper")
    # At most one row per salt and key, so the verdict reaches a hot key in many tasks.
    verdicts = firsts.select("key", "_salt").distinct().join(repeated, "key")
    losers = dealt.join(verdicts, ["key", "_salt"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    # Rows that repeat id and text name the same lines, each of which counts once.
    return losers.groupBy("doc", "row").agg(_runs(F.collect_set("line")).alias("dropped"))


def _kept_text(lines: Column, runs: Column) -> Column:
    """The lines outside the runs, joined; linear in the number of lines."""
    def build(parts: Column) -> Column:
        def gap(k: Column) -> Column:
            after = F.when(k == 0, F.lit(-1)).otherwise(F.get(parts["runs"], k - 1)["last"])
            until = F.when(k == F.size(parts["runs"]), F.size(parts["lines"])).otherwise(
                F.get(parts["runs"], k)["first"]
            )
            return F.slice(parts["lines"], after + 2, until - after - 1)

        gaps = F.transform(F.sequence(F.lit(0), F.size(parts["runs"])), gap)
        return F.array_join(F.flatten(gaps), "\n")

    return let(F.struct(lines.alias("lines"), runs.alias("runs")), build)


def drop_repeated_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """The rows of ``df`` with repeated lines removed: ``input, n_lines, n_dropped, kept``.

    ``input`` holds the unchanged row as a struct, so no name of an extra column clashes.
    A line's key is the line stripped of white space, with A-Z in lower case. Keys of at least
    ``min_length`` characters found in ``min_documents`` documents stay only in the largest id.

    NULL text counts as empty, an empty text as one empty line. Rows with the same id count as
    one document; rows without an id count as one document below all others. Repeated rows get
    the same answer each. An empty table gives no rows.
    """
    rows = df.select(
        F.struct("*").alias("input"), F.col(id_column).alias("doc"), whole_text(text).alias("text")
    ).withColumn("row", F.xxhash64("text"))
    bitmaps = keep_bitmaps(rows.select("doc", "row", "text"), min_length, min_documents)
    bitmaps = bitmaps.select(F.col("doc").alias("of"), F.col("row").alias("of_row"), "dropped")
    joined = rows.join(bitmaps, F.col("doc").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    lengths = F.transform("dropped", lambda run: run["last"] - run["first"] + 1)
    lost = F.aggregate(lengths, F.lit(0), lambda total, n: total + n)
    kept = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        _kept_text(line_keys(F.col("text")), F.col("dropped"))
    )
    return joined.select(
        "input",
        F.size(line_keys(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
