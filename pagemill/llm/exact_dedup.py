"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest
first; those rows meet the index in a sort-merge anti-join that does not move the index, and
the absent ones are appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.llm.columns import lookup, whole_text
from pagemill.session import scratch_path, written

INDEX_SCHEMA = "digest binary, keep_id bigint, batch string"


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class DigestIndex:
    """Digests seen so far, with the row that stays for each and the batch that brought it."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        """Open the table ``name``, or create it with files in ``path`` and that many buckets.

        The default number of buckets is that of the shuffle partitions, so that a batch and the
        index have the same division.
        """
        self.spark, self.name, self.path = spark, name, path
        if spark.catalog.tableExists(name):
            # An index keeps the division it was created with.
            described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
            self.buckets = int(described["data_type"])
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            self._write(spark.createDataFrame([], INDEX_SCHEMA), "errorifexists")

    def _write(self, entries: DataFrame, mode: str) -> None:
        writer = entries.write.mode(mode).format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
        if self.path:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.name)

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def absent(self, digests: DataFrame) -> DataFrame:
        """The rows whose digest is not in the index yet."""
        return digests.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, entries: DataFrame) -> None:
        # One task per bucket writes one sorted file.
        dealt = entries.select("digest", "keep_id", "batch").repartition(self.buckets, "digest")
        self._write(dealt, "append")


def dedup_batch(
    df: DataFrame, index: DigestIndex, id_column: str = "doc_id", text: str = "text", batch: str | None = None
) -> DataFrame:
    """Judge every row of a batch and add its new texts to the index.

    ``batch`` names the batch. The same batch may be run again, also after a run that ended between the index and the
    answers: what it brought is still its own, nothing is added twice, and the answers are the same. Without a name
    every call is a batch of its own.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` for each row, dropped ones too.
    Of equal texts the largest id stays, unless an earlier batch brought the text: then the
    entry of the index stays and all rows of the batch go. ``group_size`` counts the batch.

    NULL text equals the empty text. Rows without an id stay only where their whole group has
    none. Rows that repeat id and text are one document and get the same answer. An empty table
    gives no rows and adds nothing.
    """
    batch = batch or uuid.uuid4().hex
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), text_digest(whole_text(text)).alias("digest"))
    # Written, or the optimizer would move the anti-join below the aggregation, where a common text is skewed.
    groups = written(
        rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digests"
    )
    index.append(index.absent(groups).withColumn("batch", F.lit(batch)))
    stays = index.entries().select(
        "digest", F.col("keep_id").alias("stays"), (F.col("batch") == batch).alias("is_new")
    )
    answers = groups.select("digest", "group_size").join(stays.hint("merge"), "digest")
    judged = lookup(rows, answers, ["digest"], ["doc_id"])
    return judged.select(
        "doc_id",
        F.col("stays").alias("keep_id"),
        "group_size",
        (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("stays"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup_exact(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One table on its own: :func:`dedup_batch` with a new index in the shared folder."""
    spark = df.sparkSession
    name = f"digest_index_{uuid.uuid4().hex}"
    index = DigestIndex(spark, name, scratch_path(spark, name))
    answers = written(dedup_batch(df, index, id_column, text), "answers")
    spark.sql(f"DROP TABLE {name}")
    return answers
