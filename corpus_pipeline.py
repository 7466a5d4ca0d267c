"""Documents to packed training sequences, one written table per stage.

NULL and empty texts fail the quality rules. Rows that repeat id and text pass them alike and are one row after near dedup; rows
that repeat an id with another text stay if their texts are kept. Columns beside those used pass through all stages but the last. A table
without rows gives no sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagemill.llm.line_dedup import drop_repeated_lines
from pagemill.llm.mixing import mix_sources
from pagemill.llm.near_dedup import near_duplicates
from pagemill.llm.packing import pack_documents
from pagemill.llm.quality import judge_quality
from pagemill.session import table, written

# Targets of the mixture: present shares to these powers, and the share of all tokens to sample.
MIX_POWERS = {"source": 0.85, "lang": 0.85, "topic": 1.0}
MIX_BUDGET = 0.9
# Near duplicates share this many percent of their windows of so many words.
NEAR_WORDS, NEAR_SIMILARITY = 5, 80
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = judge_quality(docs, table(spark, sf_dir, "labels"))
    # As a generated row the verdict is computed before the filter; else the filter would compute it a second time.
    generated = judged.select(F.inline(F.array(F.struct("input", "kept"))))
    return generated.where("kept").select("input.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; ``n_chars`` follows the text. Every document stays, even an empty one."""
    cut, changed = drop_repeated_lines(docs), F.col("n_dropped") > 0
    new = {
        "text": F.when(changed, F.col("kept")).otherwise(F.col("input.text")),
        "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("input.n_chars")),
    }
    return cut.select(*[new.get(c, F.col(f"input.{c}")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and one row of those that repeat id and text."""
    judged = near_duplicates(docs, size=NEAR_WORDS, similarity=NEAR_SIMILARITY)
    gone = judged.where("not kept").select(F.col("doc_id").alias("gone_id"))
    docs = docs.join(gone.distinct(), F.col("doc_id") == F.col("gone_id"), "left_anti")
    copies = docs.groupBy("doc_id", F.xxhash64("text")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return docs if copies.isEmpty() else docs.dropDuplicates(["doc_id", "text"])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that token shares approach the target mixture."""
    judged = mix_sources(docs, budget=MIX_BUDGET, powers=MIX_POWERS, tokenizer=TOKENIZER)
    gone = judged.where("not kept").select(F.col("row").alias("gone_row")).distinct()
    row = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    return docs.join(gone, row == F.col("gone_row"), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in its training sequence."""
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("source mixing", mixing),
    ("best-fit packing", packing),
]

# Hashed n-grams and tokenizers have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
