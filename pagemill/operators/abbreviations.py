"""Abbreviations of a corpus, by how much more often a full stop follows them than chance has it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A word is an abbreviation if it nearly always has a stop, this share of the time, rather than as often as any word.
STOPPED = 0.99
# Least score, and most abbreviations that a list holds, so that it may be part of a pattern.
MIN_SCORE = 3.0
MOST = 500
SCALE = 6


def stop_counts(df: DataFrame, text: str) -> DataFrame:
    """``word, stopped, plain``: how often each word stands right before a full stop, and how often it does not.

    Words are lower-cased runs without white space that hold letters only, with single stops between; they end at white
    space, so that the stop behind a word is its own. Counts are partial sums before the shuffle.
    """
    runs = F.filter(F.split(F.lower(text), r"[\t-\r ]+"), lambda w: w.rlike(r"^\p{L}+(?:\.\p{L}+)*\.?$"))
    words = df.select(F.explode(runs).alias("run"))
    stopped = F.col("run").endswith(".")
    word = F.when(stopped, F.substring("run", F.lit(1), F.length("run") - 1)).otherwise(F.col("run"))
    return words.groupBy(word.alias("word")).agg(F.count_if(stopped).alias("stopped"), F.count_if(~stopped).alias("plain"))


def _log_likelihood(hits: Column, n: Column, p: Column) -> Column:
    return hits * F.ln(p) + (n - hits) * F.ln(1 - p)


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """``word, stopped, plain, score``: the log ratio of the likelihoods, less for long words, more for stops inside.

    One row of totals is joined to the counts as scalars.
    """
    total = counts.agg(F.sum("stopped").alias("s"), F.sum(F.col("stopped") + F.col("plain")).alias("n"))
    chance = F.lit(total.select(F.col("s") / F.col("n")).scalar())
    n = F.col("stopped") + F.col("plain")
    ratio = 2 * (_log_likelihood(F.col("stopped"), n, F.lit(STOPPED)) - _log_likelihood(F.col("stopped"), n, chance))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    inside = F.length("word") - letters + 1
    return counts.withColumn("score", F.round(ratio * F.exp(-letters.cast("double")) * inside, SCALE))


def learn_abbreviations(df: DataFrame, text: str, min_score: float = MIN_SCORE, most: int = MOST) -> list[str]:
    """The abbreviations of the corpus with the highest scores, at most ``most``."""
    scores = abbreviation_scores(stop_counts(df, text)).where(F.col("score") >= min_score)
    return [r["word"] for r in scores.orderBy(F.desc("score"), "word").limit(most).collect()]
