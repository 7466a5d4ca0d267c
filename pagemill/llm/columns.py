"""Column helpers and the skew-safe lookup shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

# The white space and the letters of the contracts.
WHITE = " \t\n\x0b\x0c\r"
NO_WHITE = r"[^\x20\x09-\x0D]"
WHITE_RUN = r"[\x20\x09-\x0D]+"
# Bits of one bitmap of Spark; sizes of bitmaps are multiples of it.
BITMAP_ROW = 32768
# A hot key is dealt to this many groups.
SALTS = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Without it the optimizer may move the expression into a lambda, where it would be
    computed for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(text: str) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words_of(text: Column, separator: str = WHITE_RUN) -> Column:
    """The words between the separators; none of them is empty."""
    return F.filter(F.split(text, separator), lambda word: word != "")


def salt_of(*names: str) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(SALTS)).cast("int")


def lookup(
    rows: DataFrame, answers: DataFrame, key: Sequence[str], salt_by: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join any number of rows per key with the one answer of the key.

    Rows are dealt by key and salt. The salts in which a key occurs are found with a
    pre-aggregation, so that an answer is copied to at most ``SALTS`` groups and a key with a third
    of all rows is spread over as many tasks. Key columns must not be NULL.
    """
    salted = rows.withColumn("_salt", salt_of(*salt_by))
    present = salted.select(*key, "_salt").distinct()
    dealt = present.join(answers, list(key))
    return salted.join(dealt, [*key, "_salt"], how).drop("_salt")


def member_bitmap(bits: DataFrame, size: int) -> np.ndarray:
    """Bytes whose bits tell which numbers below ``size`` the column ``bit`` holds.

    The driver gets at most ``size / 8`` bytes, whatever the rows; see :func:`is_member`.
    """
    counted = bits.select((F.col("bit") + 1).alias("bit"))
    rows = counted.groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bitmap")
    )
    whole = np.zeros((size // BITMAP_ROW, BITMAP_ROW // 8), dtype=np.uint8)
    for bucket, bitmap in rows.collect():
        # Buckets count from 1.
        whole[bucket - 1] = np.frombuffer(bitmap, dtype=np.uint8)
    return whole.ravel()


def is_member(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)
