"""Row numbers inside groups of any size.

``row_number() over (partition by g order by o)`` puts a whole group into one task,
which fails when one group holds a third of all rows, or when there is no group at
all. Here only the keys ``(g, o)`` are sorted, by range partitioning, and written with their place in the
order. A key's number is its place in its range, less the place where its group begins there, plus the
rows of the group in earlier ranges: prefix sums of one count per range and group, at most
one row per range for any single group. The rows themselves are moved once, to meet the number of their key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pagemill.session import written

# Places are numbered by partition in their upper bits and by row in these.
ROW_BITS = 33


def sorted_places(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``_key, _group, _place, _range`` of every row; places ascend with the keys, ranges are the partitions of the sort.

    As structs, key and group compare equal to themselves even where a column is NULL.
    """
    keys = df.select(F.struct(*groups, *order).alias("_key"), F.struct(*groups, F.lit(0)).alias("_group"))
    by_range = keys.repartitionByRange("_key").sortWithinPartitions("_key")
    places = written(by_range.withColumn("_place", F.monotonically_increasing_id()), "places")
    return places.withColumn("_range", F.shiftright("_place", ROW_BITS))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    number: str = "row_no",
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based position of each row inside its group, and the group's size.

    ``(partition_by, order_by)`` has to be unique for a numbering that is the same on every run; rows that
    share a key get consecutive numbers in any order.
    """
    places = sorted_places(df, partition_by, order_by)
    counts = places.groupBy("_group", "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_group",
        "_range",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("_total"),
    )
    # Equal keys lie together, so the first of their numbers tells the others.
    numbers = places.join(offsets, ["_group", "_range"]).groupBy("_key").agg(
        F.min(F.col("_place") + F.col("_shift")).alias("_before"), F.first("_total").alias("_total")
    )
    # The join has the key of this window, so the rows are shuffled once.
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    keyed = df.withColumn("_key", F.struct(*partition_by, *order_by)).withColumn("_nth", nth)
    joined = keyed.join(numbers, "_key")
    result = [*[F.col(c) for c in df.columns], (F.col("_before") + F.col("_nth")).alias(number)]
    if total:
        result.append(F.col("_total").alias(total))
    return joined.select(*result)
