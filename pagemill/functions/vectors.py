"""Dense vector arithmetic on ARRAY columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_l2(a: Column, b: Column) -> Column:
    def term(x, y):
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return _total(F.zip_with(a, b, term))


def norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def l2_normalize(v: Column) -> Column:
    """Scale to unit length; the zero vector stays as it is."""
    length = norm(v)
    return F.transform(v, lambda x: x.cast("double") / F.when(length > 0, length).otherwise(1.0))


def cosine_distance(a: Column, b: Column) -> Column:
    """One minus the cosine; the cosine with a zero vector counts as 0."""
    return 1.0 - F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
