"""Human-readable sizes, durations and timestamps."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def one_decimal(value: Column) -> Column:
    """Format with one decimal, rounding the exact binary value, ties to even.

    Java's formatter rounds the shortest decimal text instead and so prints 0.4 for
    0.35 (which is a little below 0.35). ``value * 10`` is split into a rounded
    product and its exact error, and the error decides on an apparent tie.
    """
    x = F.abs(value.cast("double"))
    product = x * 10.0
    high = x * 134217729.0 - (x * 134217729.0 - x)
    error = (high * 10.0 - product) + (x - high) * 10.0
    tie = product - F.floor(product) == 0.5
    tenths = F.rint(F.when(tie, product + 0.25 * F.signum(error)).otherwise(product))
    # A decimal prints its one digit itself; the general formatter is many times slower.
    shown = (tenths.cast("decimal(20,0)") * F.lit(Decimal("0.1"))).cast("string")
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), shown)


def file_size(size_bytes: Column) -> Column:
    """``0 B``, ``512.0 B``, ``1.2 KB`` ... up to TB."""
    units = ["B", "KB", "MB", "GB", "TB"]

    def step(value_of) -> Column:
        chosen = F.when(size_bytes < 1024, value_of(0))
        for power in range(1, len(units) - 1):
            chosen = chosen.when(size_bytes < 1024 ** (power + 1), value_of(power))
        return chosen.otherwise(value_of(len(units) - 1))

    # The unit is chosen first and the number formatted once, outside any branch, so that
    # its repeated parts are computed once.
    scaled = size_bytes.cast("double") / step(lambda power: F.lit(float(1024**power)))
    text = F.concat(one_decimal(scaled), F.lit(" "), step(lambda power: F.lit(units[power])))
    return F.when(size_bytes == 0, F.lit("0 B")).otherwise(text)


def duration(seconds: Column) -> Column:
    """Seconds below one minute, minutes below one hour, else hours."""
    def step(second, minute, hour) -> Column:
        return (
            F.when(seconds < 60, F.lit(second))
            .when(seconds < 3600, F.lit(minute))
            .otherwise(F.lit(hour))
        )

    return F.concat(one_decimal(seconds / step(1.0, 60.0, 3600.0)), step("s", "m", "h"))


def compact_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def iso_timestamp(ts: Column) -> Column:
    """ISO 8601 with microseconds, which are left out where they are zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(ts == F.date_trunc("second", ts), whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def report_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def session_id(ts: Column) -> Column:
    return F.concat(F.lit("session_"), compact_timestamp(ts))
