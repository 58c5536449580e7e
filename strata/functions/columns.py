"""Column expressions shared by the transforms. All built-in, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: discount applied to the silver sales price.
DISCOUNT_FACTOR = 0.9


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: Column | str, scale: int = 2) -> Column:
    """Round like the reference engine: ``round(x * 10^s) / 10^s`` with ties
    away from zero, on the binary double value.

    Spark's ``round`` rounds the decimal text of the double instead, so
    ``round(1.015, 2)`` is 1.02 there and 1.01 here. NaN, infinities and
    values too large to carry a fraction are returned unchanged.
    """
    x = col(c)
    m = float(10**scale)
    scaled = F.abs(x) * F.lit(m)
    whole = F.floor(scaled).cast(T.DoubleType())
    nearest = F.when(scaled - whole >= F.lit(0.5), whole + F.lit(1.0)).otherwise(whole)
    return (
        F.when(x.isNull(), F.lit(None).cast(T.DoubleType()))
        .when(F.isnan(x) | (scaled >= F.lit(2.0**52)), x)
        .otherwise(F.signum(x) * nearest / F.lit(m))
    )


def mean_ticket(total: str, n: str) -> Column:
    """Mean of ``n`` unrounded prices with sum ``total``, rounded to the cent.

    The mean is first rounded to nine decimals, which removes the trace that
    the order of a double sum leaves, so a half-cent tie rounds the same way
    however the rows were partitioned. NaN, infinite and huge means are
    passed through, as a plain average would give them.
    """
    mean = F.col(total) / F.col(n).cast(T.DoubleType())
    return F.when(F.col(n) > F.lit(0), round_half_away(round_half_away(mean, 9), 2))


def integral_from_text(c: Column | str, dtype: T.DataType = T.LongType()) -> Column:
    """Whole-number text to an integral type, strictly.

    ``"52"`` and ``"52.0"`` (how float-typed writers print whole numbers)
    both give 52; empty text is NULL; anything else (``"52.5"``, ``"abc"``)
    fails the batch through the ANSI cast. Plain integers take the fast
    path (one ``try_cast``).
    """
    text = F.trim(col(c).cast(T.StringType()))
    direct = text.try_cast(dtype)
    as_double = text.try_cast(T.DoubleType())
    whole = as_double.isNotNull() & (as_double == F.floor(as_double)) & (F.abs(as_double) < F.lit(2.0**53))
    return (
        F.when(text.isNull() | (text == F.lit("")), F.lit(None).cast(dtype))
        .when(direct.isNotNull(), direct)
        .when(whole, as_double.cast(dtype))
        .otherwise(text.cast(dtype))
    )


def month_start(c: Column | str) -> Column:
    """First day of the month as a DATE (timestamps are cast to date first)."""
    return F.trunc(col(c).cast(T.DateType()), "month")


def discounted(price: Column | str, factor: float = DISCOUNT_FACTOR) -> Column:
    return col(price) * F.lit(float(factor))


def source_file_name() -> Column:
    """Base name of the file a row was read from (file-based sources only)."""
    return F.col("_metadata.file_name")


def is_missing(c: Column | str, dtype: T.DataType) -> Column:
    """NULL, and for floating columns also NaN: both count as missing."""
    x = col(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()
