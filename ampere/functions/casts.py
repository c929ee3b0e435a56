"""Lenient casts with warehouse SAFE_CAST semantics (bad text -> NULL, never an error)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain decimal or scientific notation only. Spark's own cast also accepts
# suffixes such as "12f"/"12d" and the words NaN/Infinity; those become NULL here.
_FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INT_TEXT = r"^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c) -> Column:
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(_FLOAT_TEXT), text.try_cast("double"))


def safe_bigint(c) -> Column:
    """'12' -> 12; '12.0', '1,234', 'w' -> NULL; out of range -> NULL."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(_INT_TEXT), text.try_cast("bigint"))


def safe_divide(a, b) -> Column:
    """NULL when the divisor is 0 or NULL (no ANSI divide-by-zero error)."""
    return F.try_divide(_col(a), F.nullif(_col(b), F.lit(0)))


NOISE_DIGITS = 10


def stable_round(c, digits: int) -> Column:
    """Round half-up to ``digits`` after first rounding to 10 places.

    Sums of floats differ in their last bits between engines and summation orders.
    A mean of 2-decimal values can be an exact decimal tie (x.xxxxxx5); the noise
    then puts one engine's double just below the tie and another's just above it.
    Rounding to 10 places first removes that noise, so ties resolve alike.
    """
    return F.round(F.round(_col(c), NOISE_DIGITS), digits)


PUBLISHED_DIGITS = 6


def published(df: DataFrame, digits: int = PUBLISHED_DIGITS) -> DataFrame:
    """Every double column rounded to the export's precision."""
    cols = [stable_round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
