"""Flat-export cell formatting: every value becomes the text a spreadsheet cell gets."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.functions.casts import stable_round

# Fixed values of the export format.
TEXT_COLUMNS = ("period", "state_id", "sector_id", "region_id")  # forced to text with a leading '
CHUNK_ROWS = 20_000                                               # rows per write call
FLOAT_DIGITS = 6                                                  # floats rounded to 6 places


def column_name(position: int) -> str:
    """Spreadsheet name of the column at a 1-based position: A, ..., Z, AA, AB, ...

    Names of one length are the numbers of so many base-26 places, in order.
    """
    places, index = 1, position - 1
    while index >= 26 ** places:
        index -= 26 ** places
        places += 1
    return "".join(string.ascii_uppercase[index // 26 ** p % 26] for p in reversed(range(places)))


def float_text(c: Column, digits: int = FLOAT_DIGITS) -> Column:
    """Round half-up to ``digits`` and print without exponent or trailing zeros."""
    fixed = stable_round(c, digits).try_cast(f"decimal(38,{digits})").cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(fixed, r"0+$", ""), r"\.$", "")
    # Values too wide for the decimal keep Spark's own text rather than becoming blank.
    return F.coalesce(F.when(trimmed == "-0", F.lit("0")).otherwise(trimmed), c.cast("string"))


def cell_text(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if name in TEXT_COLUMNS:
        text = F.concat(F.lit("'"), c.cast("string"))
    elif isinstance(dtype, T.BooleanType):
        text = F.when(c.isNull(), F.lit(None)).when(c, F.lit("TRUE")).otherwise(F.lit("FALSE"))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = float_text(c)
    elif isinstance(dtype, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def format_cells(df: DataFrame, upper_headers: bool = True) -> DataFrame:
    """One projection over the schema: typed columns -> cell text, headers upper-cased."""
    cols = [cell_text(f.name, f.dataType).alias(f.name.upper() if upper_headers else f.name)
            for f in df.schema.fields]
    return df.select(*cols)
