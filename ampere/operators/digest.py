"""A digest of a table's content that does not depend on the order of its rows.

Rows are hashed where they lie; counts and sums of the hashes are partial aggregates, so
tables of any size are compared by one row each. Two 64-bit hashes of different seeds are
summed as 38-digit decimals: a changed, missing or repeated row changes the digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hashes(columns: Sequence[str | Column]) -> tuple[Column, Column]:
    """Null and empty values differ: each column is hashed with its null flag."""
    cols = [c if isinstance(c, Column) else F.col(c) for c in columns]
    parts = [x for c in cols for x in (c.isNull(), c)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(7919), *parts)


def content_digest(columns: Sequence[str | Column], n_rows: str = "n_rows", digest: str = "digest") -> list[Column]:
    """Aggregates: number of rows and digest text (of no rows: ``0:0``)."""
    a, b = (F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string") for h in row_hashes(columns))
    return [F.count(F.lit(1)).alias(n_rows), F.concat_ws(":", a, b).alias(digest)]
