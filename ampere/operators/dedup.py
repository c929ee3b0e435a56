"""Duplicate elimination: keep-latest per key, grouped collapse, legacy distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (e.g. newest ``ingested_at``).

    NULL keys group together, as in ``PARTITION BY``. Rows that tie on ``order`` are
    resolved by ``tiebreak`` columns (descending, NULLs last) so reruns pick the same
    row. ``row_number() == 1`` lets Catalyst insert a partial WindowGroupLimit before
    the shuffle, so a key with millions of copies is cut to one row per map task.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys]
    spec = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).desc_nulls_last()
                                                        for c in tiebreak])
    return (df.withColumn("_rn", F.row_number().over(spec))
              .filter(F.col("_rn") == 1).drop("_rn"))


def collapse(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Dedup by aggregation (e.g. MAX(name), AVG(value), MAX(ingested_at) per hour)."""
    return df.groupBy(*keys).agg(*aggs)


def distinct_latest(df: DataFrame, columns: Sequence[str], ts: str = "ingested_at") -> DataFrame:
    """Older dedup: GROUP BY every attribute, MAX(ts). Collapses identical rows only,
    so two different values for one key both survive."""
    return df.groupBy(*columns).agg(F.max(ts).alias(ts))
