"""Keyed upsert (MERGE: matched -> replace all non-key columns, unmatched -> insert).

Plain Parquet has no row-level MERGE, so the merged table is
``target LEFT ANTI JOIN source ON keys  UNION ALL  source``:

* the source row wins even where it carries NULLs (last run wins, not newest row);
* with ``null_safe=False`` (the SQL default) a NULL key never matches, so such rows
  are inserted again by every run, exactly like ``MERGE ... ON a = b``;
* running the same source twice leaves the table unchanged for non-NULL keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           null_safe: bool = False) -> DataFrame:
    src_keys = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    conds = [(F.col(k).eqNullSafe(F.col(f"_k_{k}")) if null_safe
              else F.col(k) == F.col(f"_k_{k}")) for k in keys]
    kept = target.join(src_keys, reduce(lambda a, b: a & b, conds), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def touched_partitions(target: DataFrame, source: DataFrame, part_col: str) -> DataFrame:
    """Target rows that share a partition value with the source batch.

    Only these partitions can change in an upsert when the partition column is a
    function of the key (month of the period), so only these are rewritten.
    """
    parts = source.select(part_col).distinct()
    return target.join(parts, part_col, "left_semi")
