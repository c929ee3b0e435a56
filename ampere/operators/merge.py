"""MERGE that tells what happened to each row, without moving keyless rows.

Matched rows take the source's values, unmatched ones of either side stay: one full outer
join on the keys yields the merged table and, from the same join, the effect on each row:

=============  ===============================================================
kept           in the target only
inserted       in the source only
replaced       in both, another value
unchanged      in both, equal but for the load stamp (the source's row is taken)
reinserted     a source row with a NULL key: it never matches, and is added by every run
=============  ===============================================================

Rows whose key holds a NULL cannot match. They are split off both sides before the join,
so a group of such rows, which grows with every run, is never shuffled.

Other keys must be unique on either side (staged rows are), as MERGE demands.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EFFECTS = ("kept", "inserted", "replaced", "unchanged", "reinserted")
EFFECT = "_effect"


def has_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
          stamp: Sequence[str] = ("ingested_at",), effect: str = EFFECT) -> DataFrame:
    """The merged table (columns of ``target``) with one of ``EFFECTS`` per row."""
    columns = target.columns
    keyed = has_key(keys)
    t = target.filter(keyed).select(*(F.col(c).alias(f"_t_{c}") for c in columns), F.lit(True).alias("_t"))
    s = source.filter(keyed).select(*(F.col(c).alias(f"_s_{c}") for c in columns), F.lit(True).alias("_s"))
    both = t.join(s, reduce(Column.__and__, [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys]), "full_outer")
    values = [c for c in columns if c not in keys and c not in stamp]
    same = reduce(Column.__and__, [F.col(f"_t_{c}").eqNullSafe(F.col(f"_s_{c}")) for c in values], F.lit(True))
    what = (F.when(F.col("_s").isNull(), "kept").when(F.col("_t").isNull(), "inserted")
            .when(same, "unchanged").otherwise("replaced"))
    merged = both.select(*(F.when(F.col("_s").isNull(), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c)
                           for c in columns), what.alias(effect))
    return (merged.unionByName(target.filter(~keyed).withColumn(effect, F.lit("kept")))
            .unionByName(source.filter(~keyed).select(*columns).withColumn(effect, F.lit("reinserted"))))


def effect_counts(effect: str = EFFECT) -> list[Column]:
    """Aggregates that count each effect, for ``agg`` or ``observe``."""
    return [F.count_if(F.col(effect) == e).alias(e) for e in EFFECTS]
