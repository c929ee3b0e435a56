"""Quality-check building blocks: counts, freshness, coverage, status reports.

All checks are aggregates returning small report DataFrames (check, status,
detail ...). Raising on failure is a separate, explicit step (``require``) that
pulls only the report rows to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


def freshness(df: DataFrame, name: str, latest: Column) -> DataFrame:
    """One row: (table_name, n_rows, latest) with latest rendered as text."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), latest.cast("string").alias("latest")) \
             .select(F.lit(name).alias("table_name"), "n_rows", "latest")


def freshness_report(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    parts = [freshness(df, name, latest) for name, (df, latest) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def status(ok: Column, warn_only: bool = False) -> Column:
    return F.when(ok, F.lit(PASS)).otherwise(F.lit(WARN if warn_only else FAIL))


def nonempty_report(report: DataFrame) -> DataFrame:
    """PASS when a table has rows (the check's detail keeps count and latest)."""
    return report.select(
        "table_name",
        status(F.col("n_rows") > 0).alias("status"),
        F.concat(F.col("n_rows").cast("string"), F.lit(" rows up to "),
                 F.coalesce(F.col("latest"), F.lit("nothing"))).alias("detail"))


def count_rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [count_rows(df, n) for n, df in tables.items()])


def require(report: DataFrame, ok_col: str = "status", failing: Sequence[str] = (FAIL,)) -> DataFrame:
    """Raise if any report row is failing; the report is small by construction."""
    bad = report.filter(F.col(ok_col).isin(*failing)).collect()
    if bad:
        raise RuntimeError(f"quality check failed: {[r.asDict() for r in bad]}")
    return report
