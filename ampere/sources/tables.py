"""Access to the generated parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampere.session import configure


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; listing the needed columns keeps ReadSchema narrow.

    The relation is resolved on every call, so rows appended since are seen. Scan splits
    and shuffles are left to Spark at every size.
    """
    configure(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
