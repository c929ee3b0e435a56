"""Declared schemas of the raw and staging layers (idempotent set-up: a table that
does not exist yet reads as an empty DataFrame of its schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW = _schema(("payload", S), ("source_file", S), ("ingested_at", TS))
STAGING = {
    "retail": _schema(("period", S), ("state_id", S), ("state_name", S), ("sector_id", S),
                      ("sector_name", S), ("price_cents_kwh", D), ("sales_mwh", D),
                      ("customers", L), ("ingested_at", TS)),
    "generation": _schema(("period", S), ("state_id", S), ("fuel_type_code", S),
                          ("fuel_type_desc", S), ("generation_mwh", D), ("ingested_at", TS)),
    "demand": _schema(("period", TS), ("region_id", S), ("region_name", S), ("demand_mwh", D),
                      ("ingested_at", TS)),
}


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.parquet(path).select(*schema.fieldNames())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
