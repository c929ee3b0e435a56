"""Landing files (one folder per dataset-month) and the raw load that reads them.

Layout: ``<root>/raw/<dataset>/year=YYYY/month=MM/`` holding gzipped JSON text.
Writers emit JSON Lines (one record per line, several part files per month); the
reader also accepts files whose line is one JSON array of records (the layout the
source pipeline's object store holds), so both land in the same raw table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.session import configure
from ampere.sources.bindings import DATASET_FOLDERS

RECORDS_PER_FILE = 2_000_000


def dataset_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/raw/{DATASET_FOLDERS.get(dataset, dataset)}"


def split_by_month(records: DataFrame, period: str = "period") -> DataFrame:
    """Attach year/month from the first 7 characters of the period; shorter periods
    (and NULL) are dropped."""
    p = F.col(period).cast("string")
    return (records.filter(F.length(p) >= 7)
            .withColumn("year", F.substring(p, 1, 4))
            .withColumn("month", F.substring(p, 6, 2)))


def month_counts(records: DataFrame, period: str = "period") -> DataFrame:
    """Records per YYYY-MM of a pull (what each landing file will hold)."""
    split = split_by_month(records, period)
    return (split.groupBy(F.concat_ws("-", "year", "month").alias("ym"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def write_landing(payloads: DataFrame, root: str, dataset: str,
                  records_per_file: int = RECORDS_PER_FILE) -> str:
    """Overwrite only the months present in ``payloads`` (dynamic partition overwrite):
    a month with no records is never written, so its previous file survives.

    The rebalance lets AQE split a large month by its measured size and join small ones."""
    configure(payloads.sparkSession)
    split = split_by_month(payloads)
    path = dataset_path(root, dataset)
    (split.hint("rebalance", "year", "month")
          .select("year", "month", F.col("payload").alias("value"))
          .write.mode("overwrite").partitionBy("year", "month")
          .option("maxRecordsPerFile", records_per_file)
          .option("compression", "gzip").text(path))
    return path


def month_filter(months: Sequence[date]) -> Column:
    keys = [f"{m:%Y-%m}" for m in months]
    return F.concat_ws("-", F.col("year"), F.col("month")).isin(*keys)


def parsed_lines(line: Column) -> Column:
    """The records of a landed line, which is one record or one array of records.

    A cut-off array, or one spread over several lines, raises instead of losing records."""
    text = F.trim(line)
    return F.when(text.startswith("["), F.from_json(text, "array<string>", {"mode": "FAILFAST"})) \
            .otherwise(F.array(text))


def read_landing(spark: SparkSession, root: str, dataset: str,
                 months: Sequence[date] | None = None) -> DataFrame:
    """Records of the chosen months (partition-pruned; a missing month is no rows)."""
    configure(spark)
    df = spark.read.text(dataset_path(root, dataset))
    if months is not None:
        df = df.filter(month_filter(months))
    return (df.select(F.explode(parsed_lines(F.col("value"))).alias("payload"),
                      F.col("_metadata.file_path").alias("_path"), "year", "month")
              .select("payload", F.expr("substring(_path, instr(_path, 'raw/'))").alias("source_file"),
                      "year", "month")
              .filter(F.col("payload").isNotNull() & (F.length("payload") > 0)))


def load_raw(spark: SparkSession, root: str, dataset: str, months: Sequence[date] | None,
             ingested_at: str) -> DataFrame:
    """Raw rows (payload, source_file, ingested_at) for one load; one timestamp per load."""
    return read_landing(spark, root, dataset, months).select(
        "payload", "source_file", F.lit(ingested_at).cast("timestamp_ntz").alias("ingested_at"))


def file_inventory(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Files and bytes per landed month, from the listing alone: no file is opened."""
    configure(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
             .load(dataset_path(root, dataset)).select("year", "month", "path", "length", "modificationTime"))
    return files.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"),
        F.max("modificationTime").alias("landed_at"))


def landed_months(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Inventory: months that have at least one record, with their file count."""
    df = read_landing(spark, root, dataset)
    return (df.groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.count_distinct("source_file").alias("n_files")))
