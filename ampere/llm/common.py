"""Helpers that several operators share: table access, scratch tables, tidy columns."""

from __future__ import annotations

import gc
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.session import _SCRATCH, remove_path, scratch_path

#: ASCII white space, the complement of the word class ``[^\x20\x09-\x0D]``.
SPACE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read anew on each call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(taken, base: str) -> str:
    """A column name like ``base`` that is not in ``taken`` (names compare without case)."""
    used = {c.lower() for c in taken}
    name = base
    while name.lower() in used:
        name += "_"
    return name


def without(df: DataFrame, names) -> list[Column]:
    """The columns of ``df`` except those an operator is about to add: its own win."""
    drop = {n.lower() for n in names}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in drop]


#: Rows of an Arrow batch. Rows hold texts here: ten thousand of them, the default, would be held
#: several times over outside the heap of each executor.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.sparkContext.getConf().get(key, None) is None:  # the cluster's own setting stays
        spark.conf.set(key, BATCH_ROWS)
    return spark


class Scratch:
    """Intermediate tables in the shared checkpoint folder.

    They cut lineage the way ``checkpoint()`` does, and survive the loss of any executor.
    Shuffle files of the job that wrote a table are removed with it: nobody reads them again.
    ``drop`` removes a table nobody reads any more, ``clear`` all of them; the rest goes when
    the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = small_batches(spark), scratch_path(spark, name), 0

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        with shuffle_files_removed(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove_path(self.spark, t._scratch)

    def clear(self) -> None:
        remove_path(self.spark, self.root)


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Within it, a query's shuffle files go when the query has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_folders() -> set[str]:
    """Folders of scratch tables that are still there."""
    return set(_SCRATCH)


def release(spark: SparkSession, folders: set[str], *still_read: DataFrame) -> None:
    """Remove scratch folders, but those that one of the tables is still read from.

    The driver collects its garbage too: plans and broadcasts of what is over are held by it
    until it does, which a long run of many small jobs may put off (classic sessions only)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    files = [f for df in still_read for f in df.inputFiles()]
    for folder in folders & set(_SCRATCH):
        name = folder.rsplit("/", 1)[1]  # unique; schemes may be spelt in several ways
        if not any(f"/{name}/" in f for f in files):
            remove_path(spark, folder)


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
