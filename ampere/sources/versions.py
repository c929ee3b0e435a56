"""Tables that change in one commit: version folders, a manifest each, one pointer.

    <path>/data/v=<version>/ym=YYYY-MM/   months written by that version
    <path>/manifest/v=<version>/          which version holds each month of the table
    <path>/_current/                      one small file per commit, naming its version

A commit writes its months into a folder of its own, then the manifest of the whole table,
then adds the version to the pointer. Readers take the newest version in the pointer and
the months its manifest names, so they see all months of a commit or none, at any moment and
after a crash at any point. Nothing that a reader may hold open is overwritten; ``vacuum``
removes what the latest versions do not name.

A manifest has one row per month (``ym``, ``v``, ``n_rows``, ``first``, ``last``), so it is small, and
a table's row count and its first and latest period are known without a scan.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.session import configure, path_exists, remove_path

PART = "ym"
MANIFEST = "ym string, v string, n_rows long, first string, last string"


class Conflict(RuntimeError):
    """The table has moved on since the commit read it."""


def new_version() -> str:
    """A name that sorts after all earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def advance(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current one. The pointer is only ever added to, one file per
    version, so a reader finds the old or the new version, never half of one."""
    (spark.createDataFrame([(version,)], "version string").coalesce(1)
          .write.mode("append").text(f"{path}/_current"))


def current(spark: SparkSession, path: str) -> str | None:
    """The version readers see, or None before the first commit."""
    if not path_exists(spark, f"{path}/_current"):
        return None
    return spark.read.text(f"{path}/_current").agg(F.max("value")).first()[0]


def manifest(spark: SparkSession, path: str, version: str | None = None) -> list:
    """Rows of the manifest (one per month), of the current version if none is named."""
    version = version or current(spark, path)
    return [] if version is None else (
        spark.read.schema(MANIFEST).parquet(f"{path}/manifest/v={version}").orderBy(PART).collect())


def _files(spark: SparkSession, path: str, schema: T.StructType, months: list) -> DataFrame:
    """The months named by manifest rows: a listing of their versions, pruned to them."""
    whole = T.StructType([*schema.fields, T.StructField("v", T.StringType()), T.StructField(PART, T.StringType())])
    held: dict[str, list[str]] = {}
    for m in months:
        held.setdefault(m.v, []).append(m.ym)
    if not held:
        return spark.createDataFrame([], whole)
    named = reduce(Column.__or__, [(F.col("v") == v) & F.col(PART).isin(yms) for v, yms in held.items()])
    return (spark.read.schema(whole).option("basePath", f"{path}/data")
            .parquet(*(f"{path}/data/v={v}" for v in held)).filter(named))


def read(spark: SparkSession, path: str, schema: T.StructType, version: str | None = None,
         months=None) -> DataFrame:
    """The table at its current (or a named) version with its month column ``ym``; only some
    ``months`` if given. A table without a commit is empty."""
    configure(spark)
    rows = manifest(spark, path, version)
    if months is not None:
        wanted = set(months)
        rows = [r for r in rows if r.ym in wanted]
    return _files(spark, path, schema, rows).drop("v")


def commit(spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType, base: str | None,
           order: str = "period") -> str:
    """Replace the months that occur in ``rows`` (columns of ``schema`` and ``ym``), keep all others.

    ``base`` is the version the rows were made from. If another commit came in between, the
    new version is not published and ``Conflict`` is raised.
    """
    version = new_version()
    folder = f"{path}/data/v={version}"
    (rows.select(*schema.fieldNames(), PART).hint("rebalance", PART)
         .write.partitionBy(PART).parquet(folder))
    whole = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
    written = (spark.read.schema(whole).parquet(folder).groupBy(PART)  # one column is scanned
               .agg(F.count(F.lit(1)).alias("n_rows"), F.min(order).cast("string").alias("first"),
                    F.max(order).cast("string").alias("last")).collect())
    months = {r.ym: (r.ym, r.v, r.n_rows, r["first"], r["last"]) for r in manifest(spark, path, base)} if base else {}
    months |= {r.ym: (r.ym, version, r.n_rows, r["first"], r["last"]) for r in written}
    (spark.createDataFrame(list(months.values()), MANIFEST).coalesce(1)
          .write.parquet(f"{path}/manifest/v={version}"))
    if current(spark, path) != base:
        raise Conflict(f"{path}: version {base} is not the current one any more")
    advance(spark, path, version)
    return version


def stats(spark: SparkSession, path: str) -> tuple[int, str | None, str | None]:
    """Rows, first and latest period of the table, from its manifest alone."""
    rows = manifest(spark, path)
    return (sum(r.n_rows for r in rows), min((r["first"] for r in rows if r["first"]), default=None),
            max((r["last"] for r in rows if r["last"]), default=None))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove data that none of the latest ``keep`` versions names; returns the versions removed.

    Folders newer than the current version may belong to a running commit and stay."""
    if not path_exists(spark, f"{path}/_current"):
        return []
    known = sorted(r.value for r in spark.read.text(f"{path}/_current").distinct().collect())
    used = set(known[-keep:])
    for v in known[-keep:]:
        used |= {r.v for r in manifest(spark, path, v)}
    folders = {f.rsplit("/v=", 1)[1] for f in _children(spark, f"{path}/data")}
    gone = sorted(v for v in folders if v not in used and v < known[-1])
    for v in gone:
        remove_path(spark, f"{path}/data/v={v}")
    return gone


def _children(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in fs.listStatus(p) if "/v=" in s.getPath().toString()]
