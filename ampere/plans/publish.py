"""Publishing tabs in chunks, and proving that what was published is what was meant.

A tab is a header line and one line per row, in the tab's order. Lines are written in chunks of
``CHUNK_ROWS``, the unit a spreadsheet takes in one call, one file per chunk:

    <root>/<tab>/v=<version>/chunk=<k>/part-*.txt      {"line": n, "cells": [...]}

Line numbers come from a range-partitioned sort, never from one task; a chunk is bounded, so
it is the unit dealt to the writers. A publish is a new version behind a pointer: readers
see the tab before or after it. ``reconcile`` compares the files with the tab's query by
digest, so one changed, lost or repeated cell shows, not only a row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ampere.functions.cells import CHUNK_ROWS, cell_text, column_name
from ampere.operators.digest import content_digest
from ampere.operators.ordering import ordered_index
from ampere.plans.exports import TAB_ORDER
from ampere.session import configure, remove_path, scratch_path, side_by_side
from ampere.sources import versions

LINE = "line long, cells array<string>"


def _cells(df: DataFrame):
    return F.array(*(cell_text(f.name, f.dataType) for f in df.schema.fields))


def tab_lines(df: DataFrame, order: Sequence[str], scratch: str | None = None) -> DataFrame:
    """Line 0 with the header, then one line per row: (line, cells)."""
    indexed = ordered_index(df, list(order), "_row", scratch=scratch)
    rows = indexed.select((F.col("_row") + 1).alias("line"), _cells(df).alias("cells"))
    header = df.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("line"), F.array(*(F.lit(c.upper()) for c in df.columns)).alias("cells"))
    return rows.unionByName(header)


def publish(frames: Mapping[str, DataFrame], root: str, orders: Mapping[str, Sequence[str]] = TAB_ORDER,
            chunk_rows: int = CHUNK_ROWS) -> dict[str, int]:
    """Write every tab in chunks; returns the data rows written per tab."""
    def write(tab: str) -> int:
        df = frames[tab]
        spark = configure(df.sparkSession)
        scratch, path, version = scratch_path(spark, "publish"), f"{root.rstrip('/')}/{tab}", versions.new_version()
        count = Observation()
        lines = tab_lines(df, orders.get(tab, ()), scratch).withColumn(
            "chunk", F.floor(F.col("line") / chunk_rows))
        (lines.repartition("chunk").sortWithinPartitions("chunk", "line")
              .observe(count, F.count(F.lit(1)).alias("n"))
              .select("chunk", F.to_json(F.struct("line", "cells")).alias("value"))
              .write.partitionBy("chunk").text(f"{path}/v={version}"))
        versions.advance(spark, path, version)
        remove_path(spark, scratch)
        return count.get["n"] - 1

    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    return dict(zip(frames, side_by_side(spark, write, frames)))  # tabs do not depend on each other


def published(spark: SparkSession, root: str, tab: str) -> DataFrame:
    """The lines of a published tab as its files hold them: (chunk, line, cells)."""
    configure(spark)
    path = f"{root.rstrip('/')}/{tab}"
    files = spark.read.schema("value string, chunk string").text(f"{path}/v={versions.current(spark, path)}")
    return files.select(F.col("chunk").cast("long").alias("chunk"),
                        F.from_json("value", LINE, {"mode": "FAILFAST"}).alias("r")).select("chunk", "r.*")


def written_ranges(spark: SparkSession, root: str, tabs: Sequence[str]) -> DataFrame:
    """First and last sheet line and the range of each chunk, as written."""
    def letter(n):
        return reduce(lambda done, k: done.when(n == k, column_name(k)), range(2, 53), F.when(n == 1, "A"))

    parts = []
    for tab in tabs:
        per = published(spark, root, tab).groupBy("chunk").agg(
            F.min("line").alias("lo"), F.max("line").alias("hi"), F.count(F.lit(1)).alias("n"),
            F.max(F.size("cells")).alias("width"))
        parts.append(per.select(
            F.lit(tab).alias("tab"), "chunk", (F.col("lo") + 1).alias("first_line"),
            (F.col("lo") + F.col("n")).alias("last_line"),
            F.concat(F.lit(f"'{tab}'!A"), (F.col("lo") + 1).cast("string"), F.lit(":"), letter(F.col("width")),
                     (F.col("hi") + 1).cast("string")).alias("a1_range")))
    return reduce(DataFrame.unionByName, parts)


def reconcile(spark: SparkSession, root: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Per tab: rows of its query, rows published, and whether header and content are equal.

    Each side is one pass that sums row hashes; only one row per tab and side meets."""
    parts = []
    for tab, df in frames.items():
        wanted = df.select(_cells(df).alias("cells")).agg(*content_digest(["cells"], "n_rows", "d"))
        lines = published(spark, root, tab)
        body = F.col("line") > 0
        got = lines.filter(body).agg(*content_digest(["cells"], "n_published", "g"))
        header = lines.filter(~body).agg(
            F.count(F.lit(1)).alias("heads"), F.max(F.to_json(F.struct("cells"))).alias("head"))
        expected = F.to_json(F.struct(F.array(*(F.lit(c.upper()) for c in df.columns)).alias("cells")))
        one = F.lit(tab).alias("table_name")
        parts.append(wanted.select(one, "n_rows", "d")
                     .join(got.select(one, "n_published", "g"), "table_name")
                     .join(header.select(one, "heads", "head"), "table_name")
                     .select("table_name", "n_rows", "n_published",
                             ((F.col("heads") == 1) & F.col("head").eqNullSafe(expected)).alias("header_equal"),
                             (F.col("d") == F.col("g")).alias("content_equal")))
    return reduce(DataFrame.unionByName, parts)
