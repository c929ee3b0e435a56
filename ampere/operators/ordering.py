"""Global row numbers without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into one
task. Instead: range-partition and sort (distributed), tag rows with their partition
and in-partition position, materialise once (a scratch table in the shared folder, so
positions are stable if a task is re-run), then add each partition's offset from a table
with one row per partition (bounded by the partition count, safe to broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.session import scratch_path

POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | record number


def ordered_index(df: DataFrame, order: Sequence[Column | str], index_col: str = "row_index",
                  scratch: str | None = None) -> DataFrame:
    """Attach a 0-based position in ``order`` (ties keep an arbitrary stable order).

    The tagged rows are written to ``scratch``, which the caller may remove when the result
    has been used (by default a folder that goes when the driver ends)."""
    tagged = (df.orderBy(*order) if order else df).withColumn(
        "_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", POS_BITS))
    path = scratch or scratch_path(df.sparkSession, "ordered")
    tagged.write.parquet(path)
    tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    running = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    joined = tagged.join(F.broadcast(offsets.select("_pid", "_first", "_offset")), "_pid")
    return (joined.withColumn(index_col, F.col("_offset") + F.col("_mid") - F.col("_first"))
                  .drop("_mid", "_pid", "_first", "_offset"))
