"""Trailing-row statistics and z-score anomaly flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """0 when the deviation is 0 or undefined, else (x - mean) / std."""
    return (F.when(std.isNull() | (std == 0), F.lit(0.0))
            .otherwise(F.try_divide(value - mean, std)))


def rolling_zscore(df: DataFrame, partition: Sequence[str], order: str, value: str,
                   rows: int = 12, threshold: float = 2.5, mean_col: str = "rolling_avg_12m",
                   std_col: str = "rolling_std_12m", z_col: str = "z_score",
                   flag_col: str = "is_anomaly") -> DataFrame:
    """Mean and sample deviation over the last ``rows`` rows (current row included),
    z-score against them and a two-sided ``|z| > threshold`` flag.

    The frame counts rows, not calendar months, so a gap stretches it and early rows
    use fewer values. Both aggregates share one window spec: one exchange, one sort.
    The partition is one series (a state); after keep-latest it holds one row per
    period, so a task's buffer is bounded by the number of periods.
    """
    spec = Window.partitionBy(*partition).orderBy(order).rowsBetween(-(rows - 1), 0)
    x = F.col(value)
    out = (df.withColumn(mean_col, F.avg(x).over(spec))
             .withColumn(std_col, F.stddev_samp(x).over(spec)))
    out = out.withColumn(z_col, zscore(x, F.col(mean_col), F.col(std_col)))
    return out.withColumn(flag_col, F.abs(F.col(z_col)) > F.lit(threshold))


def rolling_zscore_chunked(df: DataFrame, partition: Sequence[str], order: str, value: str,
                           chunk: Column, rows: int = 12, threshold: float = 2.5,
                           mean_col: str = "rolling_avg_12m", std_col: str = "rolling_std_12m",
                           z_col: str = "z_score", flag_col: str = "is_anomaly") -> DataFrame:
    """Same result as :func:`rolling_zscore`, without putting a whole series in one task.

    ``chunk`` is a coarse, order-preserving bucket of the order column (e.g. the year
    of a month). Each (series, chunk) is windowed on its own, after prepending a halo:
    the ``rows - 1`` rows that precede the chunk in its series. Those come from the
    tails (last ``rows - 1`` rows) of the ``rows - 1`` preceding non-empty chunks,
    which always hold them. Every step is bounded per (series, chunk) or per chunk
    row, so one hot series (a third of all rows, say) is spread over its chunks.
    Order values must be unique within a series (true after keep-latest).
    """
    n1 = rows - 1
    keys = list(partition)
    base = df.withColumn("_chunk", chunk)
    # 1) last n1 rows of every (series, chunk): a partial WindowGroupLimit keeps it bounded
    w_tail = Window.partitionBy(*keys, "_chunk").orderBy(F.col(order).desc())
    tails = (base.select(*keys, "_chunk", order, value)
             .withColumn("_r", F.row_number().over(w_tail)).filter(F.col("_r") <= n1)
             .groupBy(*keys, "_chunk")
             .agg(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
                  .alias("_tail")))  # at most n1 elements by construction
    # 2) halo of each chunk = latest n1 rows among the tails of the n1 previous chunks
    w_prev = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(-n1, -1)
    prev = F.array_sort(F.flatten(F.collect_list("_tail").over(w_prev)))
    halo = (tails.select(*keys, "_chunk", prev.alias("_prev"))
            .select(*keys, "_chunk", F.expr(
                f"slice(_prev, greatest(size(_prev) - {n1} + 1, 1), {n1})").alias("_halo"))
            .select(*keys, "_chunk", F.explode("_halo").alias("h"))
            .select(*keys, "_chunk", F.col("h.o").alias(order), F.col("h.v").alias(value),
                    F.lit(True).alias("_is_halo")))
    # 3) window per (series, chunk) over halo + own rows; keep own rows only
    framed = base.withColumn("_is_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    spec = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(-n1, 0)
    x = F.col(value)
    out = (framed.withColumn(mean_col, F.avg(x).over(spec))
                 .withColumn(std_col, F.stddev_samp(x).over(spec))
                 .filter(~F.col("_is_halo")).drop("_is_halo", "_chunk"))
    out = out.withColumn(z_col, zscore(x, F.col(mean_col), F.col(std_col)))
    return out.withColumn(flag_col, F.abs(F.col(z_col)) > F.lit(threshold))
