"""Flat export of the six dashboard tabs: projection, roll-up, order, cell text, chunks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.functions.cells import CHUNK_ROWS, column_name, format_cells
from ampere.operators.ordering import ordered_index
from ampere.operators.shares import share_of_total
from ampere.plans.legacy import hourly_export

TAB_ORDER = {
    "fact_retail_prices": ("state_id", "period"),
    "fact_generation": ("state_id", "period", "fuel_category"),
    "dim_state": ("state_id",),
    "fact_rto_heatmap": ("month", "region_id", "hour_of_day"),
    "fact_rto_regional": ("month", "region_id"),
    "fact_anomaly_leaderboard": (),  # exported in table order, i.e. unordered
}

RETAIL_EXPORT_COLUMNS = ("period", "period_date", "state_id", "state_name", "sector_id",
                         "sector_name", "price_cents_kwh", "sales_mwh", "customers",
                         "rolling_avg_12m", "rolling_std_12m", "z_score", "is_anomaly")


def generation_by_category(fact_generation: DataFrame) -> DataFrame:
    """Roll fuel codes up to one row per (month, state, category) before export.

    The category share is SUM(code shares); it is computed as category total / state
    total, the same number without adding up rounded ratios (so it does not depend
    on the order the code rows are summed in).
    """
    rolled = (fact_generation
              .groupBy("period", "period_date", "state_id", "fuel_category")
              .agg(F.sum("generation_mwh").alias("generation_mwh")))
    return share_of_total(rolled, ["period", "state_id"], "generation_mwh", "generation_share")


_TAB_QUERIES = {
    "fact_retail_prices": lambda mart: mart.select(*RETAIL_EXPORT_COLUMNS),
    "fact_generation": generation_by_category,
    "dim_state": lambda mart: mart,
    "fact_rto_heatmap": lambda mart: mart.select("month", "hour_of_day", "region_id", "region_name", "avg_demand_mwh"),
    "fact_rto_regional": lambda mart: mart.select("month", "region_id", "region_name", "avg_demand_mwh",
                                                  "peak_demand_mwh"),
    "fact_anomaly_leaderboard": lambda mart: mart,
}


def tab_frames(marts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The typed result of the export query of each mart given (before cell formatting)."""
    return {tab: query(marts[tab]) for tab, query in _TAB_QUERIES.items() if tab in marts}


def sheet_tab(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort on the typed columns, then turn every column into cell text."""
    ordered = df.orderBy(*order) if order else df
    return format_cells(ordered)


def chunk_ranges(tab: str, df: DataFrame, order: Sequence[str],
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Write ranges of a tab: the header is line 0 of chunk 0, data row i is line i+1.

    (tab, chunk, first_line, last_line, a1_range) with 1-based sheet lines.
    """
    indexed = ordered_index(df.select(*(order or df.columns[:1])), list(order or []))
    lines = indexed.select((F.col("row_index") + 1).alias("line")).unionByName(
        df.sparkSession.range(1).select(F.lit(0).cast("long").alias("line")))
    last_col = column_name(len(df.columns))
    per_chunk = (lines.groupBy(F.floor(F.col("line") / chunk_rows).alias("chunk"))
                 .agg(F.min("line").alias("lo"), F.max("line").alias("hi")))
    return per_chunk.select(
        F.lit(tab).alias("tab"), F.col("chunk").cast("long").alias("chunk"),
        (F.col("lo") + 1).alias("first_line"), (F.col("hi") + 1).alias("last_line"),
        F.concat(F.lit(f"'{tab}'!A"), (F.col("lo") + 1).cast("string"), F.lit(f":{last_col}"),
                 (F.col("hi") + 1).cast("string")).alias("a1_range"))


def all_chunk_ranges(tabs: Mapping[str, DataFrame]) -> DataFrame:
    parts = [chunk_ranges(t, df, TAB_ORDER[t]) for t, df in tabs.items()]
    return reduce(DataFrame.unionByName, parts)


def write_csv(tabs: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """CSV sink, one folder per tab, header row in upper case (already in the columns)."""
    out = {}
    for tab, df in tabs.items():
        path = f"{root.rstrip('/')}/{tab}"
        sheet_tab(df, TAB_ORDER[tab]).write.mode("overwrite").option("header", True).csv(path)
        out[tab] = path
    return out


def write_typed_csv(marts: Mapping[str, DataFrame], stg_demand: DataFrame, root: str,
                    names: Sequence[str] = ("fact_retail_prices", "fact_generation", "dim_state")) -> dict[str, str]:
    """The full marts and the hourly demand as typed CSV with their own column names."""
    frames = {n: marts[n] for n in names} | {"staging_rto_demand": hourly_export(stg_demand)}
    out = {}
    for name, df in frames.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", True).csv(path)
        out[name] = path
    return out
