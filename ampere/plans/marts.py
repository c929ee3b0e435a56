"""Staging -> the six dashboard marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.functions.fuel import fuel_category, is_detail_code
from ampere.functions.periods import hour_of_day, month_start, period_date
from ampere.operators.rolling import rolling_zscore, rolling_zscore_chunked
from ampere.operators.shares import share_of_total

ANOMALY_Z = 2.5
WINDOW_ROWS = 12


def is_state(col: str = "state_id"):
    """Two-character ids are states (keeps 'US' and codes such as '90')."""
    return F.length(F.col(col)) == 2


def fact_retail_prices(stg_retail: DataFrame, rows: int = WINDOW_ROWS,
                       threshold: float = ANOMALY_Z, chunk_by=None) -> DataFrame:
    """Monthly all-sector prices with the rolling z-score and anomaly flag.

    One window partition per state is bounded (one row per month after keep-latest).
    ``chunk_by`` (a coarse order bucket such as the year) switches to the chunked
    operator, which never puts a whole series in one task.
    """
    base = (stg_retail
            .filter((F.col("sector_id") == "ALL") & F.col("price_cents_kwh").isNotNull())
            .select("period", "state_id", "state_name", "sector_id", "sector_name",
                    "price_cents_kwh", "sales_mwh", "customers"))
    if chunk_by is None:
        scored = rolling_zscore(base, ["state_id"], "period", "price_cents_kwh", rows, threshold)
    else:
        scored = rolling_zscore_chunked(base, ["state_id"], "period", "price_cents_kwh",
                                        chunk_by, rows, threshold)
    return scored.select(
        "period", period_date("period").alias("period_date"),
        "state_id", "state_name", "sector_id", "sector_name",
        "price_cents_kwh", "sales_mwh", "customers",
        "rolling_avg_12m", "rolling_std_12m", "z_score", "is_anomaly")


def fact_generation(stg_generation: DataFrame) -> DataFrame:
    base = (stg_generation
            .filter(F.col("generation_mwh").isNotNull() & is_detail_code("fuel_type_code"))
            .select("period", "state_id", "fuel_type_code", "fuel_type_desc", "generation_mwh"))
    shared = share_of_total(base, ["period", "state_id"], "generation_mwh", "generation_share")
    return shared.select(
        "period", period_date("period").alias("period_date"), "state_id",
        "fuel_type_code", "fuel_type_desc", fuel_category("fuel_type_code").alias("fuel_category"),
        "generation_mwh", "generation_share")


def dim_state(stg_retail: DataFrame) -> DataFrame:
    """Distinct (id, name) pairs over all sectors: a renamed state gives two rows."""
    return stg_retail.filter(is_state()).select("state_id", "state_name").distinct()


def state_history(stg_retail: DataFrame) -> DataFrame:
    """What a state was called when: (state_id, state_name, valid_from, valid_to), the end excluded.

    A name holds until the state's next name; of two names in one month the last in order
    counts. A state has a row per month, so its window is small."""
    series = Window.partitionBy("state_id").orderBy("period")
    named = (stg_retail.filter(is_state() & F.col("state_name").isNotNull())
             .groupBy("state_id", "period").agg(F.max("state_name").alias("state_name"))
             .withColumn("_before", F.lag("state_name").over(series)))
    changes = named.filter(~F.col("state_name").eqNullSafe(F.col("_before")))
    return changes.select("state_id", "state_name", F.col("period").alias("valid_from"),
                          F.lead("period").over(series).alias("valid_to"))


def with_state_at(fact: DataFrame, history: DataFrame, name: str = "dim_state_name") -> DataFrame:
    """Every fact row once, with its state's name in its period (NULL before the first one).

    Intervals of a state do not overlap, so a renamed state does not double its rows."""
    h = history.select(F.col("state_id").alias("_id"), F.col("state_name").alias(name), "valid_from", "valid_to")
    during = (F.col("period") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("period") < F.col("valid_to")))
    return fact.join(h, (F.col("state_id") == F.col("_id")) & during, "left").drop("_id", "valid_from", "valid_to")


def fact_rto_heatmap(stg_demand: DataFrame) -> DataFrame:
    return (stg_demand
            .groupBy(month_start("period").alias("month"), hour_of_day("period").alias("hour_of_day"),
                     "region_id", "region_name")
            .agg(F.avg("demand_mwh").alias("avg_demand_mwh")))


def fact_rto_regional(stg_demand: DataFrame) -> DataFrame:
    return (stg_demand
            .groupBy(month_start("period").alias("month"), "region_id", "region_name")
            .agg(F.avg("demand_mwh").alias("avg_demand_mwh"),
                 F.max("demand_mwh").alias("peak_demand_mwh")))


def fact_anomaly_leaderboard(fact_retail: DataFrame) -> DataFrame:
    """Anomalies per state, most first (state id breaks ties); zero-anomaly states absent."""
    return (fact_retail.filter(F.col("is_anomaly") & is_state())
            .groupBy("state_id", "state_name").agg(F.count(F.lit(1)).alias("anomaly_count"))
            .orderBy(F.col("anomaly_count").desc(), "state_id", "state_name"))
