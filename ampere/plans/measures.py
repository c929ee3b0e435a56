"""Dashboard measures computed from the marts (the BI layer's formulas, as Spark)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.functions.casts import safe_divide
from ampere.functions.fuel import CLEAN_CATEGORIES, source_group
from ampere.operators.shares import share_of_total
from ampere.plans.marts import is_state

SPIKE_Z = 2.0            # the dashboard's z = 2 line (one-sided: price above average)
TOP_OPERATORS = 7        # bars for the largest grid operators


def _since(df: DataFrame, start_period: str | None, col: str = "period") -> DataFrame:
    return df if start_period is None else df.filter(F.col(col) >= F.lit(start_period))


def headline(fact_retail: DataFrame, fact_generation: DataFrame, stg_demand: DataFrame,
             start_period: str | None = None, demand_region: str | None = None) -> DataFrame:
    """Four headline numbers in one row, each a scalar aggregate (no joins).

    ``demand_region`` is the respondent whose mean is shown, such as the code of an
    aggregate over all regions; without it the mean is over every respondent."""
    gen = _since(fact_generation, start_period)
    price = _since(fact_retail, start_period)
    clean = gen.select(safe_divide(
        F.sum(F.when(F.col("fuel_category").isin(*CLEAN_CATEGORIES), F.col("generation_mwh"))),
        F.sum("generation_mwh")).alias("v")).scalar()
    # both price numbers from one pass over the price mart (one struct-valued subquery)
    price_stats = price.select(F.struct(
        F.avg("price_cents_kwh").alias("avg_price"),
        F.count_if(F.col("z_score") > SPIKE_Z).alias("spikes"))).scalar()
    avg_price = price_stats.getField("avg_price")
    spikes = price_stats.getField("spikes")
    demand = stg_demand if demand_region is None else stg_demand.filter(F.col("region_id") == demand_region)
    if start_period is not None:
        demand = demand.filter(F.date_format("period", "yyyy-MM") >= F.lit(start_period))
    avg_demand = demand.select(F.avg("demand_mwh")).scalar()
    return fact_retail.sparkSession.range(1).select(
        clean.alias("clean_share"), avg_price.alias("avg_price_cents_kwh"),
        spikes.alias("price_spikes"), avg_demand.alias("avg_hourly_demand_mwh"))


def avg_price_by_state(fact_retail: DataFrame, start_period: str | None = None) -> DataFrame:
    return (_since(fact_retail, start_period).filter(is_state())
            .groupBy("state_id", "state_name")
            .agg(F.avg("price_cents_kwh").alias("avg_price_cents_kwh")))


def spikes_by_state(fact_retail: DataFrame, start_period: str | None = None) -> DataFrame:
    """Months above z = 2 per state since the start month (states with none show 0)."""
    return (_since(fact_retail, start_period).filter(is_state())
            .groupBy("state_id", "state_name")
            .agg(F.count_if(F.col("z_score") > SPIKE_Z).alias("spike_months")))


def fuel_mix(fact_generation: DataFrame, state_id: str | None = None) -> DataFrame:
    """Share of each fuel category in each month's generation (optionally one state)."""
    gen = fact_generation if state_id is None else fact_generation.filter(
        F.col("state_id") == state_id)
    by_cat = gen.groupBy("period", "fuel_category").agg(F.sum("generation_mwh").alias("mwh"))
    return share_of_total(by_cat, ["period"], "mwh", "share")


def source_group_shares(fact_generation: DataFrame) -> DataFrame:
    """Fossil / nuclear / renewable / other share of each month's generation."""
    grouped = fact_generation.withColumn("source_group", source_group("fuel_category"))
    by_group = grouped.groupBy("period", "source_group").agg(F.sum("generation_mwh").alias("mwh"))
    return share_of_total(by_group, ["period"], "mwh", "share")


def zscore_series(fact_retail: DataFrame, threshold: float = SPIKE_Z) -> DataFrame:
    return fact_retail.select(
        "state_id", "period", "period_date", "z_score",
        F.lit(threshold).alias("threshold"), (F.col("z_score") > threshold).alias("above_threshold"))


def demand_by_operator(stg_demand: DataFrame, top: int = TOP_OPERATORS,
                       operators: Sequence[str] | None = None) -> DataFrame:
    """Average hourly demand per grid operator, the ``top`` largest (a top-k report).

    ``operators`` names the respondents shown, so that aggregates over several of them do
    not take a place."""
    if operators is not None:
        stg_demand = stg_demand.filter(F.col("region_id").isin(*operators))
    return (stg_demand.groupBy("region_id")
            .agg(F.max("region_name").alias("region_name"),
                 F.avg("demand_mwh").alias("avg_demand_mwh"))
            .orderBy(F.col("avg_demand_mwh").desc_nulls_last(), "region_id")
            .limit(top))
