"""Pipeline checks: mart validation, health report, coverage, raw demand profile."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.functions.casts import safe_double, stable_round
from ampere.functions.payload import DEMAND_FIELDS, field, with_fields
from ampere.functions.periods import strict_hour
from ampere.operators.quality import (FAIL, PASS, freshness, freshness_report,
                                      nonempty_report, status)

MIN_MONTHS = 70
MIN_REGIONS = 50
FIRST_YEAR = 2020


def validate_marts(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and latest period of the four time-series marts (raise with ``require``)."""
    return freshness_report({
        "fact_retail_prices": (marts["fact_retail_prices"], F.max("period")),
        "fact_generation": (marts["fact_generation"], F.max("period")),
        "fact_rto_regional": (marts["fact_rto_regional"], F.max("month")),
        "fact_rto_heatmap": (marts["fact_rto_heatmap"], F.max("month")),
    })


def health_report(staging: Mapping[str, DataFrame], marts: Mapping[str, DataFrame]) -> DataFrame:
    """PASS/FAIL per table (rows > 0), as the end-to-end health check prints it."""
    tables = {
        "staging.retail_prices": (staging["retail"], F.max("period")),
        "staging.generation": (staging["generation"], F.max("period")),
        "staging.rto_demand": (staging["demand"], F.max("period")),
        "marts.fact_retail_prices": (marts["fact_retail_prices"], F.max("period")),
        "marts.fact_generation": (marts["fact_generation"], F.max("period")),
        "marts.fact_rto_heatmap": (marts["fact_rto_heatmap"], F.max("month")),
        "marts.fact_rto_regional": (marts["fact_rto_regional"], F.max("month")),
        "marts.fact_anomaly_leaderboard": (marts["fact_anomaly_leaderboard"], F.lit("-")),
        "marts.dim_state": (marts["dim_state"], F.lit("-")),
    }
    parts = [freshness(df, name, latest) for name, (df, latest) in tables.items()]
    return nonempty_report(reduce(DataFrame.unionByName, parts)).withColumnRenamed(
        "table_name", "check_name")


def month_coverage(records: DataFrame, dataset: str, min_months: int = MIN_MONTHS,
                   start: str | None = None, end: str | None = None) -> DataFrame:
    """Months between start and end (default: the data's first and last) that hold
    records; PASS when at least ``min_months`` do."""
    present = records.select(F.substring("period", 1, 7).alias("ym")).filter(
        F.length("ym") == 7).distinct()
    first = F.lit(start) if start else present.select(F.min("ym")).scalar()
    last = F.lit(end) if end else present.select(F.max("ym")).scalar()
    expected = records.sparkSession.range(1).select(F.explode(F.sequence(
        F.to_date(F.concat(first, F.lit("-01"))), F.to_date(F.concat(last, F.lit("-01"))),
        F.expr("interval 1 month"))).alias("m")).select(F.date_format("m", "yyyy-MM").alias("ym"))
    have = expected.join(present, "ym", "left_semi")
    return have.agg(F.count(F.lit(1)).alias("n_months"), F.max("ym").alias("latest")).select(
        F.lit(dataset).alias("dataset"), "n_months", "latest",
        status(F.col("n_months") >= min_months).alias("status"))


def month_calendar(present: DataFrame, dataset: str, start: str, end: str | None = None,
                   min_months: int = MIN_MONTHS) -> DataFrame:
    """Months from ``start`` to ``end`` (default: the latest present) held against a calendar.

    ``present`` has a column ``ym``; a month that it lacks is listed. Months outside the
    calendar do not count. PASS needs ``min_months`` months and no gap before the latest."""
    present = present.select("ym").distinct()
    last = F.lit(end) if end else present.select(F.max("ym")).scalar()
    spine = present.sparkSession.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(f"{start}-01")), F.greatest(F.to_date(F.concat(last, F.lit("-01"))), F.to_date(F.lit(f"{start}-01"))),
        F.expr("interval 1 month"))).alias("m")).select(F.date_format("m", "yyyy-MM").alias("ym"))
    marked = spine.join(present.withColumn("_have", F.lit(True)), "ym", "left")  # one row per month
    have = F.col("_have").isNotNull()
    return marked.agg(
        F.count_if(have).alias("n_months"), F.max(F.when(have, F.col("ym"))).alias("latest"),
        F.array_join(F.sort_array(F.collect_list(F.when(~have, F.col("ym")))), ",").alias("missing")).select(
        F.lit(dataset).alias("dataset"), "n_months", "latest", "missing",
        status((F.col("n_months") >= min_months) & (F.col("missing") == "")).alias("status"))


def demand_coverage(stg_demand: DataFrame, min_regions: int = MIN_REGIONS,
                    first_year: int = FIRST_YEAR) -> DataFrame:
    agg = stg_demand.agg(F.count_distinct("region_id").alias("regions"),
                         F.min("period").alias("first_hour"))
    ok = (F.col("regions") >= min_regions) & (F.year("first_hour") == first_year)
    return agg.select("regions", "first_hour", status(ok).alias("status"))


def _demand_fields(raw_demand: DataFrame) -> DataFrame:
    return with_fields(raw_demand, DEMAND_FIELDS)


def type_histogram(raw_demand: DataFrame) -> DataFrame:
    return (_demand_fields(raw_demand).groupBy(field("type").alias("type"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "type"))


def parse_rates(raw_demand: DataFrame) -> DataFrame:
    j = _demand_fields(raw_demand)
    return j.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(strict_hour(field("period")).isNotNull()).alias("parsed_strict"),
        F.count_if(field("respondent").isNotNull()).alias("has_respondent"),
        F.count_if(safe_double(field("value")).isNotNull()).alias("has_value"))


def top_regions(stg_demand: DataFrame, top: int = 5) -> DataFrame:
    return (stg_demand.groupBy("region_id")
            .agg(F.count(F.lit(1)).alias("n"), stable_round(F.avg("demand_mwh"), 0).alias("avg_mwh"))
            .orderBy(F.col("avg_mwh").desc_nulls_last(), "region_id").limit(top))


def staging_guard(raw: DataFrame, stg: DataFrame, table: str) -> DataFrame:
    """FAIL when the raw load has rows but staging is empty."""
    raw_n = raw.select(F.count(F.lit(1))).scalar()
    stg_n = stg.select(F.count(F.lit(1))).scalar()
    return raw.sparkSession.range(1).select(
        F.lit(table).alias("table_name"), raw_n.alias("raw_rows"), stg_n.alias("staging_rows"),
        F.when((raw_n > 0) & (stg_n == 0), F.lit(FAIL)).otherwise(F.lit(PASS)).alias("status"))


def pull_profile(records: DataFrame, state: str = "stateid", sector: str = "sectorName") -> DataFrame:
    """Records in a pull, distinct states and distinct sectors."""
    return records.agg(F.count(F.lit(1)).alias("n_records"),
                       F.count_distinct(state).alias("n_states"),
                       F.count_distinct(sector).alias("n_sectors"))


def staging_effect(effects: Mapping[str, Mapping[str, int]], spark) -> DataFrame:
    """Per dataset what a batch did to its staging table (counts gathered while it was written)."""
    kinds = ("kept", "inserted", "replaced", "unchanged", "reinserted")
    return spark.createDataFrame([(d, *(int(e.get(k, 0)) for k in kinds)) for d, e in effects.items()],
                                 "dataset string, " + ", ".join(f"{k} long" for k in kinds))


def sample_payloads(raw: DataFrame, n: int = 3) -> DataFrame:
    """A few raw payloads to eyeball (deterministic: smallest text first)."""
    return raw.select("payload").orderBy("payload").limit(n)
