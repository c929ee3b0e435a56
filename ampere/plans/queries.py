"""Registered queries: (spark, sf_dir) -> DataFrame over the generated tables.

Each one runs the pipeline's own operators on data Spark derives from the whole
tables (see ``ampere.sources.bindings``). Doubles are published rounded to 6
places, the precision of the pipeline's flat export, so that engines whose float
sums differ in the last bit still agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.functions.casts import published
from ampere.operators.upsert import upsert
from ampere.plans import marts, staging
from ampere.session import configure, held
from ampere.sources.bindings import raw_history, raw_load

# ---------------------------------------------------------------- staging states

def staged(spark: SparkSession, sf_dir: str, dataset: str, load: str) -> DataFrame:
    configure(spark)
    raw = raw_load(spark, sf_dir, dataset, load)
    if dataset == "retail":
        return staging.stage_retail(raw)
    if dataset == "generation":
        return staging.stage_generation(raw)
    return staging.stage_demand(raw)


KEYS = {"retail": staging.RETAIL_KEYS, "generation": staging.GENERATION_KEYS,
        "demand": staging.DEMAND_KEYS}


def current_staging(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Staging after two runs: the full-history load, then the re-pulled window.

    The window's batch is read twice, for its keys and for its rows, so it is held."""
    batch = held(staged(spark, sf_dir, dataset, "revision"), "batch")
    return upsert(staged(spark, sf_dir, dataset, "backfill"), batch, KEYS[dataset])


def q_stg_retail(spark, sf_dir):
    return published(staged(spark, sf_dir, "retail", "backfill"))


def q_stg_generation(spark, sf_dir):
    return published(staged(spark, sf_dir, "generation", "backfill"))


def q_stg_rto(spark, sf_dir):
    return published(staged(spark, sf_dir, "demand", "backfill"))


def q_keep_latest_retail(spark, sf_dir):
    """Keep-latest over a raw table holding both loads: revised rows win."""
    configure(spark)
    return published(staging.stage_retail(raw_history(spark, sf_dir, "retail")))


def q_keep_latest_generation(spark, sf_dir):
    configure(spark)
    return published(staging.stage_generation(raw_history(spark, sf_dir, "generation")))


def q_upsert_retail(spark, sf_dir):
    return published(current_staging(spark, sf_dir, "retail"))


def q_upsert_generation(spark, sf_dir):
    return published(current_staging(spark, sf_dir, "generation"))


def q_upsert_rto(spark, sf_dir):
    return published(current_staging(spark, sf_dir, "demand"))


# ---------------------------------------------------------------- marts

def fact_retail(spark, sf_dir):
    return marts.fact_retail_prices(current_staging(spark, sf_dir, "retail"))


def fact_generation(spark, sf_dir):
    return marts.fact_generation(current_staging(spark, sf_dir, "generation"))


def q_fact_retail_prices(spark, sf_dir):
    return published(fact_retail(spark, sf_dir))


def q_fact_retail_prices_chunked(spark, sf_dir):
    """The price mart through the skew-safe chunked rolling window (chunk = year)."""
    stg = current_staging(spark, sf_dir, "retail")
    return published(marts.fact_retail_prices(stg, chunk_by=F.substring("period", 1, 4)))


def q_fact_generation(spark, sf_dir):
    return published(fact_generation(spark, sf_dir))


def q_dim_state(spark, sf_dir):
    return marts.dim_state(current_staging(spark, sf_dir, "retail")).orderBy("state_id", "state_name")


def q_fact_rto_heatmap(spark, sf_dir):
    return published(marts.fact_rto_heatmap(current_staging(spark, sf_dir, "demand")))


def q_fact_rto_regional(spark, sf_dir):
    return published(marts.fact_rto_regional(current_staging(spark, sf_dir, "demand")))


def q_fact_anomaly_leaderboard(spark, sf_dir):
    return marts.fact_anomaly_leaderboard(fact_retail(spark, sf_dir))


QUERIES = {
    "stg_retail": q_stg_retail,
    "stg_generation": q_stg_generation,
    "stg_rto": q_stg_rto,
    "keep_latest_retail": q_keep_latest_retail,
    "keep_latest_generation": q_keep_latest_generation,
    "upsert_retail": q_upsert_retail,
    "upsert_generation": q_upsert_generation,
    "upsert_rto": q_upsert_rto,
    "fact_retail_prices": q_fact_retail_prices,
    "fact_retail_prices_chunked": q_fact_retail_prices_chunked,
    "fact_generation": q_fact_generation,
    "dim_state": q_dim_state,
    "fact_rto_heatmap": q_fact_rto_heatmap,
    "fact_rto_regional": q_fact_rto_regional,
    "fact_anomaly_leaderboard": q_fact_anomaly_leaderboard,
}


# ---------------------------------------------------------------- more registered queries
# (imports kept local to this section so the first slice above reads on its own)

from datetime import date  # noqa: E402
from functools import reduce  # noqa: E402

from ampere.functions.payload import DEMAND_FIELDS, field, with_fields  # noqa: E402
from ampere.functions.periods import hour_period, month_window  # noqa: E402
from ampere.operators.quality import count_report  # noqa: E402
from ampere.plans import checks, exports, legacy, measures  # noqa: E402
from ampere.session import scratch_path  # noqa: E402
from ampere.sources import landing  # noqa: E402
from ampere.sources.bindings import (LOAD_TIMES, LOOKBACK_MONTHS, RECORDS,  # noqa: E402
                                     payload_records)

DATASETS = ("retail", "generation", "demand")


_MART_SOURCES = {
    "fact_retail_prices": ("retail", marts.fact_retail_prices),
    "fact_generation": ("generation", marts.fact_generation),
    "dim_state": ("retail", marts.dim_state),
    "fact_rto_heatmap": ("demand", marts.fact_rto_heatmap),
    "fact_rto_regional": ("demand", marts.fact_rto_regional),
    "fact_anomaly_leaderboard": ("fact_retail_prices", marts.fact_anomaly_leaderboard),
}


def current_frames(spark, sf_dir, *names) -> dict:
    """The staged datasets and marts that are asked for, each planned once.

    A staged dataset is held: several marts read it, and a global sort reads its input twice."""
    made: dict = {}

    def frame(name):
        if name not in made:
            if name in DATASETS:
                made[name] = held(current_staging(spark, sf_dir, name), "staged")
            else:
                source, mart = _MART_SOURCES[name]
                made[name] = mart(frame(source))
        return made[name]

    return {name: frame(name) for name in names}


def current_marts(spark, sf_dir, *names) -> dict:
    return current_frames(spark, sf_dir, *(names or _MART_SOURCES))


def q_json_extract_rto(spark, sf_dir):
    raw = raw_load(spark, sf_dir, "demand", "backfill")
    j = with_fields(raw, DEMAND_FIELDS)
    from ampere.functions.casts import safe_double
    return j.select(field("period").alias("period_text"), field("respondent").alias("region_id"),
                    field("respondent-name").alias("region_name"),
                    safe_double(field("value")).alias("value"), field("type").alias("type"))


def q_parse_period(spark, sf_dir):
    raw = raw_load(spark, sf_dir, "demand", "backfill")
    j = with_fields(raw, DEMAND_FIELDS)
    return (j.select(field("period").alias("period_text"))
            .groupBy("period_text").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("period_text", hour_period("period_text").alias("period"), "n_rows"))


def _records(spark, sf_dir, dataset, load="backfill"):
    configure(spark)
    return RECORDS[dataset](spark, sf_dir, load)


def q_split_by_month(spark, sf_dir):
    parts = [landing.month_counts(_records(spark, sf_dir, d)).select(F.lit(d).alias("dataset"), "*")
             for d in DATASETS]
    return reduce(DataFrame.unionByName, parts)


def _landing_root(spark, sf_dir):
    """Land the full-history pull of all three datasets in a fresh shared folder."""
    root = scratch_path(spark, "landing")
    for d in DATASETS:
        landing.write_landing(payload_records(_records(spark, sf_dir, d), d), root, d)
    return root


def q_landing_roundtrip(spark, sf_dir):
    root = _landing_root(spark, sf_dir)
    parts = [landing.landed_months(spark, root, d).select(
        F.lit(d).alias("dataset"), "year", "month", "n_records") for d in DATASETS]
    return reduce(DataFrame.unionByName, parts)


def _anchor(records: DataFrame) -> date:
    latest = records.select(F.max(F.substring("period", 1, 7))).first()[0]
    return date(int(latest[:4]), int(latest[5:7]), 1)


def q_raw_window(spark, sf_dir):
    """Raw load of the re-pull window (anchor month and the 3 before) from landing."""
    root = _landing_root(spark, sf_dir)
    parts = []
    for d in DATASETS:
        months = month_window(_anchor(_records(spark, sf_dir, d)), LOOKBACK_MONTHS)
        raw = landing.load_raw(spark, root, d, months, LOAD_TIMES["revision"])
        parts.append(raw.groupBy(F.regexp_extract("source_file", r"year=(\d{4})/month=(\d{2})", 0)
                                 .alias("partition")).agg(
            F.count(F.lit(1)).alias("n_records"), F.max("ingested_at").alias("ingested_at"))
            .select(F.lit(d).alias("dataset"), "*"))
    return reduce(DataFrame.unionByName, parts)


def q_generation_by_category(spark, sf_dir):
    return published(exports.generation_by_category(fact_generation(spark, sf_dir)))


def q_headline(spark, sf_dir):
    return published(measures.headline(
        *current_frames(spark, sf_dir, "fact_retail_prices", "fact_generation", "demand").values()))


def q_avg_price_by_state(spark, sf_dir):
    return published(measures.avg_price_by_state(fact_retail(spark, sf_dir)))


def q_spikes_by_state(spark, sf_dir):
    return measures.spikes_by_state(fact_retail(spark, sf_dir))


def q_fuel_mix(spark, sf_dir):
    return published(measures.fuel_mix(fact_generation(spark, sf_dir)))


def q_fossil_nuclear_renewable(spark, sf_dir):
    return published(measures.source_group_shares(fact_generation(spark, sf_dir)))


def q_zscore_series(spark, sf_dir):
    return published(measures.zscore_series(fact_retail(spark, sf_dir)))


def q_demand_by_operator(spark, sf_dir):
    return published(measures.demand_by_operator(current_staging(spark, sf_dir, "demand")))


def q_validate_marts(spark, sf_dir):
    return checks.validate_marts(current_marts(
        spark, sf_dir, "fact_retail_prices", "fact_generation", "fact_rto_regional", "fact_rto_heatmap"))


def q_health_report(spark, sf_dir):
    frames = current_frames(spark, sf_dir, *DATASETS, *_MART_SOURCES)
    return checks.health_report(frames, frames)


def q_coverage_months(spark, sf_dir):
    parts = [checks.month_coverage(_records(spark, sf_dir, d), d) for d in DATASETS]
    return reduce(DataFrame.unionByName, parts)


def q_demand_coverage(spark, sf_dir):
    return checks.demand_coverage(current_staging(spark, sf_dir, "demand"))


def q_type_histogram(spark, sf_dir):
    configure(spark)
    return checks.type_histogram(raw_load(spark, sf_dir, "demand", "backfill"))


def q_parse_rates(spark, sf_dir):
    configure(spark)
    return checks.parse_rates(raw_load(spark, sf_dir, "demand", "backfill"))


def q_top_regions(spark, sf_dir):
    return checks.top_regions(current_staging(spark, sf_dir, "demand"))


def q_staging_guard(spark, sf_dir):
    configure(spark)
    parts = []
    for d, table_name in (("retail", "retail_prices"), ("generation", "generation"),
                          ("demand", "rto_demand")):
        parts.append(checks.staging_guard(raw_load(spark, sf_dir, d, "backfill"),
                                          staged(spark, sf_dir, d, "backfill"), table_name))
    return reduce(DataFrame.unionByName, parts)


def q_row_counts(spark, sf_dir):
    frames = current_frames(spark, sf_dir, *DATASETS, *_MART_SOURCES)
    return count_report({f"{'staging' if k in DATASETS else 'marts'}.{k}": v for k, v in frames.items()})


def _tab(spark, sf_dir, tab):
    frames = exports.tab_frames(current_marts(spark, sf_dir, tab))
    return exports.sheet_tab(frames[tab], exports.TAB_ORDER[tab])


def q_export_chunks(spark, sf_dir):
    return exports.all_chunk_ranges(exports.tab_frames(current_marts(spark, sf_dir)))


def q_reconcile_export(spark, sf_dir):
    m = current_marts(spark, sf_dir)
    frames = exports.tab_frames(m)
    mart_n = count_report(m).withColumnRenamed("n_rows", "mart_rows")
    tab_n = count_report(frames).withColumnRenamed("n_rows", "export_rows")
    joined = mart_n.join(tab_n, "table_name", "full_outer")
    return joined.select("table_name", "mart_rows", "export_rows",
                         F.col("mart_rows").eqNullSafe(F.col("export_rows")).alias("counts_equal"))


def q_fact_with_state(spark, sf_dir):
    stg = current_staging(spark, sf_dir, "retail")
    fact = marts.fact_retail_prices(stg)
    dim = marts.dim_state(stg).withColumnRenamed("state_name", "dim_state_name")
    return published(fact.join(dim, "state_id", "left"))


def q_legacy_distinct_dedup(spark, sf_dir):
    configure(spark)
    return published(legacy.retail_distinct(raw_history(spark, sf_dir, "retail")))


def q_legacy_all_series_demand(spark, sf_dir):
    configure(spark)
    return published(legacy.demand_all_series(raw_load(spark, sf_dir, "demand", "backfill")))


def q_hourly_export(spark, sf_dir):
    return published(legacy.hourly_export(current_staging(spark, sf_dir, "demand")))


def q_legacy_stg_generation(spark, sf_dir):
    configure(spark)
    return published(legacy.typed_generation_strict(raw_load(spark, sf_dir, "generation", "backfill")))


def q_pull_profile(spark, sf_dir):
    return checks.pull_profile(_records(spark, sf_dir, "retail"))


SPIKE_START = "1999-01"  # the dashboard's "show data from" month used for this view


def q_spikes_by_state_since(spark, sf_dir):
    return measures.spikes_by_state(fact_retail(spark, sf_dir), start_period=SPIKE_START)


QUERIES.update({
    "json_extract_rto": q_json_extract_rto,
    "parse_period": q_parse_period,
    "split_by_month": q_split_by_month,
    "landing_roundtrip": q_landing_roundtrip,
    "raw_window": q_raw_window,
    "generation_by_category": q_generation_by_category,
    "headline": q_headline,
    "avg_price_by_state": q_avg_price_by_state,
    "spikes_by_state": q_spikes_by_state,
    "fuel_mix": q_fuel_mix,
    "fossil_nuclear_renewable": q_fossil_nuclear_renewable,
    "zscore_series": q_zscore_series,
    "demand_by_operator": q_demand_by_operator,
    "validate_marts": q_validate_marts,
    "health_report": q_health_report,
    "coverage_months": q_coverage_months,
    "demand_coverage": q_demand_coverage,
    "type_histogram": q_type_histogram,
    "parse_rates": q_parse_rates,
    "top_regions": q_top_regions,
    "staging_guard": q_staging_guard,
    "row_counts": q_row_counts,
    **{f"export_{short}": (lambda tab: (lambda spark, sf_dir: _tab(spark, sf_dir, tab)))(tab)
       for short, tab in (("prices", "fact_retail_prices"), ("generation", "fact_generation"),
                          ("dim_state", "dim_state"), ("heatmap", "fact_rto_heatmap"),
                          ("regional", "fact_rto_regional"),
                          ("leaderboard", "fact_anomaly_leaderboard"))},
    "export_chunks": q_export_chunks,
    "reconcile_export": q_reconcile_export,
    "fact_with_state": q_fact_with_state,
    "legacy_distinct_dedup": q_legacy_distinct_dedup,
    "legacy_stg_generation": q_legacy_stg_generation,
    "pull_profile": q_pull_profile,
    "spikes_by_state_since": q_spikes_by_state_since,
    "legacy_all_series_demand": q_legacy_all_series_demand,
    "hourly_export": q_hourly_export,
})

from ampere.plans.stored_queries import QUERIES as STORED  # noqa: E402

QUERIES.update(STORED)
