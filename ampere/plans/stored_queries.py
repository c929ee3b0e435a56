"""Registered queries over stored layers and over records with defects.

The first part runs the pipeline itself: it lands, loads, merges, writes and publishes in a
scratch folder and reads the result back. The second part takes the dirty records
(``ampere.sources.dirty``), so that each rule for bad rows decides some.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.functions.casts import published
from ampere.functions.payload import DEMAND_FIELDS, field, with_fields
from ampere.functions.periods import hour_period
from ampere.operators.merge import EFFECT, effect_counts, merge
from ampere.operators.upsert import upsert
from ampere.plans import checks, exports, legacy, marts, measures, runs
from ampere.plans import publish as publishing
from ampere.session import configure, held, scratch_path
from ampere.sources import landing
from ampere.sources.bindings import RECORDS, payload_records, raw_load
from ampere.sources.dirty import DIRTY, dirty_raw

DATASETS = tuple(runs.TABLES)
LOADS = ("backfill", "revision")
#: Where the calendar of the check over the bound tables starts: before their first month.
CALENDAR_START = "1994-06"
#: Respondents shown by name, and the one whose mean is the headline, in the bound tables.
SHOWN_OPERATORS = ("click", "purchase", "view")
HEADLINE_REGION = "view"


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ stored layers

def _two_runs(spark: SparkSession, sf_dir: str, datasets=DATASETS, records=RECORDS) -> tuple[runs.Layout, dict]:
    """Both loads through landing, raw, staging and marts under a fresh root."""
    layout = runs.Layout(scratch_path(spark, "warehouse"))
    for load in LOADS:
        result = runs.run_from_tables(spark, sf_dir, layout, load, datasets=datasets, records=records)
    return layout, result


def q_stored_retail_mart(spark, sf_dir):
    """The price mart as two scheduled runs leave it on storage."""
    layout, _ = _two_runs(spark, sf_dir, ("retail",))
    return published(runs.read_mart(spark, layout, "fact_retail_prices"))


def q_stored_demand(spark, sf_dir):
    """Staged hourly demand over six months, of which the second run replaces four in one commit."""
    layout, _ = _two_runs(spark, sf_dir, ("demand",), DIRTY)
    return published(runs.read_staging(spark, layout, "demand"))


def q_layer_report(spark, sf_dir):
    """Rows and latest of every stored layer, as gathered while the layers were written."""
    layout, _ = _two_runs(spark, sf_dir)
    return runs.layer_report(spark, layout)


def q_merge_effect(spark, sf_dir):
    """What the second run did to each staging table's touched months."""
    return _two_runs(spark, sf_dir, DATASETS, DIRTY)[1]["effect"]


def _published_tabs(spark, sf_dir):
    """All tabs of the two marts that need the least, published in chunks."""
    layout, _ = _two_runs(spark, sf_dir)
    frames = exports.tab_frames({n: runs.read_mart(spark, layout, n) for n in runs.MART_NAMES})
    root = scratch_path(spark, "tabs")
    counts = publishing.publish(frames, root)
    return root, frames, counts


def q_published_chunks(spark, sf_dir):
    """First and last line of every chunk, read back from the published files."""
    root, frames, _ = _published_tabs(spark, sf_dir)
    return publishing.written_ranges(spark, root, list(frames))


def q_reconcile_published(spark, sf_dir):
    """Published files against the tabs' queries: counts, header and content."""
    root, frames, _ = _published_tabs(spark, sf_dir)
    return publishing.reconcile(spark, root, frames)


def _landed(spark, sf_dir, records=RECORDS):
    configure(spark)
    root = scratch_path(spark, "landing")
    for d in DATASETS:
        landing.write_landing(payload_records(records[d](spark, sf_dir), d), root, d)
    return root


def q_landed_files(spark, sf_dir):
    """Files per landed month, from the listing alone."""
    root = _landed(spark, sf_dir)
    return _union([landing.file_inventory(spark, root, d).select(
        F.lit(d).alias("dataset"), "year", "month", "n_files", (F.col("n_bytes") > 0).alias("has_bytes"))
        for d in DATASETS])


def q_calendar_gaps(spark, sf_dir):
    """Landed months against a calendar from a fixed start, with the months that are missing."""
    root = _landed(spark, sf_dir)
    return _union([checks.month_calendar(
        landing.file_inventory(spark, root, d).select(F.concat_ws("-", "year", "month").alias("ym")), d,
        CALENDAR_START) for d in DATASETS])


# ------------------------------------------------------------------ records with defects

def dirty_staged(spark, sf_dir, dataset, load="backfill"):
    configure(spark)
    return runs.STAGE[dataset](dirty_raw(spark, sf_dir, dataset, load))


def dirty_current(spark, sf_dir, dataset):
    target, source = (dirty_staged(spark, sf_dir, dataset, load) for load in LOADS)
    return upsert(target, held(source, "batch"), runs.KEYS[dataset])  # read for its keys and its rows


def q_dirty_staging(dataset):
    return lambda spark, sf_dir: published(dirty_staged(spark, sf_dir, dataset))


def q_dirty_upsert(dataset):
    return lambda spark, sf_dir: published(dirty_current(spark, sf_dir, dataset))


def q_dirty_dim_state(spark, sf_dir):
    return marts.dim_state(dirty_current(spark, sf_dir, "retail"))


def q_dirty_leaderboard(spark, sf_dir):
    return marts.fact_anomaly_leaderboard(marts.fact_retail_prices(dirty_current(spark, sf_dir, "retail")))


def q_dirty_fact_generation(spark, sf_dir):
    return published(marts.fact_generation(dirty_current(spark, sf_dir, "generation")))


def q_dirty_hourly_export(spark, sf_dir):
    return published(legacy.hourly_export(dirty_current(spark, sf_dir, "demand")))


def q_dirty_periods(spark, sf_dir):
    """Every period text of hourly demand with the hour read from it, unreadable ones too."""
    configure(spark)
    j = with_fields(dirty_raw(spark, sf_dir, "demand"), DEMAND_FIELDS)
    return (j.select(field("period").alias("period_text")).groupBy("period_text")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select("period_text", hour_period("period_text").alias("period"), "n_rows"))


def q_state_history(spark, sf_dir):
    return marts.state_history(dirty_current(spark, sf_dir, "retail"))


def q_fact_with_state_at(spark, sf_dir):
    """Prices of states with the name each had in the month: one row per price."""
    stg = dirty_current(spark, sf_dir, "retail")
    fact = marts.fact_retail_prices(stg).filter(F.col("state_id").isNotNull()).select(
        "period", "state_id", "price_cents_kwh")
    return published(marts.with_state_at(fact, marts.state_history(stg)))


def _same_again(spark, sf_dir, dataset):
    """Effects of merging the second load, and of merging it once more."""
    target, source = (dirty_staged(spark, sf_dir, dataset, load) for load in LOADS)
    once = merge(target, source, runs.KEYS[dataset])
    again = merge(once.drop(EFFECT), source, runs.KEYS[dataset])
    return _union([df.agg(*effect_counts()).select(F.lit(dataset).alias("dataset"), F.lit(n).alias("run"), "*")
                   for n, df in ((1, once), (2, again))])


def q_upsert_idempotent(spark, sf_dir):
    """A second merge of the same load replaces and inserts nothing but keyless rows."""
    return _union([_same_again(spark, sf_dir, d) for d in DATASETS])


def q_keyless_rows(spark, sf_dir):
    """Rows with a NULL key after one and after two merges of the same load: they add up."""
    parts = []
    for d in ("retail", "generation"):
        keys = runs.KEYS[d]
        target, source = (dirty_staged(spark, sf_dir, d, load) for load in LOADS)
        once = merge(target, source, keys).drop(EFFECT)
        again = merge(once, source, keys).drop(EFFECT)
        keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        parts += [df.agg(F.count_if(keyless).alias("keyless"), F.count_if(~keyless).alias("keyed")).select(
            F.lit(d).alias("dataset"), F.lit(n).alias("merges"), "*") for n, df in ((0, target), (1, once), (2, again))]
    return _union(parts)


# ------------------------------------------------------------------ first versions, named measures

def q_legacy_stg_retail(spark, sf_dir):
    configure(spark)
    return published(legacy.staged_retail_strict(raw_load(spark, sf_dir, "retail")))


def q_legacy_stg_demand(spark, sf_dir):
    configure(spark)
    return published(legacy.staged_demand_strict(raw_load(spark, sf_dir, "demand")))


def q_demand_of_named_operators(spark, sf_dir):
    return published(measures.demand_by_operator(dirty_current(spark, sf_dir, "demand"), operators=SHOWN_OPERATORS))


def q_headline_of_region(spark, sf_dir):
    retail, generation, demand = (dirty_current(spark, sf_dir, d) for d in DATASETS)
    keyed = marts.fact_retail_prices(retail).filter(F.col("state_id").isNotNull())
    return published(measures.headline(keyed, marts.fact_generation(generation), demand,
                                       start_period="1996-01", demand_region=HEADLINE_REGION))


QUERIES = {
    "stored_retail_mart": q_stored_retail_mart,
    "stored_demand": q_stored_demand,
    "layer_report": q_layer_report,
    "merge_effect": q_merge_effect,
    "published_chunks": q_published_chunks,
    "reconcile_published": q_reconcile_published,
    "landed_files": q_landed_files,
    "calendar_gaps": q_calendar_gaps,
    "dirty_stg_retail": q_dirty_staging("retail"),
    "dirty_stg_generation": q_dirty_staging("generation"),
    "dirty_stg_rto": q_dirty_staging("demand"),
    "dirty_upsert_rto": q_dirty_upsert("demand"),
    "dirty_dim_state": q_dirty_dim_state,
    "dirty_leaderboard": q_dirty_leaderboard,
    "dirty_fact_generation": q_dirty_fact_generation,
    "dirty_hourly_export": q_dirty_hourly_export,
    "dirty_periods": q_dirty_periods,
    "state_history": q_state_history,
    "fact_with_state_at": q_fact_with_state_at,
    "upsert_idempotent": q_upsert_idempotent,
    "keyless_rows": q_keyless_rows,
    "legacy_stg_retail": q_legacy_stg_retail,
    "legacy_stg_demand": q_legacy_stg_demand,
    "demand_of_named_operators": q_demand_of_named_operators,
    "headline_of_region": q_headline_of_region,
}
