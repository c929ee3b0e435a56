"""Two scheduled runs against persisted layers reproduce the registered queries."""

from collections import Counter

import pytest

from ampere.plans import queries as Q
from ampere.plans.publish import published
from ampere.plans.runs import (MART_NAMES, TABLES, Layout, check_all, diagnose_demand, export_csv, hourly_pull, layer_report,
                               load_raw, mart_metrics, read_mart, read_staging, run_from_tables)
from ampere.sources import versions
from tests.conftest import SF_SMALL


def bag(df, cols):
    return Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())



def test_backfill_then_revision_then_rerun(spark, tmp_root):
    layout = Layout(tmp_root)
    run_from_tables(spark, SF_SMALL, layout, "backfill")
    first = read_staging(spark, layout, "retail")
    assert bag(first, first.columns) == bag(Q.staged(spark, SF_SMALL, "retail", "backfill"),
                                            first.columns)
    run_from_tables(spark, SF_SMALL, layout, "revision", publish_to=f"{tmp_root}/sheet")
    for d in ("retail", "generation", "demand"):
        got = read_staging(spark, layout, d)
        assert bag(got, got.columns) == bag(Q.current_staging(spark, SF_SMALL, d), got.columns)
    fact = read_mart(spark, layout, "fact_retail_prices")
    cols = ["period", "state_id", "is_anomaly"]
    assert bag(fact, cols) == bag(Q.fact_retail(spark, SF_SMALL), cols)
    # a re-run of the same window changes nothing
    before = bag(read_staging(spark, layout, "generation"), ["period", "state_id",
                                                             "fuel_type_code", "generation_mwh"])
    run_from_tables(spark, SF_SMALL, layout, "revision")
    after = bag(read_staging(spark, layout, "generation"), ["period", "state_id",
                                                            "fuel_type_code", "generation_mwh"])
    assert before == after
    lines = published(spark, f"{tmp_root}/sheet", "fact_retail_prices").orderBy("line").collect()
    assert lines[0].cells[:3] == ["PERIOD", "PERIOD_DATE", "STATE_ID"]
    assert len(lines) == fact.count() + 1
    paths = export_csv(spark, layout, f"{tmp_root}/csv")
    tab = spark.read.option("header", True).csv(f"{tmp_root}/csv/tabs/fact_retail_prices")
    assert tab.columns[:3] == ["PERIOD", "PERIOD_DATE", "STATE_ID"] and tab.count() == fact.count()
    hours = spark.read.option("header", True).csv(paths["staging_rto_demand"])
    assert hours.columns == ["hour", "hour_of_day", "month", "day_of_week", "region_id", "region_name", "demand_mwh"]
    assert hours.count() == read_staging(spark, layout, "demand").filter("demand_mwh is not null").count()
    assert spark.read.option("header", True).csv(paths["fact_generation"]).columns == read_mart(
        spark, layout, "fact_generation").columns

    whole = check_all(spark, layout, published=f"{tmp_root}/sheet", start="1995-01", raise_on_fail=False)
    report = {r.check_name: r.status for r in whole.collect()}
    assert all(report[f"published.{n}"] == "PASS" for n in MART_NAMES)
    # the sheet was published before the third run, which changed no value
    assert report["marts.fact_retail_prices"] == "PASS" and report["landing.retail"] == "PASS"
    assert report["staging.demand_coverage"] == "FAIL"   # 5 regions, not 50
    with pytest.raises(RuntimeError):
        check_all(spark, layout)


def test_reports_come_from_what_was_observed(spark, tmp_root):
    layout = Layout(tmp_root)
    result = run_from_tables(spark, SF_SMALL, layout, "backfill")
    effect = {r.dataset: r for r in result["effect"].collect()}
    for d in TABLES:
        stored = read_staging(spark, layout, d)
        assert effect[d].inserted == stored.count() == versions.stats(spark, layout.staging(d))[0]
        assert effect[d].kept == effect[d].replaced == effect[d].unchanged == effect[d].reinserted == 0
    for name in MART_NAMES:
        assert mart_metrics(spark, layout, name).n_rows == read_mart(spark, layout, name).count()
    report = layer_report(spark, layout)
    assert [r.status for r in report.collect()] == ["PASS"] * 9
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()  # no layer is read
    profile = diagnose_demand(spark, layout).first()
    assert profile.staging_rows == read_staging(spark, layout, "demand").count()
    assert profile.raw_rows == load_raw(spark, layout, None, "2026-03-01 00:00:00", ("demand",)).first().rows


def test_hourly_pull_ends_with_the_day(spark):
    from datetime import date
    rows = [("2024-01-30T23",), ("2024-01-31 00:15:00",), ("2024-02-01T00Z",), ("2024-02-02T05:30",), ("2024-02",), (None,)]
    got = hourly_pull(spark.createDataFrame(rows, "period string"), date(2024, 2, 1)).collect()
    assert [r.period for r in got] == ["2024-01-30T23", "2024-01-31 00:15:00", "2024-02-01T00Z"]


def test_planning_a_repull_starts_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("planning", "planning")
    try:
        for d in TABLES:
            Q.current_staging(spark, SF_SMALL, d)
        # resolving a table's schema reads a footer; nothing scans or aggregates rows
        jobs = [j for j in sc.statusTracker().getJobIdsForGroup("planning")
                if max((sc.statusTracker().getStageInfo(s).numTasks if sc.statusTracker().getStageInfo(s) else 0
                        for s in sc.statusTracker().getJobInfo(j).stageIds), default=0) > 1]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == []
