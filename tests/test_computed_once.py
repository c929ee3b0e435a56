"""Frames that several plans read are computed once, and independent steps run side by side."""

import os
import threading
from datetime import datetime

import pytest

from ampere.plans.queries import current_frames
from ampere.plans.stored_queries import dirty_current
from ampere.session import held, side_by_side
from ampere.sources.bindings import generation_records, retail_records
from ampere.sources.dirty import dirty_generation, dirty_retail
from tests.conftest import rows

DAY = datetime(1995, 3, 14, 5, 6)
TABLES = {
    "nation": ("n_nationkey int, n_name string", [(1, "ONE"), (2, "TWO"), (2, "TWO")]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, 1), (3, 2), (4, 2), (None, 1)]),
    "supplier": ("s_suppkey long, s_nationkey int", [(1, 1), (2, 2), (None, 2)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
               [(1, 1, DAY, "A"), (2, 1, DAY, "B"), (3, 2, DAY, "A"), (4, 1, DAY, "A"), (5, 3, DAY, None),
                (6, 3, DAY, "A"), (7, None, DAY, "A"), (8, 2, None, "A")]),
    "lineitem": ("l_orderkey long, l_suppkey long, l_partkey long, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_shipdate timestamp_ntz",
                 [(k, 1 + k % 2, p, float(k), 10.0 * k, 0.1, DAY) for k in range(1, 9) for p in (0, 6)]
                 + [(None, None, 1, 1.0, 1.0, 0.0, DAY), (1, 1, 0, 2.0, 3.0, 0.0, None)]),
    "events": ("event_id long, ts timestamp_ntz, event_type string, value double, props string",
               [(i, DAY, "view", float(i), '{"k": 0}') for i in range(8)]),
}


@pytest.fixture()
def small(spark, tmp_root):
    for name, (schema, data) in TABLES.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_root}/{name}.parquet")
    return tmp_root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_customers_count_once_per_sector_and_once_for_all(spark, small):
    got = {(r.period, r.stateid, r.sectorid): (r.sales, r.customers) for r in retail_records(spark, small).collect()}
    assert got == {  # customers 1 and 2 of state 01; customer 3 of a nation listed twice
        ("1995-03", "01", "A"): (18.0, 2), ("1995-03", "01", "B"): (4.0, 1), ("1995-03", "01", "ALL"): (22.0, 2),
        ("1995-03", "02", "A"): (24.0, 1), ("1995-03", "02", None): (20.0, 1), ("1995-03", "02", "ALL"): (44.0, 1),
        (None, "01", "A"): (16.0, 1), (None, "01", "ALL"): (16.0, 1)}


def test_orders_are_not_doubled_before_they_are_shuffled(spark, small):
    assert "Expand" not in plan(retail_records(spark, small))


def test_generation_by_month_and_code(spark, small):
    got = {(r.period, r.location, r.fueltypeid): r.generation for r in generation_records(spark, small).collect()}
    assert got == {("1995-03", "01", "ALL"): 20.0, ("1995-03", "01", "STH"): 20.0,
                   ("1995-03", "02", "ALL"): 16.0, ("1995-03", "02", "STH"): 16.0, (None, "01", "ALL"): 2.0}


@pytest.mark.parametrize("records", [dirty_retail, dirty_generation])
def test_records_with_defects_are_computed_once(spark, small, records):
    df = records(spark, small)
    assert plan(df).count("lineitem.parquet") == 1


def test_the_batch_of_an_upsert_is_not_planned_again(spark, small):
    p = plan(dirty_current(spark, small, "generation"))
    assert p.count("lineitem.parquet") == 1  # the first load; the second is read from its scratch table


def test_marts_read_the_held_staging(spark, small):
    frames = current_frames(spark, small, "generation", "fact_generation", "fact_rto_regional")
    assert not any(t in plan(df) for df in frames.values() for t in ("lineitem.parquet", "events.parquet"))


def test_held_rows_and_types(spark):
    df = spark.range(3).selectExpr("id", "CASE WHEN id > 0 THEN CAST(id AS decimal(9,2)) END AS d",
                                   "timestamp_ntz'1995-03-14 05:06:07' AS t")
    again = held(df)
    assert again.dtypes == df.dtypes and rows(again) == rows(df)


def test_side_by_side_in_order_and_at_once(spark):
    meet = threading.Barrier(3, timeout=20)
    assert side_by_side(spark, lambda n: (meet.wait() >= 0, n * n), (1, 2, 3)) == [(True, 1), (True, 4), (True, 9)]


def test_side_by_side_raises_the_first_error(spark):
    done = []

    def work(n):
        if n == 1:
            raise ValueError("one")
        done.append(spark.range(n).count())

    with pytest.raises(ValueError, match="one"):
        side_by_side(spark, work, (1, 2, 3))
    assert sorted(done) == [2, 3]


def test_landed_source_file_starts_at_the_raw_folder(spark, tmp_root):
    from ampere.sources import landing
    root = os.path.join(tmp_root, "land")
    landing.write_landing(spark.createDataFrame([("1995-03", "{}")], "period string, payload string"), root, "demand")
    [r] = landing.read_landing(spark, root, "demand").collect()
    assert r.source_file.startswith("raw/rto-demand/year=1995/month=03/part-") and (r.year, r.month) == ("1995", "03")
