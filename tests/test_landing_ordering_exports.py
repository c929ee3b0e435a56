import gzip
import json
import os

from pyspark.sql import functions as F

from ampere.functions.cells import format_cells
from ampere.operators.ordering import ordered_index
from ampere.operators.quality import require
from ampere.plans import checks
from ampere.sources import landing
from tests.conftest import rows


def payloads(spark, recs):
    return spark.createDataFrame([(r.get("period"), json.dumps(r)) for r in recs],
                                 "period string, payload string")


def test_landing_overwrites_only_written_months(spark, tmp_root):
    first = payloads(spark, [{"period": "2026-01", "v": 1}, {"period": "2026-02", "v": 2},
                             {"period": "2026", "v": 9}, {"v": 0}])
    landing.write_landing(first, tmp_root, "retail")
    second = payloads(spark, [{"period": "2026-02", "v": 3}])
    landing.write_landing(second, tmp_root, "retail")
    got = landing.read_landing(spark, tmp_root, "retail").select(
        "year", "month", F.get_json_object("payload", "$.v").alias("v"))
    assert rows(got) == [("2026", "01", "1"), ("2026", "02", "3")]   # short periods dropped


def test_landing_reads_array_files_and_missing_months(spark, tmp_root):
    d = os.path.join(tmp_root, "raw", "retail-prices", "year=2025", "month=12")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "data.json.gz"), "wt") as fh:
        json.dump([{"period": "2025-12", "v": 1}, {"period": "2025-12", "v": 2}], fh)
    import datetime as dt
    df = landing.read_landing(spark, tmp_root, "retail", [dt.date(2025, 12, 1), dt.date(2026, 1, 1)])
    assert df.count() == 2
    assert df.first().source_file == "raw/retail-prices/year=2025/month=12/data.json.gz"
    assert landing.read_landing(spark, tmp_root, "retail", [dt.date(2024, 1, 1)]).count() == 0


def test_ordered_index_matches_global_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        ((F.col("id") * 7919) % 5000).alias("k"))
    idx = ordered_index(df, ["k"])
    got = sorted((r.k, r.row_index) for r in idx.collect())
    assert got == [(k, k) for k in range(5000)]


def test_format_cells(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [("2026-01", "90", True, 1.23456789, dt.date(2026, 1, 1), 5, "x"),
         (None, None, None, None, None, None, None)],
        "period string, state_id string, is_anomaly boolean, z double, d date, n bigint, s string")
    out = format_cells(df).collect()
    assert out[0].asDict() == {"PERIOD": "'2026-01", "STATE_ID": "'90", "IS_ANOMALY": "TRUE",
                               "Z": "1.234568", "D": "2026-01-01", "N": "5", "S": "x"}
    assert set(out[1].asDict().values()) == {""}


def test_quality_reports(spark):
    raw = spark.range(3).select(F.lit("{}").alias("payload"))
    empty = spark.range(0)
    report = checks.staging_guard(raw, empty, "retail_prices")
    assert report.first().status == "FAIL"
    try:
        require(report)
        raise AssertionError("expected failure")
    except RuntimeError as e:
        assert "retail_prices" in str(e)
    ok = checks.staging_guard(empty.select(F.lit("{}").alias("payload")), empty, "x")
    assert require(ok).first().status == "PASS"


def test_chunk_ranges_over_several_chunks(spark):
    from ampere.plans.exports import chunk_ranges
    df = spark.range(0, 2500, numPartitions=5).select(
        ((F.col("id") * 7) % 2500).alias("k"), F.lit("x").alias("a"), F.lit(1.0).alias("b"))
    got = sorted(tuple(r) for r in chunk_ranges("t", df, ["k"], chunk_rows=1000).collect())
    # 2501 lines (header + 2500 rows) -> three write calls
    assert got == [("t", 0, 1, 1000, "'t'!A1:C1000"),
                   ("t", 1, 1001, 2000, "'t'!A1001:C2000"),
                   ("t", 2, 2001, 2501, "'t'!A2001:C2501")]


def test_sample_payloads_is_deterministic(spark):
    raw = spark.createDataFrame([("c",), ("a",), ("b",), ("d",)], "payload string")
    assert [r.payload for r in checks.sample_payloads(raw, 3).collect()] == ["a", "b", "c"]
