import json

from pyspark.sql import functions as F

from ampere.plans.runs import Layout, read_staging
from ampere.sources import landing
from ampere.streaming.landing_stream import start_staging_stream


def land(spark, root, recs):
    df = spark.createDataFrame([(r["period"], json.dumps(r)) for r in recs],
                               "period string, payload string")
    landing.write_landing(df, root, "generation")


def rec(period, state, code, gen):
    return {"period": period, "location": state, "fueltypeid": code,
            "fuelTypeDescription": "x", "generation": gen}


def test_stream_upserts_new_and_revised_months(spark, tmp_root):
    layout = Layout(tmp_root)
    ckpt = f"{tmp_root}/_ckpt/generation"
    land(spark, layout.landing, [rec("2026-01", "TX", "NGO", "1"), rec("2026-02", "TX", "NGO", "2")])
    q = start_staging_stream(spark, layout, "generation", ckpt)
    q.awaitTermination(300)
    got = {r.period: r.generation_mwh for r in read_staging(spark, layout, "generation").collect()}
    assert got == {"2026-01": 1.0, "2026-02": 2.0}
    # February is re-landed with a revised value, March is new; January is untouched
    land(spark, layout.landing, [rec("2026-02", "TX", "NGO", "5"), rec("2026-03", "TX", "NGO", "7")])
    q = start_staging_stream(spark, layout, "generation", ckpt)
    q.awaitTermination(300)
    stg = read_staging(spark, layout, "generation")
    got = {r.period: r.generation_mwh for r in stg.collect()}
    assert got == {"2026-01": 1.0, "2026-02": 5.0, "2026-03": 7.0}
    assert stg.filter(F.col("ingested_at").isNull()).count() == 0


def test_a_cut_off_array_fails_the_batch(spark, tmp_root):
    import gzip
    import os

    import pytest
    from pyspark.errors import StreamingQueryException

    folder = os.path.join(tmp_root, "landing", "raw", "generation", "year=2026", "month=01")
    os.makedirs(folder)
    with gzip.open(os.path.join(folder, "data.json.gz"), "wt") as f:
        f.write('[{"period": "2026-01", "location": "TX"}, {"period": "2026')
    q = start_staging_stream(spark, Layout(tmp_root), "generation", f"{tmp_root}/_ckpt")
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(300)
