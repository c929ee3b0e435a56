import math

from pyspark.sql import functions as F

from ampere.plans import marts
from ampere.plans.exports import generation_by_category
from tests.conftest import rows


def retail_stg(spark, series):
    """series: {state: [prices by month]} -> staging rows (sector ALL)."""
    data = []
    for state, prices in series.items():
        for i, p in enumerate(prices):
            data.append((f"20{10 + i // 12:02d}-{i % 12 + 1:02d}", state, f"name {state}", "ALL",
                         "all", p, 1.0, 1, None))
    return spark.createDataFrame(data, "period string, state_id string, state_name string, "
                                       "sector_id string, sector_name string, price_cents_kwh double, "
                                       "sales_mwh double, customers bigint, ingested_at timestamp_ntz")


def z_of(fact, state):
    return [r.z_score for r in fact.filter(F.col("state_id") == state).orderBy("period").collect()]


def test_zscore_edge_cases(spark):
    fact = marts.fact_retail_prices(retail_stg(spark, {
        "AA": [5.0],                     # single month: std NULL, z 0
        "BB": [7.0] * 12,                # std 0, z 0
        "CC": [1.0] * 11 + [2.0],        # jump after 11 equal: z = 11/sqrt(12)
        "DD": [1.0] * 7 + [2.0],         # 8 rows: z = 7/sqrt(8), a spike but no anomaly
    }))
    got = {r.state_id: r for r in fact.filter("period = '2010-01'").collect()}
    assert got["AA"].rolling_std_12m is None and got["AA"].z_score == 0.0
    assert z_of(fact, "BB") == [0.0] * 12
    cc = fact.filter("state_id = 'CC'").orderBy("period").collect()[-1]
    assert math.isclose(cc.z_score, 11 / math.sqrt(12), rel_tol=1e-12) and cc.is_anomaly
    dd = fact.filter("state_id = 'DD'").orderBy("period").collect()[-1]
    assert math.isclose(dd.z_score, 7 / math.sqrt(8), rel_tol=1e-12) and not dd.is_anomaly


def test_window_counts_rows_not_months_and_z_bound(spark):
    prices = [float((i * 7919) % 13) for i in range(30)]
    fact = marts.fact_retail_prices(retail_stg(spark, {"EE": prices}))
    for n, r in enumerate(fact.orderBy("period").collect(), start=1):
        k = min(n, 12)
        assert abs(r.z_score) <= (k - 1) / math.sqrt(k) + 1e-9


def test_dim_state_and_leaderboard(spark):
    stg = retail_stg(spark, {"US": [1.0] * 11 + [9.0], "ABC": [1.0] * 11 + [9.0],
                             "TX": [1.0] * 11 + [9.0], "CA": [2.0] * 12})
    assert rows(marts.dim_state(stg), "state_id") == [("CA",), ("TX",), ("US",)]
    lead = marts.fact_anomaly_leaderboard(marts.fact_retail_prices(stg))
    assert [(r.state_id, r.anomaly_count) for r in lead.collect()] == [("TX", 1), ("US", 1)]


def gen_stg(spark, data):
    return spark.createDataFrame(
        [(p, s, c, f"d {c}", g, None) for p, s, c, g in data],
        "period string, state_id string, fuel_type_code string, fuel_type_desc string, "
        "generation_mwh double, ingested_at timestamp_ntz")


def test_generation_shares(spark):
    stg = gen_stg(spark, [
        ("2026-01", "TX", "NGO", 60.0), ("2026-01", "TX", "WNT", 40.0),
        ("2026-01", "TX", "ALL", 100.0), ("2026-01", "TX", "COL", 5.0),   # aggregates excluded
        ("2026-01", "TX", None, 5.0), ("2026-01", "TX", "PET", None),     # null code / value
        ("2026-01", "CA", "NUC", 10.0), ("2026-01", "CA", "SPV", -10.0),  # total 0 -> NULL share
        ("2026-01", None, "NGO", 3.0),                                    # NULL state groups
    ])
    fact = marts.fact_generation(stg)
    got = {(r.state_id, r.fuel_type_code): (r.fuel_category, r.generation_share)
           for r in fact.collect()}
    assert got == {("TX", "NGO"): ("Natural Gas", 0.6), ("TX", "WNT"): ("Wind", 0.4),
                   ("CA", "NUC"): ("Nuclear", None), ("CA", "SPV"): ("Solar & Geothermal", None),
                   (None, "NGO"): ("Natural Gas", 1.0)}
    rolled = generation_by_category(fact)
    assert rows(rolled.filter("state_id = 'TX'"), "fuel_category", "generation_share") == \
        [("Natural Gas", 0.6), ("Wind", 0.4)]


def test_demand_marts(spark):
    import datetime as dt
    stg = spark.createDataFrame([
        (dt.datetime(2026, 3, 1, 5), "PJM", "PJM", 100.0, None),
        (dt.datetime(2026, 3, 2, 5), "PJM", "PJM", 300.0, None),
        (dt.datetime(2026, 3, 2, 6), "PJM", "PJM", None, None),
    ], "period timestamp_ntz, region_id string, region_name string, demand_mwh double, "
       "ingested_at timestamp_ntz")
    heat = rows(marts.fact_rto_heatmap(stg), "hour_of_day", "avg_demand_mwh")
    assert heat == [(5, 200.0), (6, None)]
    reg = marts.fact_rto_regional(stg).first()
    assert (reg.month, reg.avg_demand_mwh, reg.peak_demand_mwh) == (dt.date(2026, 3, 1), 200.0, 300.0)


def test_chunked_rolling_equals_plain_window_on_a_hot_series(spark):
    from ampere.operators.rolling import rolling_zscore, rolling_zscore_chunked
    import random
    rnd = random.Random(7)
    data = []
    # one hot series with gaps (empty and 1-row chunks) and a few small ones
    for i in range(3000):
        if rnd.random() < 0.6 or i < 5:
            data.append(("HOT", i, float(rnd.randint(1, 40))))
    for s in ("A", "B"):
        for i in range(0, 200, 7):
            data.append((s, i, float(rnd.randint(1, 9))))
    data.append(("ONE", 5, 3.0))
    df = spark.createDataFrame(data, "k string, t long, x double")
    plain = rolling_zscore(df, ["k"], "t", "x", rows=12)
    chunked = rolling_zscore_chunked(df, ["k"], "t", "x", F.floor(F.col("t") / 17), rows=12)
    cols = ["k", "t", "x", "rolling_avg_12m", "rolling_std_12m", "z_score", "is_anomaly"]

    def key(r):
        return tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v) for v in r)

    assert sorted(key(r) for r in plain.select(*cols).collect()) == \
        sorted(key(r) for r in chunked.select(*cols).collect())
