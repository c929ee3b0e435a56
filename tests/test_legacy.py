"""First versions of the staging steps: variant path, strict casts, cut texts."""

import json

import pytest

from ampere.plans import legacy
from ampere.plans.marts import state_history, with_state_at
from tests.conftest import rows


def raw(spark, *records):
    return spark.createDataFrame([(json.dumps(r), "2026-01-01") for r in records], "payload string, at string").selectExpr(
        "payload", "cast(at as timestamp_ntz) as ingested_at")


GOOD = {"period": "2026-01-15", "stateid": "TX", "stateDescription": "Texas", "sectorid": "RES" * 10,
        "sectorName": "home", "price": "9.5", "sales": 12, "customers": "7"}


def test_retail_is_cut_typed_and_collapsed(spark):
    out = legacy.staged_retail_strict(raw(spark, GOOD, GOOD, {**GOOD, "price": None}, {"stateid": "no period"}))
    got = rows(out.drop("ingested_at"))
    base = ("2026-01", "TX", "Texas", ("RES" * 10)[:20], "home")
    assert got == [(*base, None, 12.0, 7), (*base, 9.5, 12.0, 7)]


@pytest.mark.parametrize("field,text", [("price", "w"), ("sales", "1,5"), ("customers", "7.5")])
def test_a_bad_number_names_its_record(spark, field, text):
    out = legacy.staged_retail_strict(raw(spark, GOOD, {**GOOD, "stateid": "ZZ", field: text}))
    with pytest.raises(Exception, match=f"{field} is not a .*number: {text} in .*ZZ"):
        out.collect()


def test_demand_keeps_minutes_and_every_series(spark):
    hour = {"period": "2026-01-15T05", "respondent": "A", "respondent-name": "Alpha", "value": "1", "type": "DF"}
    out = legacy.staged_demand_strict(raw(
        spark, hour, {**hour, "value": "3", "type": "D"}, {**hour, "period": "2026-01-15T05:30"},
        {**hour, "period": "2026-01-15T05Z", "respondent": None}))
    got = [(str(r.period), r.region_id, r.demand_mwh) for r in out.orderBy("period", "region_id").collect()]
    assert got == [("2026-01-15 05:00:00", None, 1.0), ("2026-01-15 05:00:00", "A", 2.0), ("2026-01-15 05:30:00", "A", 1.0)]
    with pytest.raises(Exception, match="period is not a timestamp: 2026-01-45T99"):
        legacy.staged_demand_strict(raw(spark, {**hour, "period": "2026-01-45T99"})).collect()


def test_a_renamed_state_does_not_double_its_facts(spark):
    stg = spark.createDataFrame(
        [("2025-01", "TX", "Old"), ("2025-02", "TX", "Old"), ("2025-03", "TX", "New"), ("2025-04", "TX", None),
         ("2025-05", "TX", "Old"), ("2025-01", "CA", "Cal"), ("2025-01", "USA", "Land")],
        "period string, state_id string, state_name string")
    history = state_history(stg)
    assert rows(history) == [("CA", "Cal", "2025-01", None), ("TX", "New", "2025-03", "2025-05"),
                             ("TX", "Old", "2025-01", "2025-03"), ("TX", "Old", "2025-05", None)]
    facts = spark.createDataFrame([(f"2025-0{m}", "TX") for m in range(1, 7)] + [("2024-12", "TX"), ("2025-03", "ZZ")],
                                  "period string, state_id string")
    got = {(r.period, r.state_id): r.dim_state_name for r in with_state_at(facts, history).collect()}
    assert len(got) == 8 == with_state_at(facts, history).count()
    assert [got[f"2025-0{m}", "TX"] for m in range(1, 7)] == ["Old", "Old", "New", "New", "Old", "Old"]
    assert got["2024-12", "TX"] is None and got["2025-03", "ZZ"] is None
