"""MERGE with effects against a plain dictionary, keyless rows, the persisted form."""

import random

from pyspark.sql import functions as F

from ampere.operators.digest import content_digest
from ampere.operators.merge import EFFECT, EFFECTS, effect_counts, merge
from ampere.operators.upsert import upsert
from ampere.plans import runs
from ampere.sources import versions
from tests.conftest import rows

COLUMNS = "k1 string, k2 long, v double, ingested_at long"


def plain(target, source):
    """Rows and effects by a dictionary; keyless rows never match."""
    held = {r[:2]: r for r in target if None not in r[:2]}
    out = [(*r, "kept") for r in target if None in r[:2]]
    for r in source:
        if None in r[:2]:
            out.append((*r, "reinserted"))
            continue
        old = held.pop(r[:2], None)
        what = "inserted" if old is None else "unchanged" if old[2] == r[2] else "replaced"
        out.append((*r, what))
    return sorted([*out, *((*r, "kept") for r in held.values())], key=repr)


def sample(seed, stamp):
    r = random.Random(seed)
    keys = {(r.choice(["a", "b", "c", None]), r.choice([1, 2, 3, 4, 5, None])) for _ in range(25)}
    return [(*k, r.choice([1.0, 2.0, None]), stamp) for k in sorted(keys, key=repr)]


def test_rows_and_effects_equal_a_dictionary(spark):
    seen = set()
    for seed in range(6):
        t, s = sample(seed, 1), sample(seed + 100, 2)
        got = merge(spark.createDataFrame(t, COLUMNS), spark.createDataFrame(s, COLUMNS), ["k1", "k2"])
        assert sorted(map(tuple, got.collect()), key=repr) == plain(t, s)
        seen |= {r[EFFECT] for r in got.collect()}
        assert rows(got.drop(EFFECT)) == rows(upsert(spark.createDataFrame(t, COLUMNS),
                                                     spark.createDataFrame(s, COLUMNS), ["k1", "k2"]))
    assert seen == set(EFFECTS)


def test_merging_twice_only_adds_keyless_rows(spark):
    t, s = (spark.createDataFrame(sample(n, n), COLUMNS) for n in (1, 2))
    once = merge(t, s, ["k1", "k2"]).drop(EFFECT)
    again = merge(once, s, ["k1", "k2"])
    c = again.agg(*effect_counts()).first()
    assert c.inserted == c.replaced == 0 and c.reinserted > 0
    keyless = F.col("k1").isNull() | F.col("k2").isNull()
    assert rows(again.drop(EFFECT).filter(~keyless)) == rows(once.filter(~keyless))


def test_keyless_rows_are_split_off_before_the_exchange(spark, tmp_root):
    for name, n in (("t", 1), ("s", 2)):
        spark.createDataFrame(sample(n, n) * 1, COLUMNS).write.parquet(f"{tmp_root}/{name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = merge(spark.read.parquet(f"{tmp_root}/t"), spark.read.parquet(f"{tmp_root}/s"), ["k1", "k2"])
        plan = df._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("IsNotNull(k1)") == 2          # both join inputs are read without keyless rows
    assert plan.count("Or(IsNull(k1),IsNull(k2))") == 2  # which are read on their own, and join nothing


def test_persisted_merge_counts_and_commits_all_months_at_once(spark, tmp_root):
    def batch(data):
        return spark.createDataFrame(data, "period string, state_id string, x double, ingested_at long")

    path, keys, cols = f"{tmp_root}/t", ["period", "state_id"], ["period", "state_id", "x", "ingested_at"]
    first = runs.upsert_table(spark, path, batch([("2024-01", "A", 1.0, 1), ("2024-02", "A", 2.0, 1),
                                                  ("2024-02", "B", 3.0, 1), ("2024-02", None, 4.0, 1)]), keys, cols)
    assert first == {"kept": 0, "inserted": 3, "replaced": 0, "unchanged": 0, "reinserted": 1}
    base = versions.current(spark, path)
    second = runs.upsert_table(spark, path, batch([("2024-02", "A", 2.0, 2), ("2024-02", "B", None, 2),
                                                   ("2024-03", "C", 5.0, 2), ("2024-02", None, 4.0, 2)]), keys, cols)
    assert second == {"kept": 1, "inserted": 1, "replaced": 1, "unchanged": 1, "reinserted": 1}
    schema = batch([]).schema
    assert rows(versions.read(spark, path, schema).drop("ym")) == sorted([
        ("2024-01", "A", 1.0, 1), ("2024-02", None, 4.0, 1), ("2024-02", None, 4.0, 2), ("2024-02", "A", 2.0, 2),
        ("2024-02", "B", None, 2), ("2024-03", "C", 5.0, 2)], key=lambda t: tuple((v is not None, v) for v in t))
    assert len({m.v for m in versions.manifest(spark, path)}) == 2
    assert versions.read(spark, path, schema, base).count() == 4


def test_digests_ignore_order_and_see_every_change(spark):
    def digest(data):
        return spark.createDataFrame(data, "a string, b long").agg(*content_digest(["a", "b"])).first()

    base = [("x", 1), ("y", None), (None, 2), ("x", 1)]
    assert digest(base) == digest(base[::-1])
    assert digest([]) == (0, "0:0")
    for other in (base[:3], [*base, ("x", 1)], [("x", 1), ("y", 0), (None, 2), ("x", 1)],
                  [("x", 1), ("y", None), ("", 2), ("x", 1)], [("y", None), ("y", None), (None, 2), ("x", 1)]):
        assert digest(other) != digest(base)
