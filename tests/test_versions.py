"""Versioned tables: one commit for several months, crashes, conflicts, time travel, vacuum."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.sources import versions

NAMED = T.StructType([T.StructField("period", T.StringType()), T.StructField("x", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, NAMED).withColumn("ym", F.substring("period", 1, 7))


def content(spark, path, version=None, months=None):
    return sorted((r.period, r.x) for r in versions.read(spark, path, NAMED, version, months).collect())


def commit(spark, path, rows, base="current"):
    base = versions.current(spark, path) if base == "current" else base
    return versions.commit(spark, path, frame(spark, rows), NAMED, base)


def test_a_commit_replaces_its_months_and_keeps_the_others(spark, tmp_root):
    assert content(spark, tmp_root) == [] and versions.stats(spark, tmp_root) == (0, None, None)
    first = commit(spark, tmp_root, [("2024-01", 1), ("2024-02", 2), ("2024-03", 3)])
    second = commit(spark, tmp_root, [("2024-02", 20), ("2024-02", 21), ("2024-04", 40)])
    now = [("2024-01", 1), ("2024-02", 20), ("2024-02", 21), ("2024-03", 3), ("2024-04", 40)]
    assert content(spark, tmp_root) == now
    assert content(spark, tmp_root, first) == [("2024-01", 1), ("2024-02", 2), ("2024-03", 3)]
    assert content(spark, tmp_root, months=["2024-02", "2023-01"]) == [("2024-02", 20), ("2024-02", 21)]
    assert versions.stats(spark, tmp_root) == (5, "2024-01", "2024-04")
    assert {m.ym: m.v == second for m in versions.manifest(spark, tmp_root)} == {
        "2024-01": False, "2024-02": True, "2024-03": False, "2024-04": True}


@pytest.mark.parametrize("step", ["data", "manifest", "pointer"])
def test_a_run_killed_inside_a_commit_leaves_the_old_version(spark, tmp_root, monkeypatch, step):
    commit(spark, tmp_root, [("2024-01", 1), ("2024-02", 2)])
    before = content(spark, tmp_root)

    class Killed(Exception):
        pass

    def kill(*args, **kwargs):
        raise Killed

    if step == "data":  # one of two months is written when the run dies
        version = versions.new_version()
        frame(spark, [("2024-01", 100)]).write.partitionBy("ym").parquet(f"{tmp_root}/data/v={version}")
    else:
        monkeypatch.setattr(versions, "manifest" if step == "manifest" else "advance", kill)
        with pytest.raises(Killed):
            commit(spark, tmp_root, [("2024-01", 100), ("2024-02", 200)], versions.current(spark, tmp_root))
        monkeypatch.undo()
    assert content(spark, tmp_root) == before
    commit(spark, tmp_root, [("2024-02", 3)])  # the next run is not disturbed by the leftovers
    assert content(spark, tmp_root) == [("2024-01", 1), ("2024-02", 3)]


def test_a_commit_on_an_outdated_version_is_refused(spark, tmp_root):
    base = commit(spark, tmp_root, [("2024-01", 1)])
    commit(spark, tmp_root, [("2024-01", 2)])
    with pytest.raises(versions.Conflict):
        commit(spark, tmp_root, [("2024-01", 3)], base)
    assert content(spark, tmp_root) == [("2024-01", 2)]


def test_an_empty_batch_changes_nothing(spark, tmp_root):
    commit(spark, tmp_root, [])
    assert content(spark, tmp_root) == []
    commit(spark, tmp_root, [("2024-01", 1)])
    commit(spark, tmp_root, [])
    assert content(spark, tmp_root) == [("2024-01", 1)]


def test_only_named_months_are_scanned(spark, tmp_root):
    commit(spark, tmp_root, [("2024-01", 1), ("2024-02", 2)])
    commit(spark, tmp_root, [("2024-02", 3)])
    files = versions.read(spark, tmp_root, NAMED, months=["2024-01"])
    assert len({f for f in files.select(F.col("_metadata.file_path")).distinct().collect()}) == 1
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ym#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_vacuum_keeps_what_the_latest_versions_name(spark, tmp_root):
    made = [commit(spark, tmp_root, [("2024-01", k)] + ([("2024-02", 9)] if k == 0 else [])) for k in range(4)]
    assert versions.vacuum(spark, tmp_root, keep=2) == [made[1]]  # 0 holds February, 2 and 3 are kept
    assert content(spark, tmp_root) == [("2024-01", 3), ("2024-02", 9)]
    assert content(spark, tmp_root, made[2]) == [("2024-01", 2), ("2024-02", 9)]
    assert sorted(f for f in os.listdir(f"{tmp_root}/data") if f.startswith("v=")) == sorted(
        f"v={made[i]}" for i in (0, 2, 3))
    assert versions.vacuum(spark, f"{tmp_root}/none") == []
