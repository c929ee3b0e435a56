"""Chunked publishing: files, order, header, reconciliation, republishing."""

import glob
import json
import os

from pyspark.sql import functions as F

from ampere.plans import exports
from ampere.plans import publish as P


def tab(spark, n=2500):
    return spark.range(0, n, numPartitions=5).select(
        ((F.col("id") * 7) % max(n, 1)).alias("k"), F.concat(F.lit(' "q",\n'), F.col("id").cast("string")).alias("state_id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") / 7).alias("b"))


def test_files_hold_the_chunks_in_order(spark, tmp_root):
    df = tab(spark)
    assert P.publish({"t": df}, tmp_root, {"t": ["k"]}, chunk_rows=1000) == {"t": 2500}
    folder = glob.glob(f"{tmp_root}/t/v=*")
    assert len(folder) == 1 and len(glob.glob(f"{folder[0]}/chunk=*")) == 3
    lines = []
    for chunk in range(3):
        (file,) = glob.glob(f"{folder[0]}/chunk={chunk}/part-*")
        with open(file, encoding="utf-8") as f:
            lines += [json.loads(x) for x in f]
    assert [x["line"] for x in lines] == list(range(2501))  # in sheet order within and over files
    assert lines[0]["cells"] == ["K", "STATE_ID", "B"]
    assert [int(x["cells"][0]) for x in lines[1:]] == list(range(2500))
    assert all(x["cells"][1].startswith("' \"q\",\n") for x in lines[1:])
    ranges = exports.chunk_ranges("t", df, ["k"], 1000)
    got = P.written_ranges(spark, tmp_root, ["t"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ranges.collect()))


def test_an_empty_tab_is_its_header(spark, tmp_root):
    df = tab(spark, 5).filter("k < 0")
    assert P.publish({"t": df}, tmp_root, {"t": ["k"]}) == {"t": 0}
    assert [tuple(r.cells) for r in P.published(spark, tmp_root, "t").collect()] == [("K", "STATE_ID", "B")]
    assert P.reconcile(spark, tmp_root, {"t": df}).first() == ("t", 0, 0, True, True)


def test_one_changed_cell_turns_the_reconciliation_red(spark, tmp_root):
    df = tab(spark, 300)
    P.publish({"t": df}, tmp_root, {"t": ["k"]}, chunk_rows=100)
    assert P.reconcile(spark, tmp_root, {"t": df}).first() == ("t", 300, 300, True, True)
    changed = df.withColumn("b", F.when(F.col("k") == 123, F.lit(1.5)).otherwise(F.col("b")))
    assert P.reconcile(spark, tmp_root, {"t": changed}).first() == ("t", 300, 300, True, False)
    renamed = df.withColumnRenamed("b", "c")
    assert P.reconcile(spark, tmp_root, {"t": renamed}).first() == ("t", 300, 300, False, True)
    (file,) = glob.glob(f"{tmp_root}/t/v=*/chunk=1/part-*")  # a line lost in a stored file
    with open(file, encoding="utf-8") as f:
        kept = f.readlines()[1:]
    os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    with open(file, "w", encoding="utf-8") as f:
        f.writelines(kept)
    assert P.reconcile(spark, tmp_root, {"t": df}).first() == ("t", 300, 299, True, False)


def test_readers_see_the_last_whole_publish(spark, tmp_root, monkeypatch):
    P.publish({"t": tab(spark, 10)}, tmp_root, {"t": ["k"]})

    def kill(*args):
        raise InterruptedError

    monkeypatch.setattr(P.versions, "advance", kill)
    try:
        P.publish({"t": tab(spark, 20)}, tmp_root, {"t": ["k"]})
    except InterruptedError:
        pass
    monkeypatch.undo()
    assert P.published(spark, tmp_root, "t").count() == 11
    P.publish({"t": tab(spark, 30)}, tmp_root, {"t": ["k"]})
    assert P.published(spark, tmp_root, "t").count() == 31
