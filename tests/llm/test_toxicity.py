"""Toxicity: held-out accuracy, the counterfactual penalty, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from ampere.llm import toxicity


def corpus(n, seed):
    r = random.Random(seed)
    calm = ["the", "river", "music", "garden", "market", "and", "people", "walk", "quiet", "story"]
    rude = ["idiots", "scum", "trash", "vermin"]
    rows = []
    for i in range(n):
        toxic = r.random() < 0.25
        words = [r.choice(calm) for _ in range(r.randint(15, 60))]
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(rude))
        # One group is mentioned mostly in toxic texts.
        if r.random() < (0.7 if toxic else 0.05):
            words.insert(0, "Muslims")
        elif r.random() < 0.2:
            words.insert(0, r.choice(["Christians", "Hindus", "Buddhists"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def frames(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_learns_and_spares_neutral_mentions(spark):
    docs, labels = frames(spark, corpus(900, 1))
    model = toxicity.learn(docs, labels, strength=4.0)
    loose = toxicity.learn(docs, labels, strength=0.0)
    test = corpus(400, 2)
    got = {r.doc_id: r.score for r in toxicity.score(frames(spark, test)[0], model).collect()}
    right = sum((got[i] >= 0.3) == bool(y) for i, _, y in test)
    assert right >= 0.97 * len(test)
    words = {toxicity._id("muslims")}
    assert abs(sum(model.weights.get(i, 0) for i in words)) < 0.35 * abs(sum(loose.weights.get(i, 0) for i in words))


def test_swapping_stays_in_kind():
    assert toxicity.swapped({"the", "women"}) != {"the", "women"}
    assert toxicity.swapped({"the", "women"}) <= {"the", *toxicity.SWAP["women"]}
    assert toxicity.swapped({"the", "cat"}) is None


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "x"), (2, "a" * 5000), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs.withColumn("score", F.lit("old")), model).collect()
    assert len(rows) == 5 and all(0 < r.score < 1 for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), labels.limit(0))).count() == 0


def test_query_on_held_out_documents(spark):
    from ampere.llm.queries import op3_counterfactual_toxicity
    d = "/root/testdata/sf0.1"
    rows = op3_counterfactual_toxicity(spark, d).join(
        spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert pytest.approx(1) == sum(t.score > c.score for t in toxic for c in clean) / len(toxic) / len(clean) or (
        sum(t.score > c.score for t in toxic for c in clean) >= 0.97 * len(toxic) * len(clean))
