"""Secret scanning: held-out accuracy on planted secrets and look-alikes, odd rows."""

import random
import string

from pyspark.sql import functions as F

from ampere.llm import secret_scan


def corpus(n, seed):
    r = random.Random(seed)
    words = ["service", "config", "deploy", "river", "market", "update", "with", "from", "garden", "number"]
    rows = []
    for i in range(n):
        prose = lambda k: " ".join(r.choice(words) for _ in range(k))
        kind = i % 6
        hexes = "".join(r.choice("0123456789abcdef") for _ in range(40))
        value = {0: "AKIA" + "".join(r.choice(string.ascii_uppercase + string.digits) for _ in range(15)) + "7",
                 1: "".join(r.choice(string.ascii_letters + string.digits) for _ in range(31)) + "9",
                 2: hexes, 3: "".join(r.choice(string.digits) for _ in range(16)),
                 4: r.choice(words) + r.choice(words) + "-" + str(r.randint(10, 9999)), 5: hexes}[kind]
        lead = {0: " key ", 1: ' token = "', 2: " commit ", 3: " card ", 4: " see ", 5: " secret="}[kind]
        rows.append((i, prose(20) + lead + value + (" " if kind != 1 else '" ') + prose(10), kind in (0, 1, 5)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1200, 3)
    truth = {i: y for i, _, y in rows}
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    words = secret_scan.dictionary(docs)
    found = secret_scan.candidates(docs, words).cache()
    labelled = found.filter("id % 5 < 3").join(
        spark.createDataFrame([(i, int(y)) for i, y in truth.items()], "id long, label int"), "id")
    judged = secret_scan.judge(found.filter("id % 5 >= 3"), secret_scan.train(labelled)).collect()
    assert len(judged) >= 470
    right = sum((r.score >= 0.5) == truth[r.id] for r in judged)
    assert right >= 0.97 * len(judged)
    texts = {i: t for i, t, _ in rows}
    assert all(texts[r.id][r.start:r.start + len(r.value)] == r.value for r in judged)


def test_scan_with_odd_rows(spark):
    rows = [(1, None, None), (1, "", "p"), (None, "password=abcdef1234567890", None), (2, "x" * 40_000 + "1", "p")]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, score string")
    out = secret_scan.scan(docs, lambda id: F.lit(True), path="score").collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    assert secret_scan.scan(docs.limit(0), lambda id: F.lit(True)).count() == 0


PLANTED = ['password = "P@ssw0rd!2024"', "pwd=Tr0ub4dor&3", "token: correct-horse-battery-staple",
           "secret=AbCdEfGhIjKlMnOpQrStUvWx", "api_key='two words'", 'config["passwd"] => kurz', '{"auth": "q!"}']
VALUES = ["P@ssw0rd!2024", "Tr0ub4dor&3", "correct-horse-battery-staple", "AbCdEfGhIjKlMnOpQrStUvWx", "two words",
          "kurz", "q!"]


def test_assigned_values_of_any_form_are_candidates(spark):
    texts = [f"river garden {p}, and more text" for p in PLANTED] + ["loose AbCdEfGhIjKlMnOpQrStUvWx here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.id, r.value) for r in secret_scan.candidates(docs, set()).collect()}
    assert found >= set(enumerate(VALUES + VALUES[3:4]))
    assert secret_scan.spans("the author: someone, at https://example.org/ or keys; = none") == []


def test_scan_judges_such_values_secret(spark):
    r = random.Random(4)
    text = lambda i: corpus(6, i)[r.randrange(6)][1]
    rows = [(i, text(i) + " " + PLANTED[i % 4] + " and more") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = secret_scan.scan(docs, lambda id: id % 5 < 3).filter("doc_id % 5 >= 3").collect()
    for n in range(4):
        scores = [x.score for x in out if x.doc_id % 4 == n and x.value == VALUES[n]]
        assert len(scores) == 40 and sum(s >= 0.5 for s in scores) >= 36


def test_hot_copies_do_not_fill_the_sample(spark):
    rows = corpus(600, 5)
    docs = spark.createDataFrame([(i, t, int(y)) for i, t, y in rows], "doc_id long, text string, label int")
    found = secret_scan.candidates(docs, set()).join(docs.select(F.col("doc_id").alias("id"), "label"), "id").cache()
    first = found.orderBy(F.xxhash64("features"), "label").limit(1)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(499).cast("long")))
    hot = found.unionAll(first.withColumn("id", copies))
    forest = secret_scan.train(hot, sample=200)
    assert not isinstance(forest, float)
    judged = secret_scan.judge(found, forest).collect()
    assert sum((r.score >= 0.5) == bool(r.label) for r in judged) >= 0.9 * len(judged)


def test_coverage():
    assert secret_scan.coverage("marketgarden12", {"market", "garden"}) == 12 / 14
