"""Mixing: targets against stepwise resharing, totals, expectations, odd rows."""

import random
from collections import Counter, defaultdict

import pytest

from ampere.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Share by weight, stop at the cap, reshare the excess until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        total = sum(w[s] for s in free)
        target = {s: left * w[s] / total for s in free}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return {**{s: most * sizes[s] for s in full}, **target}
        full |= over


def corpus(seed, n=600):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = r.choice(["a", "a", "a", "a", "b", "c", "é", "Z", None, "tiny"] if i else ["tiny"])
        rows.append((r.choice([i, i, 7, None]), " ".join(["w"] * r.choice([0, 1, 3, 9, 40])), source, "x"))
    return rows + [(None, None, "b", "x"), (5, "", None, "x"), (5, "same text", "c", "x")] * 3


@pytest.mark.parametrize("seed,bucket", [(1, 2048), (2, 16)])
def test_targets_totals_and_reruns(spark, seed, bucket):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    got = mixing.plan(df, bucket=bucket).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 40
    again = mixing.plan(df.repartition(7), bucket=bucket).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_mix_repeats_rows_as_planned(spark):
    rows = corpus(3, 200)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, m string")
    out = mixing.mix(df)
    assert out.columns == df.columns
    got = Counter(tuple(r) for r in out.collect())
    have = Counter(rows)
    assert all(n <= 2 * have[r] for r, n in got.items())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    want = brute_targets(sizes)
    for s, t in want.items():
        assert abs(sum(n * len((r[1] or "").split()) for r, n in got.items() if r[2] == s) - t) <= 40


def test_a_move_keeps_words_and_expectation():
    r = random.Random(1)
    for _ in range(300):
        p, q, s, t = r.random(), r.random(), r.randint(1, 50), r.randint(1, 50)
        up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
        first, second = mixing.pivot(p, s, q, t, 0.0), mixing.pivot(p, s, q, t, 0.999999999)
        for x, y in (first, second):
            assert x * s + y * t == pytest.approx(p * s + q * t)
            assert x in (0.0, 1.0) or y in (0.0, 1.0) or min(x, y, 1 - x, 1 - y) < 1e-9
        chance = down / (up + down)
        assert chance * first[0] + (1 - chance) * second[0] == pytest.approx(p)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.plan(df).count() == 0
    assert mixing.mix(df).count() == 0
