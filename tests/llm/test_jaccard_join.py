"""The Jaccard join against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from ampere.llm import jaccard_join


def brute(rows, similar=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            x = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * x >= similar * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    smallest = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows))), key=repr)


def corpus(seed, n=140, words=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passage = [r.choice(vocabulary) for _ in range(40)]
    base, out = [], []
    for _ in range(n):
        kind = r.random()
        if kind < 0.35 or not base:
            t = [r.choice(vocabulary) for _ in range(r.randint(1, 90))]
            if r.random() < 0.5:
                t += passage
            base.append(t)
        else:
            t = list(r.choice(base[:6] if kind < 0.8 else base))
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                if t:
                    t[r.randrange(len(t))] = r.choice(vocabulary)
            if kind > 0.9:
                base.append(t)
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("seed,region,stars", [(1, 2048, 4), (2, 2048, 0), (3, 5, 1), (4, 5, 0)])
def test_equals_brute_force(spark, monkeypatch, seed, region, stars):
    monkeypatch.setattr(jaccard_join, "REGION", region)
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", stars)
    texts = corpus(seed) + [None, "", " \n", "one", "One", "one two", "a b c d e", "A  b\tc d e"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(1000, texts[0]), (None, texts[1]), (None, "solo x")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, cls string")
    got = sorted((tuple(r) for r in jaccard_join.linked(df).collect()), key=repr)
    assert got == brute(rows)


def test_frequent_shingles_only_move_work(spark, monkeypatch):
    texts = corpus(9)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    every = np.unique(np.concatenate([jaccard_join.shingles(t, jaccard_join.Hashes()) for t in texts[::3]]))
    monkeypatch.setattr(jaccard_join, "frequent", lambda docs, text="text": every)
    assert sorted((tuple(r) for r in jaccard_join.linked(df).collect()), key=repr) == brute(rows)


def test_region_join_finds_every_component():
    r = random.Random(3)
    for _ in range(20):
        sets = []
        for _ in range(60):
            s = set(r.choice(sets)) if sets and r.random() < 0.7 else set(r.sample(range(4000), r.randint(1, 40)))
            for _ in range(r.choice([0, 1, 2, 3])):
                if len(s) > 1:
                    s.remove(r.choice(sorted(s)))
                s.add(r.randrange(4000))
            sets.append(s)
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        root = list(range(60))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        links = jaccard_join.join_region(arrays, list(range(60)))
        for a, b in links:
            assert 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            root[find(a)] = find(b)
        for i in range(60):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    assert find(i) == find(j)


def test_empty_table(spark):
    assert jaccard_join.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0
