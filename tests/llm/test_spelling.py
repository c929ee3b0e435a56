"""Spelling variants against all pairs in plain Python, block cuts, odd texts."""

import random
import zlib
from collections import Counter

import re

import numpy as np
import pytest

from ampere.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, delete=97):
    count = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if delete and h % delete == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def run(spark, docs, delete=97, **limits):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = spelling.variants(df, delete=delete, **limits)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()))


def corpus(seed, n_words=150, n_docs=400, letters="abcdeéÿ×z"):
    r = random.Random(seed)
    base = ["".join(r.choices(letters, k=r.randint(4, 8))) for _ in range(n_words)]
    weight = [1 / (k + 1) for k in range(n_words)]

    def typo(w):
        k, how = r.randrange(len(w)), r.randrange(4)
        return [w, w[:k] + w[k + 1:], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1:]][how]

    return [(i, " ".join(typo(w) if r.random() < 0.3 else w.upper() if r.random() < 0.1 else w
                         for w in r.choices(base, weight, k=30))) for i in range(n_docs)]


@pytest.mark.parametrize("limits", [{}, {"own": 3, "others": 5}, {"classes": 1, "own": 16, "others": 7}])
def test_equals_all_pairs(spark, limits):
    docs = corpus(1)
    assert run(spark, docs, **limits) == brute(docs)


def test_chains_ties_and_anagrams(spark):
    def times(w, n):
        return " ".join([w] * n)

    docs = [(1, times("abcde", 100)), (2, times("abcdf", 40)), (3, times("abcdff", 20)), (4, times("abxdff", 10)),
            (5, times("abxdffg", 5)), (6, times("edcba", 7)), (7, times("bacde", 9)),
            (8, times("zzzza zzzzb", 8)), (9, times("zzzzc", 4)), (10, times("aaaaa", 3) + " " + times("aaaaaa", 6))]
    assert run(spark, docs, delete=None) == brute(docs, None)
    got = {r[0]: r for r in run(spark, docs, delete=None)}
    assert got["abxdffg"][2] == "abcde" and got["zzzzc"][1] == "zzzza" and got["edcba"][4] == 0


def test_deletions_follow_the_id(spark):
    docs = [(i, "abcdefgh ijklmnop") for i in range(3000)]
    want = brute(docs)
    assert len(want) > 2
    assert run(spark, docs) == want


def test_odd_texts(spark):
    long = "".join(random.Random(2).choices("abcd", k=30000))
    docs = [(1, None), (2, ""), (3, "1234 .. ß ÀÉ àé"), (None, "hello hellO HELLO hello"), (None, "hello"),
            (4, f"{long} {long} {long} {long[:-1]} {long[:-1]} {long[:-1]} {long}x"), (5, f"{long} {long}z" * 3)]
    docs += [(9, "worlds worlds worlds world world world")] * 3
    assert run(spark, docs) == brute(docs)
    assert run(spark, []) == []


def test_other_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, "alpha alpha alpha", 3, "x")], "doc_id long, text string, n int, word string")
    assert [tuple(r) for r in spelling.variants(df).collect()] == [("alpha", None, "alpha", 3, 0, None)]


def test_products_give_squared_distances():
    r = np.random.default_rng(5)
    a, b = r.integers(0, 3, (40, 90)).astype(np.float32), r.integers(0, 3, (30, 90)).astype(np.float32)
    b[:10] = a[:10]
    b[3, 0] += 1
    found = {(int(i), int(j)) for x, y in spelling.close(a, b, rows=16) for i, j in zip(x, y)}
    assert found == {(i, j) for i in range(40) for j in range(30) if ((a[i] - b[j]) ** 2).sum() <= 2}
