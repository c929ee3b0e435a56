"""Line runs against brute force over all stretches of lines."""

import random

import pytest

from ampere.llm import line_runs


def brute(rows, min_words, beyond=10**9):
    """rows: (id, text) in the order of 'earlier'; stretches up to so many words over the least."""
    seqs = []
    for _, t in rows:
        lines = (t or "").split("\n")
        seqs.append([(n, x) for n, x in enumerate(lines) if x.split()])
    first = {}
    gone = [set() for _ in rows]
    for d, seq in enumerate(seqs):
        for i in range(len(seq)):
            for j in range(i + 1, len(seq) + 1):
                key = tuple(x for _, x in seq[i:j])
                words = sum(len(x.split()) for x in key)
                if words < min_words:
                    continue
                if words > min_words + beyond:
                    break
                if key in first:
                    gone[d].update(n for n, _ in seq[i:j])
                else:
                    first[key] = (d, i)
    return [("\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in g) if g else t, len(g))
            for (_, t), g in zip(rows, gone, strict=True)]


def smallest(rows, min_words):
    """The same by the smallest stretches of ``min_words`` words that start or end at each line."""
    found = []
    for d, (_, t) in enumerate(rows):
        seq = [(n, x) for n, x in enumerate((t or "").split("\n")) if x.split()]
        words = [len(x.split()) for _, x in seq]
        spans = set()
        for i in range(len(seq)):
            j, total = i, 0
            while j < len(seq) and total < min_words:
                total += words[j]
                j += 1
            if total >= min_words:
                spans.add((i, j))
            j, total = i + 1, 0
            while j and total < min_words:
                j -= 1
                total += words[j]
            if total >= min_words:
                spans.add((j, i + 1))
        found += [(d, i, tuple(seq[i:j])) for i, j in spans]
    first = {}
    for d, i, part in found:
        key = tuple(x for _, x in part)
        first[key] = min(first.get(key, (d, i)), (d, i))
    gone = [set() for _ in rows]
    for d, i, part in found:
        if first[tuple(x for _, x in part)] != (d, i):
            gone[d].update(n for n, _ in part)
    return [("\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in g) if g else t, len(g))
            for (_, t), g in zip(rows, gone, strict=True)]


def corpus(seed, n=60):
    r = random.Random(seed)
    line = lambda: " ".join(r.choice("abcdefgh") * r.randint(1, 2) for _ in range(r.choice([1, 1, 2, 5])))
    common, texts = [line() for _ in range(12)], []
    for _ in range(n):
        if texts and r.random() < 0.3:
            a = r.choice(texts).split("\n")
            i, j = sorted((r.randrange(len(a) + 1), r.randrange(len(a) + 1)))
            part = a[i:j]
        else:
            part = []
        new = [r.choice([*common, line(), line(), "", "  "]) for _ in range(r.randint(1, 14))]
        k = r.randint(0, len(new))
        texts.append("\n".join(new[:k] + part + new[k:]))
    return texts


@pytest.mark.parametrize("seed,words", [(1, 4), (2, 7), (3, 12), (4, 1)])
def test_equals_brute_force(spark, seed, words):
    texts = [*corpus(seed), "", None]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, u string")
    out = line_runs.remove(df, min_words=words)
    assert out.columns == ["doc_id", "text", "u", "deleted_lines"]
    got = {r.doc_id: (r.text, r.deleted_lines) for r in out.collect()}
    assert [got[i] for i, _ in rows] == brute(rows, words)


def test_smallest_stretches_are_enough():
    for seed in range(8):
        rows = list(enumerate(corpus(seed)))
        for words in (1, 4, 9, 20):
            assert smallest(rows, words) == brute(rows, words)


def test_a_hot_line_before_many_others_and_very_long_texts(spark):
    r = random.Random(5)
    twice = [f"tail {k} of many words here" for k in range(300)]
    rows = [(i, f"hot line in front\n{twice[i % 300]}") for i in range(600)]
    long = "\n".join(f"line {r.randrange(4000)} and more" for _ in range(6000))
    rows += [(1000, long), (1001, "new start\n" + long), (1002, "w" * 50000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: (x.text, x.deleted_lines) for x in line_runs.remove(df, min_words=8).collect()}
    assert [got[i] for i, _ in rows] == smallest(rows, 8)


def test_equal_rows_keep_their_first(spark):
    t = "one two three\nfour five six"
    rows = [(1, t), (1, t), (1, t), (None, t), (None, None), (None, None), (2, "x"), (2, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.deleted_lines) for r in line_runs.remove(df, min_words=4).collect()), key=repr)
    assert got == sorted([(1, t, 0), (1, "", 2), (1, "", 2), (None, "", 2), (None, None, 0), (None, None, 0),
                          (2, "x", 0), (2, "x", 0)], key=repr)


def test_empty_table(spark):
    assert line_runs.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_cross_one_shuffle_at_any_size(spark):
    rows = list(enumerate(corpus(5)))
    df = spark.createDataFrame([*rows, rows[0], rows[0]], "doc_id long, text string")
    plan = line_runs.remove(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("Exchange hashpartitioning(_u#") == 2, plan
