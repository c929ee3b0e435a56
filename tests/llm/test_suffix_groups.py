"""Suffix arrays against sorting, removal against brute force over all strings."""

import hashlib
import random

import pytest

from ampere.llm import suffix_groups


def test_suffix_array_equals_sorting():
    r = random.Random(4)
    for _ in range(400):
        text = [r.randrange(r.choice([1, 2, 3, 30])) for _ in range(r.randint(0, 60))]
        assert suffix_groups.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(texts, length):
    where = {}
    for d, b in enumerate(texts):
        for p in range(len(b) - length + 1):
            where.setdefault(b[p:p + length], []).append((d, p))
    gone = [bytearray(len(b)) for b in texts]
    for places in where.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p:p + length] = b"\1" * length
    out = []
    for b, g in zip(texts, gone, strict=True):
        rest = bytes(x for x, y in zip(b, g, strict=True) if not y)
        runs = sum(1 for i, y in enumerate(g) if y and (i == 0 or not g[i - 1]))
        out.append((len(b), sum(g), runs, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, texts = prose(60), []
    for _ in range(60):
        kind = r.random()
        if kind < 0.3 or not texts:
            t = prose(r.randint(1, 120))
        elif kind < 0.6:
            t = list(r.choice(texts))
            for _ in range(r.randint(0, 3)):
                if t:
                    t[r.randrange(len(t))] = r.choice("xyz")
            t = "".join(t)
        elif kind < 0.9:
            a, b = sorted(r.randrange(len(passage)) for _ in range(2))
            t = prose(r.randint(0, 20)) + passage[a:b] + prose(r.randint(0, 20)) + r.choice(["", passage])
        else:
            t = r.choice(["ab", "a", "abcab"]) * r.randint(1, 200)
        texts.append(t)
    return texts


@pytest.mark.parametrize("seed,length,rows", [(1, 60, 20_000), (2, 33, 20_000), (3, 60, 2), (4, 400, 3), (5, 41, 5)])
def test_removal_equals_brute_force(spark, monkeypatch, seed, length, rows):
    monkeypatch.setattr(suffix_groups, "BAND_ROWS", rows)
    texts = corpus(seed) + ["", None, "short"]
    texts += [texts[0], texts[1]]
    ids = list(range(len(texts) - 2)) + [0, None]
    df = spark.createDataFrame(list(zip(ids, texts, range(len(texts)), strict=True)),
                               "doc_id long, text string, spans int").withColumnRenamed("spans", "row")
    out = suffix_groups.remove(df, length=length, digest=True)
    got = {r.row: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    want = brute([(t or "").encode() for t in texts], length)
    assert [got[i] for i in range(len(texts))] == want


def test_kept_bytes_and_spans_agree(spark):
    texts = corpus(7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in suffix_groups.remove(df, length=50).collect():
        b, rest, at = r.text.encode(), b"", 0
        for s in r.spans:
            rest, at = rest + b[at:s.a], s.e
        assert rest + b[at:] == bytes(r.kept_bytes)


def test_empty_table(spark):
    assert suffix_groups.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0
