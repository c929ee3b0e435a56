"""Grammar files of token ids against the library, round trips, random access, odd texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ampere.llm import repair

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def grammar_parts(ids, **kw):
    s, rules, lengths, base = repair.compress(np.array(ids, "<u4"), gain=0, **kw)
    return s, rules, lengths, base


@pytest.mark.parametrize("ids", [
    [], [7], [1, 1], [5] * 1000, [1, 2] * 500, [1, 2, 1] * 300, [0, 0, 0, 1] * 200 + [2], list(range(500))])
def test_grammars_expand_to_their_ids(ids):
    s, rules, lengths, base = grammar_parts(ids, frequent=2)
    assert repair.expand(s, rules, lengths, base).tolist() == ids
    for r, (a, b) in enumerate(rules):  # rules use earlier symbols only; lengths are right
        assert max(a, b) < base + r
        assert repair.expand(np.array([base + r]), rules, lengths, base).size == lengths[r]


def test_random_grammars_and_slices():
    r = np.random.default_rng(4)
    for n, m, frequent in ((3000, 3, 2), (20000, 40, 8), (5000, 4000, 8)):
        ids = (r.zipf(1.4, n) % m).astype("<u4")
        s, rules, lengths, base = grammar_parts(ids, frequent=frequent)
        assert (repair.expand(s, rules, lengths, base) == ids).all()
        covered = np.cumsum(repair._sizes(s.astype(np.int64), base, lengths))
        assert covered[-1] == n
        for _ in range(40):
            a, b = sorted(r.integers(0, n + 1, 2))
            assert (repair.slice_of(s, rules, lengths, base, covered, a, b) == ids[a:b]).all()


def test_no_frequent_pair_is_left():
    text = "the cat sat on the mat and the dog sat on the log " * 400
    ids = np.frombuffer(text.encode(), np.uint8)
    s, rules, lengths, base = grammar_parts(ids, frequent=8)
    _, count = np.unique(s[:-1].astype(np.int64) << 32 | s[1:], return_counts=True)
    assert count.max() < 8 and len(s) + 2 * len(rules) < len(ids) / 20


def test_pieces_equal_whole_texts(library):
    r = random.Random(3)
    parts = ["a", "Word", "'s", "1234", " ", "  ", "\n", "\t", " ", " ", "é", "日本", ".", "<|endoftext|>",
             "\x1c", "\x85", "​", " \n ", "don't", "😀", "\r\n", "ü"]
    texts = ["".join(r.choices(parts, k=r.randrange(30))) for _ in range(4000)]
    texts += [None, "", " ", "  a", " a", "x" * 70000, "a " * 1000, "\n a", "a　 b"]
    with open(VOCABULARY, encoding="utf-8") as f:
        pieces = repair.Pieces(f.read())
    for t in texts:
        assert [*np.frombuffer(pieces.encode(t), "<u4").tolist(), 2] == library(t), repr(t)


def brute(docs, library):
    out, at = [], 0
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        ids = library(t)
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def digests(df, id="doc_id"):
    return sorted(map(tuple, df.select(id, "start", "n_tokens", F.crc32("ids")).collect()), key=repr)


def test_files_hold_all_documents_in_order(spark, tmp_root, library):
    r = random.Random(9)
    docs = [(i * 7 - 40, " ".join(r.choices(["alpha", "beta", "gamma", "x1", "über", "\n"], k=r.randrange(80))))
            for i in range(300)]
    docs += [(5001, None), (5002, ""), (5003, "long text " * 20000)]
    r.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    path = f"{tmp_root}/files"
    repair.write(df, path, VOCABULARY, shard=700, part=60, frequent=3)
    files = spark.read.parquet(path)
    assert files.select("part").distinct().count() > 3 and files.count() > 10
    assert files.filter((F.size("ids") > 1) & (F.col("n_tokens") > 700)).isEmpty()
    want = brute(docs, library)
    assert digests(repair.read(spark, path)) == sorted(want, key=repr)
    some = spark.createDataFrame([(5001,), (5003,), (-40,), (2,), (2,), (123456,)], "doc_id long")
    asked = {5001, 5003, -40, 2}
    assert digests(repair.lookup(spark, path, some)) == sorted((w for w in want if w[0] in asked), key=repr)


def test_repeated_rows_null_ids_and_empty_tables(spark, tmp_root, library):
    docs = [(3, "same text here")] * 50 + [(None, "no id"), (3, "other"), (1, "first")]
    df = spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id long, text string, ids string, n int")
    repair.write(df, f"{tmp_root}/a", VOCABULARY, shard=20, part=10)
    got = repair.read(spark, f"{tmp_root}/a").collect()
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [None, 1] + [3] * 51
    assert all(a.start + a.n_tokens == b.start for a, b in zip(by_start, by_start[1:]))
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got) == sorted(library(t) for _, t in docs)
    repair.write(df.limit(0), f"{tmp_root}/b", VOCABULARY)
    assert repair.read(spark, f"{tmp_root}/b").collect() == []
