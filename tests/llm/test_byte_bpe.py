"""Byte BPE against the public library, stitching at small chunks, round trips."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from ampere.llm import byte_bpe
from ampere.llm.queries import vocabulary

TEXTS = ["", None, "a", " ", "  \n\n  x", "it's we'll they've 're", "'" * 30 + "re" * 20,
         "héllo wörld ñandú 你好 🙂🙂 ​x", "a" * 700, " " * 501 + "b", "x\n" * 200,
         "don'" + "t" * 50, "12345 67 8" * 40, "tab\t\tsep \r\n end  "]


@pytest.fixture(scope="module")
def reference():
    path, pattern = vocabulary()
    ranks = byte_bpe.load_ranks(open(path, "rb").read())
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, seed=5):
    r = random.Random(seed)
    parts = [" ", "  ", "\n", "'", "'s", "'ve", "word", "é", "你好", "99", "!?", "aaaaaaa", "🙂", "\t"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 400))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [7, 64, 1 << 18])
def test_matches_the_library_and_round_trips(spark, reference, chunk):
    texts = TEXTS + random_texts(25)
    df = spark.createDataFrame([(i % 9, t, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, ids string")
    path, pattern = vocabulary()
    coded = byte_bpe.encode(df, path, pattern, chunk=chunk, overlap=5)
    assert coded.columns == ["doc_id", "text", "ids"]
    rows = byte_bpe.decode(coded, path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = reference.encode_ordinary(r.text or "")
        assert bytes(r.ids) == struct.pack(f"<{len(want)}I", *want), repr(r.text)
        assert bytes(r.raw) == (r.text or "").encode()


def test_long_piece_merges_like_the_library(reference):
    path, pattern = vocabulary()
    ranks = byte_bpe.load_ranks(open(path, "rb").read())
    for piece in ("ab" * 3000, "=" * 5000, "señor" * 900):
        assert byte_bpe.merge_piece(piece.encode(), ranks) == reference._core_bpe.encode_single_piece(piece.encode())


def test_empty_table(spark):
    path, pattern = vocabulary()
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode(df, path, pattern).count() == 0


def test_query_digests_on_the_small_tables(spark, reference):
    from ampere.llm.queries import op6_byte_bpe
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op6_byte_bpe(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = reference.encode_ordinary(r.text)
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    assert public_tokenizers.PATTERN


def test_query_on_texts_beyond_a_chunk(spark, reference, tmp_path):
    from ampere.llm.queries import QUERIES

    texts = [" ".join(random_texts(n)) for n in (1, 2000)] + ["word " * 60_000]
    assert [len(t) > byte_bpe.CHUNK + byte_bpe.OVERLAP for t in texts] == [False, True, True]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    rows = QUERIES["op6_byte_bpe"](spark, str(tmp_path)).collect()
    assert len(rows) == 3
    for r in rows:
        want = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_many_pieces_merge_like_each_one(reference):
    path, pattern = vocabulary()
    ranks = byte_bpe.load_ranks(open(path, "rb").read())
    pairs = byte_bpe.pair_ranks(ranks)
    r = random.Random(8)
    pieces = [bytes(r.choices(b"aeinrst hl\xc3\xa9\xff", k=r.randrange(1, 40))) for _ in range(3000)]
    pieces += [b"a", b"aaaaaaa", b"abab" * 12, b" the"]
    ids, ends = byte_bpe.merge_pieces(pieces, ranks, pairs)
    for x, a, e in zip(pieces, ends[:-1], ends[1:], strict=True):
        if x not in ranks:
            assert ids[a:e].tolist() == byte_bpe.merge_piece(x, ranks), x
    ids, ends = byte_bpe.merge_pieces([], ranks, pairs)
    assert ids.tolist() == [] and ends.tolist() == [0]


def test_encoder_forgets_without_loss_and_takes_other_patterns(reference, monkeypatch):
    import pyarrow as pa

    path, pattern = vocabulary()
    ranks = byte_bpe.load_ranks(open(path, "rb").read())
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 20)
    texts = random_texts(300) + ["x" * 500, None]
    for p in (pattern, r"\s*\S+|\s+"):
        want = tiktoken.Encoding("x", pat_str=p, mergeable_ranks=ranks, special_tokens={})
        encoder = byte_bpe.Encoder(ranks, p)
        for k in range(0, len(texts), 7):
            part = texts[k:k + 7]
            for t, ids in zip(part, encoder.encode(pa.array(part, pa.string())).to_pylist(), strict=True):
                assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want.encode_ordinary(t or "")
