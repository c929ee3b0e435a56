"""Every stage of the pipeline against brute force on what its predecessor kept."""

import struct
from collections import Counter

import duckdb
import pytest
import tiktoken

import corpus_pipeline
from ampere.llm import byte_bpe
from ampere.llm.queries import vocabulary
from ampere.llm.sql import ORACLE
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_line_runs import smallest as brute_lines

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
        rows = docs.collect()
        out.append(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "mixing sources", "byte-level BPE"]
    for rows in stages[1:-1]:
        assert list(rows[0].asDict()) == list(stages[0][0].asDict())
        assert all(r.n_chars == len(r.text) for r in rows)


def test_quality_keeps_what_the_sql_keeps(stages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DIR}/documents.parquet')")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE['op8_line_quality_rules']}) WHERE kept").fetchall()}
    assert {r.doc_id for r in stages[1]} == kept


def test_lines(stages):
    before = sorted(stages[1], key=lambda r: r.doc_id)
    want = brute_lines([(r.doc_id, r.text) for r in before], 20)
    want = {r.doc_id: t for r, (t, _) in zip(before, want, strict=True) if t.split()}
    assert {r.doc_id: r.text for r in stages[2]} == want


def test_near_duplicates(stages):
    groups = brute_groups([(r.doc_id, r.text) for r in stages[2]])
    assert sorted(r.doc_id for r in stages[3]) == sorted({c for _, _, c in groups})


def test_mixture(stages):
    before = {r.doc_id: r for r in stages[3]}
    taken = Counter(r.doc_id for r in stages[4])
    assert set(taken) <= set(before) and max(taken.values()) <= 2
    for r in stages[4]:
        assert r == before[r.doc_id]
    words = sum(len(r.text.split()) for r in before.values())
    got = sum(len(r.text.split()) for r in stages[4])
    per = Counter()
    for r in before.values():
        per[r.source] = max(per[r.source], len(r.text.split()))
    assert abs(got - 1.5 * words) <= sum(per.values())


def test_tokens(stages):
    path, pattern = vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                                mergeable_ranks=byte_bpe.load_ranks(open(path, "rb").read()))
    want = Counter()
    for r in stages[4]:
        ids = library.encode_ordinary(r.text)
        want[(r.doc_id, struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter((r.doc_id, bytes(r.ids)) for r in stages[5]) == want


def test_equal_rows_and_other_columns_pass(spark):
    text = " ".join(f"word{i % 70}" for i in range(140)) + "."
    docs = spark.createDataFrame(
        [(1, text, None, None, 5, "x"), (1, text, None, None, 5, "x"), (None, text, "en", "s", None, "y")],
        "doc_id long, text string, lang string, source string, n_chars long, u string")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "u"]
    assert docs.count() <= 2


def test_run_applies_the_stages_and_frees_what_they_leave(spark, stages):
    from ampere.llm.common import scratch_folders

    before = scratch_folders()
    out = corpus_pipeline.run(spark, DIR)
    got = Counter((r.doc_id, bytes(r.ids)) for r in out.collect())
    assert got == Counter((r.doc_id, bytes(r.ids)) for r in stages[5])
    left = {f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in scratch_folders() - before}
    assert left <= {"pipeline", "mix-units"}


def test_empty_table_with_clashing_columns(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, row string, _u long, kept int, ids binary, u long"
    docs = spark.createDataFrame([], kinds)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
        assert docs.columns == [c.split()[0] for c in kinds.split(", ")]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, DIR)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"] and out.count() == 0


def test_a_very_long_text_and_clashing_columns_pass(spark):
    text = "\n".join(" ".join(f"w{(i * 7 + j) % 9973}x{i}" for j in range(12)) + "." for i in range(6000))
    docs = spark.createDataFrame(
        [(1, text, "en", "s", len(text), "r", 3, 1, b"i", 4), (2, None, "en", "s", 0, None, None, None, None, None),
         (3, "", "en", "s", 0, "r", 3, 1, b"i", 4)],
        "doc_id long, text string, lang string, source string, n_chars long, row string, _u long, kept int, ids binary, u long")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, DIR)
    assert [tuple(r) for r in kept.collect()] == [tuple(docs.first())]
