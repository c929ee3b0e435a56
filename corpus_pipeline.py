"""A training-data pipeline: clean, deduplicate, mix and encode the documents.

Each stage takes what its predecessor kept, as written and read again, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm import byte_bpe, jaccard_join, line_runs, mixing, quality_rules
from ampere.llm.common import Scratch, read, release, scratch_folders
from ampere.llm.queries import vocabulary


#: Scratch folders that the stage which ran last has left for its result.
_LEFT: set[str] = set()


def _stage(work):
    """A stage whose predecessor's scratch tables go first, unless its input is read from them."""
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _LEFT, docs)
        before = scratch_folders()
        out = work(spark, docs, sf_dir)
        _LEFT.update(scratch_folders() - before)
        _LEFT.intersection_update(scratch_folders())
        return out
    return run


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break a rule go; documents that fail or lose too much go."""
    return quality_rules.keep_clean(docs)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; so do documents left without a word."""
    return _sized(line_runs.remove(docs).drop("deleted_lines")).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingles, that of the smallest id stays."""
    return jaccard_join.one_per_group(docs)


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of sources takes it: never, once or twice."""
    return mixing.mix(docs)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    path, pattern = vocabulary()
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, pattern).drop("text")
    return byte_bpe.decode(coded, path).select(
        "doc_id", "lang", "source", F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
        "ids", F.sha2("raw", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixture),
    ("byte-level BPE", tokens),
]

#: Random rounding and BPE are beyond SQL; tests/llm/test_pipeline.py has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch, docs, last = Scratch(spark, "pipeline"), read(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.write(docs)
            if last is not None:
                scratch.drop(last)
            last = docs
    return docs
