"""Secret scanning with a random forest against false positives.

Candidates, from every whole text: runs of 12 or more key-like characters with a digit, runs
of ``LONG`` or more without one, and what is assigned to a key word (``password = ...``): the
whole quoted or non-blank value, of any length and with any characters. A run within a longer
value is a candidate of its own.
A random forest, trained here from labelled findings, tells secrets from look-alikes by
their length, the kinds of characters and the transitions between kinds, the share that
dictionary words cover, the path the text came from, and the neighbouring words. The
dictionary is counted over all documents and holds the ``DICTIONARY`` most frequent words.

The forest is fitted on at most ``SAMPLE`` different labelled findings (smallest hashes of each
kind first), weighted by their copies and by the share of their kind; scanning and scoring
cover everything, in place.

Defined results: null and empty texts have no candidates; a null path is an empty one;
rows equal in all columns give equal findings each; without labelled findings of both kinds
every candidate gets the share of secrets among them (0.5 without any). Columns of the
input named like an added one are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import Scratch

DICTIONARY = 20_000
SAMPLE = 20_000
TREES, DEPTH = 40, 8
LONG = 20
RUN = re.compile(r"[A-Za-z0-9+/_-]{12,}")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
ASSIGN = re.compile(r"[=:]+>?[ \t]*(?:[Bb]earer[ \t]+)?")
ASSIGNED = re.compile(r"(?i)(?:passw(?:or)?d|passphrase|pwd|secret|token|(?:api|access|private)[_-]?key|credential"
                      r"|bearer)\w*\Z|(?:\A|[\W_])(?:auth|key)\Z")
VALUE = re.compile(r"""(["'`])((?:(?!\1)[^\n])+)\1|[^\s"'`]\S*""")
WORD = re.compile(r"[a-z]{4,12}\Z")

# Words that speak for or against a secret nearby, and words of paths.
KEY_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key",
             "auth", "bearer", "credential", "private", "key")
HASH_WORDS = ("sha", "sha1", "sha256", "md5", "commit", "revision", "checksum", "digest", "uuid",
              "hash", "etag", "version", "card", "phone", "order", "invoice", "id")
PATH_WORDS = ("test", "example", "sample", "doc", "fixture", "mock", "config", "env", "log")


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> set[str]:
    """The most frequent lower-case words of 4 to 12 letters over all documents."""
    def count(batches):
        counts: Counter = Counter()

        def flush():
            words = [w for w in counts if WORD.match(w)]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], names=["w", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update((t or "").lower().split())
                if len(counts) > 500_000:
                    yield flush()
                    counts.clear()
        yield flush()

    top = docs.select(text).mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return {r.w for r in top.orderBy(F.desc("n"), "w").limit(size).collect()}  # a bounded list


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def coverage(value: str, words: set[str]) -> float:
    """Share of the characters that dictionary words cover, longest first from the left."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        for k in range(min(12, len(low) - at), 3, -1):
            if low[at:at + k] in words:
                covered += k
                at += k
                break
        else:
            at += 1
    return covered / len(low)


def features(value: str, before: str, after: str, path: str, words: set[str]) -> list[float]:
    kinds = [_kind(c) for c in value]
    n = len(value)
    moves = np.zeros(16)
    for a, b in zip(kinds, kinds[1:], strict=False):
        moves[4 * a + b] += 1 / (n - 1)
    counts = np.array(list(Counter(value).values())) / n
    near = re.findall(r"[a-z0-9_]+", before.lower())[-4:]
    follow = re.findall(r"[a-z0-9_]+", after.lower())[:2]
    left, right = before[-1:], after[:1]
    low = path.lower()
    return [
        float(n), float(-(counts * np.log2(counts)).sum()), *(kinds.count(k) / n for k in range(4)), *moves,
        sum(c in "0123456789abcdefABCDEF" for c in value) / n, coverage(value, words),
        float(left in "=:"), float(left in "\"'"), float(right in "\"'"), float(left in "@." or right in "@."),
        float(any(k in w for w in near[-1:] for k in KEY_WORDS)), float(any(k in w for w in near for k in KEY_WORDS)),
        float(any(w in HASH_WORDS for w in near)), sum(w in words for w in near + follow) / 6,
        *(float(w in low) for w in PATH_WORDS)]


def spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of every candidate, in order."""
    found = {m.span() for m in RUN.finditer(text)
             if DIGIT.search(m.group()) or len(m.group()) >= LONG and LETTER.search(m.group())}
    for m in ASSIGN.finditer(text):
        name = text[max(0, m.start() - 80):m.start()].rstrip(" \t\"'`])")
        value = VALUE.match(text, m.end()) if ASSIGNED.search(name) else None
        if value and value.group(1):
            found.add(value.span(2))
        elif value:
            # Punctuation that ends the assignment is not part of it.
            length = len(value.group().rstrip(",;.\"'`)]}>"))
            if length:
                found.add((value.start(), value.start() + length))
    return sorted(found)


def candidates(docs: DataFrame, words: set[str], id: str = "doc_id", text: str = "text",
               path: str | None = None) -> DataFrame:
    """(id, start, value, before, features) of every candidate; start counts characters from 0."""
    sent = docs.sparkSession.sparkContext.broadcast(words)  # at most DICTIONARY words
    kind = docs.schema[id].dataType.simpleString()
    where = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path else F.lit("")

    def scan(batches):
        known = sent.value
        for b in batches:
            rows = []
            for i, t, p in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                for a, e in spans(t or ""):
                    before, after = t[max(0, a - 60):a], t[e:e + 40]
                    rows.append((i, a, t[a:e], before, features(t[a:e], before, after, p, known)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [b.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["id", "start", "value", "before", "features"])

    return docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), where.alias("path")).mapInArrow(
        scan, f"id {kind}, start long, value string, before string, features array<double>")


def train(findings: DataFrame, seed: int = 7, sample: int = SAMPLE):
    """A fitted forest from (features, label), or the share of secrets if one kind is missing."""
    # Copies of one finding are one row with a weight: hot ones neither fill the sample nor lose their say.
    rows = findings.filter("label is not null").groupBy("features", "label").agg(F.count("*").alias("n"))
    kinds = {r.label: (r.n, r.different) for r in rows.groupBy("label").agg(
        F.sum("n").alias("n"), F.count("*").alias("different")).collect()}
    if len(kinds) < 2:
        return (kinds.get(1, (0, 0))[0] + 0.5) / (sum(n for n, _ in kinds.values()) + 1)
    parts = []
    for label, (n, different) in kinds.items():
        others = sum(d for k, (_, d) in kinds.items() if k != label)
        part = rows.filter(F.col("label") == label).orderBy(F.xxhash64("features")).limit(
            min(different, max(sample // 2, sample - others)))
        # What the sample of a kind leaves out is spread over what it holds: the kinds keep their shares.
        held = F.sum("n").over(Window.partitionBy("label"))
        parts.append(part.withColumn("weight", F.col("n") * F.lit(float(n)) / held))
    total = sum(n for n, _ in kinds.values())
    size = min(sample, sum(d for _, d in kinds.values()))
    rows = reduce(DataFrame.unionAll, parts).select(
        array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"),
        (F.col("weight") * F.lit(size / total)).alias("weight"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, minInstancesPerNode=2,
                                  weightCol="weight").fit(rows)


def judge(found: DataFrame, forest) -> DataFrame:
    """Candidates with the probability that they are secrets."""
    if isinstance(forest, float):
        return found.withColumn("score", F.lit(forest))
    scored = forest.transform(found.withColumn("_features", F.col("features")).withColumn(
        "features", array_to_vector("features")))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction").withColumnRenamed("_features", "features")


def known_format(value, before):
    """Labels by provider formats and assignments: 1, 0 or null where neither speaks."""
    assigned = before.rlike(r"(?i)(?:password|passwd|pwd|secret|token|api_?key)[\"'\]]{0,2}\s{0,2}[=:]\s{0,2}[\"']?$")
    # A plain word after "secret:" may be prose: the labels leave it to the forest.
    assigned = assigned & ~value.rlike("^[A-Za-z]?[a-z]{0,11}$")
    return (F.when(value.rlike(r"(?i)^(?:<.*>|\$\{?\w+\}?|\{\{.*\}\}|\*+|x+|null|none|true|false|undefined)$"), 0)
            .when(value.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$") | value.rlike("^gh[pousr]_[0-9A-Za-z]{36}$") | assigned, 1)
            .when(value.rlike("^[0-9]+$") | value.rlike("^[A-Za-z]+[-_][0-9]+$"), 0)
            .when(value.rlike("^[0-9a-f]{32}$|^[0-9a-f]{40}$|^[0-9a-f]{64}$"), 0)
            .when(value.rlike("^[0-9-]+$") | value.rlike("^[a-z]+[0-9]{1,4}$"), 0))


def scan(docs: DataFrame, learn, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """All candidates with scores; ``learn`` marks the ids whose findings are labelled for training."""
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.write(candidates(docs, dictionary(docs, text), id, text, path))
    labelled = found.filter(learn(F.col("id"))).withColumn("label", known_format(F.col("value"), F.col("before")))
    return judge(found, train(labelled)).withColumnRenamed("id", id)
