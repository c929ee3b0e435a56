"""A toxicity classifier with a counterfactual regulariser.

Logistic regression on the presence of words and word stems. While fitting, each labelled
text that mentions a group of people is scored a second time with its identity terms
swapped for others of the same kind, and a change of the score is penalised, so that a
neutral mention of a group does not become evidence by itself.

Fitting uses a bounded sample of the labelled rows (``sample_rows``, those with the
smallest hash of their id) in the driver, as sparse feature ids; scoring covers every row
in place and shuffles nothing. The model that is sent out holds at most ``n_features``
weights.

Defined results: null and empty texts have no features and score the base rate; rows with
a null label or id are not learned from; for an id with several labels the largest counts,
for one with several texts the smallest feature list; without any labelled row, or with
one class only, every text scores the (smoothed) base rate. An input column named like an
added one is replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.llm.common import fresh, without

BITS = 22
SAMPLE_ROWS = 16_000
N_FEATURES = 8_192
STEMS = (4, 5, 6)
THRESHOLD = 0.3

# Identity terms, by kind; the terms of a kind are swapped for one another.
IDENTITY = (
    ("men", "women", "guys", "girls", "boys", "ladies"),
    ("man", "woman", "guy", "girl", "boy", "lady"),
    ("male", "female", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "hispanic", "african", "arab", "european"),
    ("immigrant", "refugee", "foreigner", "citizen", "native"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("männer", "frauen"), ("mann", "frau"), ("schwul", "lesbisch", "hetero"),
    ("muslime", "christen", "juden", "hindus"), ("ausländer", "flüchtlinge", "einwanderer"),
    ("hombres", "mujeres"), ("hombre", "mujer"), ("musulmanes", "cristianos", "judíos"),
    ("inmigrantes", "refugiados", "extranjeros"),
    ("hommes", "femmes"), ("homme", "femme"), ("musulmans", "chrétiens", "juifs"),
    ("immigrés", "réfugiés", "étrangers"),
)
SWAP = {w: [x for x in kind if x != w] for kind in IDENTITY for w in kind}
EDGES = ".,;:!?\"'()[]{}<>«»“”’„|*#$%&-–—_/\\…¿¡"


def _id(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def word_features(word: str) -> tuple[int, ...]:
    """Feature ids of one lower-case word: itself and its stems."""
    if not word:
        return ()
    return (_id(word), *(_id(f"{word[:k]}*") for k in STEMS if len(word) > k))


def words_of(text: str | None) -> set[str]:
    return {w for w in {t.strip(EDGES) for t in set((text or "").lower().split())} if w}


def swapped(words: set[str]) -> set[str] | None:
    """The words with each identity term replaced by another of its kind; None without any."""
    found = sorted(w for w in words if w in SWAP)
    if not found:
        return None
    return (words - set(found)) | {SWAP[w][zlib.crc32(w.encode()) % len(SWAP[w])] for w in found}


def ids_of(words: set[str]) -> list[int]:
    return sorted({i for w in words for i in word_features(w)})


@dataclass
class Model:
    bias: float
    weights: dict[int, float] = field(default_factory=dict)


def _penalty_grad(delta, w, groups, n, strength):
    """Gradient of strength * mean((score(x) - score(swapped x))^2)."""
    change = np.bincount(groups, weights=delta["v"] * w[delta["c"]], minlength=n)
    g = np.bincount(delta["c"], weights=2 * delta["v"] * change[groups], minlength=len(w))
    return strength * g / max(1, n)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray | None]], n_features: int = N_FEATURES,
        strength: float = 4.0, l2: float = 2e-4, steps: int = 300) -> Model:
    """Fit on (label, feature ids, ids after the swap or None), by Adam on all rows."""
    y = np.array([r[0] for r in rows], dtype=float)
    base = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(base / (1 - base)))
    if len(y) == 0 or y.min() == y.max():
        return Model(bias)
    every = np.concatenate([r[1] for r in rows]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    n = 1 << BITS
    seen = np.bincount(every, minlength=n)
    with_toxic = np.bincount(every, weights=y[owner], minlength=n)
    # Standardised difference of a feature's toxic share from the base rate.
    z = np.abs(with_toxic - seen * y.mean()) / np.sqrt(seen * y.mean() * (1 - y.mean()) + 1.0)
    z[seen < 3] = 0
    chosen = np.sort(np.argsort(-z, kind="stable")[:n_features])
    chosen = chosen[z[chosen] > 0]
    place = np.full(n, -1, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))
    cols = place[every]
    rowi, cols = owner[cols >= 0], cols[cols >= 0]
    dr, dc, dv, pairs = [], [], [], 0
    for _, a, b in rows:
        if b is not None:
            for ids, sign in ((np.setdiff1d(a, b), 1.0), (np.setdiff1d(b, a), -1.0)):
                at = place[ids.astype(np.int64)]
                at = at[at >= 0]
                dr.append(np.full(len(at), pairs))
                dc.append(at)
                dv.append(np.full(len(at), sign))
            pairs += 1
    delta = {"c": np.concatenate([*dc, []]).astype(np.int64), "v": np.concatenate([*dv, []])}
    groups = np.concatenate([*dr, []]).astype(np.int64)
    w, b0 = np.zeros(len(chosen)), bias
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        s = np.bincount(rowi, weights=w[cols], minlength=len(y)) + b0
        err = (1 / (1 + np.exp(-np.clip(s, -40, 40))) - y) / len(y)
        grad = np.bincount(cols, weights=err[rowi], minlength=len(w)) + l2 * w
        if pairs:
            grad += _penalty_grad(delta, w, groups, pairs, strength)
        g = np.append(grad, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        w, b0 = w - move[:-1], b0 - move[-1]
    return Model(float(b0), {int(c): float(x) for c, x in zip(chosen, w, strict=True) if abs(x) > 1e-4})


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
          label: str = "toxic", sample_rows: int = SAMPLE_ROWS, **how) -> Model:
    """Fit on at most ``sample_rows`` labelled rows of ``docs``; ``labels`` has the id and label."""
    sample = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).dropna()
    sample = sample.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    chosen = texts.join(F.broadcast(sample), "id")  # at most sample_rows pairs of numbers

    def features(batches):
        for b in batches:
            words = [words_of(t) for t in b.column(1).to_pylist()]
            other = [swapped(x) for x in words]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2),
                pa.array([ids_of(x) for x in words], pa.list_(pa.int32())),
                pa.array([None if x is None else ids_of(x) for x in other], pa.list_(pa.int32()))],
                names=["id", "y", "a", "b"])

    schema = T.StructType([texts.schema["id"], T.StructField("y", T.IntegerType()),
                           T.StructField("a", T.ArrayType(T.IntegerType())),
                           T.StructField("b", T.ArrayType(T.IntegerType()))])
    got = chosen.select("id", "text", "y").mapInArrow(features, schema).groupBy("id").agg(
        F.min(F.struct("y", "a", "b")).alias("x")).select("id", "x.*").toArrow()
    got = got.sort_by("id") if got.num_rows else got
    a, b = (got.column(c).combine_chunks() for c in ("a", "b"))
    rows = [(y, a[i].values.to_numpy(), b[i].values.to_numpy() if b[i].is_valid else None)
            for i, y in enumerate(got.column("y").to_pylist())]
    return fit(rows, **how)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Every row with its probability of being toxic."""
    spark = docs.sparkSession
    # At most n_features weights, as plain numbers: workers have no copy of this package.
    sent = spark.sparkContext.broadcast((model.bias, dict(model.weights)))
    work = fresh([*docs.columns, out], "_text")
    source = docs.select(*without(docs, [out]), docs[f"`{text}`"].alias(work))
    schema = T.StructType([T.StructField(work, T.DoubleType()) if f.name == work else f
                           for f in source.schema.fields])

    def run(batches):
        bias, weights = sent.value
        known: dict[str, tuple[int, ...]] = {}

        def one(t):
            used = set()
            for token in set((t or "").lower().split()):
                hit = known.get(token)
                if hit is None:
                    if len(known) > 1_000_000:
                        known.clear()
                    hit = known[token] = tuple(
                        i for i in word_features(token.strip(EDGES)) if i in weights)
                if hit:
                    used.update(hit)
            s = bias + sum(weights[i] for i in sorted(used))
            return float(1 / (1 + np.exp(-min(40.0, max(-40.0, s)))))

        for b in batches:
            at = b.schema.get_field_index(work)
            scores = pa.array([one(t) for t in b.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [scores if i == at else b.column(i) for i in range(b.num_columns)], names=b.schema.names)

    return source.mapInArrow(run, schema).withColumnRenamed(work, out)


def fold(id: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo the number of folds; a null id reads as empty text."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
