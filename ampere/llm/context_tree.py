"""Language-model scoring by context-tree weighting over bytes.

Each byte is coded as 8 binary decisions. For a decision the model mixes
Krichevsky-Trofimov estimates over the contexts of 0 to ``DEPTH`` preceding bytes with the
weights of context-tree weighting: a node's block probability is half its own estimate's
and half the product of its children's, all from the counts of the training texts. A
context that training never saw is a leaf at its deepest known suffix. A text is coded
from an empty past and ends with a zero byte, so its probability is that of the whole text.

How it runs: texts are dealt into blocks of bounded size. A block sends its distinct
(context, byte) grams, with their training counts, to the subtree of their last two bytes,
where more than ``FAN`` blocks are merged group by group first;
subtrees are weighted bottom up, meet per last byte and at the root, and send each block
the code lengths of its own grams, which then sum up to scores. Word counts for the base
score travel the same way. What is gathered grows with the corpus; nothing of it passes
the driver or is broadcast, but for the number of blocks.

Defined results: null and empty texts are scored as empty (the end alone); a null id
belongs to the fold of the empty text; without training rows every bit costs one bit;
repeated rows are scored and counted one by one; a zero byte inside a text is coded like
any byte. An input column named like an added one is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.llm.common import fresh
from ampere.llm.jaccard_join import Hashes

DEPTH = 5
BLOCK_BYTES = 8 << 20
#: Lists of grams that meet in one task at most; more blocks are merged by a tree.
FAN = 256
SLICE = 4 << 20
READ = 1 << 19
WORDS_FROM = 1 << 16
ADDED = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes")
#: The end token: the hash of no word.
END = 0


# Texts to grams and words -------------------------------------------------------------

def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all positions, ends included, and the number of positions of each text.

    A key holds, from the top, the preceding bytes, the nearest first, then the byte.
    """
    pad = b"\0" * DEPTH
    buffer = np.frombuffer(pad + b"".join(t + b"\0" + pad for t in texts), dtype=np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    n = len(buffer) - DEPTH
    key = np.zeros(n, dtype=np.uint64)
    for back in range(1, DEPTH + 1):
        key = (key << np.uint64(8)) | buffer[DEPTH - back:DEPTH - back + n]
    key = (key << np.uint64(8)) | buffer[DEPTH:]
    real = np.zeros(n, dtype=bool)
    starts = np.concatenate([[0], np.cumsum(lengths + DEPTH)[:-1]]) if len(texts) else lengths
    change = np.zeros(n + 1, dtype=np.int8)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    real = np.cumsum(change[:n]).astype(bool)
    return key[real], lengths


def words_of(texts: list[bytes], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, each text's end after its words, and the
    number of tokens of each text."""
    found = hashes.of_bytes(texts)
    lengths = np.array([len(w) + 1 for w in found], dtype=np.int64)
    out = np.full(int(lengths.sum()), END, np.uint64)
    out[np.arange(len(out)) != np.repeat(np.cumsum(lengths) - 1, lengths)] = np.concatenate([*found, np.zeros(0, np.uint64)])
    return out, lengths


_MIX = np.uint64(0x9E3779B97F4A7C15)


def places(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key is in ``known``, sorted and distinct, which holds them all. A table of hashes
    finds most; those that share a slot with another are searched for."""
    bits = np.uint64(64 - min(24, max(8, len(known).bit_length() + 2)))
    table = np.zeros(1 << (64 - int(bits)), np.int32)
    table[(known * _MIX) >> bits] = np.arange(len(known), dtype=np.int32)
    at = table[(keys * _MIX) >> bits]
    wrong = np.flatnonzero(known[at] != keys)
    at[wrong] = np.searchsorted(known, keys[wrong])
    return at


def _slices(texts: list[bytes], most: int = SLICE):
    """Consecutive runs of texts of bounded size together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1 + DEPTH
        if size >= most:
            yield texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def _sum_unique(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([p[1] for p in parts]), minlength=len(keys))
    return keys, counts.astype(np.int64)


def count_block(texts: list[bytes], train: list[bool]) -> tuple[tuple, tuple]:
    """Distinct grams and words of a block, each with its count in training texts."""
    grams, words, hashes = [], [], Hashes()
    for learn in (True, False):
        chosen = [t for t, x in zip(texts, train, strict=True) if bool(x) == learn]
        for some in _slices(chosen):
            keys, n = np.unique(grams_of(some)[0], return_counts=True)
            grams.append((keys, n if learn else np.zeros_like(n)))
            keys, n = np.unique(words_of(some, hashes)[0], return_counts=True)
            words.append((keys, n if learn else np.zeros_like(n)))
    return _sum_unique(grams), _sum_unique(words)


# The weighted tree --------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by 8; x >= 0.5."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return ((y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3)
            + 1 / (1260 * y ** 5)) - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def _weight(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log block probability of a node, and the share its own estimate has in the mix."""
    return np.logaddexp(own, below) + np.log(0.5), 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


class Subtree:
    """Nodes of depth 2 to DEPTH below one pair of last bytes; ``rest`` keys are 32 bits."""

    def __init__(self, rest: np.ndarray, counts: np.ndarray):
        seen = counts > 0
        rest, counts = rest[seen].astype(np.int64), counts[seen].astype(float)
        self.nodes: dict[tuple[int, int], tuple] = {}
        below: dict[int, tuple] = {}
        for d in range(DEPTH, 1, -1):
            ctx = rest >> (8 * (DEPTH - d) + 8)
            keys, place = np.unique((ctx << 8) | (rest & 255), return_inverse=True)
            n = np.bincount(place, weights=counts, minlength=len(keys))
            for k in range(8):
                prefix = keys >> (8 - k)
                first = np.flatnonzero(np.diff(prefix, prepend=-1))
                ids = prefix[first]
                total = np.add.reduceat(n, first) if len(first) else n
                ones = np.add.reduceat(n * ((keys >> (7 - k)) & 1), first) if len(first) else n
                own = log_kt(total - ones, ones)
                if d == DEPTH:
                    lw, share = own, np.ones_like(own)
                else:
                    child, child_lw = below[k]
                    parent = ((child >> (k + 8)) << k) | (child & ((1 << k) - 1))
                    product = np.bincount(np.searchsorted(ids, parent), weights=child_lw,
                                          minlength=len(ids)) if len(ids) else own
                    lw, share = _weight(own, product)
                below[k] = (ids, lw)
                self.nodes[d, k] = (ids, total, ones, share)
        # Depth 2 by node number: the bits so far after a leading 1.
        self.n0, self.n1, self.lw = (np.zeros(256) for _ in range(3))
        for k in range(8):
            ids, total, ones, _ = self.nodes[2, k]
            at = (1 << k) + ids
            self.n0[at], self.n1[at], self.lw[at] = total - ones, ones, below[k][1]

    def log10_bytes(self, rest: np.ndarray, top: list[tuple]) -> np.ndarray:
        """log10 probability of the byte of each key; ``top``: (n0, n1, share) of depths 1, 0."""
        rest = rest.astype(np.int64)
        out = np.zeros(len(rest))
        byte = rest & 255
        for k in range(8):
            p = np.full(len(rest), np.nan)  # of a one, as the nodes below see it
            for d in range(DEPTH, 1, -1):
                ids, total, ones, share = self.nodes[d, k]
                if not len(ids):
                    continue
                want = (((rest >> (8 * (DEPTH - d) + 8)) << 8) | byte) >> (8 - k)
                at = np.minimum(np.searchsorted(ids, want), len(ids) - 1)
                known = ids[at] == want
                own = (ones[at] + 0.5) / (total[at] + 1.0)
                mixed = np.where(np.isnan(p), own, share[at] * own + (1 - share[at]) * p)
                p = np.where(known, mixed, p)
            node = (1 << k) + (byte >> (8 - k))
            for n0, n1, share in top:
                known = (n0 + n1)[node] > 0
                own = ((n1 + 0.5) / (n0 + n1 + 1.0))[node]
                mixed = np.where(np.isnan(p), own, share[node] * own + (1 - share[node]) * p)
                p = np.where(known, mixed, p)
            p = np.where(np.isnan(p), 0.5, p)
            one = ((byte >> (7 - k)) & 1).astype(bool)
            out += np.log10(np.where(one, p, 1 - p))
        return out


def _doubles(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=np.float64)


def combine(rows: list[tuple]) -> tuple:
    """(n0, n1, lw) of children to (n0, n1, lw, share) of their parent."""
    n0, n1, below = (np.sum([r[i] for r in rows], axis=0) for i in range(3))
    seen = (n0 + n1) > 0
    lw, share = _weight(np.where(seen, log_kt(n0, n1), 0.0), below)
    return n0, n1, np.where(seen, lw, 0.0), share


# The Spark job ------------------------------------------------------------------------

def score(docs: DataFrame, train: Column, text: str = "text", block_bytes: int = BLOCK_BYTES,
          fan: int = FAN) -> DataFrame:
    """Every row, without its text, with token figures, base score and model score (log10).

    ``train`` marks the rows to learn from; at most ``fan`` lists of grams meet in one task.
    """
    # Plain names inside, so that no column of the input can clash with one made here.
    outer, flag = docs.columns, fresh(docs.columns, "_train")
    docs = docs.select("*", train.alias(flag)).toDF(*(f"c{i}_" for i in range(len(outer))), "train_")
    text, train = f"c{[c.lower() for c in outer].index(text.lower())}_", F.col("train_")
    docs, keep = docs.drop("train_"), docs
    size = docs.select(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long") + 8)).first()[0] or 0
    blocks = 1 + size // block_bytes
    names = [*docs.columns, *ADDED]
    block, raw, learn = (fresh(names, x) for x in ("_block", "_raw", "_train"))
    kept = [c for c, o in zip(docs.columns, outer, strict=True) if o.lower() not in ADDED and c != text]
    hashed = [F.col(f"`{c}`") for c in docs.columns
              if "map<" not in docs.schema[c].dataType.simpleString()
              and "variant" not in docs.schema[c].dataType.simpleString()]
    source = keep.select(
        *kept,
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias(raw),
        F.coalesce(train, F.lit(False)).alias(learn),
        F.pmod(F.xxhash64(*hashed), F.lit(blocks)).cast("int").alias(block))

    def count(key, table):
        grams, words = count_block(table.column(raw).to_pylist(), table.column(learn).to_pylist())
        out = []
        for (keys, n), shift, low in ((grams, 32, np.uint32), (words, 54, np.uint64)):
            part = (keys >> np.uint64(shift)).astype(np.int64) + (WORDS_FROM if shift == 54 else 0)
            cut = np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]])
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                out.append((int(part[a]), keys[a:b].astype(low).tobytes(), n[a:b].astype(np.int64).tobytes()))
        return pa.table({"part": pa.array([x[0] for x in out], pa.int32()),
                         "block": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "keys": pa.array([x[1] for x in out], pa.binary()),
                         "n": pa.array([x[2] for x in out], pa.binary())})

    parts = source.groupBy(block).applyInArrow(count, "part int, block int, keys binary, n binary")

    def gathered(table):
        """Distinct keys of a part, their counts, and where each block's keys are in them."""
        words = table.column("part")[0].as_py() >= WORDS_FROM
        keys = [np.frombuffer(x, np.uint64 if words else np.uint32) for x in table.column("keys").to_pylist()]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate(
            [np.frombuffer(x, np.int64) for x in table.column("n").to_pylist()]), minlength=len(every))
        return words, every, n, place, [len(k) for k in keys]

    def merge(key, table):
        words, every, n, _, _ = gathered(table)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "keys": pa.array([every.tobytes()], pa.binary()),
                         "n": pa.array([n.astype(np.int64).tobytes()], pa.binary())})

    # A tree over the blocks: what many blocks share is merged before it meets in one task.
    group = F.expr(f"block div {fan}").cast("int").alias("merged_block")
    levels, left = [parts], blocks
    while left > fan:
        left = -(-left // fan)
        levels.append(levels[-1].groupBy("part", group).applyInArrow(
            merge, "part int, block int, keys binary, n binary"))

    def build(key, table):
        words, every, n, _, _ = gathered(table)
        if words:
            cells = [pa.array([None], pa.binary())] * 3
            tokens, distinct = int(n.sum()), int((n > 0).sum())
        else:
            tree = Subtree(every, n)
            cells = [pa.array([x.tobytes()], pa.binary()) for x in (tree.n0, tree.n1, tree.lw)]
            tokens = distinct = 0
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "last": pa.array([-1 if words else key[0].as_py() >> 8], pa.int32()),
                         "n0": cells[0], "n1": cells[1], "lw": cells[2],
                         "tokens": pa.array([tokens], pa.int64()), "vocabulary": pa.array([distinct], pa.int64())})

    summary = levels[-1].groupBy("part").applyInArrow(
        build, "part int, last int, n0 binary, n1 binary, lw binary, tokens long, vocabulary long")
    totals = summary.filter("last < 0").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("train_tokens"),
        F.coalesce(F.sum("vocabulary"), F.lit(0)).alias("v")).withColumn("one", F.lit(1))

    def up(key, table):
        n0, n1, lw, share = combine([tuple(map(_doubles, r)) for r in zip(
            *(table.column(c).to_pylist() for c in ("n0", "n1", "lw")), strict=True)])
        return pa.table({"last": pa.array([key[0].as_py()], pa.int32()),
                         **{c: pa.array([x.tobytes()], pa.binary()) for c, x in
                            (("n0", n0), ("n1", n1), ("lw", lw), ("share", share))}})

    cells = "n0 binary, n1 binary, lw binary, share binary"
    nodes = summary.filter("last >= 0").select("last", "n0", "n1", "lw")
    level1 = nodes.groupBy("last").applyInArrow(up, f"last int, {cells}")  # 256 rows at most
    root = level1.select(F.lit(0).alias("last"), "n0", "n1", "lw").groupBy("last").applyInArrow(
        up, f"last int, {cells}")
    # Broadcast: one root, and at most 256 rows of 12 KB, whatever the corpus.
    top = level1.select("last", F.struct("n0", "n1", "share").alias("level1"), F.lit(0).alias("zero")).join(
        F.broadcast(root.select(F.col("last").alias("zero"), F.struct("n0", "n1", "share").alias("root"))), "zero")
    top = summary.select("part", "last").join(F.broadcast(top), "last", "left").select("part", "level1", "root")

    def answer(key, table, tops):
        words, every, n, place, lengths = gathered(table)
        if words:
            values = n.astype(np.float64)
        else:
            above = [tuple(_doubles(x[c]) for c in ("n0", "n1", "share"))
                     for x in (tops.column("level1")[0].as_py(), tops.column("root")[0].as_py())]
            values = Subtree(every, n).log10_bytes(every, above)
        return dealt(table, values.astype(np.float64 if words else np.float32)[place], lengths)

    def dealt(table, values, lengths):
        cut = np.concatenate([[0], np.cumsum(lengths)])
        return pa.table({"block": table.column("block"), "part": table.column("part"),
                         "values": pa.array([values[a:b].tobytes() for a, b in
                                             zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

    def spread(key, table, answered):
        words, every, _, place, lengths = gathered(table)
        values = np.frombuffer(answered.column("values")[0].as_py(), np.float64 if words else np.float32)
        if len(values) != len(every):
            raise ValueError("merged answers do not match their grams")
        return dealt(table, values[place], lengths)

    answers = levels[-1].groupBy("part").cogroup(top.groupBy("part")).applyInArrow(
        answer, "block int, part int, values binary")
    for lower in reversed(levels[:-1]):
        answers = lower.groupBy("part", group).cogroup(answers.groupBy("part", "block")).applyInArrow(
            spread, "block int, part int, values binary")

    figures = T.StructType([
        *(f for f in source.schema.fields if f.name in kept),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("_logs", T.DoubleType()),
        T.StructField("score", T.DoubleType())])

    def total(key, table, answered):
        texts = table.column(raw).to_pylist()
        (grams, _), (vocabulary, _) = count_block(texts, [False] * len(texts))
        answered = answered.sort_by("part")
        part = answered.column("part").to_numpy()
        cells = answered.column("values").to_pylist()
        logs = np.frombuffer(b"".join(c for c, p in zip(cells, part, strict=True) if p < WORDS_FROM), np.float32)
        counts = np.frombuffer(b"".join(c for c, p in zip(cells, part, strict=True) if p >= WORDS_FROM), np.float64)
        if len(logs) != len(grams) or len(counts) != len(vocabulary):
            raise ValueError("a block's answers do not match its grams")
        log_counts, hashes = np.log10(counts + 1), Hashes()
        n_tokens, n_known, base, model = [], [], [], []
        for some in _slices(texts, READ):
            keys, lengths = grams_of(some)
            values = logs[places(grams, keys)].astype(np.float64)
            model += np.add.reduceat(values, np.cumsum(lengths) - lengths).tolist()
            tokens, lengths = words_of(some, hashes)
            at, first = places(vocabulary, tokens), np.cumsum(lengths) - lengths
            n_tokens += lengths.tolist()
            n_known += np.add.reduceat((counts[at] > 0).astype(np.int64), first).tolist()
            base += np.add.reduceat(log_counts[at], first).tolist()
        return pa.table([*(table.column(c) for c in kept), pa.array(n_tokens, pa.int64()),
                         pa.array(n_known, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                         pa.array(base, pa.float64()), pa.array(model, pa.float64())], names=figures.names)

    scored = source.groupBy(block).cogroup(answers.groupBy("block")).applyInArrow(total, figures)
    return scored.withColumn("_one", F.lit(1)).join(F.broadcast(totals), F.col("_one") == F.col("one")).select(
        *(F.col(c).alias(outer[docs.columns.index(c)]) for c in kept),
        "n_tokens", "n_known", "n_bytes", "train_tokens",
        (F.col("_logs") - F.col("n_tokens") * F.log10(F.col("train_tokens") + F.col("v") + 1)).alias("base_score"),
        "score")
