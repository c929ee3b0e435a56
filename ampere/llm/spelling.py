"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

Two words that differ by one inserted, deleted or replaced code point have letter counts at
a squared distance of 1 or 2. Words are kept in blocks by length, and a block meets itself and
the block of the next length: one NumPy product of their count matrices gives all squared
distances, the pairs at most two apart are verified letter by letter.

Blocks of one length grow with the vocabulary, so they are cut further without losing a
pair: the alphabet is dealt into ``CLASSES`` classes, and a block is the words with equal
counts per class. One edit moves at most one count up and one down, so a block meets only
itself and the blocks one such move away. Blocks above ``OWN`` words are sliced by hash, what
they meet is sliced into at most ``OTHERS`` words; every slice meets every slice. A task
holds one pair of slices, fewer words when they are long.

A word's form is its near word of most occurrences, if that has ``RATIO`` times as many;
roots follow forms by pointer doubling. Only distinct words, never occurrences, are paired.

Defined results: null and empty texts have no words; a null id counts as an empty one;
repeated rows count again; ties go to the smaller word in code-point order; empty tables
give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm.common import Scratch

LETTERS = r"[A-Za-zÀ-ÿ]+"
_ALPHABET = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]
LENGTH = 5
OCCURRENCES = 3
RATIO = 2
#: Of so many runs one loses a letter.
DELETE = 97
CLASSES = 6
OWN = 2048
OTHERS = 16384
#: Code points that the longest side of a pair of slices may hold.
POINTS = 1 << 21


def words(docs: DataFrame, id: str = "doc_id", text: str = "text", delete: int | None = DELETE,
          length: int = LENGTH, occurrences: int = OCCURRENCES) -> DataFrame:
    """Words of ``length`` letters or more with their number of occurrences ``n``.

    A run of letters loses the code point ``h % length`` if ``delete`` divides ``h``, the
    crc32 of ``<id>:<run>``.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(docs[f"`{text}`"], upper, upper.lower())
    runs = docs.select(F.coalesce(docs[f"`{id}`"].cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lowered, F.lit(f"({LETTERS})"), F.lit(1))).alias("run"))
    word = F.col("run")
    if delete:
        h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
        at = (F.pmod(h, F.length("run")) + 1).cast("int")
        word = F.when(h % delete == 0, F.concat(
            F.substring("run", F.lit(1), at - 1), F.substring("run", at + 1, F.length("run")))).otherwise(word)
    return (runs.select(word.alias("word")).filter(F.length("word") >= length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= occurrences))


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """One row of letter counts per row of code points (words of one length)."""
    slot = np.zeros(256, np.int64)
    slot[[ord(c) for c in _ALPHABET]] = np.arange(len(_ALPHABET))
    rows = np.arange(len(codes))[:, None] * len(_ALPHABET)
    return np.bincount((rows + slot[codes]).ravel(), minlength=len(codes) * len(_ALPHABET)).reshape(
        len(codes), -1).astype(np.float32)


def close(a: np.ndarray, b: np.ndarray, rows: int = OWN):
    """Pairs of rows of two count matrices at a squared distance of at most 2.

    With ``|a|^2 / 2`` and ``|b|^2 / 2`` as further columns, one product holds minus half of
    each squared distance; counts are small integers, so floats are exact.
    """
    one = np.ones((len(b), 1), np.float32)
    b = np.hstack([b, -(b * b).sum(1, keepdims=True) / 2, one])
    for k in range(0, len(a), rows):
        part = a[k:k + rows]
        half = -(part * part).sum(1, keepdims=True) / 2
        product = np.hstack([part, np.ones((len(part), 1), np.float32), half]) @ b.T
        i, j = np.nonzero(product >= -1)
        yield i + k, j


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``a`` becomes that of ``b`` by one edit (``b`` no shorter)."""
    n = a.shape[1]
    same = a == b[:, :n]
    if b.shape[1] == n:
        return (~same).sum(1) == 1
    ahead = np.where(same.all(1), n, same.argmin(1))
    tail = (a == b[:, 1:])[:, ::-1]
    return ahead + np.where(tail.all(1), n, tail.argmin(1)) >= n


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("latin-1"), np.uint8).reshape(len(texts), -1)


def _pairs(table: pa.Table) -> pa.Table:
    """Near pairs, both ways, between the own words of a block and all words it meets."""
    names, n = np.array(table["word"].to_pylist(), object), table["n"].to_numpy()
    side, size = table["side"].to_numpy(), table["length"].to_numpy()
    own = np.flatnonzero(side == 0)
    left, right = [], []
    if len(own):
        a = _codes(names[own].tolist())
        counts = letter_counts(a)
        for which in (1, 2):  # the block itself; then those it meets, by length
            for length in np.unique(size[side == which]):
                other = np.flatnonzero((side == which) & (size == length))
                b = _codes(names[other].tolist())
                step = max(1, POINTS // max(1, a.shape[1]))
                for i, j in close(counts, letter_counts(b)):
                    for k in range(0, len(i), step):
                        x, y = i[k:k + step], j[k:k + step]
                        good = one_edit(a[x], b[y])
                        x, y = own[x[good]], other[y[good]]
                        if which == 1:  # a pair in a block is seen from both its ends
                            once = names[x] < names[y]
                            x, y = x[once], y[once]
                        left.append(x)
                        right.append(y)
    x = np.concatenate(left) if left else np.zeros(0, np.int64)
    y = np.concatenate(right) if right else np.zeros(0, np.int64)
    x, y = np.concatenate([x, y]), np.concatenate([y, x])
    return pa.table({"word": pa.array(names[x].tolist(), pa.string()),
                     "near": pa.array(names[y].tolist(), pa.string()), "near_n": pa.array(n[y], pa.int64())})


def near_pairs(vocabulary: DataFrame, classes: int = CLASSES, own: int = OWN, others: int = OTHERS) -> DataFrame:
    """Both orders of every pair of words one edit apart: word, near, near_n."""
    counts = [F.length(F.translate("word", "".join(c for c in _ALPHABET if ord(c) % classes != k), ""))
              for k in range(classes)]
    listed = vocabulary.select("word", "n", F.length("word").alias("length"), F.array(*counts).alias("v"))
    moves = [[0] * classes]
    for up in range(classes):
        moves.append([-(k == up) for k in range(classes)])
        moves += [[(k == down) - (k == up) for k in range(classes)] for down in range(up + 1, classes)]

    def met(side_of):
        """The blocks whose words a word of block ``v`` is compared with."""
        targets = [F.struct(F.lit(side_of(m)).alias("side"), F.array(
            *(F.col("v")[k] + F.lit(d) if d else F.col("v")[k] for k, d in enumerate(m))).alias("v")) for m in moves]
        return F.filter(F.array(*targets), lambda t: F.array_min(t["v"]) >= 0)

    blocks = listed.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.max("length").alias("length"))
    key = F.array_join(F.col("t.v").cast("array<string>"), ",").alias("block")
    sizes = (blocks.select("m", "length", F.explode(met(lambda m: int(any(m)) + 1)).alias("t"))
             .groupBy(key).agg(F.sum("m").alias("all"),
                               F.sum(F.when(F.col("t.side") == 1, F.col("m"))).alias("m"),
                               F.max("length").alias("length"))
             .filter(F.col("m").isNotNull()))

    def slices(count: str, most: int):
        room = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(POINTS) / F.col("length"))))
        return F.ceil(F.col(count) / room).cast("int")

    sizes = sizes.select("block", slices("m", own).alias("s"), slices("all", others).alias("o"))
    roles = F.concat(met(lambda m: int(any(m)) + 1), F.array(F.struct(F.lit(0).alias("side"), F.col("v"))))
    dealt = (listed.select("word", "n", "length", F.explode(roles).alias("t"))
             .select("word", "n", "length", F.col("t.side").alias("side"), key).join(sizes, "block"))
    h = F.xxhash64("word")

    def span(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)

    mine = F.col("side") == 0
    dealt = dealt.select(
        "block", "word", "n", "length", "side",
        F.when(mine, F.array(F.pmod(h, F.col("s")).cast("int"))).otherwise(span("s")).alias("i"),
        F.when(mine, span("o")).otherwise(F.array(F.pmod(h, F.col("o")).cast("int"))).alias("j"))
    dealt = dealt.withColumn("i", F.explode("i")).withColumn("j", F.explode("j"))
    return dealt.groupBy("block", "i", "j").applyInArrow(_pairs, "word string, near string, near_n long")


def forms(vocabulary: DataFrame, ratio: int = RATIO, **limits) -> DataFrame:
    """Every word with its form, root, n, n_near and form_n."""
    scratch = Scratch(vocabulary.sparkSession, "spelling")
    vocabulary = scratch.write(vocabulary)
    best = near_pairs(vocabulary, **limits).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best"))
    named = vocabulary.join(best, "word", "left")
    wins = -F.col("best.m") >= ratio * F.col("n")
    named = scratch.write(named.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(wins, F.col("best.near")).alias("form"), F.when(wins, -F.col("best.m")).alias("form_n")))
    links = named.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps taken; the n of a form at least doubles
        links = scratch.write(links)
        step = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = links.join(step, "root", "left")
        if longer.filter(F.col("next").isNotNull()).isEmpty():
            break
        links = longer.select("word", F.coalesce("next", "root").alias("root"))
    return named.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, id: str = "doc_id", text: str = "text", delete: int | None = None, **limits) -> DataFrame:
    """Spelling variants among the words of all texts; see the module's text."""
    return forms(words(docs, id, text, delete), **limits)
