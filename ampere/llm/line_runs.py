"""Removal of repeated runs of lines, by prefix doubling over sequences of line ids.

The corpus is a sequence of line ids per document (lines without a word are layout: they
are not counted and always stay). Suffixes are ranked by their first line, then by their
first 2, 4, 8, ... lines: a rank is the place of the class's first suffix in the suffix
array, and the rank of a pair is the rank of its first half plus the suffixes of that class
with smaller second halves. Classes of one suffix are settled and drop out. A class of rank
r after k doublings is an interval of the suffix array with a longest common prefix of at
least 2**k lines; a stretch of any other length is named by the two ranks that cover it.

A run counts from ``min_words`` words on. Every line of a longer run lies in a smallest
stretch of so many words that starts or ends at one of its lines, so it is enough to look
at those: where one has an equal at an earlier place (by id, then by a hash of the row),
its lines are deleted. Overlapping stretches join into the maximal runs. First copies stay.

Defined results: rows equal in every column are one unit: its first row is judged like any
other, each further one is a later copy. Null ids come last. Null and empty texts stay as
they are; other columns pass through. A hot line or a group of copies is combined before
it is shuffled, or dealt into parts; Python code holds 512 rows of documents at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.llm.common import Scratch, fresh, without
from ampere.llm.mixing import row_hash

MIN_WORDS = 20
#: Ranks are counted up in so many ranges, 2 to the power.
BUCKET_BITS = 16
#: Parts that the members of one class are dealt into.
SALTS = 256


def lines_of(text: str | None, min_words: int) -> list[tuple]:
    """(place, line number, id, id, words, forward, backward) of the lines with a word.

    ``forward`` and ``backward`` are the lines in the smallest stretch of ``min_words`` words
    that starts or ends there; 0 without one.
    """
    rows, words = [], []
    for number, line in enumerate((text or "").split("\n")):
        b = line.encode("utf-8", "surrogatepass")
        n = len(b.split())
        if n:
            d = xxhash.xxh3_128_intdigest(b)
            rows.append((number, (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)))
            words.append(n)
    total = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)
    at = np.arange(len(rows))
    stop = np.searchsorted(total, total[:-1] + min_words)
    forward = np.where(stop <= len(rows), stop - at, 0)
    start = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    backward = np.where(start >= 0, at + 1 - start, 0)
    return [(i, *r, w, int(f), int(g)) for i, (r, w, f, g) in
            enumerate(zip(rows, words, forward.tolist(), backward.tolist(), strict=True))]


def _sequences(docs: DataFrame, id: str, text: str, min_words: int) -> DataFrame:
    """One row per unit and line, with the number of equal rows ``m``."""
    names = ["u", "id", "i", "line", "x", "y", "words", "f", "g"]

    def run(batches):
        for b in batches:
            for off in range(0, b.num_rows, 512):
                part, out = b.slice(off, 512), []
                for u, d, t in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    out += [(u, d, *r) for r in lines_of(t, min_words)]
                columns = list(zip(*out, strict=True)) if out else [()] * 9
                kinds = [pa.int64(), part.schema.field(1).type, *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(row_hash(docs).alias("u"), F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"u long, id {kind}, " + ", ".join(f"{c} long" for c in names[2:])).groupBy(
        *names).agg(F.count(F.lit(1)).alias("m"))


def first_ranks(lines: DataFrame) -> DataFrame:
    """(u, i, m, r): ranks by the first line; lines that occur once are left out."""
    ids = lines.groupBy("x", "y").agg(F.sum("m").alias("n")).filter("n > 1").withColumn(
        "b", F.shiftright("x", 64 - BUCKET_BITS))
    before = Window.partitionBy("b").orderBy("x", "y").rowsBetween(Window.unboundedPreceding, -1)
    ids = ids.withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # One row per bucket: a fixed number, so one task may add them up.
    starts = ids.groupBy("b").agg(F.sum("n").alias("n")).withColumn("start", F.coalesce(
        F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ids = ids.join(starts.select("b", "start"), "b").select("x", "y", (F.col("start") + F.col("inside")).alias("r"))
    return lines.join(ids, ["x", "y"]).select("u", "i", "m", "r")


def doubled(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks by twice as many lines, from those by ``step`` lines.

    What follows a frequent line may be much of the corpus: its second halves are counted up in
    ranges, and the ranges of a class, a bounded number, on top of that."""
    ahead = ranks.select("u", (F.col("i") - step).alias("i"), F.col("r").alias("s"))
    pairs = ranks.join(ahead, ["u", "i"])
    last = ranks.agg(F.coalesce(F.max("r"), F.lit(0))).first()[0]
    width = max(0, int(last).bit_length() - BUCKET_BITS)
    classes = pairs.groupBy("r", "s").agg(F.sum("m").alias("n")).filter("n > 1").withColumn(
        "b", F.shiftright("s", width))
    before = Window.partitionBy("r", "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranges = Window.partitionBy("r").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = classes.groupBy("r", "b").agg(F.sum("n").alias("n")).select(
        "r", "b", F.coalesce(F.sum("n").over(ranges), F.lit(0)).alias("start"))
    classes = classes.join(starts, ["r", "b"]).select(
        "r", "s", (F.col("r") + F.col("start") + F.col("inside")).alias("new"))
    return pairs.join(classes, ["r", "s"]).select("u", "i", "m", F.col("new").alias("r"))


def later_copies(named: DataFrame) -> DataFrame:
    """The stretches (u, start, n) that have an equal one at an earlier place.

    The members of a class are dealt into parts: each part's first, then the first of all, is a
    partial minimum, and it meets the members part by part, so no task gets a whole class."""
    place = F.struct(F.col("id").isNull().alias("late"), "id", "u", "start")
    dealt = named.select("n", "a", "b", "m", place.alias("place"),
                         F.pmod(F.xxhash64("u", "start"), F.lit(SALTS)).alias("part"))
    parts = dealt.groupBy("n", "a", "b", "part").agg(F.min("place").alias("least"), F.sum("m").alias("c"))
    first = parts.groupBy("n", "a", "b").agg(F.min("least").alias("first"), F.sum("c").alias("c")).filter("c > 1")
    first = parts.join(first.drop("c"), ["n", "a", "b"]).select("n", "a", "b", "part", "first")
    return dealt.join(first, ["n", "a", "b", "part"]).filter("first <> place").select(
        "place.u", "place.start", "n")


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
         scratch: Scratch | None = None) -> DataFrame:
    """(u, lines): numbers of the lines to delete from the first row of each unit."""
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    lines = scratch.write(_sequences(docs, id, text, min_words))
    forward = lines.filter("f > 0").select("u", F.col("i").alias("start"), F.col("f").alias("n"))
    backward = lines.filter("g > 0").select("u", (F.col("i") - F.col("g") + 1).alias("start"), F.col("g").alias("n"))
    stretches = scratch.write(forward.unionAll(backward).distinct())
    longest = stretches.agg(F.max("n")).first()[0] or 0
    named, ranks, step = None, scratch.write(first_ranks(lines)), 1
    while step <= longest:
        mine = stretches.filter((F.col("n") >= step) & (F.col("n") < 2 * step))
        head = ranks.select("u", F.col("i").alias("start"), "m", F.col("r").alias("a"))
        tail = ranks.select("u", F.col("i").alias("t"), F.col("r").alias("b"))
        now = scratch.write(mine.join(head, ["u", "start"]).withColumn("t", F.col("start") + F.col("n") - step).join(
            tail, ["u", "t"]).select("u", "start", "n", "m", "a", "b"))
        named = now if named is None else named.unionAll(now)
        step *= 2
        if step <= longest:
            ranks, old = scratch.write(doubled(ranks, step // 2)), ranks
            scratch.drop(old)
    empty = docs.sparkSession.createDataFrame([], "u long, line long")
    if named is None:
        return empty.groupBy("u").agg(F.collect_list("line").alias("lines"))
    scratch.drop(ranks, stretches)
    later = later_copies(named.join(lines.select("u", "id").distinct(), "u")).select(
        "u", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("i")).distinct()
    return later.join(lines.select("u", "i", "line"), ["u", "i"]).groupBy("u").agg(
        F.collect_list("line").alias("lines"))


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
           deleted: str = "deleted_lines") -> DataFrame:
    """Every row with its text after deletion, and the number of lines deleted."""
    scratch = Scratch(docs.sparkSession, "lines")
    work = Scratch(docs.sparkSession, "line-ranks")
    gone = scratch.write(runs(docs, id, text, min_words, work))
    work.clear()
    names = [*docs.columns, deleted]
    u, m, late, cut = (fresh(names, x) for x in ("_u", "_m", "_late", "_cut"))
    kept = [c for c in docs.columns if c.lower() != deleted.lower()]
    rows = docs.select(*without(docs, [deleted]), row_hash(docs).alias(u))
    # Equal rows are interchangeable: one stands for all (combined before the shuffle), with their
    # number. It meets its lines where that shuffle has brought it: texts cross it once, at any size.
    units = rows.groupBy(u).agg(F.any_value(F.struct(*(F.col(f"`{c}`") for c in kept))).alias(cut),
                                F.count(F.lit(1)).alias(m)).select(u, *(F.col(cut)[c].alias(c) for c in kept), m)
    lines = gone.select(F.col("u").alias(u), F.col("lines").alias(cut))
    every = units.join(lines.hint("merge"), u, "left").select(
        *(F.col(f"`{c}`") for c in kept), F.explode(F.sequence(F.lit(1).cast("long"), m)).alias(late), cut).select(
        *(F.col(f"`{c}`") for c in kept), (F.col(late) > 1).alias(late), cut)
    at = kept.index(next(c for c in kept if c.lower() == text.lower()))
    schema = T.StructType([*(f for f in docs.schema.fields if f.name in kept), T.StructField(deleted, T.LongType())])

    def run(batches):
        for batch in batches:
            for off in range(0, batch.num_rows, 512):
                part = batch.slice(off, 512)
                texts, counts = [], []
                for t, again, lines in zip(part.column(at).to_pylist(), part.column(len(kept)).to_pylist(),
                                           part.column(len(kept) + 1).to_pylist(), strict=True):
                    drop = set(lines or ())
                    if again:
                        rows = lines_of(t, min_words)
                        enough = sum(r[4] for r in rows) >= min_words
                        drop = {r[1] for r in rows} if enough else set()
                    if drop:
                        t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop)
                    texts.append(t)
                    counts.append(len(drop))
                columns = [pa.array(texts, part.schema.field(at).type) if i == at else part.column(i)
                           for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=schema.names)

    return every.mapInArrow(run, schema)
