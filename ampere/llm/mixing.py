"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is due ``target / source size`` copies. Whole copies are
given; the fractions left are rounded pairwise: of two documents of a source, mass (words)
is moved from one to the other, in a direction drawn so that expectations stay, until one
of the two fractions is 0 or 1. The words of a pair's sum never change, so a source's
total is exact but for its very last document. Documents are dealt into buckets per source;
each bucket leaves at most one fraction, and the fractions left meet in fewer buckets on
the next level of the tree, until one per source remains and is drawn.

Rows that are equal in every column form one unit with a multiplicity, of which only the
fractional part takes part in the rounding. That keeps repeated rows from making a hot
group, and reruns agree: order and draws come from hashes of the rows.

Defined results: a null text has size 0; documents of size 0 are rounded on their own; a
null source is a source and comes last; null ids are fine; an empty table gives an empty
result; an input column named like an added one is replaced. Work in a bucket is a
running pass with one document in memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import Scratch, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Units a bucket holds on average, and buckets that meet in one on the next level.
BUCKET = 512
FAN_IN = 32


def targets(units: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source its size and target: ``share`` of all words by weight, filled like water.

    One row per source; the running sums over sources are the only unpartitioned window.
    A source stops at ``most`` times its size. The level of the rest solves
    ``sum(min(most * size, level * weight)) = share * total``: with sources ordered by
    ``most * size / weight``, it is the largest among those that keep under their own cap
    """
    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    ranked = per.withColumn("_r", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)),
                     (F.col("_r") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", w).withColumn("_full", most * F.col("source_size") / F.col("_w"))
    order = Window.orderBy("_full", "_r")
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("_budget", share * F.sum("source_size").over(every))
    ranked = ranked.withColumn(
        "_level",
        (F.col("_budget") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        / (F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))))
    level = F.max(F.when(F.col("_level") <= F.col("_full"), F.col("_level"))).over(every)
    return ranked.withColumn("_level", level).select(
        "source", "source_size",
        F.when(F.col("_level").isNull(), most * F.col("source_size")).otherwise(
            F.least(most * F.col("source_size"), F.col("_level") * F.col("_w"))).alias("target"))


def _draw(a: int, b: int) -> float:
    """A uniform number from two 64-bit hashes (splitmix64 of their mix)."""
    z = (a * 0x9E3779B97F4A7C15 + b + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((z ^ (z >> 31)) >> 11) / (1 << 53)


def pivot(p: float, s: int, q: float, t: int, u: float) -> tuple[float, float]:
    """Fractions of two documents of sizes ``s`` and ``t`` after one move; one is 0 or 1."""
    up = min((1 - p) * s, q * t)      # words the first can gain
    down = min(p * s, (1 - q) * t)    # words it can lose
    if u * (up + down) < down:
        if (1 - p) * s <= q * t:
            return 1.0, max(0.0, q - up / t)
        return min(1.0, p + up / s), 0.0
    if p * s <= (1 - q) * t:
        return 0.0, min(1.0, q + down / t)
    return max(0.0, p - down / s), 1.0


def _round_buckets(rows):
    """Running pass over rows sorted by group: (group, key, size, fraction) -> (key, fraction)."""
    group, held = None, None
    for b in rows:
        keys, values = [], []
        columns = [b.column(i).to_pylist() for i in range(4)]
        for g, key, size, p in zip(*columns, strict=True):
            if g != group:
                if held:
                    keys.append(held[0])
                    values.append(held[2])
                group, held = g, None
            if held is None:
                held = (key, size, p)
                continue
            x, y = pivot(held[2], held[1], p, size, _draw(held[0], key))
            for k, s, v in ((held[0], held[1], x), (key, size, y)):
                if v in (0.0, 1.0):
                    keys.append(k)
                    values.append(v)
                else:
                    held = (k, s, v)
            if x in (0.0, 1.0) and y in (0.0, 1.0):
                held = None
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.float64())],
                                         names=["key", "p"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[2]], pa.float64())],
                                         names=["key", "p"])


def round_fractions(units: DataFrame, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """(key, source, size > 0, p in (0, 1)) -> (key, up): 1 where the fraction became 1."""
    n = units.count()
    buckets = 1 << max(0, int(np.ceil(np.log2(max(1, n / bucket)))))
    group = F.xxhash64("source", F.col("source").isNull())
    current, done = units.withColumn("b", F.pmod(F.xxhash64("key"), F.lit(buckets))), None
    while True:
        g = F.xxhash64(group, "b")
        level = current.select(g.alias("g"), "key", "size", "p").repartition("g").sortWithinPartitions(
            "g", "key").mapInArrow(_round_buckets, "key long, p double")
        level = scratch.write(level)
        settled = level.filter("p = 0 or p = 1")
        done = settled if done is None else done.unionAll(settled)
        rest = level.filter("p > 0 and p < 1")
        if buckets == 1:
            break
        buckets = max(1, buckets // FAN_IN)
        current = rest.join(units.drop("p"), "key").withColumn(
            "b", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    last = rest.select("key", F.when(
        F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1 << 30)) < F.col("p") * (1 << 30), 1.0).otherwise(0.0).alias("p"))
    return done.unionAll(last).select("key", F.col("p").cast("long").alias("up"))


def _units(docs: DataFrame, id: str, source: str, size: Column, extra: Column) -> DataFrame:
    return docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{source}`").alias("source"),
                       size.alias("size"), extra.alias("h")).groupBy("id", "source", "size", "h").agg(
        F.count(F.lit(1)).alias("m"))


def row_hash(docs: DataFrame) -> Column:
    """A hash of a whole row, columns of any type included."""
    parts = []
    for f in docs.schema.fields:
        c = F.col(f"`{f.name}`")
        text = f.dataType.simpleString()
        parts += [F.to_json(F.struct(c)) if "map<" in text or "variant" in text else c, c.isNull()]
    return F.xxhash64(*parts)


def copies(units: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE,
           most: float = MOST, bucket: int = BUCKET) -> DataFrame:
    """Units (id, source, size, h, m) with source_size, target and ``total`` copies of the unit."""
    units = scratch.write(units.withColumn("key", F.xxhash64(
        "id", F.col("id").isNull(), "source", F.col("source").isNull(), "size", "h")))
    per = targets(units, weights, share, most)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = F.least(F.lit(most), due) * F.col("m")
    due = units.join(per, units["source"].eqNullSafe(per["source"])).drop(per["source"]).withColumn(
        "due", due).withColumn("whole", F.floor("due")).withColumn("p", F.col("due") - F.col("whole"))
    due = scratch.write(due)
    open_ = due.filter("p > 0 and size > 0").select("key", "source", "size", "p")
    up = round_fractions(open_, scratch, bucket)
    alone = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) < F.col("p") * (1 << 30)
    return due.join(up, "key", "left").select(
        "id", "source", "size", "h", "m", "source_size", "target",
        (F.col("whole") + F.coalesce(F.col("up"), F.when((F.col("size") == 0) & alone, 1).otherwise(0))
         ).alias("total"))


def _each(unit: DataFrame) -> DataFrame:
    """One row per input row: a unit's copies dealt evenly over its rows."""
    return unit.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m")))).withColumn(
        "copies", (F.floor(F.col("total") / F.col("m"))
                   + F.when(F.col("_i") <= F.col("total") % F.col("m"), 1).otherwise(0)).cast("int")).drop("_i")


def plan(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """Per input row: id, size, source_size, target, copies and the words they take."""
    scratch = Scratch(docs.sparkSession, "mix")
    words = word_count(F.col(f"`{text}`"))
    unit = Scratch(docs.sparkSession, "mix-units").write(copies(_units(docs, id, source, words, F.lit(0)), scratch, **how))
    scratch.clear()
    return _each(unit).select(
        F.col("id").alias(id), F.col("source").alias("source"), "size", "source_size", "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The documents of the mixture, each as often as it is taken, in the columns of ``docs``."""
    scratch = Scratch(docs.sparkSession, "mix")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), row_hash(docs).alias("h"),
                       F.col(f"`{id}`").alias("id"), F.col(f"`{source}`").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"))
    unit = copies(_units(rows, "id", "source", F.col("size"), F.col("h")), scratch, **how)
    unit = Scratch(docs.sparkSession, "mix-units").write(unit)
    scratch.clear()
    unit = unit.select(F.col("id").alias("uid"), F.col("source").alias("usource"),
                                      F.col("size").alias("usize"), F.col("h").alias("uh"), "m", "total")
    on = (F.col("id").eqNullSafe(F.col("uid")) & F.col("source").eqNullSafe(F.col("usource"))
          & (F.col("h") == F.col("uh")) & (F.col("size") == F.col("usize")))
    once = rows.join(unit.filter("m = 1 and total > 0"), on).select("row", "total")
    # Equal rows are interchangeable: one of them stands for its unit (partial aggregation).
    many = rows.join(unit.filter("m > 1 and total > 0"), on).groupBy("uh", "usize", "uid", "usource").agg(
        F.any_value("row").alias("row"), F.any_value("total").alias("total")).select("row", "total")
    taken = once.unionAll(many).select("row", F.explode(
        F.sequence(F.lit(1).cast("long"), F.col("total").cast("long"))).alias("copy"))
    return taken.select(*(F.col("row")[c].alias(c) for c in docs.columns))
