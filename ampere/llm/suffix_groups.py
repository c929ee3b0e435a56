"""Removal of long byte strings that occur more than once, by suffix arrays.

Every position that starts a string of ``length`` bytes is judged. So that equal strings
meet, each gets an anchor by its own bytes alone: the first smallest 8-byte gram hash in
its first half. Strings with one anchor share a core; cores that occur once are settled.
Where a core always occurs in the same surroundings, all its strings repeat. Elsewhere the
surroundings are cut into narrow bands (``BAND`` start positions around a longer core),
and a suffix array over their ends, the core being one symbol, tells which strings agree.

The suffix array is built by linear grouping (``suffix_array``): suffixes are grouped by
their Lyndon prefix; groups are taken in descending order, and every member extends the
Lyndon word of its previous smaller position; then each group's order is emitted in
ascending order, each suffix placing those that point to it. No ranks are renamed.

Bands that are shared too widely for one task are halved until they are small: a half has
a longer core and shorter ends. So no group is unbounded, and nothing is capped.

Defined results: null and empty texts have no bytes; texts shorter than ``length`` are kept
whole; repeated rows count as occurrences of each other; extra columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.llm.common import Scratch, fresh, without

LENGTH = 400
BAND = 16
BAND_ROWS = 20_000
BATCH = 40_000
ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "spans")


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of a list of integers by Lyndon groups; shorter suffixes sort first."""
    end = len(text)
    text = [*text, min(text, default=0) - 1]  # a last symbol below all others
    members: list[list[int]] = []
    down: list[int] = []
    up: list[int] = []
    number: dict[int, int] = {}
    symbols = sorted(set(text))
    for k, symbol in enumerate(symbols):
        number[symbol] = k
        members.append([])
        down.append(k - 1)
        up.append(k + 1)
    up[-1] = -1
    group = [number[x] for x in text]
    for i, g in enumerate(group):
        members[g].append(i)

    smaller = [-1] * len(text)
    done = [False] * len(text)
    g = len(members) - 1
    while g >= 0:
        own = sorted(i for i in members[g] if group[i] == g)
        members[g] = own
        reached: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            done[i] = True
            if j >= 0:
                reached[j] = reached.get(j, 0) + 1
        # A position reached k times has its word extended k times. Per old group and k they
        # form a new group, right above the old one, more often extended ones higher.
        moved: dict[int, dict[int, list[int]]] = {}
        for j, k in reached.items():
            moved.setdefault(group[j], {}).setdefault(k, []).append(j)
        for old, by_count in moved.items():
            at = old
            for k in sorted(by_count):
                new = len(members)
                members.append(by_count[k])
                down.append(at)
                up.append(up[at])
                if up[at] >= 0:
                    down[up[at]] = new
                up[at] = new
                at = new
                for j in by_count[k]:
                    group[j] = new
        g = down[g]

    # Ascending: each suffix places the chain of positions that wait for it.
    place, slot, g = [0] * len(members), 0, 0
    while g >= 0:
        place[g] = slot
        slot += sum(1 for i in members[g] if group[i] == g)
        g = up[g]
    out, placed = [end] * len(text), [False] * len(text)
    placed[end] = True
    for r in range(len(text)):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            out[place[group[j]]] = j
            place[group[j]] += 1
            placed[j] = True
            j = smaller[j]
    return out[1:]


# Anchors ------------------------------------------------------------------------------

def anchors(b: bytes, length: int) -> list[tuple[int, int, int]]:
    """(anchor, first start, last start) of all strings of ``length`` bytes, in order.

    A string's anchor is the leftmost smallest gram hash among its first ``length // 2``
    grams, so it depends on the string alone.
    """
    n, reach = len(b), length // 2
    if n < length:
        return []
    x = np.frombuffer(b, np.uint8).astype(np.uint64)
    for k in (1, 2, 4):
        x = (x[:-k] << np.uint64(8 * k)) | x[k:]
    h = x * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    m = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    k = 1
    while 2 * k <= reach:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    if reach > k:
        m = np.minimum(m[:len(m) - (reach - k)], m[reach - k:])
    at = (m[:n - length + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return list(zip(at[first].tolist(), first.tolist(), last.tolist(), strict=True))


def _signed(x: int) -> int:
    return x - (1 << 63)


def _anchor_rows(length: int):
    core = length - length // 2 + 1
    names = ["core", "whole", "t", "rep", "s", "a", "b", "c"]

    def run(batches):
        for batch in batches:
            for off in range(0, batch.num_rows, 512):
                part = batch.slice(off, 512)
                # Copies inside a slice are counted, not repeated.
                seen: dict[int, list] = {}
                for t, rep, b in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    if t in seen:
                        seen[t][2] += 1
                        seen[t][0] = min(seen[t][0], rep)
                    else:
                        seen[t] = [rep, b or b"", 1]
                rows = []
                for t, (rep, b, c) in seen.items():
                    for s, a, e in anchors(b, length):
                        rows.append((_signed(xxhash.xxh3_64_intdigest(b[s:s + core])),
                                     _signed(xxhash.xxh3_64_intdigest(b[a:e + length], seed=s - a)),
                                     t, rep, s, a, e, c))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)

    return run, ", ".join(f"{x} long" for x in names)


def _bands(length: int, band: int):
    """Rows (t, text, wanted anchors) to the bands of their starts."""
    names = ["key", "left", "right", "base", "t", "s", "c"]

    def run(batches):
        for batch in batches:
            for off in range(0, batch.num_rows, 256):
                part = batch.slice(off, 256)
                out = []
                for t, b, wanted in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    for w in wanted:
                        s, a, e = w["s"], w["a"], w["b"]
                        for j in range((s - e) // band, (s - a) // band + 1):
                            hi, lo = min(s - a, band * j + band - 1), max(s - e, band * j)
                            start, stop = s - band * j, s - band * j - band + 1 + length
                            out.append((_signed(xxhash.xxh3_64_intdigest(b[start:stop], seed=j)),
                                        b[s - hi:start], b[stop:s - lo + length], band * j, t, s, w["c"]))
                columns = list(zip(*out, strict=True)) if out else [()] * 7
                kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                                                 names=names)

    return run, "key long, left binary, right binary, base long, t long, s long, c long"


def repeated_starts(groups: list[list[tuple[bytes, bytes, int]]], width: int) -> list[list[list[int]]]:
    """Per group and member (left, right, count) the offsets o whose string repeats.

    A member stands for left + core + right; offset o starts o bytes before the core and
    takes ``width`` symbols, the core being one.
    """
    text, origin = [], []
    for g, rows in enumerate(groups):
        for r, (left, right, _) in enumerate(rows):
            for o in range(len(left), -1, -1):
                origin.append((g, r, o))
            text.extend(x + 1 for x in left)
            text.append(257 + g)
            text.extend(x + 1 for x in right)
            text.append(0)
            origin.extend([None] * (len(right) + 1))
    out = [[[] for _ in rows] for rows in groups]

    def settle(run):
        if sum(groups[g][r][2] for g, r, _ in run) > 1:
            for g, r, o in run:
                out[g][r].append(o)

    run, last = [], None
    for i in suffix_array(text):
        here = origin[i]
        if here is None or here[2] + 1 + len(groups[here[0]][here[1]][1]) < width:
            continue  # not a start, or the anchor of a string is another one
        string = text[i:i + width]
        if string != last:
            settle(run)
            run, last = [], string
        run.append(here)
    settle(run)
    return out


def _settle_bands(width: int):
    """Rows sorted by key to the byte ranges of repeated strings, group by group."""
    def run(batches):
        batch: list[tuple[list, list]] = []
        held: dict = {}
        key, size = None, 0

        def close():
            nonlocal held, size
            if held and (len(held) > 1 or next(iter(held.values()))[0] > 1):
                batch.append((list(held), list(held.values())))
                size += sum(len(x) + len(y) + 2 for x, y in held)
            held = {}

        def flush():
            nonlocal batch, size
            t_out, a_out, b_out = [], [], []
            found = repeated_starts([[(x, y, v[0]) for (x, y), v in zip(k, rows, strict=True)]
                                     for k, rows in batch], width)
            for (_, rows), offsets in zip(batch, found, strict=True):
                for (_, places), each in zip(rows, offsets, strict=True):
                    for t, s in places:
                        for o in each:
                            t_out.append(t)
                            a_out.append(s - o)
                            b_out.append(1)
            batch, size = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(t_out, pa.int64()), pa.array(a_out, pa.int64())], names=["t", "a"])

        for rows in batches:
            for k, left, right, base, t, s, c in zip(*(rows.column(i).to_pylist() for i in range(7)), strict=True):
                if k != key:
                    close()
                    key = k
                    if size >= BATCH:
                        yield flush()
                entry = held.setdefault((left, right), [0, []])
                entry[0] += c
                if c == 1:  # the others repeat as a whole
                    entry[1].append((t, s - base))
        close()
        yield flush()

    return run


def _halve(rows: DataFrame, width: int) -> DataFrame:
    """Bands of ``width`` starts cut into two of half the width."""
    h = width // 2
    upper = rows.filter(F.length("left") >= h).select(
        F.xxhash64("key", F.lit(1), F.expr(f"substring(left, length(left) - {h} + 1, {h})")).alias("key"),
        F.expr(f"substring(left, 1, length(left) - {h})").alias("left"),
        F.expr(f"substring(right, 1, {h - 1})").alias("right"), (F.col("base") + h).alias("base"), "t", "s", "c")
    lower = rows.filter(F.length("right") >= h).select(
        F.xxhash64("key", F.lit(0), F.expr(f"substring(right, 1, {h})")).alias("key"),
        F.expr(f"substring(left, greatest(1, length(left) - {h - 2}), {h - 1})").alias("left"),
        F.expr(f"substring(right, {h + 1}, {h})").alias("right"), "base", "t", "s", "c")
    return upper.unionAll(lower)


def _settled(rows: DataFrame, scratch: Scratch, band: int) -> DataFrame:
    """(t, a): starts of repeated strings, from bands; wide groups are halved first."""
    out, width = None, band
    while True:
        groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("total")).filter("total > 1")
        groups = scratch.write(groups)
        big = groups.filter(F.col("n") > BAND_ROWS)
        last = width == 1 or big.isEmpty()
        small = groups if last else groups.filter(F.col("n") <= BAND_ROWS)
        if width == 1:  # one start each: the key says it all
            now = rows.join(groups, "key", "left_semi").filter("c = 1").select("t", (F.col("s") - F.col("base")).alias("a"))
        else:
            mine = rows.join(small.select("key"), "key", "left_semi")
            now = mine.repartition("key").sortWithinPartitions("key").select(
                "key", "left", "right", "base", "t", "s", "c").mapInArrow(_settle_bands(width), "t long, a long")
        out = now if out is None else out.unionAll(now)
        if last:
            return out
        rows = scratch.write(_halve(rows.join(big.select("key"), "key", "left_semi"), width))
        width //= 2


def repeated(docs: DataFrame, id: str, text: str, length: int, scratch: Scratch, band: int = BAND) -> DataFrame:
    """(t, spans): byte ranges to remove, per hash of a text."""
    t, rep = F.xxhash64(F.col(f"`{text}`")), F.xxhash64(F.col(f"`{id}`"), F.col(f"`{id}`").isNull())
    source = docs.select(t.alias("t"), rep.alias("rep"), F.col(f"`{text}`").cast("binary").alias("b"))
    run, schema = _anchor_rows(length)
    rows = scratch.write(source.filter(F.length("b") >= length).mapInArrow(run, schema))
    # Written, so that the join below has the counts as a side of its own: a hot core is then
    # split at run time, as it could not be within the stage that counts.
    cores = scratch.write(rows.groupBy("core").agg(F.sum("c").alias("n")).filter("n > 1").select("core"))
    shared = scratch.write(rows.join(cores, "core", "left_semi"))
    scratch.drop(rows)
    wholes = shared.groupBy("core", "whole").agg(
        F.sum("c").alias("c"), F.min(F.struct("t", "rep", "s", "a", "b")).alias("x"))
    wholes = scratch.write(wholes)
    sure = shared.join(wholes.filter("c > 1").select("core", "whole"), ["core", "whole"], "left_semi").select(
        "t", "a", (F.col("b") + length).alias("e"))
    mixed = scratch.write(wholes.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).filter(
        "n > 1 and least = 1").select("core"))
    wanted = wholes.join(mixed, "core", "left_semi").select("x.t", "x.rep", F.struct(
        F.col("x.s"), F.col("x.a"), F.col("x.b"), F.col("c")).alias("w")).groupBy("t", "rep").agg(
        F.collect_list("w").alias("w"))
    run, schema = _bands(length, band)
    bands = source.join(wanted, ["t", "rep"]).select("t", "b", "w").mapInArrow(run, schema)
    # Rows equal in id and text were asked the same twice.
    bands = scratch.write(bands.groupBy("key", "left", "right", "base", "t", "s", "c").agg(
        F.count(F.lit(1)).alias("_n")).drop("_n"))
    alone = _settled(bands, scratch, band).select("t", "a", (F.col("a") + length).alias("e"))
    return sure.unionAll(alone).distinct().groupBy("t").agg(F.collect_list(F.struct("a", "e")).alias("spans"))


def merge(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, e in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return [tuple(x) for x in out]


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH,
           digest: bool = False) -> DataFrame:
    """Every row with its byte figures, its removed spans and the bytes (or digest) kept.

    Adds n_bytes, n_removed, n_spans, spans and kept_bytes; with ``digest`` the SHA-256 of
    the bytes kept instead of the last two.
    """
    scratch, work = Scratch(docs.sparkSession, "suffix"), Scratch(docs.sparkSession, "suffix-work")
    found = scratch.write(repeated(docs, id, text, length, work))
    work.clear()
    names = [*docs.columns, *ADDED]
    raw, key, mine = (fresh(names, x) for x in ("_raw", "_t", "_spans"))
    source = docs.select(*without(docs, [x for x in ADDED]), F.xxhash64(F.col(f"`{text}`")).alias(key),
                         F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias(raw))
    kept = [c for c in source.columns if c not in (key, raw)]
    joined = source.join(found.withColumnRenamed("t", key).withColumnRenamed("spans", mine), key, "left").select(
        *(F.col(f"`{c}`") for c in kept), raw, mine)
    span = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("e", T.LongType())]))
    schema = T.StructType([
        *(f for f in source.schema.fields if f.name in kept), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
        *([T.StructField("kept_sha256", T.StringType())] if digest else
          [T.StructField("spans", span), T.StructField("kept_bytes", T.BinaryType())])])

    def run(batches):
        for batch in batches:
            for off in range(0, batch.num_rows, 512):
                part = batch.slice(off, 512)
                n = part.num_columns
                sizes, removed, counts, last, spans_out = [], [], [], [], []
                for b, spans in zip(part.column(n - 2).to_pylist(), part.column(n - 1).to_pylist(), strict=True):
                    gone = merge((x["a"], x["e"]) for x in spans or [])
                    rest, at = [], 0
                    for a, e in gone:
                        rest.append(b[at:a])
                        at = e
                    rest = b"".join([*rest, b[at:]])
                    sizes.append(len(b))
                    removed.append(len(b) - len(rest))
                    counts.append(len(gone))
                    spans_out.append([{"a": a, "e": e} for a, e in gone])
                    last.append(hashlib.sha256(rest).hexdigest() if digest else rest)
                tail = [pa.array(last, pa.string())] if digest else [
                    pa.array(spans_out, pa.list_(pa.struct([("a", pa.int64()), ("e", pa.int64())]))),
                    pa.array(last, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(n - 2)), pa.array(sizes, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), *tail], names=schema.names)

    return joined.mapInArrow(run, schema)
