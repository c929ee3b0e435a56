"""Exact n-gram Jaccard join in the metric space of word shingles.

``1 - |A & B| / |A | B|`` is a metric. Documents with the same shingle set are one class.
A class is dealt to the buckets of its rarest shingles: two sets with similarity 0.8 or
more share at least ``spare(n)`` of the first ``n - ceil(0.8 n) + spare(n)`` under any one
order of all shingles, so no link is lost. Each bucket has a pivot. The pivots span
regions: first every class is compared with its regions' pivots only, and all within the
radius of a pivot are linked through it. Buckets with one component left are done. The
rest are joined region by region: pairs whose distances to the pivot differ by more than
the radius are skipped (triangle inequality), classes inside the window that reaches over
the radius are kept for the next pivot, and so on until a region holds one component
(``join_region``). Regions too large for one task are cut into blocks that meet pairwise.

Order of shingles: by hash, but the frequent ones last. Which are frequent is counted over
all documents; the list is bounded by ``HOT_LIST`` entries however large the input is, and
only decides which buckets are used, never which links are found.

Defined results: texts without words have no shingles and no links; a text with fewer
words than a shingle is one shingle; repeated rows and equal ids are fine; a null id
counts as no id when the smallest is taken.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import Scratch, fresh, release, scratch_folders
from ampere.llm.mixing import row_hash

WORDS = 5
#: Similarity in hundredths.
SIMILAR = 80
HOT_LIST = 1 << 20
HOT_CHUNK = 2_000_000
REGION = 2048
SPARE = 20
STAR_ROUNDS = 2
BLOOM_BITS = 25
#: Bytes of text that are hashed at a time.
CHUNK = 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of lower-cased words: polynomials in an odd number, taken from running sums over all
    bytes of a chunk at once and shifted to the word's start."""

    def __init__(self):
        with np.errstate(over="ignore"):
            self.value = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
            self.value[65:91] = self.value[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.base = 0xD1342543DE82EF95
        self.powers(CHUNK + 1)

    def powers(self, n: int) -> None:
        for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def hashes(self, chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word of a chunk that begins and ends between words."""
        b = np.frombuffer(chunk, np.uint8)
        if len(b) + 1 > len(self.up):
            self.powers(len(b) + 1)
        gap = np.append(self.space[b], True)
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        ends = np.flatnonzero(gap & np.concatenate([[False], ~gap[:-1]]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value[b] * self.up[:len(b)], dtype=np.uint64)])
        h = (sums[ends] - sums[starts]) * self.down[starts]
        return starts, _mixed(h ^ (ends - starts).astype(np.uint64))

    def of_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Hashes of the words of each text, in order."""
        return self.of_bytes([(t or "").encode("utf-8", "surrogatepass") for t in texts])

    def of_bytes(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        held, size = [], 0

        def flush():
            starts, h = self.hashes(b"\n".join(held))
            cut = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in held])[:-1])
            out.extend(np.split(h, cut))

        for raw in texts:
            if held and size + len(raw) + 1 > CHUNK:
                flush()
                held, size = [], 0
            if len(raw) >= CHUNK:
                out.append(np.concatenate([self.hashes(x)[1] for x in _spans(raw)]))
                continue
            held.append(raw)
            size += len(raw) + 1
        if held:
            flush()
        return out


def _spans(raw: bytes):
    """A long text in pieces of about a chunk, cut between words."""
    at = 0
    for m in re.finditer(rb"[^\x20\x09-\x0D]{%d,}|[\x20\x09-\x0D]" % CHUNK, raw):
        if m.end() - at >= CHUNK:
            yield raw[at:m.end()]
            at = m.end()
    yield raw[at:]


def shingle_sets(texts: list[str | None], words: Hashes, size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    out = []
    for w in words.of_texts(texts):
        n = len(w) - size + 1
        if n <= 0:
            out.append(np.array([xxhash.xxh64_intdigest(w.tobytes(), seed=len(w))] if len(w) else [], np.uint64))
            continue
        h = np.zeros(n, np.uint64)
        for i in range(size):
            h = (h ^ w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h.sort()
        out.append(h[np.append(True, h[1:] != h[:-1])])
    return out


def shingles(text: str | None, words: Hashes, size: int = WORDS) -> np.ndarray:
    return shingle_sets([text], words, size)[0]


def _by_slices(column, words: Hashes):
    """Sets of a column of texts, a few texts at a time."""
    for off in range(0, len(column), 256):
        yield from shingle_sets(column.slice(off, 256).to_pylist(), words)


def spare(n):
    """Shared prefix shingles that a link of a set of n shingles needs at least.

    Longer prefixes cost postings, but few unrelated texts share so many of their rarest.
    """
    return 1 + n // SPARE


def prefix_length(n: int, similar: int = SIMILAR) -> int:
    return int(n - -(-similar * n // 100) + spare(n))


def _class(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _longs(values) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def frequent(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Shingles of many documents: at most HOT_LIST, each of more than its share of all."""
    def count(batches):
        words, held, size = Hashes(), [], 0

        def flush():
            every = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            at = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
            keys, n = every[at], np.diff(at, append=len(every))
            often = n >= 4
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([_longs(keys[often]), pa.array([0], pa.int64())]),
                 pa.array(np.append(n[often], 0), pa.int64()),
                 pa.array(np.append(np.zeros(int(often.sum()), np.int64), size), pa.int64())],
                names=["s", "df", "total"])

        for b in batches:
            for s in _by_slices(b.column(0), words):
                held.append(s)
                size += len(s)
                if size >= HOT_CHUNK:
                    yield flush()
                    held, size = [], 0
        yield flush()

    counted = docs.select(text).mapInArrow(count, "s long, df long, total long").groupBy("s").agg(
        F.sum("df").alias("df"), F.sum("total").alias("total")).filter("df >= 32 or total > 0")
    scratch = Scratch(docs.sparkSession, "jaccard-frequent")
    counted = scratch.write(counted)
    total = counted.agg(F.sum("total")).first()[0] or 0
    hot = counted.filter(F.col("df") > max(32, total // HOT_LIST)).select("s").toArrow()
    scratch.drop(counted)
    return np.sort(hot.column("s").to_numpy().astype(np.int64).view(np.uint64))


def sketch(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Per row: id, set size, class, and the prefix, cold and hot shingles apart."""
    hot = docs.sparkSession.sparkContext.broadcast(frequent(docs, text))  # 8 MB at most

    def run(batches):
        words, often = Hashes(), hot.value
        for b in batches:
            n, cls, cold_out, hot_out = [], [], [], []
            for s in _by_slices(b.column(1), words):
                n.append(len(s))
                cls.append(_class(s))
                is_hot = np.zeros(len(s), bool)
                if len(often) and len(s):
                    is_hot = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s
                k = prefix_length(len(s)) if len(s) else 0
                cold = s[~is_hot][:k]
                cold_out.append(cold.view(np.int64))
                hot_out.append(s[is_hot][:k - len(cold)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                 pa.array(cold_out, pa.list_(pa.int64())), pa.array(hot_out, pa.list_(pa.int64()))],
                names=["id", "n", "cls", "cold", "hot"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"id {kind}, n long, cls long, cold array<long>, hot array<long>")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) -> (node, label): the smallest node of each component, by large and small stars."""
    e = scratch.write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    while True:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionAll(low.filter("a > m").select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        new = scratch.write(small.filter("a > b").distinct())
        same = (new.count() == e.count()
                and new.join(e, ["a", "b"], "left_anti").isEmpty())
        scratch.drop(e)
        e = new
        if same:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _buckets(rows: DataFrame) -> DataFrame:
    """(s, cls) of the shingles that more than one class has."""
    cold = rows.select(F.explode("cold").alias("s"), "cls")
    w = Window.partitionBy("s")
    cold = cold.select("s", "cls", F.min("cls").over(w).alias("lo"), F.max("cls").over(w).alias("hi")).filter(
        "lo < hi").select("s", "cls").distinct()
    # Frequent shingles may fill a bucket with much of the input: combine before the shuffle.
    hot = rows.select(F.explode("hot").alias("s"), "cls").distinct()
    many = hot.groupBy("s").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("s")
    return cold.unionAll(hot.join(many, "s", "left_semi"))


def _several(b: DataFrame, scratch: Scratch, similar: int) -> DataFrame:
    """Postings (s, cls, n, label) that can still join two components."""
    while True:  # each pass drops what the last one left without partners
        live = b.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("s")
        b = b.join(live, "s", "left_semi")
        least = F.ceil(F.col("n") * similar / 100)
        need = 1 + F.floor(least / SPARE)
        enough = b.groupBy("cls").agg(F.count(F.lit(1)).alias("c"), F.any_value("n").alias("n")).filter(
            F.col("c") >= need).select("cls")
        new = scratch.write(b.join(enough, "cls", "left_semi"))
        before = b.count()
        if new.count() >= 0.9 * before:
            return new
        b = new


def _bloom_add(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
    for shift in (0, 20):
        at = (keys.view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << BLOOM_BITS) - 1)
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64),
                         np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    return bits


def _bloom_has(bits: np.ndarray, key: int) -> bool:
    for shift in (0, 20):
        at = (key >> shift) & ((1 << BLOOM_BITS) - 1)
        if not bits[at >> 3] >> (at & 7) & 1:
            return False
    return True


def _representative(id_hash: int, cls: int) -> int:
    return xxhash.xxh3_64_intdigest(np.array([id_hash, cls], np.int64).tobytes())


def _sets(docs: DataFrame, id: str, text: str, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """(cls, set) of the wanted classes, made again from the texts of their representatives.

    A filter of fixed size keeps most other texts from being sent around; it may let some
    through, never lose one.
    """
    def collect(batches):
        bits = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
        for b in batches:
            keys = [_representative(i, c) for i, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            bits |= _bloom_add(np.array(keys, np.uint64)) if keys else 0
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    parts = wanted.select("rep", "cls").coalesce(16).mapInArrow(collect, "bits binary").toLocalIterator()
    every = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
    for r in parts:  # 4 MB each
        every |= np.frombuffer(r.bits, np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(every)

    def run(batches):
        words, bits = Hashes(), sent.value
        for b in batches:
            out = []
            for i, s in zip(b.column(0).to_pylist(), _by_slices(b.column(1), words), strict=True):
                c = _class(s)
                if _bloom_has(bits, _representative(i, c)):
                    out.append((c, s.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                              pa.array([x[1] for x in out], pa.list_(pa.int64()))], names=["cls", "set"])

    made = docs.select(_id_hash(F.col(f"`{id}`")), F.col(f"`{text}`")).mapInArrow(run, "cls long, set array<long>")
    made = made.join(wanted.select("cls"), "cls", "left_semi")
    return scratch.write(made.groupBy("cls").agg(F.any_value("set").alias("set")))


def _id_hash(id):
    return F.xxhash64(id, id.isNull())


def join_region(sets: list[np.ndarray], labels: list, similar: int = SIMILAR) -> list[tuple[int, int]]:
    """Links that connect what is linked in a region, by pivots and triangle windows."""
    radius = 1 - similar / 100
    sizes = np.array([len(s) for s in sets])
    root = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    links, todo = [], [np.argsort(sizes, kind="stable")]
    while todo:
        at = todo.pop()
        if len({find(labels[i]) for i in at.tolist()}) < 2:
            continue
        # Sizes of linked sets differ by a quarter at most: gaps cut a region.
        at = at[np.argsort(sizes[at], kind="stable")]
        gap = np.flatnonzero(sizes[at][1:] * similar > 100 * sizes[at][:-1])
        if len(gap):
            todo += np.split(at, gap + 1)
            continue
        pivot, rest = at[0], at[1:]
        values = np.concatenate([sets[i] for i in rest])
        owner = np.repeat(np.arange(len(rest)), sizes[rest])
        p = sets[pivot]
        hit = p[np.minimum(np.searchsorted(p, values), len(p) - 1)] == values
        both = np.bincount(owner[hit], minlength=len(rest))
        union = sizes[rest] + len(p) - both
        distance = 1 - both / union
        near = 100 * both >= similar * union
        for i in rest[near].tolist():
            a, b = find(labels[i]), find(labels[pivot])
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(pivot), i))
        if near.all():
            continue
        # Inside the radius all are linked through the pivot; they stay only for those outside
        # that their distance to the pivot does not exclude.
        reach = distance[~near].min() - radius - 1e-9
        stay = ~near | (distance >= reach)
        rest, distance = rest[stay], distance[stay]
        order = np.argsort(distance, kind="stable")
        cut = np.flatnonzero(np.diff(distance[order]) > radius + 1e-9)
        todo += np.split(rest[order], cut + 1)
    return links


def _regions(b: DataFrame, sets: DataFrame, scratch: Scratch, similar: int) -> DataFrame:
    """Edges between the components left, region by region."""
    pivots = b.groupBy("s").agg(F.min("cls").alias("region"))
    member = b.join(pivots, "s").groupBy("region", "cls").agg(
        F.count(F.lit(1)).alias("w"), F.any_value("n").alias("n"), F.any_value("label").alias("label"))
    # Linked classes share as many buckets as either of them needs. While each leaves regions with
    # less than half of its need, in buckets, they still meet in one that both have kept.
    need = 1 + F.floor(F.ceil(F.col("n") * similar / 100) / SPARE)
    light = Window.partitionBy("cls").orderBy("w", "region").rowsBetween(Window.unboundedPreceding, 0)
    member = member.withColumn("sum", F.sum("w").over(light)).filter(
        F.col("sum") > F.floor((need - 1) / 2)).select("region", "cls", "label")
    sizes = member.groupBy("region").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    member = member.join(sizes, "region").withColumn("k", F.ceil(F.col("c") / REGION))
    # Block pairs (i <= j); a class of block i is in every pair with i.
    member = member.withColumn("i", F.pmod(F.xxhash64("cls"), F.col("k"))).withColumn(
        "j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))).select(
        "region", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "cls", "label")

    def run(key, table):
        cls, label = table.column("cls").to_pylist(), table.column("label").to_pylist()
        held = table.column("set").combine_chunks()
        ends = np.cumsum(held.value_lengths().to_numpy())
        found = [np.sort(x) for x in np.split(held.flatten().to_numpy().view(np.uint64), ends[:-1])]
        links = join_region(found, label, similar)
        return pa.table({"a": pa.array([cls[x] for x, _ in links], pa.int64()),
                         "b": pa.array([cls[y] for _, y in links], pa.int64())})

    return member.join(sets, "cls").groupBy("region", "i", "j").applyInArrow(run, "a long, b long")


def linked(docs: DataFrame, id: str = "doc_id", text: str = "text", similar: int = SIMILAR) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id its links reach)."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = scratch.write(sketch(docs, id, text))
    classes = rows.filter("n > 0").groupBy("cls").agg(
        F.min("id").alias("id"), F.any_value("n").alias("n")).withColumn("rep", _id_hash(F.col("id")))
    classes = scratch.write(classes)
    # The prefixes are the bulk: they go as soon as the buckets of several classes are written.
    buckets = scratch.write(_buckets(rows.filter("n > 0")))
    rows, prefixes = scratch.write(rows.select("id", "n", "cls")), rows
    scratch.drop(prefixes)
    first = scratch.write(buckets.join(classes.select("cls", "n", F.col("cls").alias("label")), "cls"))
    scratch.drop(buckets)
    b = _several(first, scratch, similar)
    scratch.drop(first)
    wanted = classes.join(b.select("cls").distinct(), "cls", "left_semi")
    sets, edges, round_ = None, None, 0
    if not b.isEmpty():
        sets = _sets(docs, id, text, wanted, scratch)
    while not b.isEmpty():
        if round_ < STAR_ROUNDS:
            seed = F.xxhash64("cls", F.lit(round_))
            pivots = b.groupBy("s").agg(F.min_by(F.struct("cls", "n", "label"), seed).alias("p"))
            pairs = b.join(pivots, "s").filter("label <> p.label").groupBy("cls", F.col("p.cls").alias("p")).agg(
                F.count(F.lit(1)).alias("shared"), F.any_value("n").alias("n"), F.any_value("p.n").alias("m"))
            fit = (F.least("n", "m") * 100 >= F.greatest("n", "m") * similar) & (
                F.col("shared") >= 1 + F.floor(F.least("n", "m") / SPARE))
            pairs = pairs.filter(fit & (F.col("cls") != F.col("p"))).select("cls", "p")
            near = pairs.join(sets, "cls").join(
                sets.select(F.col("cls").alias("p"), F.col("set").alias("other")), "p").select(
                "cls", "p", (F.size("set") + F.size("other")).alias("both"),
                F.size(F.array_intersect("set", "other")).alias("x"))
            new = near.filter(F.col("x") * 100 >= (F.col("both") - F.col("x")) * similar).select(
                F.col("cls").alias("a"), F.col("p").alias("b"))
        else:
            new = _regions(b, sets, scratch, similar)
        new = scratch.write(new)
        edges = new if edges is None else edges.unionAll(new)
        last = round_ >= STAR_ROUNDS
        round_ += 1
        label = components(edges, scratch)
        if last:
            break
        again = b.select("s", "cls", "n").join(label, b["cls"] == label["node"], "left").select(
            "s", "cls", "n", F.coalesce("label", "cls").alias("label"))
        old, b = b, _several(again, scratch, similar)
        # Few classes are left after a round: later rounds must not move the other sets.
        all_sets, sets = sets, scratch.write(sets.join(b.select("cls").distinct(), "cls", "left_semi"))
        scratch.drop(old, all_sets)
    if edges is None:
        label = classes.select(F.col("cls").alias("node"), F.col("cls").alias("label")).limit(0)
    named = classes.join(label, classes["cls"] == label["node"], "left").select(
        "cls", "id", F.coalesce("label", "cls").alias("label"))
    smallest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    member = named.join(smallest, "label").select("cls", "component_id")
    out = Scratch(docs.sparkSession, "jaccard-linked").write(
        rows.select("id", "n", "cls").join(member, "cls", "left").select(
            F.col("id").alias(id), F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
    scratch.clear()
    return out


def one_per_group(docs: DataFrame, id: str = "doc_id", text: str = "text", similar: int = SIMILAR) -> DataFrame:
    """The rows of ``docs`` with one row of each group: that of the smallest id.

    Equal ids are told apart by a hash of their rows; of rows equal in every column one
    stays, unless their text is without words. Columns stay as they are.
    """
    scratch = Scratch(docs.sparkSession, "jaccard-keep")
    u, m, n, one = (fresh(docs.columns, x) for x in ("_u", "_m", "_n", "_one"))
    rows = docs.select("*", row_hash(docs).alias(u))
    place = F.struct(F.col(f"`{id}`").isNull().alias("late"), F.col(f"`{id}`").alias("id"), F.col(u).alias("u"))
    before = scratch_folders()
    groups = linked(rows.select(place.alias("place"), F.col(f"`{text}`").alias("text")), "place", "text", similar)
    made = scratch_folders() - before
    stay = scratch.write(groups.filter("place = component_id").groupBy(F.col("place.u").alias(u)).agg(
        F.count(F.lit(1)).alias(m), F.min("n_shingles").alias(n)))
    release(docs.sparkSession, made)
    rows = rows.join(stay, u)
    plain = rows.filter((F.col(m) == 1) | (F.col(n) == 0)).select(*(F.col(f"`{c}`") for c in docs.columns))
    equal = rows.filter((F.col(m) > 1) & (F.col(n) > 0)).groupBy(u).agg(
        F.any_value(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias(one))
    return plain.unionAll(equal.select(*(F.col(one)[c].alias(c) for c in docs.columns)))
