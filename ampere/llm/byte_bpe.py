"""Byte-level BPE over overlapping chunks, and its inverse.

A text of one chunk is pre-tokenised and encoded where it lies; the different pieces of an
Arrow batch are encoded once (``pieces``). Longer texts are cut into
chunks that overlap a little, dealt over the cluster and pre-tokenised in parallel. The
pattern only looks ahead, so two scans that share a boundary agree from there on: per
text, the true scan is carried over each cut until it meets a boundary that the next
chunk found as well, and is taken up there (``stitch``). The segments between these points
hold whole pre-tokens; they are dealt out again, their pieces encoded, and the ids put
together in order. Decoding concatenates the raw bytes of the ids.

Ids are held as binary, little-endian unsigned 32-bit integers.

Defined results: null and empty texts have no ids; repeated rows each get their ids; null
and repeated keys are fine, as long texts are matched by the whole text; an input column
named like the added one is replaced; other columns pass through. Memory in a task is one
Arrow batch plus a bounded cache of pieces, and for long texts one text with its ids.
"""

from __future__ import annotations

import base64
import heapq
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.llm.common import fresh, small_batches, without
from ampere.llm.pieces import PATTERN, encoded, flat, joined

CHUNK = 1 << 18
OVERLAP = 1 << 10
CACHED_PIECES = 160_000
#: Bytes of a pre-token from which it is merged by itself, and not held.
LONG = 64
ROWS = 512
#: No pre-token decision looks further than this beyond the end of a match.
LOOK = 4


def load_ranks(raw: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in raw.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, leftmost first, until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts at i; 0 once merged away
    left = list(range(-1, n - 1))
    queue = []

    def offer(i: int) -> None:
        if end[i] < n:
            rank = ranks.get(piece[i:end[end[i]]])
            if rank is not None:
                heapq.heappush(queue, (rank, i, end[i], end[end[i]]))

    for i in range(n):
        offer(i)
    while queue:
        _, i, mid, stop = heapq.heappop(queue)
        if end[i] != mid or mid >= n or end[mid] != stop:
            continue
        end[i], end[mid] = stop, 0
        if stop < n:
            left[stop] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def pair_ranks(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring tokens whose bytes together have a rank, as sorted 64-bit keys, and that rank."""
    rows = [(ranks[token[:k]] << 32 | ranks[token[k:]], rank) for token, rank in ranks.items()
            for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
    found = np.array(sorted(rows), np.int64).reshape(-1, 2)
    return found[:, 0].copy(), found[:, 1].copy()


def merge_pieces(pieces: list[bytes], ranks: dict[bytes, int], pairs) -> tuple[np.ndarray, np.ndarray]:
    """``merge_piece`` on many short pieces at once: the ids of all, and where each one's begin and end.

    In each step every piece that still has a pair with a rank merges its first lowest one."""
    keys, values = pairs
    none = np.int64(1) << 40
    sizes = np.array([len(x) for x in pieces], np.int64)
    of_byte = np.array([ranks.get(bytes([x]), -1) for x in range(256)], np.int64)
    symbols = of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    if len(symbols) and symbols.min() < 0:
        raise KeyError("a byte that no token has")
    whose = np.repeat(np.arange(len(pieces)), sizes)

    def ranked(at):
        """Ranks of the pairs that begin at ``at``."""
        out = np.full(len(at), none)
        two = np.flatnonzero(at + 1 < len(symbols))
        two = two[whose[at[two]] == whose[at[two] + 1]]
        want = symbols[at[two]] << 32 | symbols[at[two] + 1]
        place = np.minimum(np.searchsorted(keys, want), max(0, len(keys) - 1))
        hit = keys[place] == want if len(keys) else np.zeros(len(want), bool)
        out[two[hit]] = values[place[hit]]
        return out

    rank = ranked(np.arange(len(symbols)))
    done = []
    while len(symbols):
        begin = np.flatnonzero(np.diff(whose, prepend=-1))
        least = np.minimum.reduceat(rank, begin)
        each = np.repeat(least, np.diff(begin, append=len(symbols)))
        over = each == none
        if over.any():
            done.append((whose[over], symbols[over]))
            go = ~over
            symbols, whose, rank, each = symbols[go], whose[go], rank[go], each[go]
            if not len(symbols):
                break
        at = np.flatnonzero(rank == each)
        at = at[np.diff(whose[at], prepend=-1) != 0]
        symbols[at] = each[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        at -= np.arange(len(at))  # one symbol is gone for each merge before
        symbols, whose, rank = symbols[keep], whose[keep], rank[keep]
        anew = np.concatenate([at, at[at > 0] - 1])
        rank[anew] = ranked(anew)
    whose = np.concatenate([x for x, _ in done]) if done else np.zeros(0, np.int64)
    symbols = np.concatenate([x for _, x in done]) if done else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(pieces)))])
    return symbols[np.argsort(whose, kind="stable")], ends


class Encoder(dict):
    """Pre-tokens to packed ids; forgets everything when it holds too many."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs=None):
        super().__init__()
        self.ranks, self.find, self.pairs = ranks, regex.compile(pattern).findall, pairs or pair_ranks(ranks)
        self.cut = pattern == PATTERN  # of other patterns it is not known where a pre-token always ends
        self.single = regex.compile(r" ?(\p{L}+|\p{N}+)").fullmatch

    def learn(self, tokens: set[bytes]) -> None:
        short = []
        for x in tokens:
            whole = self.ranks.get(x)
            if whole is not None:
                self[x] = struct.pack("<I", whole)
            elif len(x) <= LONG:
                short.append(x)
            else:
                ids = merge_piece(x, self.ranks)
                self[x] = struct.pack(f"<{len(ids)}I", *ids)
        ids, ends = merge_pieces(short, self.ranks, self.pairs)
        raw, ends = ids.astype("<u4").tobytes(), (ends * 4).tolist()
        self.update((x, raw[a:e]) for x, a, e in zip(short, ends[:-1], ends[1:], strict=True))

    def pieces(self, found: list[bytes]) -> list[bytes]:
        """Ids of pieces of text, each of one or more pre-tokens."""
        tokens = [None] * len(found)  # of those that are not known to be one pre-token
        for k, x in enumerate(found):
            if not (self.cut and (x in self or self.single(x.decode("utf-8", "surrogatepass")))):
                tokens[k] = [y.encode("utf-8", "surrogatepass")
                             for y in self.find(x.decode("utf-8", "surrogatepass"))]
        needed = {y for x, parts in zip(found, tokens, strict=True) for y in ([x] if parts is None else parts)}
        new = needed - self.keys()
        if len(self) + len(new) > CACHED_PIECES:
            self.clear()
            new = needed
        self.learn(new)
        out = [self[x] if parts is None else b"".join(map(self.__getitem__, parts))
               for x, parts in zip(found, tokens, strict=True)]
        for x in new:
            if len(x) > LONG:
                del self[x]
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        return encoded(texts, self.pieces, self.cut)


def boundaries(chunk: str, pattern: str, last: bool) -> np.ndarray:
    """Ends of the pre-tokens of a chunk that what follows the chunk cannot change."""
    ends = [m.end() for m in regex.finditer(pattern, chunk)]
    if not last:
        while ends and ends[-1] > len(chunk) - LOOK:
            ends.pop()
    return np.array(ends, dtype="<i4")


def stitch(text: str, found: list[np.ndarray], pattern: str, chunk: int = CHUNK) -> list[int]:
    """Points on true pre-token boundaries, one near each cut, from the chunks' boundaries.

    ``found[k]`` is relative to ``k * chunk``. The scan up to each point is the true one:
    the first chunk starts at 0, and each next one is entered at a boundary both share.
    """
    match = regex.compile(pattern).match
    at, points = 0, [0]
    own = None  # boundaries of the chunk the true scan follows, and its offset
    for k, ends in enumerate(found):
        start = k * chunk
        ends = ends.astype(np.int64) + start
        if k == 0:
            at = int(ends[-1]) if len(ends) else 0
            own = ends
            continue
        here = np.concatenate([[start], ends])
        # Where the true scan crosses the cut: the first of its boundaries past the start.
        i = int(np.searchsorted(own, start))
        candidates = own[i:]
        shared = candidates[np.isin(candidates, here)]
        if len(shared):
            at = int(shared[0])
        else:
            known = set(here.tolist())
            at = int(own[-1]) if len(own) else at
            while at not in known and at < len(text):
                if k + 1 < len(found) and at >= start + chunk:
                    break  # one pre-token covers the whole chunk; the next one takes over
                at = match(text, at).end()
        points.append(at)
        follow = ends[ends > at] if at in (here if len(here) < 64 else set(here.tolist())) else ends[:0]
        own = np.concatenate([[at], follow])
    points.append(len(text))
    return sorted(set(points))


def _batches(rows, encode, name):
    for whole in rows:
        at = whole.schema.get_field_index(name)
        for off in range(0, whole.num_rows, ROWS):  # a slice at a time, for little memory
            batch = whole.slice(off, ROWS)
            ids = encode(batch.column(at))
            columns = [ids if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _encoded(df: DataFrame, column: str, ranks, pattern: str) -> DataFrame:
    """``df`` with the text in ``column`` replaced by its ids."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == column else f
                           for f in df.schema.fields])

    def work(rows):
        raw, *pairs = ranks.value
        yield from _batches(rows, Encoder(load_ranks(raw), pattern, pairs).encode, column)

    return df.mapInArrow(work, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
           ids: str = "ids", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Every row with its ids; see the module's text."""
    spark = small_batches(docs.sparkSession)
    with open(ranks_path, "rb") as f:  # the vocabulary is a fixed file of under a megabyte
        raw = f.read()
    ranks = spark.sparkContext.broadcast((raw, *pair_ranks(load_ranks(raw))))
    keep = [c for c in docs.columns if c.lower() != ids.lower()]
    names = [*docs.columns, ids]
    n, h, key, work = (fresh(names, x) for x in ("_n", "_h", "_key", "_text"))
    source = docs.select(*without(docs, [ids]), docs[f"`{text}`"].alias(work))
    short = source.filter(F.coalesce(F.char_length(work), F.lit(0)) <= chunk)
    out = _encoded(short, work, ranks, pattern).select(
        *(F.col(f"`{c}`") for c in keep), F.col(work).alias(ids))

    long = source.filter(F.char_length(work) > chunk)
    whole = long.select(work).select(
        F.sha2(F.col(work), 256).alias(key), F.col(work)).dropDuplicates([key])
    cuts = whole.select(key, F.col(work), F.explode(F.sequence(
        F.lit(0), F.floor((F.char_length(work) - 1) / chunk).cast("int"))).alias(n))
    pieces = cuts.select(
        key, n, F.col(work).substr(F.col(n) * chunk + 1, F.lit(chunk + overlap)).alias(work),
        (F.char_length(work) <= F.col(n) * chunk + chunk + overlap).alias(h))
    pieces = pieces.repartition(F.col(key), F.col(n))

    def ends(rows):
        for b in rows:
            found = [boundaries(t, pattern, last).tobytes() for t, last in
                     zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())],
                                             names=[key, n, work])

    found = pieces.mapInArrow(ends, f"{key} string, {n} int, {work} binary")
    per_text = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(n, work))).alias(h))

    def points(rows):
        for b in rows:
            cut = [stitch(t, [np.frombuffer(x[work], "<i4") for x in f], pattern, chunk)
                   for t, f in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cut, pa.list_(pa.int32()))], names=[key, work, n])

    stitched = whole.join(per_text, key).select(key, work, h).mapInArrow(
        points, f"{key} string, {work} string, {n} array<int>")
    segments = stitched.select(
        key, work, n, F.explode(F.sequence(F.lit(1), F.size(n) - 1)).alias(h)).select(
        key, F.col(h).alias(n), F.expr(f"substring(`{work}`, `{n}`[`{h}` - 1] + 1, "
                                       f"`{n}`[`{h}`] - `{n}`[`{h}` - 1])").alias(work))
    coded = _encoded(segments.repartition(F.col(key), F.col(n)), work, ranks, pattern)
    joined = coded.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(n, work))).alias(h)).select(
        F.col(key), F.unhex(F.array_join(F.transform(h, lambda x: F.hex(x[work])), "")).alias(ids))
    rest = long.withColumn(key, F.sha2(F.col(work), 256)).join(joined, key).select(
        *(F.col(f"`{c}`") for c in keep), ids)
    return out.unionAll(rest)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", raw: str = "raw") -> DataFrame:
    """Every row with the raw bytes that its ids stand for; no ids: no bytes."""
    with open(ranks_path, "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())
    names = [*df.columns, raw]
    work = fresh(names, "_ids")
    source = df.select(*without(df, [raw]), df[f"`{ids}`"].alias(work))

    def lookup(rows):
        tokens = {rank: token for token, rank in load_ranks(ranks.value).items()}
        table = pa.array([tokens.get(k) for k in range(max(tokens, default=-1) + 1)], pa.large_binary())

        def raw_bytes(cells):
            data, ends = flat(cells)
            which = pa.array(data.view("<u4"))
            if table.null_count and not table.is_valid().take(which).true_count == len(which):
                raise KeyError("an id that no token has")
            return joined(table, which, ends // 4).cast(pa.binary())

        yield from _batches(rows, raw_bytes, work)

    return source.mapInArrow(lookup, source.schema).withColumnRenamed(work, raw)
