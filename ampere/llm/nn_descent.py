"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors are one node of the graph; a node keeps its ``k + 1`` smallest ids, which are
all that a result can ever show of it. Every node is indexed. The first graph comes from a
few random cuts of the space, compared in bounded blocks. Then, in rounds, the neighbours of
each node (both ways) meet there and are compared with each other, where one of the two is
new: whoever is nearer than the worst neighbour held replaces it. Nodes are dealt to buckets,
and a bucket is one row of the graph: it asks the others for the nodes it needs, each once, and
sends what it finds. Rounds end when at most the share ``CHANGED`` of all edges is new. A query
walks the graph both ways: the best nodes seen that are not yet opened give their neighbours as
new candidates, all queries moving together in joins, until no node of the beam is unopened.

The beam is not fixed, as a larger table needs a wider one: ``PROBES`` of the queries are
compared with all nodes (one pass), and the beam of all queries widens by a fifth, their walk
going on from where it is, whenever they have one node each to open on average, until the probes
find the share ``RECALL`` of their true neighbours or all that is held is opened. A step is one
job: the candidates go, in one row for each bucket of nodes, to the nodes, and come back if they
are near enough to be held; queries with nothing to open wait until the beam widens.
Graph and walk compare 32-bit floats, scaled by one factor for the whole table; scores
returned are computed on the original vectors in doubles.

Defined results: vectors that are null, empty, zero, of another length than most, or that
hold a null or a non-finite component take no part, as query or candidate; null ids take
no part; of repeated ids every row counts as a candidate of the others' and queries once
per id and vector. With fewer candidates than ``k`` all that were reached are returned, and
all are reached up to one block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ampere.llm.common import Scratch

NEIGHBOURS = 64
CUTS = 4
BLOCK = 512
#: Nodes compared with each other in a cut, so many with all at a time, and places whose nodes are compared together.
CELL = 2048
STRIP = 256
TOGETHER = 64
#: Nodes and numbers of a bucket of the graph at most, and buckets that a small graph is dealt to. A node is
#: numbered by its bucket and, in the lower bits, its place there.
HOME, NUMBERS, FEW = 2048, 1 << 17, 24
PLACE = 16
#: Numbers of vectors in a row that one bucket sends another: larger cells would fill an executor's heap.
CELLS = 1 << 16
LAST = (1 << PLACE) - 1
CHANGED = 0.02
BEAM = 96
#: Nodes of a bucket, which meet the queries' candidates among them.
BUCKET = 4096
#: Nodes a query opens at a time, and the part by which too narrow a beam widens.
OPEN = 16
WIDEN = 5
#: So many nodes asked for in a step are broadcast.
FEW_ASKED = 1 << 16
PROBES = 200
RECALL = 0.93


def usable(table: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, as arrays of doubles."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(F.col(f"`{id}`").cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def _matrix(cells, dtype=np.float32) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=dtype).reshape(len(cells), -1)


def _groups(batches, key="g"):
    """Runs of rows of one group, as (group, dict of columns), from rows sorted by group."""
    held, group = [], None
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [len(g)]])
        for a, e in zip(cut[:-1], cut[1:], strict=True):
            if group is not None and g[a] != group:
                yield group, pa.Table.from_batches(held)
                held = []
            group = g[a]
            held.append(b.slice(a, e - a))
    if held:
        yield group, pa.Table.from_batches(held)


def _sent(to: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """A row for each bucket that is sent anything: the bucket, and its part of each column as bytes."""
    order = np.argsort(to, kind="stable")
    to = to[order]
    first = np.flatnonzero(np.diff(to, prepend=-1))
    cut = list(zip(first, np.append(first[1:], len(to)), strict=True))
    return [pa.array(to[first], pa.int64()),
            *(pa.array([c[a:e].tobytes() for a, e in cut], pa.binary()) for c in (c[order] for c in columns))]


def _column(table: pa.Table, name: str, dtype) -> np.ndarray:
    """What the rows of a binary column hold, one after the other."""
    cells = [np.frombuffer(c, dtype) for c in (cell.as_buffer() for cell in table.column(name)) if c.size]
    return cells[0] if len(cells) == 1 else np.concatenate([np.zeros(0, dtype), *cells])


def _meet(left: DataFrame, right: DataFrame, buckets: int, work, schema: str) -> DataFrame:
    """``work`` on the rows of either side, bucket by bucket."""
    left, right = (side.repartition(buckets, "g").groupBy("g") for side in (left, right))
    return left.cogroup(right).applyInArrow(work, schema)


def _ranks(at: np.ndarray, s: np.ndarray):
    """(order, rank): by place, nearest first, and the rank at the place."""
    i = s.view(np.int32).astype(np.int64)
    i = np.where(i < 0, i ^ 0x7FFFFFFF, i)  # ordered as the floats are
    order = np.argsort((at.astype(np.int64) << 32) + (0x7FFFFFFF - i))
    first = np.diff(at[order], prepend=-1) != 0
    here = np.arange(len(at))
    return order, here - np.maximum.accumulate(np.where(first, here, 0))


def _once(at: np.ndarray, b: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where to find each pair (place, node) once, sorted; of equal ones one that is not ``last``, if there is any."""
    key = (at.astype(np.int64) << 41) | (b << 1) | last
    order = np.argsort(key)
    return order[np.diff(key[order] >> 1, prepend=-1) != 0]


def _best(x: np.ndarray, ids: np.ndarray, k: int):
    """Edges to the k nearest others within a block."""
    k = min(k, len(ids) - 1)
    if k <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    top, s = np.zeros((len(ids), k), np.int64), np.zeros((len(ids), k), np.float32)
    for a in range(0, len(ids), STRIP):
        sims = x[a:a + STRIP] @ x.T
        here = np.arange(len(sims))
        sims[here, a + here] = -np.inf
        best = np.argpartition(sims, len(ids) - k, axis=1)[:, len(ids) - k:]
        top[a:a + STRIP], s[a:a + STRIP] = ids[best], np.take_along_axis(sims, best, 1)
    return np.repeat(ids, k), top.ravel(), s.ravel()


def _top(edges: DataFrame, k: int, key="u", other="v") -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc("s"), other)
    return edges.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)


FOUND = "g long, at binary, b binary, s binary"
GRAPH = "g long, x binary, v binary, s binary, new binary, edges long, fresh long"


def _found(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> list[pa.Array]:
    """Edges, sent to the bucket of the node that they leave."""
    return _sent(u >> PLACE, (u & LAST).astype(np.int32), v, s)


def first_graph(nodes: DataFrame, n: int, k: int) -> DataFrame:
    """Edges from random cuts: sign bits choose a cell, its order along a line the blocks."""
    bits = max(0, int(np.ceil(np.log2(max(1, n / CELL)))) - 2) if n > CELL else 0

    def place(batches):
        for b in batches:
            x = _matrix(b.column(1).to_pylist()) if b.num_rows else np.zeros((0, 1), np.float32)
            parts = []
            for cut in range(CUTS if bits or n > CELL else 1):
                lines = np.random.default_rng(1000 + cut).standard_normal((x.shape[1], bits + 1)).astype(np.float32)
                y = x @ lines
                cell = (y[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                parts.append(pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int64) * CUTS + cut), pa.array(y[:, bits].astype(np.float64)),
                     b.column(0), b.column(1)], names=["g", "y", "node", "x"]))
            yield from parts

    def compare(batches):
        for _, rows in _groups(batches):
            m = rows.num_rows
            size = m if m <= CELL else int(np.ceil(m / np.ceil(m / CELL)))
            for a in range(0, m, size):
                part = rows.slice(a, size)
                ids = part.column("node").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    _found(*_best(_matrix(part.column("x").to_pylist()), ids, k)), names=["g", "at", "b", "s"])

    placed = nodes.select("node", "x").mapInArrow(place, "g long, y double, node long, x binary")
    # A cell may be large, a task's part of it is not: cells are dealt in slices along y.
    return placed.repartitionByRange("g", "y").sortWithinPartitions("g", "y").mapInArrow(compare, FOUND)


def _merged(found: DataFrame, graph: DataFrame, buckets: int, k: int) -> DataFrame:
    """The graph of the k nearest of what each node holds and what was found; the latter are new."""
    def merge(found, held):
        at, b, s = (_column(found, c, t) for c, t in (("at", np.int32), ("b", np.int64), ("s", np.float32)))
        v, sv = _column(held, "v", np.int64).reshape(-1, k), _column(held, "s", np.float32).reshape(-1, k)
        old = v >= 0
        at = np.concatenate([np.nonzero(old)[0].astype(np.int32), at])
        b, s = np.concatenate([v[old], b]), np.concatenate([sv[old], s])
        late = np.arange(len(at)) >= np.count_nonzero(old)
        keep = _once(at, b, late)
        at, b, s, late = at[keep], b[keep], s[keep], late[keep]
        order, rank = _ranks(at, s)
        order, rank = order[rank < k], rank[rank < k]
        v, sv, new = np.full_like(v, -1), np.full_like(sv, -np.inf), np.zeros(v.shape, bool)
        for to, of in ((v, b), (sv, s), (new, late)):
            to[at[order], rank] = of[order]
        return pa.table([held.column("g"), held.column("x"), *(pa.array([c.tobytes()], pa.binary()) for c in (v, sv, new)),
                         pa.array([len(order)]), pa.array([int(new.sum())])],
                        names=["g", "x", "v", "s", "new", "edges", "fresh"])

    return _meet(found, graph.select("g", "x", "v", "s"), buckets, merge, GRAPH)


def _both(graph: DataFrame, buckets: int, k: int, most: int, all: bool) -> DataFrame:
    """(g, at, b, new): the k neighbours of the nodes, and the best ``most`` that lead to each node;
    unless ``all``, of nodes with new ones only."""
    def turn(batches):
        for batch in batches:
            for g, v, s, new in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v = np.frombuffer(v, np.int64).reshape(-1, k)
                held = v >= 0
                u = (g << PLACE) + np.nonzero(held)[0]
                s, new = (np.frombuffer(c, t).reshape(-1, k)[held] for c, t in ((s, np.float32), (new, bool)))
                yield pa.RecordBatch.from_arrays(
                    _sent(v[held] >> PLACE, (v[held] & LAST).astype(np.int32), u, s, new), names=["g", "at", "b", "s", "new"])

    def join(back, held):
        at, b, s, new = (_column(back, c, t) for c, t in (
            ("at", np.int32), ("b", np.int64), ("s", np.float32), ("new", bool)))
        order, rank = _ranks(at, s)
        order = order[rank < most]
        v, late = _column(held, "v", np.int64).reshape(-1, k), _column(held, "new", bool).reshape(-1, k)
        old = v >= 0
        at = np.concatenate([np.nonzero(old)[0].astype(np.int32), at[order]])
        b, new = np.concatenate([v[old], b[order]]), np.concatenate([late[old], new[order]])
        keep = _once(at, b, ~new)
        at, b, new = at[keep], b[keep], new[keep]
        if not all:
            some = np.zeros(len(v), bool)
            some[at[new]] = True
            at, b, new = at[some[at]], b[some[at]], new[some[at]]
        return pa.table([held.column("g"), *(pa.array([c.tobytes()], pa.binary()) for c in (at, b, new))],
                        names=["g", "at", "b", "new"])

    turned = graph.select("g", "v", "s", "new").mapInArrow(turn, FOUND + ", new binary")
    return _meet(turned, graph.select("g", "v", "new"), buckets, join, "g long, at binary, b binary, new binary")


def _compared(at: np.ndarray, p: np.ndarray, new: np.ndarray, x: np.ndarray, worst: np.ndarray):
    """(a, b, s): of the nodes ``p`` that meet at a place, what is nearer to one of them than its worst, where
    one of the two is new."""
    order = np.lexsort((~new, at))  # new ones first
    at, p = at[order], p[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    size = np.diff(np.append(first, len(at)))
    fresh = np.add.reduceat(new[order].astype(np.int64), first) if len(first) else size
    places = np.lexsort((size, fresh))  # places of one batch are alike
    places = places[(fresh[places] > 0) & (size[places] > 1)]
    out = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]]
    for off in range(0, len(places), TOGETHER):
        here = places[off:off + TOGETHER]
        wide, r = size[here].max(), fresh[here].max()
        col = np.arange(wide)
        ids = p[np.minimum(first[here, None] + col, len(p) - 1)]
        real, late = col < size[here, None], col < fresh[here, None]
        y = x[ids]
        sims = np.matmul(y[:, :r], y.transpose(0, 2, 1))
        sims[:, np.arange(r), np.arange(r)] = -np.inf
        pair = late[:, :r, None] & real[:, None, :]
        g, i, j = np.nonzero((sims > worst[ids[:, :r]][:, :, None]) & pair)
        out.append((ids[g, i], ids[g, j], sims[g, i, j]))
        # The other way round where the other is not new; if it is, it has its own row.
        g, i, j = np.nonzero((sims > worst[ids][:, None, :]) & pair & ~late[:, None, :])
        out.append((ids[g, j], ids[g, i], sims[g, i, j]))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _round(both: DataFrame, graph: DataFrame, buckets: int, k: int) -> DataFrame:
    """Neighbours of each node, both ways, compared with one another if one of them is new.

    A bucket asks the others for the nodes that its nodes know, each once, compares those that meet,
    and sends what it finds to the buckets of the nodes that it is better for."""
    def ask(batches):
        for batch in batches:
            for g, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.unique(np.frombuffer(b, np.int64))
                to, at = _sent(ids >> PLACE, (ids & LAST).astype(np.int32))
                yield pa.RecordBatch.from_arrays([to, pa.array(np.full(len(to), g)), at], names=["g", "by", "at"])

    def answer(asked, held):
        worst = _column(held, "s", np.float32).reshape(-1, k)[:, -1]
        x, g = _column(held, "x", np.float32).reshape(len(worst), -1), held.column("g")[0].as_py() << PLACE
        step = max(1, CELLS // x.shape[1])
        wanted = [(by, at[a:a + step]) for by, at in zip(
            asked.column("by").to_pylist(), (np.frombuffer(c, np.int32) for c in asked.column("at").to_pylist()), strict=True)
            for a in range(0, len(at), step)]
        return pa.table([pa.array([by for by, _ in wanted], pa.int64()), *(pa.array([c.tobytes() for c in column], pa.binary())
                         for column in ([g + at.astype(np.int64) for _, at in wanted], (x[at] for _, at in wanted),
                                        (worst[at] for _, at in wanted)))], names=["g", "b", "x", "worst"])

    def compare(known, both):
        ids, worst = _column(known, "b", np.int64), _column(known, "worst", np.float32)
        if not len(ids):
            return pa.table(_found(ids, ids, worst), names=["g", "at", "b", "s"])
        x = _column(known, "x", np.float32).reshape(len(ids), -1)
        order = np.argsort(ids)
        p = order[np.searchsorted(ids, _column(both, "b", np.int64), sorter=order)]
        a, b, s = _compared(_column(both, "at", np.int32), p, _column(both, "new", bool), x, worst)
        return pa.table(_found(ids[a], ids[b], s), names=["g", "at", "b", "s"])

    asked = both.select("g", "b").mapInArrow(ask, "g long, by long, at binary")
    known = _meet(asked, graph.select("g", "x", "s"), buckets, answer, "g long, b binary, x binary, worst binary")
    return _merged(_meet(known, both, buckets, compare, FOUND), graph, buckets, k)


def build(nodes: DataFrame, n: int, k: int, buckets: int, scratch: Scratch) -> DataFrame:
    """GRAPH: a row for each bucket of nodes, with the vectors of its nodes and their k neighbours."""
    def gather(rows):
        rows = rows.sort_by("node")
        v = np.full((rows.num_rows, k), -1)
        return pa.table([pa.array([rows.column("node")[0].as_py() >> PLACE]), *(pa.array([c], pa.binary()) for c in (
            b"".join(rows.column("x").to_pylist()), v.tobytes(), np.full(v.shape, -np.inf, np.float32).tobytes()))],
            names=["g", "x", "v", "s"])

    empty = nodes.select(F.shiftright("node", PLACE).alias("g"), "node", "x").repartition(buckets, "g").groupBy(
        "g").applyInArrow(gather, "g long, x binary, v binary, s binary")

    def written(graph):
        counts = Observation()
        graph = scratch.write(graph.observe(counts, F.sum("fresh").alias("fresh"), F.sum("edges").alias("edges")))
        return graph, (counts.get["fresh"] or 0) / (counts.get["edges"] or 1)

    graph, changed = written(_merged(first_graph(nodes, n, k), empty, buckets, k))
    while n > BLOCK and changed > CHANGED:
        both = scratch.write(_both(graph, buckets, k, k, False))
        new, changed = written(_round(both, graph, buckets, k))
        scratch.drop(graph, both)
        graph = new
    return graph


def linked(graph: DataFrame, buckets: int, k: int) -> DataFrame:
    """(node, vs): the neighbours of each node, and the best 2 k that lead to it."""
    def rows(batches):
        for batch in batches:
            for g, at, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, b = np.frombuffer(at, np.int32), np.frombuffer(b, np.int64)
                first = np.flatnonzero(np.diff(at, prepend=-1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((g << PLACE) + at[first].astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(b))],
                    names=["node", "vs"])

    return _both(graph, buckets, k, 2 * k, True).select("g", "at", "b").mapInArrow(rows, "node long, vs array<long>")


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _dealt(nodes: DataFrame, buckets: int) -> DataFrame:
    """(g, node, x): the nodes of each bucket, in order, as bytes in one row."""
    def deal(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_bucket(b.column(0).to_numpy(), buckets)), b.column(0), b.column(1)],
                                             names=["g", "node", "x"])

    def pack(rows):
        rows = rows.sort_by("node")
        cells = [rows.column("node").to_numpy().tobytes(), b"".join(rows.column("x").to_pylist())]
        return pa.table([rows.column("g")[:1], *(pa.array([c], pa.binary()) for c in cells)], names=["g", "node", "x"])

    return nodes.select("node", "x").mapInArrow(deal, "g long, node long, x binary").groupBy("g").applyInArrow(
        pack, "g long, node binary, x binary")


def _scored(pairs: DataFrame, places: DataFrame, buckets: int) -> DataFrame:
    """(q, node, s): what is nearer to a query than its ``worst``, from (q, qx, worst, vs).

    The candidates go to the nodes, those that some queries have in one bucket in a row, not the nodes to the queries."""
    def deal(batches):
        for b in batches:
            for off in range(0, b.num_rows, 256):
                part = b.slice(off, 256)
                q, worst = part.column(0).to_numpy(), part.column(2).to_numpy()
                qx, ids = _matrix(part.column(1).to_pylist()), part.column(3).flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), part.column(3).value_lengths().to_numpy())
                g = _bucket(ids, buckets)
                order = np.lexsort((row, g))
                ids, row, g = ids[order], row[order], g[order]
                first = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(g, prepend=-1))
                at, many = row[first], np.diff(np.append(first, len(ids))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*_sent(g[first], q[at], qx[at], worst[at], many), _sent(g, ids)[1]],
                                                 names=["g", "q", "qx", "worst", "many", "vs"])

    def compare(asked, held):
        out = []
        if asked.num_rows:
            node, q = _column(held, "node", np.int64), _column(asked, "q", np.int64)
            x, qx = (_column(t, c, np.float32).reshape(m, -1) for t, c, m in ((held, "x", len(node)), (asked, "qx", len(q))))
            worst = _column(asked, "worst", np.float32)
            at = np.searchsorted(node, _column(asked, "vs", np.int64))
            row = np.repeat(np.arange(len(q)), _column(asked, "many", np.int32))
            for off in range(0, len(at), 1 << 15):
                i, r = at[off:off + (1 << 15)], row[off:off + (1 << 15)]
                sims = np.einsum("ij,ij->i", x[i], qx[r])
                near = sims > worst[r]
                out.append((q[r[near]], node[i[near]], sims[near]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float32()), strict=True)],
                        names=["q", "node", "s"])

    dealt = pairs.select("q", "qx", "worst", "vs").mapInArrow(
        deal, "g long, q binary, qx binary, worst binary, many binary, vs binary")
    return dealt.groupBy("g").cogroup(places.groupBy("g")).applyInArrow(compare, "q long, node long, s float")


def _held(seen: DataFrame, beam: int, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """Of (q, node, s, opened) the best of each query, half more than the beam, so that it may widen;
    which of them to open next (``ask``), if its query opens any (``moves``), and how many those are and the unopened
    ones. ``_waits``: rows of queries that do not move, and their unopened ones."""
    most = beam + beam // 2
    w = Window.partitionBy("q")
    r = w.orderBy(F.desc("s"), "node")
    rows = seen.withColumn("r", F.row_number().over(r)).filter(F.col("r") <= most)
    free = ~F.col("opened") & (F.col("r") <= beam)
    # A query that holds its beam takes no worse nodes in, also where a wider beam would have room:
    # else all that it has once dropped would come back.
    rows = rows.withColumn("worst", F.when(F.count("*").over(w) >= beam, F.min("s").over(w)).otherwise(
        F.lit(float("-inf"))).cast("float"))
    rows = rows.withColumn("ask", free & (F.sum(free.cast("int")).over(r) <= OPEN))
    rows = rows.withColumn("moves", F.max("ask").over(w))
    counts = Observation()
    rows = scratch.write(rows.select("q", "node", "s", "opened", "ask", "worst", "moves").observe(
        counts, F.count_if("ask").alias("asked"), F.count_if(~F.col("opened")).alias("unopened"),
        F.count_if(~F.col("moves")).alias("rest"), F.count_if(~F.col("moves") & ~F.col("opened")).alias("waiting")))
    rows._waits = counts.get["rest"], counts.get["waiting"]
    return rows, counts.get["asked"], counts.get["unopened"]


def opened(seen: DataFrame, walkers: DataFrame, links: DataFrame, places: DataFrame, buckets: int,
           few: bool = False) -> DataFrame:
    """(q, node, s, opened): the nodes that were asked for are opened, their neighbours come in that
    the query does not hold yet. ``few``: so few are asked for that they go to the links."""
    asked = seen.filter("ask").select("q", "node", "worst")
    asked = (F.broadcast(asked) if few else asked).join(links, "node").groupBy("q").agg(
        F.max("worst").alias("worst"), F.flatten(F.collect_list("vs")).alias("vs"))
    held = seen.groupBy("q").agg(F.collect_list("node").alias("held"))
    asked = asked.join(held, "q").withColumn("vs", F.array_except("vs", "held")).filter(F.size("vs") > 0)
    new = _scored(asked.join(walkers, "q"), places, buckets)
    return seen.select("q", "node", "s", (F.col("opened") | F.col("ask")).alias("opened")).unionAll(
        new.withColumn("opened", F.lit(False)))


def start(walkers: DataFrame) -> DataFrame:
    """(q, node, s, opened, ask, worst): each query's own node, which always stays, to be opened."""
    return walkers.select("q", F.col("q").alias("node"), F.lit(float("inf")).cast("float").alias("s"),
                          F.lit(False).alias("opened"), F.lit(True).alias("ask"),
                          F.lit(float("-inf")).cast("float").alias("worst"))


def nearest(probes: list, nodes: DataFrame, k: int) -> DataFrame:
    """(q, node): the true k nearest other nodes of a few queries, by one pass over all nodes."""
    ids, x = np.array([p.q for p in probes], np.int64), _matrix([p.qx for p in probes])

    def compare(batches):
        held, scores = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0), np.float32)
        for b in batches:
            if not b.num_rows:
                continue
            other = b.column(0).to_numpy()
            sims = x @ _matrix(b.column(1).to_pylist()).T
            sims[ids[:, None] == other] = -np.inf
            scores = np.hstack([scores, sims])
            held = np.hstack([held, np.broadcast_to(other, sims.shape)])
            if scores.shape[1] > k:
                top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                scores, held = np.take_along_axis(scores, top, 1), np.take_along_axis(held, top, 1)
        a, b = np.nonzero(scores > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(held[a, b], pa.int64()), pa.array(scores[a, b])],
                                         names=["u", "v", "s"])

    found = nodes.select("node", "x").mapInArrow(compare, "u long, v long, s float")
    return _top(found, k).select(F.col("u").alias("q"), F.col("v").alias("node"))


def walk(walkers: DataFrame, links: DataFrame, nodes: DataFrame, n: int, k: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """The nodes held when none of a query's ``beam`` best is unopened, and the beam: it widens until
    the probes find the share RECALL of their true neighbours, or nothing held is unopened."""
    beam, buckets = max(BEAM, 2 * k), int(np.ceil(n / BUCKET))
    probes = walkers.orderBy(F.xxhash64("q"), "q").limit(PROBES).collect()
    if not probes:
        return start(walkers), beam
    true = {(t.q, t.node) for t in nearest(probes, nodes, k).collect()}
    few = F.broadcast(walkers.sparkSession.createDataFrame([(p.q,) for p in probes], "q long"))
    places, queries, enough = scratch.write(_dealt(nodes, buckets)), walkers.count(), False
    seen, asked, unopened = _held(opened(start(walkers), walkers, links, places, buckets, queries <= FEW_ASKED), beam, scratch)
    # Queries that do not move wait in the tables where they came to rest until the beam widens.
    waits, waiting = [], 0
    while True:
        every, widens = seen, False
        for table in waits:
            every = every.unionAll(table.filter(~F.col("moves")))
        if not enough and asked <= queries:
            # What is still asked for could only raise the share: it may widen a beam, never narrow it.
            found = _top(every.join(few, "q").filter(F.col("q") != F.col("node")), k, "q", "node")
            enough = sum((f.q, f.node) in true for f in found.select("q", "node").collect()) >= RECALL * len(true)
            widens = not enough and unopened + waiting > 0
            if widens:
                beam += beam // WIDEN
        if not asked and (enough or not unopened + waiting):
            scratch.drop(places)
            return every, beam
        old, gone = seen, []
        if widens:
            gone, waits, waiting = [old, *waits], [], 0
        elif old._waits[0]:
            waits, waiting = [*waits, old], waiting + old._waits[1]
        else:
            gone = [old]
        seen, asked, unopened = _held(opened(
            every if widens else old.filter("moves"), walkers, links, places, buckets, asked <= FEW_ASKED), beam, scratch)
        scratch.drop(*gone)


def search(table: DataFrame, queries: Column, id: str = "vec_id", vector: str = "embedding",
           k: int = 20, neighbours: int = NEIGHBOURS) -> DataFrame:
    """For each row that ``queries`` (a condition on ``id``) marks, its k nearest other rows."""
    scratch = Scratch(table.sparkSession, "nn")
    rows = usable(table, id, vector)
    order = Window.partitionBy("v").orderBy("id")
    ranked = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    ranked = scratch.write(ranked)
    nodes = ranked.groupBy("v").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids"))

    of = nodes.agg(F.max(F.array_max(F.transform("v", F.abs))).alias("largest"), F.max(F.size("v")).alias("d"),
                   F.count("*").alias("n")).first()
    largest, n = of["largest"] or 1.0, of["n"]
    home = max(1, min(HOME, NUMBERS // (of["d"] or 1), max(BLOCK, n // FEW)))
    buckets = int(np.ceil(n / home)) or 1

    def single(batches):
        for b in batches:
            cells = [(np.array(x) / largest).astype(np.float32).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(_bucket(b.column(0).to_numpy(), buckets)), *b.columns,
                                              pa.array(cells, pa.binary())], names=["g", "node", "v", "ids", "x"])

    def number(batches):
        g, at = -1, 0
        for b in batches:
            to, number = b.column(0).to_numpy(), np.zeros(b.num_rows, np.int64)
            for i, bucket in enumerate(to.tolist()):
                g, at = bucket, at + 1 if bucket == g else 0
                number[i] = (g << PLACE) + at
            yield pa.RecordBatch.from_arrays([pa.array(number), *b.columns[2:]], names=["node", "v", "ids", "x"])

    nodes = nodes.select("node", "v", "ids").mapInArrow(
        single, "g long, node long, v array<double>, ids array<long>, x binary")
    nodes = scratch.write(nodes.repartition(buckets, "g").sortWithinPartitions("g", "node").mapInArrow(
        number, "node long, v array<double>, ids array<long>, x binary"))
    graph = build(nodes, n, neighbours, buckets, scratch)

    asked = rows.withColumnRenamed("id", id).filter(queries).select(F.col(id).alias("q"), "v").distinct()
    asked = scratch.write(asked.join(nodes.select("v", "node"), "v").select("q", "node").distinct())
    # All rows of one vector ask the same: the walk is made once per node.
    walkers = scratch.write(asked.select("node").distinct().join(nodes, "node").select(
        F.col("node").alias("q"), F.col("x").alias("qx")))
    links = scratch.write(linked(graph, buckets, neighbours))
    scratch.drop(graph)
    if n > BLOCK:
        seen, beam = walk(walkers, links, nodes, n, k, scratch)
    else:
        beam = max(BEAM, 2 * k)
        seen = opened(start(walkers), walkers, links, _dealt(nodes, 1), 1)
    exact = nodes.select("node", "v")
    dot = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    best = _top(seen, beam, "q", "node").select(F.col("q").alias("from"), "node").join(exact, "node").join(
        exact.select(F.col("node").alias("from"), F.col("v").alias("qv")), "from").select("from", "node", dot.alias("s"))
    members = ranked.select(F.col("id").alias("vec_id"), "v").join(nodes.select("v", "node"), "v").select("node", "vec_id")
    near = asked.select(F.col("q").alias("query_id"), F.col("node").alias("from")).join(best, "from").join(
        members, "node").filter(F.col("vec_id") != F.col("query_id"))
    w = Window.partitionBy("query_id", "from").orderBy(F.desc("s"), "vec_id")
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.col("s").alias("score"))
