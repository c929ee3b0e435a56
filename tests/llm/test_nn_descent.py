"""Neighbour search: recall and exact scores against brute force, ties, odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from ampere.llm import nn_descent


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        at = ids.index(q)
        order = sorted((-float(np.dot(x[at], y)), i) for i, y in zip(ids, x, strict=True) if i != q)
        out[q] = [i for _, i in order[:k]]
    return out


def check(spark, ids, x, k=20, least=0.9, every=20):
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in zip(ids, x, strict=True)],
                               "vec_id long, embedding array<float>")
    rows = nn_descent.search(df, F.col("vec_id") % every == 0, k=k).collect()
    x = np.asarray(x, np.float32).astype(float)
    want = brute(ids, x, [i for i in ids if i % every == 0], k)
    got = {}
    for r in rows:
        got.setdefault(r.query_id, {})[r["rank"]] = r
        assert abs(r.score - float(np.dot(x[ids.index(r.query_id)], x[ids.index(r.vec_id)]))) < 1e-12
    hits = 0
    for q, best in want.items():
        mine = [got[q][i + 1] for i in range(len(got[q]))]
        assert len(mine) == len(best) and all(m.vec_id != q for m in mine)
        assert [(-m.score, m.vec_id) for m in mine] == sorted((-m.score, m.vec_id) for m in mine)
        hits += len({m.vec_id for m in mine} & set(best))
    assert hits >= least * sum(map(len, want.values()))


def test_recall_on_clusters_with_a_common_vector(spark):
    r = np.random.default_rng(1)
    centres = r.standard_normal((10, 32))
    x = centres[r.integers(0, 10, 1500)] + 0.7 * r.standard_normal((1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:700] = x[3]
    x = np.round(x, 6)
    check(spark, list(range(1500)), x)


def test_recall_on_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    check(spark, [r.vec_id for r in rows], [r.embedding for r in rows])


def test_recall_does_not_fall_where_a_fixed_budget_is_too_small(spark):
    x = np.random.default_rng(2).standard_normal((10_000, 192))
    check(spark, list(range(10_000)), x / np.linalg.norm(x, axis=1, keepdims=True), every=100)


def test_recall_does_not_depend_on_the_unit(spark):
    x = np.random.default_rng(3).standard_normal((1500, 32))
    check(spark, list(range(1500)), 1e-9 * x / np.linalg.norm(x, axis=1, keepdims=True), every=50)


def test_small_and_odd_vectors(spark):
    check(spark, [0, 20, 1, 2, 3], [[1, 0], [1, 0], [0.5, 1], [0, 1], [1, 0]], k=20, least=1.0)
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]),
         (None, [1.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0]), (120, [])], "vec_id long, embedding array<float>")
    rows = nn_descent.search(df, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.vec_id, r.score) for r in rows] == [(0, 1, 5.0)]
    assert nn_descent.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_a_walk_takes_few_jobs(spark, monkeypatch):
    writes, write = [], nn_descent.Scratch.write
    monkeypatch.setattr(nn_descent.Scratch, "write", lambda self, df: writes.append(self.root) or write(self, df))
    x = np.random.default_rng(4).standard_normal((6000, 64))
    check(spark, list(range(6000)), x / np.linalg.norm(x, axis=1, keepdims=True))
    assert len(writes) <= 40


def test_candidates_meet_their_bucket_and_come_back_if_near_enough(spark):
    x = np.random.default_rng(5).standard_normal((300, 8)).astype(np.float32)
    ids = [7 * i - 1000 for i in range(300)]
    nodes = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in zip(ids, x, strict=True)], "node long, x binary")
    pairs = [(5, bytearray(x[0].tobytes()), 0.5, ids[3:200]), (6, bytearray(x[1].tobytes()), -1e9, ids[:2]),
             (8, bytearray(x[2].tobytes()), 1e9, ids)]
    asked = spark.createDataFrame(pairs, "q long, qx binary, worst float, vs array<long>")
    got = {(r.q, r.node): r.s for r in nn_descent._scored(asked, nn_descent._dealt(nodes, 7), 7).collect()}
    want = {(5, ids[i]): float(x[0] @ x[i]) for i in range(3, 200) if x[0] @ x[i] > 0.5}
    want |= {(6, ids[i]): float(x[1] @ x[i]) for i in range(2)}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-4 for p in want)


def test_what_a_query_holds_is_not_asked_again(spark):
    x = np.random.default_rng(6).standard_normal((40, 8)).astype(np.float32)
    cells = [bytearray(v.tobytes()) for v in x]
    nodes = spark.createDataFrame(list(enumerate(cells)), "node long, x binary")
    walkers = spark.createDataFrame([(0, cells[0]), (1, cells[1])], "q long, qx binary")
    links = spark.createDataFrame([(i, [(i + j) % 40 for j in range(1, 9)]) for i in range(40)], "node long, vs array<long>")
    low = float("-inf")
    seen = spark.createDataFrame(
        [(0, 0, float("inf"), True, False, low), (0, 5, 0.5, False, True, low), (0, 6, 0.4, False, True, low),
         (0, 7, 0.3, True, False, low), (1, 1, float("inf"), True, False, low)],
        "q long, node long, s float, opened boolean, ask boolean, worst float")
    rows = nn_descent.opened(seen, walkers, links, nn_descent._dealt(nodes, 3), 3).collect()
    assert sorted((r.q, r.node) for r in rows) == [(0, 0), *((0, i) for i in range(5, 15)), (1, 1)]
    assert {r.node for r in rows if r.q == 0 and r.opened} == {0, 5, 6, 7}


def test_a_query_that_holds_its_beam_takes_no_worse_nodes_when_it_widens(spark):
    seen = spark.createDataFrame(
        [(q, i, 1.0 - i / 100, True) for q, m in ((0, 12), (1, 9), (2, 30)) for i in range(m)],
        "q long, node long, s float, opened boolean")
    rows, asked, unopened = nn_descent._held(seen, 10, nn_descent.Scratch(spark, "held"))
    worst = {r.q: (r.worst, r.n) for r in rows.groupBy("q").agg(F.max("worst").alias("worst"), F.count("*").alias("n")).collect()}
    assert worst == {0: (np.float32(0.89), 12), 1: (float("-inf"), 9), 2: (np.float32(0.86), 15)}
    assert (asked, unopened) == (0, 0)


def test_the_graph_moves_as_rows_of_buckets_not_of_edges(spark, monkeypatch):
    rows, write = [], nn_descent.Scratch.write

    def counted(self, df):
        table = write(self, df)
        rows.append(table.count())
        return table

    monkeypatch.setattr(nn_descent.Scratch, "write", counted)
    x = np.random.default_rng(7).standard_normal((3000, 16))
    check(spark, list(range(3000)), x, every=100)
    assert max(rows) <= 2 * 3000


def test_neighbours_of_a_node_meet_where_one_is_new():
    r = np.random.default_rng(8)
    x, worst = r.standard_normal((60, 5)).astype(np.float32), r.standard_normal(60).astype(np.float32)
    size = r.integers(1, 30, 90)
    at = np.repeat(np.arange(90), size)
    p = np.concatenate([r.permutation(60)[:m] for m in size])
    new = (r.random(len(p)) < 0.3) & (at % 4 > 0)
    shuffled = r.permutation(len(p))
    got = [*zip(*(c.tolist() for c in nn_descent._compared(at[shuffled], p[shuffled], new[shuffled], x, worst)), strict=True)]
    want = {}
    for g in range(90):
        here = np.flatnonzero(at == g)
        for i in here:
            for j in here:
                s = float(x[p[i]] @ x[p[j]])
                if i != j and (new[i] or new[j]) and s > worst[p[i]]:
                    want.setdefault((p[i], p[j]), []).append(s)
    assert len(got) == sum(map(len, want.values())) and {(a, b) for a, b, _ in got} == want.keys()
    assert all(abs(s - want[a, b][0]) < 1e-4 for a, b, s in got)


def test_the_nearest_are_kept_each_once_and_what_was_held_is_not_new(spark):
    def row(g, **columns):
        return (g, *(bytearray(np.asarray(c, t).tobytes()) for c, t in columns.values()))

    f, i, low = np.float32, np.int64, -np.inf
    graph = spark.createDataFrame(
        [row(0, x=([], f), v=([[9, 8], [7, -1]], i), s=([[-0.5, -2], [0.1, low]], f)),
         row(1, x=([], f), v=([[-1, -1]], i), s=([[low, low]], f))], "g long, x binary, v binary, s binary")
    found = spark.createDataFrame(
        [row(0, at=([0, 0, 1], np.int32), b=([9, 5, 7], i), s=([-0.5, -1, 0.1], f)),
         row(0, at=([1, 1], np.int32), b=([3, 3], i), s=([0.0, 0.0], f))], nn_descent.FOUND)
    got = {r.g: r for r in nn_descent._merged(found, graph, 2, 2).collect()}
    assert np.frombuffer(got[0].v, i).tolist() == [9, 5, 7, 3]
    assert np.frombuffer(got[0].s, f).tolist() == [-0.5, -1, f(0.1), 0]
    assert np.frombuffer(got[0].new, bool).tolist() == [False, True, False, True]
    assert (got[0].edges, got[0].fresh) == (4, 2)
    assert np.frombuffer(got[1].v, i).tolist() == [-1, -1] and (got[1].edges, got[1].fresh) == (0, 0)


def test_a_query_with_nothing_to_open_waits(spark):
    seen = spark.createDataFrame(
        [(q, i, 1.0 - i / 100, q == 0 or i > 3) for q, m in ((0, 9), (1, 9)) for i in range(m)] + [(2, 0, 1.0, True)]
        + [(3, i, 1.0 - i / 100, i < 6) for i in range(8)], "q long, node long, s float, opened boolean")
    rows, asked, unopened = nn_descent._held(seen, 6, nn_descent.Scratch(spark, "waits"))
    assert {(r.q, r.moves) for r in rows.collect()} == {(0, False), (1, True), (2, False), (3, False)}
    assert (asked, unopened, rows._waits) == (4, 6, (9 + 1 + 8, 2))
