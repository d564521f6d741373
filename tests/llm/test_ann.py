import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, score int, rank string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(None if i is None else int(i), v if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in zip(ids, vectors)], SCHEMA).repartition(3)


def brute(ids, x, queries, k=20):
    out = {}
    for q in queries:
        s = x @ x[list(ids).index(q)]
        rows = sorted(((-s[j], i) for j, i in enumerate(ids) if i != q))[:k]
        out[q] = [(i, -d) for d, i in rows]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_over_several_shards(spark, scaled, monkeypatch):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(1500, 24)) + 2 * rng.normal(size=(10, 24))[rng.integers(0, 10, 1500)]).astype(np.float32).astype(float)
    x *= rng.uniform(0.2, 3, (1500, 1)) if scaled else 1
    x = x.astype(np.float32).astype(float)
    monkeypatch.setattr(ann, "SHARD", 300)
    df = frame(spark, x)
    graphs, kept, _ = ann.index(df, 300)
    assert graphs.count() == 5 and kept.count() == 1500
    got = results(ann.nearest(df, F.col("vec_id") % 20 == 0))
    want = brute(range(1500), x, range(0, 1500, 20))
    assert recall(got, want) > 0.95
    assert all(abs(s - x[q] @ x[i]) < 1e-9 for q in got for i, s in got[q])


def test_copies_ties_and_fewer_candidates(spark):
    x = [[1, 0]] * 70 + [[0, 1]] * 3 + [[0.5, 0.5]]
    got = results(ann.nearest(frame(spark, x), F.col("vec_id") % 20 == 0))
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[20]] == list(range(20))
    few = results(ann.nearest(frame(spark, [[1, 2], [2, 1], [3, 3]]), F.col("vec_id") == 0))
    assert few == {0: [(2, 9.0), (1, 4.0)]}


def test_vectors_that_take_no_part(spark):
    x = [[1, 2], None, [0, 0], [None, 1], [float("nan"), 1], [float("inf"), 1], [], [1, 2, 3], [2, 2], [5, 5], [4, 4], [1, 1]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, None, 20, 20]
    got = results(ann.nearest(frame(spark, x, ids), F.col("vec_id") % 20 == 0))
    assert got == {0: [(8, 6.0), (20, 3.0)], 20: [(8, 4.0), (0, 3.0)]}  # of a repeated id the smaller vector counts
    assert ann.nearest(frame(spark, x[:1]).limit(0), F.lit(True)).collect() == []
    assert ann.nearest(frame(spark, x[1:3]), F.lit(True)).collect() == []
    assert ann.nearest(frame(spark, x[:1]), F.lit(True)).collect() == []


def test_lengths_are_searched_apart(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 100)
    rng = np.random.default_rng(4)
    x = [rng.normal(size=8 if k % 3 else 5).astype(np.float32).tolist() for k in range(600)]
    x[40] = [1.0]
    df = frame(spark, x)
    _, kept, plan = ann.index(df, 100)
    assert kept.count() == 600 and [(size, shards) for size, _, shards in plan] == [(1, 1), (5, 2), (8, 4)] and [first for _, first, _ in plan] == [0, 1, 3]
    got = results(ann.nearest(df, F.col("vec_id") % 20 == 0))
    want = {}
    for size in (5, 8):
        ids = [i for i, v in enumerate(x) if len(v) == size]
        want |= brute(ids, np.array([x[i] for i in ids]), [i for i in ids if i % 20 == 0])
    assert got.keys() == want.keys() and recall(got, want) > 0.97  # alone of its length, a vector has no neighbours


def test_large_groups_of_near_copies_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 250)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 16))
    x[:400] = x[0] + 0.01 * rng.normal(size=(400, 16))
    x[400:430] = x[400]
    x = x.astype(np.float32).astype(float)
    got = results(ann.nearest(frame(spark, x), F.col("vec_id") % 20 == 0))
    assert recall(got, brute(range(1200), x, range(0, 1200, 20))) >= 0.9


def test_graph_keeps_its_degree_and_reaches_all():
    rng = np.random.default_rng(2)
    base = ann.lengthened(rng.normal(size=(900, 16)), 10.0)
    assert np.allclose((base**2).sum(axis=1), 1, atol=1e-5)
    graph, entry = ann.build(base)
    assert graph.shape == (900, ann.DEGREE) and (graph < 900).all() and not (graph == np.arange(900)[:, None]).any()
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in graph)
    reached, todo = set(entry.tolist()), entry.tolist()
    while todo:
        new = {k for k in graph[todo.pop()].tolist() if k >= 0} - reached
        reached |= new
        todo += new
    assert len(reached) > 890


def test_query_against_brute_force(rows, duck):
    table = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = [r[0] for r in table], np.array([r[1] for r in table], float)
    got = {}
    for r in rows("op10_ann"):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
