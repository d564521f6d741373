"""Approximate nearest neighbours by largest inner product, over robust-pruned directed graphs.

Vectors are dealt to shards of bounded size by a hash of their id. Each shard is one graph: every
vector in turn searches the graph so far greedily, and of what it meets it keeps diverse
neighbours, passing over those that a kept neighbour is nearer to by the factor ``ALPHA``. Every
query runs a beam search in every shard; the candidates met are scored exactly, in double
precision on the original vectors, and the best of all shards are returned.

Inner products become distances by one more component, which gives all vectors the length of the
longest. Equal vectors are one vertex that carries all their ids, so copies do not crowd a graph.

Defined results: vectors that are null, zero, or hold null or non-finite components, vectors
without id take no part; vectors of different lengths are searched apart, each length in shards of its own; rows that repeat an id count once, with the smallest vector; ties go to the smaller id; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.local import local_frame
from plumbline.llm.store import written

#: Vectors of a shard, and bytes of their components; queries that search a shard together.
SHARD, SHARD_BYTES, QUERIES = 8192, 64 << 20, 2048
#: Neighbours of a vertex, beams of building and searching, and how many vertices a step expands.
DEGREE, BUILD_BEAM, BEAM, WIDTH = 32, 64, 160, 4
ALPHA = 1.2
#: Vectors that search or are inserted at once.
BATCH = 256


def beam_search(vectors: np.ndarray, graph: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best vertices met (-1 where fewer) and their inner products, best first, for all queries together."""
    count = len(queries)
    ids = np.full((count, beam), -1, np.int32)
    near = np.full((count, beam), -np.inf, np.float32)
    done = np.ones((count, beam), bool)
    seen = np.zeros((count, len(vectors)), bool)
    k = min(len(entry), beam)
    ids[:, :k], near[:, :k], done[:, :k] = entry[:k], queries @ vectors[entry[:k]].T, False
    seen[:, entry[:k]] = True
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near, done = (np.take_along_axis(x, order, 1) for x in (ids, near, done))
    live = np.arange(count)
    while len(live):
        fresh = ~done[live]
        live = live[fresh.any(axis=1)]
        if not len(live):
            break
        fresh = ~done[live]
        turn = np.cumsum(fresh, axis=1)
        pick = fresh & (turn <= WIDTH)
        row, column = np.nonzero(pick)
        done[live[row], column] = True
        chosen = np.full((len(live), WIDTH), -1, np.int32)
        chosen[row, turn[row, column] - 1] = ids[live[row], column]
        around = np.where(chosen[:, :, None] >= 0, graph[chosen], -1).reshape(len(live), -1)
        around.sort(axis=1)
        new = around >= 0
        new[:, 1:] &= around[:, 1:] != around[:, :-1]
        new &= ~seen[live[:, None], np.maximum(around, 0)]
        r, c = np.nonzero(new)
        seen[live[r], around[r, c]] = True
        product = np.full(around.shape, -np.inf, np.float32)
        product[r, c] = np.einsum("ij,ij->i", vectors[around[r, c]], queries[live[r]])
        all_near = np.concatenate([near[live], product], axis=1)
        all_ids = np.concatenate([ids[live], np.where(new, around, -1)], axis=1)
        all_done = np.concatenate([done[live], ~new], axis=1)
        top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(all_near, top, 1), axis=1, kind="stable"), 1)
        near[live], ids[live], done[live] = (np.take_along_axis(x, top, 1) for x in (all_near, all_ids, all_done))
    return ids, near


def robust_prune(vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """Up to DEGREE diverse neighbours of each point from its candidates (-1 is none), nearest first.

    All vectors have one length, so squared distances are differences of inner products.
    """
    there = (candidates >= 0) & (candidates != points[:, None])
    at = vectors[np.maximum(candidates, 0)]
    own = vectors[points]
    square = float(own[0] @ own[0]) if len(own) else 0.0
    away = 2 * (square - np.einsum("bcd,bd->bc", at, own))
    away[~there] = np.inf
    order = np.argsort(away, axis=1, kind="stable")
    candidates, away = np.take_along_axis(candidates, order, 1), np.take_along_axis(away, order, 1)
    at = np.take_along_axis(at, order[:, :, None], 1)
    between = 2 * (square - at @ at.transpose(0, 2, 1))
    alive = np.isfinite(away)
    out = np.full((len(points), DEGREE), -1, np.int32)
    rows = np.arange(len(points))
    for k in range(DEGREE):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = candidates[rows[some], first[some]]
        alive[rows, first] = False
        alive &= ~(some[:, None] & (alpha * alpha * between[rows, first] <= away))
    return out


def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entry vertices) of vectors of equal length; row i of the graph has the neighbours of i, -1 where fewer."""
    n = len(vectors)
    graph = np.full((n, DEGREE), -1, np.int32)
    order = np.random.default_rng(11).permutation(n)
    entry = order[: min(n, 8)].astype(np.int32)
    at = len(entry)
    for i in entry:
        others = entry[entry != i]
        graph[i, : len(others)] = others
    while at < n:
        batch = order[at : at + min(BATCH, max(8, at))]
        met, _ = beam_search(vectors, graph, entry, vectors[batch], BUILD_BEAM)
        # vectors inserted together may be each other's neighbours
        graph[batch] = robust_prune(vectors, batch, np.concatenate([met, np.broadcast_to(batch.astype(np.int32), (len(batch), len(batch)))], axis=1) if len(batch) <= 32 else met)
        source = np.repeat(batch, DEGREE)
        target = graph[batch].ravel()
        source, target = source[target >= 0].astype(np.int32), target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        points, first, size = np.unique(target, return_index=True, return_counts=True)
        for width in np.unique(size):  # points that get equally many new neighbours
            own = np.flatnonzero(size == width)
            for part in np.array_split(own, max(1, len(own) * int(width + DEGREE) // (BATCH * 128) + 1)):
                new = source[first[part][:, None] + np.arange(width)]
                both = np.concatenate([graph[points[part]], new], axis=1)
                both.sort(axis=1)
                both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
                full = (both >= 0).sum(axis=1) > DEGREE
                if full.any():
                    graph[points[part[full]]] = robust_prune(vectors, points[part[full]], both[full])
                if (~full).any():
                    graph[points[part[~full]]] = -np.sort(-both[~full], axis=1)[:, :DEGREE]
        at += len(batch)
    return graph, entry


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """Single-precision vectors scaled by the longest length, with one more component that makes all lengths 1."""
    y = x / longest
    rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", y, y)))
    return np.column_stack([y, rest]).astype(np.float32)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


INDEX = "shard int, size int, offsets binary, ids binary, vectors binary, graph binary, entry binary"


def _index(lengths: dict[int, float]):
    """``lengths`` has the length of the longest vector by the number of its components."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        size = len(table.column("embedding")[0])
        longest = lengths[size]
        x = _matrix(table.column("embedding"), size) + 0.0
        # equal vectors are one vertex; its ids in ascending order
        by = np.argsort(ids, kind="stable")
        ids, x = ids[by], x[by]
        _, first, vertex = np.unique(x.view(f"V{8 * size}").ravel(), return_index=True, return_inverse=True)
        owned = np.argsort(vertex, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(vertex))]).astype(np.int64)
        x = x[first]
        graph, entry = build(lengthened(x, longest))
        arrays = [a.tobytes() for a in (offsets, ids[owned], x, graph, entry)]
        shard = table.column("shard")[0].as_py()
        return pa.table(
            [pa.array([shard], pa.int32()), pa.array([size], pa.int32())] + [pa.array([a], pa.binary()) for a in arrays],
            names=["shard", "size", "offsets", "ids", "vectors", "graph", "entry"],
        )

    return run


def index(vectors: DataFrame, shard: int = SHARD) -> tuple[DataFrame, DataFrame, list[tuple[int, int, int]]]:
    """(graphs, the vectors that take part, and for each number of components its first shard and how many it has).

    One row per shard, every vector in one of them.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(fine).dropna()
    kept = written(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    sizes = kept.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square")).orderBy("size").collect()  # a row per length
    lengths, plan, first = {}, [], 0
    for row in sizes:
        lengths[row["size"]] = float(np.sqrt(row["square"])) * (1 + 1e-9)
        shards = max(1, -(-row["n"] // max(64, min(shard, SHARD_BYTES // (8 * row["size"])))))
        plan.append((row["size"], first, shards))
        first += shards
    held = local_frame(kept.sparkSession, {"size": "bigint", "first": "bigint", "shards": "bigint"}, plan)
    dealt = kept.withColumn("size", F.size("embedding").cast("bigint")).join(F.broadcast(held), "size")
    dealt = dealt.select("vec_id", "embedding", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("shards"))).cast("int").alias("shard"))
    return written(dealt.groupBy("shard").applyInArrow(_index(lengths), INDEX), "graphs"), kept, plan


def _search(k: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held = {c: batch.column(c)[row].as_buffer() for c in ("offsets", "ids", "vectors", "graph", "entry")}
                size = batch.column("size")[row].as_py()
                offsets, ids = (np.frombuffer(held[c], np.int64) for c in ("offsets", "ids"))
                x = np.frombuffer(held["vectors"], np.float64).reshape(-1, size)
                graph = np.frombuffer(held["graph"], np.int32).reshape(-1, DEGREE)
                asked = batch.column("queries")[row].values
                own = asked.field("vec_id").to_numpy()
                y = _matrix(asked.field("embedding"), size)
                longest = np.sqrt(np.einsum("ij,ij->i", x, x).max(initial=1e-300))
                base = lengthened(x, longest)
                direction = np.column_stack([y / np.sqrt(np.einsum("ij,ij->i", y, y))[:, None], np.zeros(len(y))]).astype(np.float32)
                for a in range(0, len(y), BATCH):
                    met, _ = beam_search(base, graph, np.frombuffer(held["entry"], np.int32), direction[a : a + BATCH], beam)
                    r, c = np.nonzero(met >= 0)
                    vertex = met[r, c]
                    score = np.einsum("ij,ij->i", x[vertex], y[a + r])
                    # a vertex stands for all its ids; no more than k + 1 of them can count
                    copies = np.minimum(offsets[vertex + 1] - offsets[vertex], k + 1)
                    query = np.repeat(a + r, copies)
                    inside = np.arange(len(query)) - np.repeat(np.cumsum(copies) - copies, copies)
                    found = ids[np.repeat(offsets[vertex], copies) + inside]
                    score = np.repeat(score, copies)
                    other = found != own[query]
                    query, found, score = query[other], found[other], score[other]
                    best = np.lexsort((found, -score, query))
                    query, found, score = query[best], found[best], score[best]
                    first = np.searchsorted(query, query)
                    top = np.arange(len(query)) - first < k
                    yield pa.RecordBatch.from_arrays([pa.array(own[query[top]]), pa.array(found[top]), pa.array(score[top])], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, of, k: int = 20, beam: int = BEAM) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of every vector for which the condition ``of`` holds."""
    graphs, kept, plan = index(vectors)
    asked = kept.filter(of).withColumn("size", F.size("embedding"))
    blocks = max(1, -(-asked.count() // QUERIES))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block")
    packed = asked.groupBy("size", block).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    shards = local_frame(kept.sparkSession, {"length": "bigint", "first": "bigint", "shards": "bigint"}, plan)
    last = F.col("first") + F.col("shards") - 1
    everywhere = packed.join(F.broadcast(shards), F.col("size") == F.col("length")).select("block", "queries", F.explode(F.sequence(F.col("first").cast("int"), last.cast("int"))).alias("shard"))
    # each block of queries meets each shard of its length once
    met = everywhere.join(graphs, "shard").repartition(F.col("shard"), F.col("block"))
    found = met.mapInArrow(_search(k, beam), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
