"""Near duplicates among embeddings of one label, by NN-descent on a neighbour graph.

Vectors of equal label (and length) are compared by cosine. Equal vectors are one node. The graph begins with
the nearest of cells of bounded size: nodes are sorted by the signs of random projections, several times over,
and every run of ``CELL`` is compared within itself. Then rounds of descent: each node introduces its
neighbours, in both directions, to each other, and every node keeps the nearest it has met, ``WIDTH`` of them; a
list whose entries all reach the threshold is saturated and grows: it also keeps the ``FAR`` most distant ones that reach the threshold, which
are those that tie dense groups together. The neighbours of a hub meet in groups of
bounded size, dealt anew each round. Rounds end when lists that are not saturated hardly gain any link.

Edges of the lists that reach the threshold, verified in double precision, make components. A list can be
saturated at any width, so it is then enlarged to its whole component: links are counted between all nodes of a component,
those of up to ``BLOCK`` nodes at once. In a larger one, nodes within half the threshold's angle of the mean direction
are all linked with each other and need no comparison; only the nodes further out meet every node, block by block. No pair becomes a row.

A sample (``AUDIT`` nodes, and as many that have links) is compared with all nodes of its labels; if less than ``RECALL`` of
its links were found, wider lists and further orders are tried.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without label, link with
nothing and are components of their own; so do vectors of another length. Rows that repeat an id count
once, with the smallest label and vector, nulls first; rows without id are left out. Equal vectors link whatever their number.
An empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.store import sampled_rows, written

THRESHOLD = 0.93
#: Nodes compared with each other to begin with, and how many orders of the nodes are cut into such cells.
CELL, ORDERS = 256, 4
#: Neighbours of a node, the distant ones of a saturated list, and how many neighbours of one node meet at once.
WIDTH, FAR, MEET = 8, 8, 64
#: Rounds, and the links that have to be gained for another one, as a share of all nodes.
ROUNDS, STILL = 6, 0.001
#: Hubs that are sent to every executor; more are joined.
HUBS = 100_000
#: Nodes of a component compared at once; more are compared block by block.
BLOCK = 1024
#: Nodes audited twice over, links of theirs that have to be found, and how often lists are widened.
AUDIT, RECALL, TRIES = 128, 0.995, 3
#: Cosines of stored directions (of half precision) are this close to the exact ones.
SLACK = 0.004

BITS = 48


def _half(code: pa.Array) -> np.ndarray:
    """Directions as stored: half precision, one row per node."""
    if not len(code):
        return np.zeros((0, 1), np.float32)
    data = b"".join(code.to_pylist())
    return np.frombuffer(data, np.float16).reshape(len(code), -1).astype(np.float32)


def _directions(column: pa.Array) -> np.ndarray:
    """Unit vectors of a list column whose vectors have one length, in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither square under- nor overflows
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of equal keys as one batch each, ``most`` rows at a time if given."""
    held: list[pa.RecordBatch] = []
    rows, at = 0, None

    def together() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for v in values:
            new[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            here = tuple(v[a] for v in values)
            if held and here != at:
                yield together()
                held, rows = [], 0
            at = here
            while a < b:
                step = b - a if most is None else min(b - a, most - rows)
                held.append(batch.slice(a, step))
                rows, a = rows + step, a + step
                if rows == most:
                    yield together()
                    held, rows = [], 0
    if held:
        yield together()


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


EDGES = "a bigint, b bigint, sim float"


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float32())], names=["a", "b", "sim"])


def _coded(orders: Sequence[int]):
    """Directions in half precision and a sort key per order: signs of random projections, the first weighing most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            sizes = np.diff(_column(batch, "v").offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
            for size in np.unique(sizes).tolist():
                rows = pa.array(np.flatnonzero(sizes == size))
                some = batch.take(rows)
                u = _directions(_column(some, "v"))
                keys = []
                for t in orders:
                    if (t, size) not in planes:
                        planes[t, size] = np.random.default_rng([t, size]).standard_normal((size, BITS))
                    keys.append(((u @ planes[t, size]) > 0) @ (1 << np.arange(BITS - 1, -1, -1)))
                codes = pa.array([r.tobytes() for r in u.astype(np.float16)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [_column(some, "node"), _column(some, "part"), codes, *[pa.array(k, pa.int64()) for k in keys]],
                    names=["node", "part", "code", *[f"o{t}" for t in orders]],
                )

    return run


def _in_cells(threshold: float, cell: int, width: int):
    """The nearest of every node within its run of sorted nodes, and the most distant ones that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in runs(batches, ["part"], cell):
            ids, u = _column(met, "node").to_numpy(), _half(_column(met, "code"))
            if len(ids) < 2:
                continue
            sims = u @ u.T
            np.fill_diagonal(sims, -2)
            k = min(width, len(ids) - 1)
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            yield _edges(np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(sims, near, 1).ravel())
            full = np.flatnonzero((sims >= threshold - SLACK).sum(axis=1) > k)
            if len(full):
                links = np.where(sims[full] >= threshold - SLACK, sims[full], 2)
                far = np.argpartition(links, min(FAR, len(ids)) - 1, axis=1)[:, : min(FAR, len(ids))]
                i, j = np.nonzero(np.take_along_axis(links, far, 1) <= 1.5)
                yield _edges(ids[full[i]], ids[far[i, j]], links[i, far[i, j]])

    return run


def _introduced(threshold: float):
    """Pairs of one node's neighbours of which one is a new neighbour, where a list of theirs has a place for the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in runs(batches, ["middle", "chunk"]):
            ids, first, again = np.unique(_column(met, "node").to_numpy(), return_index=True, return_inverse=True)
            u = _half(_column(met, "code").take(pa.array(first)))
            fresh = np.bincount(again, _column(met, "fresh").to_numpy(zero_copy_only=False)) > 0
            worst, far = (_column(met, c).to_numpy()[first] for c in ("worst", "far"))
            sims = u @ u.T
            good = (fresh[:, None] | fresh[None, :]) & ((sims > worst[:, None]) | ((sims < far[:, None]) & (sims >= threshold - SLACK)))
            np.fill_diagonal(good, False)
            i, j = np.nonzero(good)
            if len(i):
                yield _edges(ids[i], ids[j], sims[i, j])

    return run


def _nearest(edges: DataFrame, threshold: float, width: int) -> DataFrame:
    """Each node's list (a, b, sim, fresh, far) from edges that may repeat: ``width`` nearest, and the most distant of further ones that reach the threshold."""
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = Window.partitionBy("a")
    once = edges.repartition(n, "a").groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    links = F.count(F.when(F.col("sim") >= threshold - SLACK, 1)).over(own)
    ranked = once.withColumn("place", F.row_number().over(own.orderBy(F.desc("sim"), "b"))).withColumn("links", links)
    distant = (F.col("place") <= F.col("links")) & (F.col("links") - F.col("place") < FAR)
    return ranked.filter((F.col("place") <= width) | distant).select("a", "b", "sim", "fresh", (F.col("place") > width).alias("far"))


def _began(coded: DataFrame, orders: Sequence[int], nodes: int, threshold: float, width: int) -> DataFrame:
    # partitions of several cells each, as the last one of a partition is cut short
    n = max(1, min(int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes // (4 * CELL)))
    parts = []
    for t in orders:
        by = ["part", f"o{t}", "node"]
        parts.append(coded.select("node", "part", "code", f"o{t}").repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(_in_cells(threshold, CELL, width), EDGES))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def descend(coded: DataFrame, lists: DataFrame, nodes: int, threshold: float, width: int) -> DataFrame:
    """Rounds of introductions on the lists until those that are not saturated hardly gain a link."""
    n = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    link = F.col("sim") >= threshold - SLACK
    for turn in range(ROUNDS):
        both = lists.select(F.col("a").alias("middle"), F.col("b").alias("other"), "fresh").union(lists.select("b", "a", "fresh"))
        # whoever many lists name is a hub, whose neighbours meet in several groups
        hubs = lists.groupBy(F.col("b").alias("hub")).agg(F.ceil((F.count(F.lit(1)) + width + FAR) / MEET).alias("chunks")).filter("chunks > 1")
        few = hubs.limit(HUBS + 1).count() <= HUBS
        chunk = F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("other", F.lit(turn)), F.col("chunks"))).otherwise(F.lit(0))
        dealt = both.join(F.broadcast(hubs) if few else hubs, F.col("middle") == F.col("hub"), "left").select("middle", "other", "fresh", chunk.alias("chunk"))
        # a list that is not full takes anyone; a full one who is nearer, or farther, if it is saturated
        held = lists.groupBy("a").agg(
            F.count(F.when(~F.col("far"), 1)).alias("n"), F.min(F.when(~F.col("far"), F.col("sim"))).alias("least"),
            F.count(F.when(F.col("far"), 1)).alias("m"), F.max(F.when(F.col("far"), F.col("sim"))).alias("most"),
        )
        worst = F.when(F.col("n") < width, F.lit(-2.0)).otherwise(F.col("least"))
        far = F.when((F.col("n") < width) | (F.col("least") < threshold - SLACK), F.lit(-2.0)).when(F.col("m") < FAR, F.lit(2.0)).otherwise(F.col("most"))
        known = coded.select("node", "code").join(held.select(F.col("a").alias("node"), worst.cast("float").alias("worst"), far.cast("float").alias("far")), "node")
        shipped = dealt.join(known, F.col("other") == F.col("node")).select("middle", "chunk", "node", "code", "fresh", "worst", "far")
        found = shipped.repartition(n, "middle", "chunk").sortWithinPartitions("middle", "chunk").mapInArrow(_introduced(threshold), EDGES)
        old = lists.select("a", "b", "sim", F.lit(False).alias("fresh"))
        lists = written(_nearest(old.unionByName(found.withColumn("fresh", F.lit(True))), threshold, width), "lists")
        open_ = lists.groupBy("a").agg(F.count(F.when(link, 1)).alias("links"), F.count(F.when(link & F.col("fresh"), 1)).alias("gained")).filter(F.col("links") < width)
        if open_.agg(F.coalesce(F.sum("gained"), F.lit(0))).first()[0] <= STILL * nodes:
            break
    return lists


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(_column(batch, "va").offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
            good = np.zeros(batch.num_rows, bool)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                a, b = (_directions(_column(batch, c).take(pa.array(rows))) for c in ("va", "vb"))
                good[rows] = np.einsum("ij,ij->i", a, b) >= threshold
            yield pa.RecordBatch.from_arrays([_column(batch, c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    return run


# ------------------------------------------------------------------ links of whole components

COUNTS = "node bigint, links bigint"


def _counts(ids: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links.astype(np.int64))], names=["node", "links"])


def _linked(threshold: float):
    """Copies linked with each node of a component that is compared at once, the node's own included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in runs(batches, ["component"]):
            u = _directions(_column(met, "v"))
            hits = u @ u.T >= threshold
            np.fill_diagonal(hits, True)
            yield _counts(_column(met, "node").to_numpy(), hits @ _column(met, "copies").to_numpy())

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for met in runs(batches, ["component"], BLOCK):
        total = _directions(_column(met, "v")).sum(axis=0)
        yield pa.RecordBatch.from_arrays([_column(met, "component").slice(0, 1), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["component", "total"])


def _mean(table: pa.Table) -> pa.Table:
    total = table.column("total").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).sum(axis=0)
    size = math.sqrt(float(total @ total))
    return pa.table([table.column("component").slice(0, 1), pa.array([(total / (size or 1.0)).tolist()], pa.list_(pa.float64()))], names=["component", "mean"])


def _fringe(threshold: float):
    """Whether a node is farther from the mean direction than half the threshold's angle, with room for rounding."""
    half = math.sqrt((1 + threshold) / 2) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in runs(batches, ["component"], BLOCK):
            mean = _column(met, "mean").slice(0, 1).flatten().to_numpy()
            outer = _directions(_column(met, "v")) @ mean < half
            kept = [_column(met, c) for c in ("component", "node", "copies", "v")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(outer)], names=["component", "node", "copies", "v", "outer"])

    return run


def _blocks_linked(threshold: float):
    """A block of outer nodes against a block of the component: copies linked with each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                out, all_ = (_column(batch, c)[row].values for c in ("outer_rows", "rows"))
                u, w = _directions(out.field("v")), _directions(all_.field("v"))
                a, b = out.field("node").to_numpy(), all_.field("node").to_numpy()
                hits = u @ w.T >= threshold
                hits |= a[:, None] == b[None, :]
                yield _counts(a, hits @ all_.field("copies").to_numpy())
                core = ~all_.field("outer").to_numpy(zero_copy_only=False)
                back = (out.field("copies").to_numpy() @ hits)[core]
                yield _counts(b[core][back > 0], back[back > 0])

    return run


def links_of(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links): copies linked with each node (component, node, copies, v), its own included."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = members.join(sizes, "component")
    # by a hash of its own: dealt by the key of the join just made, the rows would stay as that join left them, skewed parts split
    together = sized.filter(F.col("size") <= BLOCK).drop("size").repartition(n, F.xxhash64("component")).sortWithinPartitions("component")
    small = together.mapInArrow(_linked(threshold), COUNTS)
    # salted, so that a component of any size is spread over all tasks
    salted = sized.filter(F.col("size") > BLOCK).repartition(n, "component", F.pmod(F.xxhash64("node"), F.lit(n))).sortWithinPartitions("component")
    large = written(salted, "large-components")
    if large.isEmpty():
        return small
    in_order = large.select("component", "v")
    means = in_order.mapInArrow(_sums, "component bigint, total array<double>").groupBy("component").applyInArrow(_mean, "component bigint, mean array<double>")
    judged = large.join(means, "component").sortWithinPartitions("component")
    marked = written(judged.mapInArrow(_fringe(threshold), "component bigint, node bigint, copies bigint, v array<double>, outer boolean"), "marked")
    core = marked.filter("NOT outer").groupBy("component").agg(F.sum("copies").alias("links"))
    inner = marked.filter("NOT outer").select("component", "node").join(core, "component").select("node", "links")

    def packed(rows: DataFrame, name: str) -> DataFrame:
        blocks = rows.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        dealt = rows.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        return dealt.groupBy("component", F.col("block").alias(f"{name}_block")).agg(F.collect_list(F.struct("node", "copies", "v", "outer")).alias(name))

    met = packed(marked.filter("outer"), "outer_rows").join(packed(marked, "rows"), "component").repartition(n, "component", "outer_rows_block", "rows_block")
    compared = met.select("outer_rows", "rows").mapInArrow(_blocks_linked(threshold), COUNTS)
    return small.union(inner).union(compared).groupBy("node").agg(F.sum("links").alias("links"))


# ------------------------------------------------------------------ audit


def _exact(sample: list, threshold: float):
    asked = [(r["node"], r["part"], np.array(r["v"], np.float64)) for r in sample]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(asked), np.int64)
        for batch in batches:
            for met in runs(iter([batch]), ["part"]):
                part = _column(met, "part")[0].as_py()
                of = [i for i, a in enumerate(asked) if a[1] == part]
                if of:
                    q = np.array([asked[i][2] for i in of])
                    q = q / np.abs(q).max(axis=1, keepdims=True)
                    q /= np.sqrt(np.einsum("ij,ij->i", q, q))[:, None]
                    hits = q @ _directions(_column(met, "v")).T >= threshold
                    hits |= np.array([asked[i][0] for i in of])[:, None] == _column(met, "node").to_numpy()[None, :]
                    found[of] += hits @ _column(met, "copies").to_numpy()
        yield _counts(np.array([a[0] for a in asked], np.int64), found)

    return run


def audited(nodes: DataFrame, counted: DataFrame, threshold: float) -> float:
    """Share of the links of a bounded sample of nodes that were found: nodes of any kind, and nodes with links."""
    some = sampled_rows(nodes, "node", AUDIT)
    linked = sampled_rows(nodes.join(counted.filter("links > 1").select("node"), "node", "left_semi"), "node", AUDIT, seed=1)
    sample = list({r["node"]: r for r in [*some, *linked]}.values())
    if not sample:
        return 1.0
    ids = [r["node"] for r in sample]
    exact = {r["node"]: r["links"] for r in nodes.mapInArrow(_exact(sample, threshold), COUNTS).groupBy("node").agg(F.sum("links").alias("links")).collect()}
    found = {r["node"]: r["links"] for r in counted.filter(F.col("node").isin(ids)).collect()}
    copies = {r["node"]: r["copies"] for r in sample}
    true = sum(exact[i] - copies[i] for i in ids)
    return 1.0 if not true else sum(min(found.get(i, copies[i]), exact[i]) - copies[i] for i in ids) / true


# ------------------------------------------------------------------ the operator


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, key) of all rows, key null for those that link with nothing; (key, node, copies, part, v) of different vectors."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    single = rows.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    part = F.when(F.coalesce(fine, F.lit(False)), F.concat_ws(":", F.size("v").cast("string"), "label"))
    marked = single.withColumn("part", F.when(F.col("label").isNotNull(), part)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    key = F.when(F.col("part").isNotNull(), F.unhex(F.sha2(F.concat_ws(",", "part", F.col("v").cast("array<string>")), 256)))
    kept = written(marked.select("vec_id", "part", key.alias("key"), "v"), "vectors")
    groups = kept.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("part").alias("part"), F.first("v").alias("v")
    )
    return kept.select("vec_id", "key"), written(groups, "nodes")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per id."""
    members, nodes = nodes_of(vectors)
    count = nodes.count()
    own = nodes.select("node", F.col("copies").alias("links"), F.col("node").alias("component"))
    counted = own
    lists, width, orders = None, WIDTH, list(range(ORDERS))
    for turn in range(TRIES if count > 1 else 0):
        fields = ", ".join(f"o{t} bigint" for t in orders)
        coded = written(nodes.select("node", "part", "v").mapInArrow(_coded(orders), f"node bigint, part string, code binary, {fields}"), "coded")
        started = _began(coded, orders, count, threshold, width).withColumn("fresh", F.lit(True))
        started = started if lists is None else started.unionByName(lists.select("a", "b", "sim", F.lit(True).alias("fresh")))
        lists = descend(coded, written(_nearest(started, threshold, width), "lists"), count, threshold, width)
        near = lists.filter(F.col("sim") >= threshold - SLACK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        with_a = near.join(nodes.select(F.col("node").alias("a"), F.col("v").alias("va")), "a")
        with_both = with_a.join(nodes.select(F.col("node").alias("b"), F.col("v").alias("vb")), "b").select("a", "b", "va", "vb")
        edges = with_both.mapInArrow(_verified(threshold), "a bigint, b bigint")
        found = components(edges).select("node", F.col("label").alias("component"))
        grouped = written(found.join(nodes.select("node", "copies", "v"), "node").select("component", "node", "copies", "v"), "components")
        linked = links_of(grouped, threshold).join(grouped.select("node", "component"), "node").select("node", "links", "component")
        alone = own.join(grouped.select("node"), "node", "left_anti")
        counted = written(linked.unionByName(alone), "links")
        if turn == TRIES - 1 or audited(nodes, counted, threshold) >= RECALL:
            break
        width, orders = 2 * width, list(range(orders[-1] + 1, orders[-1] + 1 + 2 * len(orders)))
    of_key = counted.join(nodes.select("node", "key"), "node").select("key", "links", "component")
    out = members.join(of_key, "key", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") - 1, F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
