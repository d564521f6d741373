"""Merkle manifest of a table: one root digest, and for every row a witness that proves the row by it.

Rows are the leaves of one ternary tree per group, in a given order; the roots of these trees are
the leaves of a last tree, whose root stands for the table. Every three consecutive nodes become the
SHA-256 of their digests (as lower-case hex, concatenated), level by level, until one is left; the last run
of a level may hold fewer, even one. A witness holds the siblings met on the way to the root, left to
right, and where among them the node itself stood.

Leaves are appended in a stream, a block of 3**6 aligned ones per stream. An open subtree carries the
partial witnesses of its leaves; each sibling that is completed later extends them. The roots of the blocks
are appended to further blocks in the same way, and the roots of the groups likewise, so that no task
sees more than a block and each round divides what is left by 729. Positions come from a range partitioning:
only counts per partition, as many rows as there are tasks, reach the driver.

Defined results: a null group comes before all others, which are in the order of their UTF-8 bytes; within
a group rows ascend by the order columns, nulls first, equal ones by their digests (rows that are equal throughout
are leaves of their own, in any order, which makes no difference to any digest). A group of one row has that leaf
as its root, a single group its root as the root of the table. Empty and very long texts are values like others.
An empty table gives an empty manifest. Extra columns are carried along; the names ``MANIFEST`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.functions.local import local_frame
from plumbline.llm.store import written

FAN = 3
#: Levels of a block: it has 729 leaves.
LEVELS = 6

MANIFEST = ("tree", "pos", "path", "siblings", "subroot", "root")


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of a row's values, each as its length in UTF-8 bytes, a colon and the value; a null is a dash."""
    texts = [v.cast("string") for v in values]
    fields = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def parent_of(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


class Frontier:
    """The open subtrees of a block that grows at its right end, and the witnesses of its leaves so far."""

    def __init__(self, levels: int = LEVELS) -> None:
        self.levels = levels
        self.path: list[bytearray] = []
        self.siblings: list[bytearray] = []
        self.open: list[list[tuple[bytes, range]]] = [[] for _ in range(levels + 1)]

    def append(self, leaf: bytes) -> None:
        place = len(self.path)
        self.path.append(bytearray())
        self.siblings.append(bytearray())
        self._complete(0, leaf, range(place, place + 1))

    def _complete(self, level: int, digest: bytes, leaves: range) -> None:
        """A node is done: it extends the witnesses below its left siblings, which in turn extend those below it."""
        run = self.open[level]
        before = b"".join(d for d, _ in run)
        for _, others in run:
            for k in others:
                self.siblings[k] += digest
        for k in leaves:
            self.siblings[k] += before
        run.append((digest, leaves))
        if len(run) == FAN and level < self.levels:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for i, (_, leaves) in enumerate(run):
            for k in leaves:
                self.path[k].append(i * (FAN + 1) + len(run))
        self._complete(level + 1, parent_of([d for d, _ in run]), range(run[0][1].start, run[-1][1].stop))

    def close(self, first: bool) -> bytes:
        """Root of the block. All blocks but the first of a tree have all levels; the first stops at one node."""
        level = 0
        while True:
            run = self.open[level]
            if len(run) == 1 and (first or level == self.levels) and not any(self.open[level + 1 :]):
                return run[0][0]
            if run:
                self._close(level)
            level += 1


def fold(leaf: bytes, path: bytes, siblings: bytes) -> bytes:
    """Root that a leaf and a witness lead to."""
    at = 0
    for code in path:
        place, size = divmod(code, FAN + 1)
        run = [siblings[at + 32 * i : at + 32 * (i + 1)] for i in range(size - 1)]
        at += 32 * (size - 1)
        leaf = parent_of([*run[:place], leaf, *run[place:]])
    return leaf


def _ranked(group: str):
    """Number the groups of a sorted partition and the rows of each, both from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tree, next_pos, last = -1, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            held = batch.column(batch.schema.get_field_index(group))
            new = np.zeros(n, bool)
            a, b = held.slice(1), held.slice(0, n - 1)
            differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
            new[1:] = differ.to_numpy(zero_copy_only=False)
            new[0] = tree < 0 or held[0].as_py() != last
            trees = tree + np.cumsum(new)
            starts = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            pos = np.where(starts >= 0, np.arange(n) - starts, next_pos + np.arange(n))
            tree, next_pos, last = int(trees[-1]), int(pos[-1]) + 1, held[n - 1].as_py()
            extra = [pa.array(np.full(n, part, np.int32)), pa.array(trees), pa.array(pos)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "part", "tree", "pos"])

    return run


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _fields(df: DataFrame) -> str:
    return ", ".join(f"{C.quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, int, int]:
    """The rows with ``tree`` (number of the group) and ``pos`` (place in it), the number of groups, and a bound of the places.

    Only the first group of a partition can have begun in an earlier one, so a pair of numbers per
    partition corrects what the partition counted by itself.
    """
    by = [C.column(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.repartitionByRange(_partitions(rows), *by).sortWithinPartitions(*by)
    ranked = written(dealt.mapInArrow(_ranked(group), f"{_fields(rows)}, part int, tree bigint, pos bigint"), "ranked")
    key = F.coalesce(F.sha2(C.column(group).cast("string"), 256), F.lit("")).alias("key")
    parts = ranked.groupBy("part").agg(
        F.min(F.struct("tree", key)).alias("first"), F.max(F.struct("tree", "pos", key)).alias("last"), F.max("pos").alias("deepest")
    )
    offsets, trees, most, before, length = [], 0, -1, None, 0
    for row in parts.orderBy("part").collect():  # a row per task
        goes_on = row["first"]["key"] == before
        tree, pos = (trees - 1, length) if goes_on else (trees, 0)
        offsets.append((row["part"], tree, pos))
        trees = tree + row["last"]["tree"] + 1
        length = row["last"]["pos"] + 1 + (pos if row["last"]["tree"] == 0 else 0)
        before, most = row["last"]["key"], max(most, row["deepest"] + pos)
    base = local_frame(rows.sparkSession, {"in_part": "bigint", "tree_base": "bigint", "pos_base": "bigint"}, offsets)
    placed = ranked.join(F.broadcast(base), F.col("part") == F.col("in_part")).select(
        *[C.column(c) for c in rows.columns],
        (F.col("tree") + F.col("tree_base")).alias("tree"),
        (F.col("pos") + F.when(F.col("tree") == 0, F.col("pos_base")).otherwise(0)).alias("pos"),
    )
    return placed, trees, most


def _append(levels: int):
    """Stream sorted leaves into blocks; a block leaves with its witnesses and root as soon as it ends."""
    size = FAN**levels

    def done(parts: list[pa.RecordBatch], at: tuple[int, int]) -> pa.RecordBatch:
        block = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        frontier = Frontier(levels)
        for digest in block.column(block.schema.get_field_index("digest")).to_pylist():
            frontier.append(digest)
        top = frontier.close(at[1] == 0)
        extra = [[bytes(p) for p in frontier.path], [bytes(s) for s in frontier.siblings], [top] * block.num_rows]
        return pa.RecordBatch.from_arrays([*block.columns, *[pa.array(x, pa.binary()) for x in extra]], names=[*block.schema.names, "path", "siblings", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        at: tuple[int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(batch.schema.get_field_index("tree")).to_numpy()
            block = batch.column(batch.schema.get_field_index("pos")).to_numpy() // size
            cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tree)]):
                here = (int(tree[a]), int(block[a]))
                if parts and here != at:
                    yield done(parts, at)
                    parts = []
                parts.append(batch.slice(a, b - a))
                at = here
        if parts:
            yield done(parts, at)

    return run


def _appended(nodes: DataFrame, label: str, levels: int) -> DataFrame:
    """Nodes (tree, pos, digest, ..) with their witness inside their block and the block's root."""
    dealt = nodes.repartition(_partitions(nodes), F.col("tree"), F.expr(f"pos div {FAN**levels}")).sortWithinPartitions("tree", "pos")
    return written(dealt.mapInArrow(_append(levels), f"{_fields(nodes)}, path binary, siblings binary, top binary"), label)


def _grown(nodes: DataFrame, most: int, label: str, levels: int) -> list[DataFrame]:
    """Rounds of appending, the first of the nodes themselves, the last of one block for each tree."""
    size = FAN**levels
    rounds = [_appended(nodes, label, levels)]
    while most >= size:
        most //= size
        tops = rounds[-1].filter(f"pos % {size} = 0").select("tree", F.expr(f"pos div {size}").alias("pos"), F.col("top").alias("digest"))
        rounds.append(_appended(tops, label, levels))
    return rounds


def _extended(below: DataFrame, above: DataFrame, met: Column, carried: Sequence[str]) -> DataFrame:
    """Witnesses of ``below`` extended by those of the nodes above them, whose further columns come along."""
    b, a = below.alias("b"), above.alias("a")
    own = [F.col(f"b.{C.quoted(c)}") for c in below.columns if c not in ("path", "siblings", *carried)]
    longer = [F.concat(f"b.{c}", f"a.{c}").alias(c) for c in ("path", "siblings")]
    return b.join(a, met).select(*own, *longer, *[F.col(f"a.{c}") for c in carried])


def manifest(rows: DataFrame, leaf: Column, group: str, order: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """The rows with the columns ``MANIFEST`` and ``digest``: where each stands, its witness up to the root, and both roots.

    ``leaf`` is the digest of a row as 32 bytes. ``siblings`` are digests of 32 bytes each, ``path`` is a
    byte per level: the node's place among its run times 4, plus the size of the run. Blocks have ``levels`` levels, which changes no digest.
    """
    size = FAN**levels
    plain = rows.drop(*MANIFEST, "digest", "part", "top", "row")
    leaves = written(plain.select("*", leaf.alias("digest"), F.monotonically_increasing_id().alias("row")), "leaves")
    placed, trees, most = numbered(leaves, group, [*order, "digest", "row"])
    low = _grown(placed.drop("row"), most, "witnesses", levels)
    tops = low[-1].filter("pos = 0").select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.col("top").alias("digest"))
    high = _grown(tops, trees - 1, "group-witnesses", levels)
    above = high[-1].withColumnRenamed("top", "root").drop("digest")
    for r in reversed(high[:-1]):
        above = _extended(r.drop("top", "digest"), above, F.expr(f"b.pos div {size} = a.pos"), ["root"])
    out = _extended(low[-1].withColumnRenamed("top", "subroot"), above, F.expr("b.tree = a.pos"), ["root"])
    for r in reversed(low[:-1]):
        out = _extended(r.drop("top"), out.drop("digest"), F.expr(f"b.tree = a.tree AND b.pos div {size} = a.pos"), ["subroot", "root"])
    return out


def _folded(candidate: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, path, siblings, root = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (candidate, "path", "siblings", "root"))
            found = [None if d is None else fold(d, p, s) for d, p, s in zip(leaf, path, siblings)]
            good = [f == r for f, r in zip(found, root)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary()), pa.array(good, pa.bool_())], names=[*batch.schema.names, "folded_root", "verified"]
            )

    return run


def verify(manifest: DataFrame, candidate: str = "digest") -> DataFrame:
    """The manifest with the root that each row's candidate leaf and witness lead to, and whether it is the root.

    A null candidate (a row that is gone) leads nowhere and is not verified.
    """
    return manifest.mapInArrow(_folded(candidate), f"{_fields(manifest)}, folded_root binary, verified boolean")
