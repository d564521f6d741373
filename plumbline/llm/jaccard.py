"""Similarity join of documents by the Jaccard coefficient of their word n-grams.

Equal texts are one node. MinHash bands propose pairs of nodes; each pair's further MinHash values
are compared a few at a time and the pair is dropped once the posterior probability that its
similarity reaches the threshold is below a tolerance; the rest is verified exactly on the sets of
shingles. Pairs are compared inside tasks.

Documents of buckets of FAMILY or more make families, which have a set R of the shingles that most of a
few members hold. If x and y lack or add d shingles each, of which they share c, then by counting they are
similar at 0.8 exactly if 9 c >= far(x) + far(y) - |R|, where far = 5 * lacking + 4 * added. So members
with far(x) + far(y) <= |R| are links without being looked at, and counted from a histogram of far; and
members whose d is too small for the c they would need are none. Only the pairs between go through
MinHash values, and those that survive are decided by their c where they met, without being stored. Any R gives the same links; one in the middle of the family leaves few
pairs open, so a large group of near copies costs work and storage in proportion to its members, while
members at the edge of similarity among each other are still compared in pairs.

Surviving pairs of different families, or of none, are written as one array of partners per document and group; what leaves the
verification is, per document, how many links it has and a smaller document that it hangs together with.

A pair that shares several bands is handled in the first one only, so links are counted once. A bucket of
many documents or bytes is cut into blocks by hash, and every two blocks meet in a task of their own, so no
task holds more than two blocks.

A document of fewer words than a shingle has one shingle, all its words. Defined results: a null or
wordless text is linked to nothing; a class is named by its smallest doc_id (null if all are null,
and by the row's own doc_id for documents without words); repeated rows count as copies; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.store import same_rows, text_digest, written
from plumbline.llm.words import _mixed, grams, pieces, words_of

SHINGLE, THRESHOLD = 5, 0.8
#: Bands that propose pairs, values of a band, and further values that are compared ``STEP`` at a time. A pair at the
#: threshold shares no band with probability (1 - 0.8**3)**20 = 6e-7.
BANDS, BAND, STEP, STEPS = 20, 3, 4, 17
VALUES = BANDS * BAND + STEP * STEPS
#: Posterior probability below which a pair is dropped.
TOLERANCE = 1e-6
#: Documents of a bucket's block, and bytes of their texts.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
#: Bytes of rows that a task takes up at a time; a larger group is taken up whole.
HELD = 4 << 20
#: Documents of a bucket that make a family, and members that its set of shingles is taken from.
FAMILY, SAMPLE = 32, 32

_SEEDS = _mixed(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
_FACTORS, _TERMS = _SEEDS[:VALUES] | np.uint32(1), _SEEDS[VALUES:]


def shingles(w, count: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner) of the shingles of texts 0 to count - 1, in order, repeats included."""
    n = np.diff(w.first)
    all_grams = grams(w.hash, size)
    owner = np.repeat(np.arange(count), n)[: len(all_grams)]
    whole = np.arange(len(all_grams)) + size <= w.first[owner + 1]
    values, owners = [all_grams[whole]], [owner[whole]]
    for i in np.flatnonzero((n > 0) & (n < size)).tolist():
        values.append(grams(w.hash[w.first[i] : w.first[i + 1]], int(n[i])))
        owners.append(np.array([i]))
    values, owners = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return values[order], owners[order]


def signatures(values: np.ndarray, owners: np.ndarray, count: int) -> np.ndarray:
    """MinHash values (count x VALUES); rows of texts without shingles are meaningless."""
    out = np.zeros((count, VALUES), np.uint32)
    there, first = np.unique(owners, return_index=True)
    if len(there):
        x = (values >> np.uint64(32)).astype(np.uint32)
        h = np.empty_like(x)
        for k in range(VALUES):
            np.multiply(x, _FACTORS[k], out=h)
            np.add(h, _TERMS[k], out=h)
            out[there, k] = np.minimum.reduceat(h, first)
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """Of n = STEP, 2 STEP, ... compared values, the fewest matches at which P(similarity >= threshold) reaches the tolerance.

    The similarity has a uniform prior, so its posterior after m of n matches is Beta(m + 1, n - m + 1).
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(STEP, STEP * STEPS + 1, STEP):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(s) + (n - m) * np.log1p(-s)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        reach = weight[:, s >= threshold].sum(axis=1) / weight.sum(axis=1)
        out.append(int(np.argmax(reach >= tolerance)))
    return np.array(out)


def survivors(signature: np.ndarray, p: np.ndarray, q: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which of the pairs (p, q) stay, comparing STEP values at a time."""
    live, matches = np.arange(len(p)), np.zeros(len(p), np.int32)
    for k in range(STEPS):
        columns = slice(BANDS * BAND + k * STEP, BANDS * BAND + (k + 1) * STEP)
        matches[live] += (signature[p[live], columns] == signature[q[live], columns]).sum(axis=1, dtype=np.int32)
        live = live[matches[live] >= least[k]]
        if not len(live):
            break
    return live


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in pieces(texts):
            w = words_of(texts.slice(a, b - a))
            signature = signatures(*shingles(w, b - a), b - a)
            has = np.diff(w.first) > 0
            raw = signature.tobytes()
            width = 4 * VALUES
            signed = pa.array([raw[i * width : (i + 1) * width] if has[i] else None for i in range(b - a)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("digest").slice(a, b - a), batch.column("size").slice(a, b - a), signed], names=["doc_id", "digest", "size", "signature"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], enough: int):
    """Tables of whole groups of rows that are equal in ``keys``, from batches sorted by them, with group numbers; ``enough`` bytes or more at a time."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        columns = [table.column(k).to_numpy() for k in keys]
        new = np.zeros(table.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        return np.cumsum(new)

    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) < enough:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        group = cut(table)
        last = int(np.searchsorted(group, group[-1]))
        if last:
            yield table.slice(0, last), group[:last]
            held = table.slice(last).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, cut(table)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct shingles of each text."""
    for batch in batches:
        for a, b in pieces(batch.column("text")):
            found = pa.array(list(_shingle_sets(batch.column("text").slice(a, b - a))), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("family").slice(a, b - a), found], names=["family", "shingles"])


def _shingle_sets(texts) -> Iterator[np.ndarray]:
    values, owners = shingles(words_of(texts), len(texts))
    for one in np.split(values, np.searchsorted(owners, np.arange(1, len(texts)))):
        yield np.unique(one.view(np.int64))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each member differs from its family's shingles, which come as the first row of its part of the family."""
    middle = np.zeros(0, np.int64)
    for batch in batches:
        given = batch.column("middle")
        for a, b in pieces(batch.column("text")):
            node, family = batch.column("node").slice(a, b - a), batch.column("family").slice(a, b - a)
            rows, out = [], []
            for k, own in enumerate(_shingle_sets(batch.column("text").slice(a, b - a))):
                if given[a + k].is_valid:
                    middle = np.sort(given[a + k].values.to_numpy())
                    continue
                differs = np.setxor1d(own, middle, assume_unique=True)
                lacking = (len(middle) + len(differs) - len(own)) // 2
                rows.append(k)
                out.append((len(middle), 4 * len(differs) + lacking, differs))
            size, far, differs = zip(*out) if out else ((), (), ())
            size, far, differs = pa.array(size, pa.int64()), pa.array(far, pa.int64()), pa.array(differs, pa.list_(pa.int64()))
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([node.take(rows), family.take(rows), size, far, differs], names=["node", "family", "middle", "far", "differs"])


def _told(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Rows (node, bucket, m, ..) with the columns of their bucket; a bucket of m rows meets them in as many parts as it has blocks."""
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    return dealt.join(buckets.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("m"), ["bucket", "part"]).drop("part")


def families(near: DataFrame, held: DataFrame) -> DataFrame:
    """Rows (node, family, middle, far, differs): the members of families, the size of the family's set of shingles, and the shingles they lack or add."""
    label = near.filter(F.col("m") >= FAMILY).select("node", "bucket", "m", F.col("node").alias("family"))
    for _ in range(2):  # the smallest node of all buckets of a node, and of theirs
        least = label.groupBy("bucket").agg(F.min("family").alias("least"), F.max("m").alias("m"))
        reached = _told(label, least).groupBy("node").agg(F.min("least").alias("family"))
        label = label.select("node", "bucket", "m").join(reached, "node")
    members = written(label.select("node", "family").distinct().join(held, "node"), "families")

    order = Window.partitionBy("family").orderBy(F.xxhash64("node"), "node")
    few = members.select("family", "node").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE)
    sets = few.select("family", "node").join(members, ["family", "node"]).mapInArrow(_sets, "family bigint, shingles array<bigint>")
    held_by = sets.select("family", F.explode("shingles").alias("shingle")).groupBy("family", "shingle").agg(F.count(F.lit(1)).alias("n"))
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes"))
    most = held_by.join(sizes, "family").filter(2 * F.col("n") > F.least("members", F.lit(SAMPLE)))
    parts = sizes.select("family", _blocks("members", "bytes").alias("parts"))
    # a family without a shingle that most hold has an empty set
    middles = parts.join(most.groupBy("family").agg(F.collect_list("shingle").alias("middle")), "family", "left")
    first = middles.select(
        "family", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(-1).cast("bigint").alias("node"), F.lit("").alias("text"),
        F.coalesce("middle", F.array().cast("array<bigint>")).alias("middle"),
    )
    rest = members.join(parts, "family").select("family", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), "node", "text", F.lit(None).cast("array<bigint>").alias("middle"))
    dealt = first.unionByName(rest).repartition("family", "part").sortWithinPartitions("family", "part", "node")
    return written(dealt.mapInArrow(_measure, "node bigint, family bigint, middle bigint, far bigint, differs array<bigint>"), "members")


def sure_links(members: DataFrame) -> DataFrame:
    """Rows (node, links, root) of the members (with their copies) that their family's set proves to be links."""
    counts = members.groupBy("family", "middle", "far").agg(F.sum("copies").alias("n"), F.min("node").alias("node"))
    # a member is linked to all that are no farther than the rest of the set's size
    asked = counts.select("family", (F.col("middle") - F.col("far")).alias("at"), F.lit(0).cast("bigint").alias("n"), F.col("far").alias("far"))
    points = asked.unionByName(counts.select("family", F.col("far").alias("at"), "n", F.lit(None).cast("bigint").alias("far")))
    running = Window.partitionBy("family").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    within = points.withColumn("within", F.sum("n").over(running)).filter("far IS NOT NULL").select("family", "far", "within")
    nearest = counts.groupBy("family").agg(F.min(F.struct("far", "node")).alias("nearest"))
    found = members.join(within, ["family", "far"]).join(nearest, "family")
    links = F.col("within") - F.when(2 * F.col("far") <= F.col("middle"), F.col("copies")).otherwise(0)
    return found.select("node", links.alias("links"), F.col("nearest.node").alias("root")).filter("links > 0")


def _blocks(rows: str, size: str):
    return F.greatest(F.ceil(F.col(rows) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES), F.lit(1)).cast("int")


_PLACE = ["bucket", "i", "j"]
_MEMBER = ["family", "middle", "far", "differs"]


def _top(root: list[int], k: int) -> int:
    while root[k] != k:
        root[k] = root[root[k]]
        k = root[k]
    return k


def _hang(root: list[int], node: np.ndarray, a: int, b: int) -> None:
    """a and b hang together, on the smaller node of their tops."""
    low, high = sorted((_top(root, a), _top(root, b)), key=lambda k: node[k])
    root[high] = low


def _open_ranges(group: np.ndarray, family: np.ndarray, middle: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of rows sorted by group, family and falling distance: where the row's undecided relatives (from the next row on) end, where its family ends and its group."""
    n = len(group)
    new = np.ones(n, bool)
    new[1:] = (group[1:] != group[:-1]) | (family[1:] != family[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    family_end = np.repeat(end, end - start)
    open_end = np.arange(n) + 1
    for a, b in zip(start[end - start > 1].tolist(), end[end - start > 1].tolist()):
        open_end[a:b] = np.maximum(open_end[a:b], a + np.searchsorted(-far[a:b], far[a:b] - middle[a:b], "left"))
    return open_end, family_end, np.searchsorted(group, group, "right")


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Undecided pairs inside a group that survive: of one family, decided by what differs from its set and counted;
    others as one row per document with the other documents it may be similar to."""
    least = least_matches()
    for table, group in _groups(batches, _PLACE, HELD):
        family, middle, far = (table.column(c).to_numpy() for c in ("family", "middle", "far"))
        order = np.lexsort((-far, family, group))
        group, family, middle, far = group[order], family[order], middle[order], far[order]
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, VALUES)[order]
        table = table.drop_columns(["signature"]).take(pa.array(order))
        differs = table.column("differs").combine_chunks()
        apart = pc.fill_null(pc.list_value_length(differs), 0).to_numpy().astype(np.int64)
        node, band, block, copies = (table.column(c).to_numpy() for c in ("node", "band", "block", "copies"))
        links, root = np.zeros(len(node), np.int64), list(range(len(node)))
        across = table.column("i").to_numpy() != table.column("j").to_numpy()
        triples = np.ascontiguousarray(signature[:, : BANDS * BAND]).reshape(-1, BANDS, BAND)
        open_end, family_end, group_end = _open_ranges(group, family, middle, far)
        left, right = [], []
        for begin, end in ((np.arange(len(group)) + 1, open_end), (family_end, group_end)):
            at, step = np.flatnonzero(begin < end), 0
            while len(at):  # the next partner of all rows at once
                p, q = at, begin[at] + step
                fit = ~across[p] | (block[p] != block[q])
                fit &= (family[p] != family[q]) | (9 * np.minimum(apart[p], apart[q]) >= far[p] + far[q] - middle[p])
                p, q = p[fit], q[fit]
                alive = survivors(signature, p, q, least)
                p, q = p[alive], q[alive]
                # only in the first band that the two share
                same = (triples[p] == triples[q]).all(axis=2)
                own = same.argmax(axis=1) == band[p]
                p, q = p[own], q[own]
                kin = family[p] == family[q]
                left.append(p[~kin])
                right.append(q[~kin])
                for a, b in zip(p[kin].tolist(), q[kin].tolist()):
                    shared = np.intersect1d(differs[a].values.to_numpy(), differs[b].values.to_numpy(), assume_unique=True)
                    if 9 * len(shared) >= far[a] + far[b] - middle[a]:
                        links[a] += copies[b]
                        links[b] += copies[a]
                        _hang(root, node, a, b)
                step += 1
                at = at[begin[at] + step < end[at]]
        p, q = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        order = np.argsort(p, kind="stable")
        p, q = p[order], q[order]
        rows = np.union1d(np.union1d(p, q), np.flatnonzero(links))
        first = np.append(np.searchsorted(p, rows), len(p)).astype(np.int32)
        picked = table.select(_PLACE + ["node"]).take(pa.array(rows))
        partners = pa.ListArray.from_arrays(pa.array(first), pa.array(node[q]))
        paired = pa.array(np.isin(rows, np.concatenate((p, q))))
        roots = pa.array(np.array([node[_top(root, k)] for k in rows.tolist()], np.int64))
        yield from picked.append_column("partners", partners).append_column("paired", paired).append_column("links", pa.array(links[rows])).append_column("root", roots).to_batches()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact similarity of the surviving pairs: per group and document, the number of linked documents and the smallest document it hangs together with."""
    for table, group in _groups(batches, _PLACE, HELD):
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        texts = table.column("text").combine_chunks()
        sets: list[np.ndarray] = []
        for a, b in pieces(texts):
            sets += _shingle_sets(texts.slice(a, b - a))
        place = {(g, n): k for k, (g, n) in enumerate(zip(group.tolist(), node.tolist()))}
        links = np.zeros(len(node), np.int64)
        root = list(range(len(node)))

        for (g, n), k in place.items():
            for other in table.column("partners")[k].as_py():
                m = place[g, other]
                shared = len(np.intersect1d(sets[k], sets[m], assume_unique=True))
                # at least 4 in 5, in whole numbers
                if 5 * shared >= 4 * (len(sets[k]) + len(sets[m]) - shared):
                    links[k] += copies[m]
                    links[m] += copies[k]
                    _hang(root, node, k, m)
        kept = np.flatnonzero(links)
        roots = np.array([node[_top(root, k)] for k in kept.tolist()], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(node[kept]), pa.array(links[kept]), pa.array(roots)], names=["node", "links", "root"])


def classes(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, digest, class_id, n_links, first), one per document row: its text's digest, its class of
    documents that hang together by links of similarity THRESHOLD or more, the number of documents linked to it
    directly, copies included, and whether it is the one document that stands for its class."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", text_digest().alias("digest"), "text")
    signed = texts.select("doc_id", "digest", F.octet_length("text").alias("size"), "text").mapInArrow(_sign, "doc_id bigint, digest binary, size int, signature binary")
    # one node per text, combined before the shuffle
    distinct = signed.filter("signature IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("signature").alias("signature")
    )
    nodes = written(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")

    bands = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"), "signature")
    bands = bands.select("node", "band", F.xxhash64("band", F.substring("signature", 1 + 4 * BAND * F.col("band"), F.lit(4 * BAND))).alias("bucket"))
    near = written(bands.join(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "bucket"), "bands")

    # texts of the documents that share a bucket; repeated rows are combined before the shuffle
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    stored = texts.groupBy("digest", key.alias("at")).agg(F.first("text").alias("text"))
    meeting = nodes.join(near.select("node").distinct(), "node").select("node", "digest", F.coalesce("rep", F.lit(-(1 << 63))).alias("at"))
    held = written(stored.join(meeting, ["digest", "at"]).select("node", "text"), "texts")

    members = families(near, held).join(nodes.select("node", "copies"), "node")
    # a document outside all families is one of its own
    placed = nodes.select("node", "size", "copies", "signature").join(members.select("node", *_MEMBER), "node", "left")
    placed = placed.withColumn("family", F.coalesce("family", -1 - F.col("node"))).na.fill(0, ["middle", "far"])
    found = near.join(placed, "node")
    kinds = found.groupBy("bucket").agg(
        F.max("m").alias("m"), F.sum(F.col("size").cast("bigint")).alias("bytes"), (F.min("family") != F.max("family")).alias("mixed"), F.max("far").alias("farthest")
    )
    # what is a link to all others of its bucket for sure needs no look there
    open_ = _told(found, kinds).filter(F.col("mixed") | (F.col("far") + F.col("farthest") > F.col("middle"))).withColumn("blocks", _blocks("m", "bytes"))
    met = open_.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "band", "node", "copies", *_MEMBER, "signature")
    ready = met.repartition(*_PLACE).sortWithinPartitions(*_PLACE, "node")
    pairs = written(ready.mapInArrow(_prune, "bucket bigint, i int, j int, node bigint, partners array<bigint>, paired boolean, links bigint, root bigint"), "pairs")
    decided = pairs.filter("links > 0").select("node", "links", "root")

    loaded = pairs.filter("paired").join(nodes.select("node", "copies"), "node").join(held, "node").select(*_PLACE, "node", "copies", "partners", "text")
    compared = loaded.repartition(*_PLACE).sortWithinPartitions(*_PLACE, "node").mapInArrow(_verify, "node bigint, links bigint, root bigint")
    verified = written(compared.unionByName(decided).unionByName(sure_links(members.drop("differs"))), "links")

    labels = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.select("node", "digest", "rep", "copies").join(labels, "node", "left").join(links, "node", "left")
    placed = placed.withColumn("label", F.coalesce("label", "node"))
    # the smallest doc_id of a class, and the text it has; nulls last
    last = F.lit((1 << 63) - 1)
    names = placed.groupBy("label").agg(F.min(F.struct(F.coalesce("rep", last).alias("id"), "digest")).alias("least"))
    known = placed.join(names, "label").select(
        "digest", F.nullif("least.id", last).alias("class_id"), F.col("least.digest").alias("best"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"), F.lit(True).alias("worded"),
    )
    worded, row = F.coalesce("worded", F.lit(False)), texts.select("doc_id", "digest").join(known, "digest", "left")
    return row.select(
        "doc_id", "digest", F.when(worded, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        (~worded | (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("best")))).alias("first"),
    )


def similar(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, class_id, n_links), one per document row."""
    return classes(documents).select("doc_id", "class_id", "n_links")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document, all columns, of each class; rows that repeat id and text are one document."""
    kept = classes(documents).filter("first")
    return same_rows(documents, kept, "left_semi").dropDuplicates(["doc_id", "__digest"]).drop("__digest")
