import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from plumbline.llm import merkle as m
from plumbline.llm import queries
from tests.test_oracle import bag


def plain_tree(leaves):
    """Levels of a ternary tree of hex digests, the leaves first."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[i : i + 3]).encode()).hexdigest() for i in range(0, len(below), 3)])
    return levels


def plain_proof(levels, pos):
    out = []
    for level in levels[:-1]:
        first = pos // 3 * 3
        out += [d for i, d in enumerate(level[first : first + 3], first) if i != pos]
        pos //= 3
    return out


def leaf_of(*values):
    return hashlib.sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 242, 728, 729])
def test_a_block_of_any_size(n):
    leaves = [hashlib.sha256(bytes([k % 256, k // 256])).digest() for k in range(n)]
    frontier = m.Frontier()
    for leaf in leaves:
        frontier.append(leaf)
    levels = plain_tree([d.hex() for d in leaves])
    root = frontier.close(True)
    assert root.hex() == levels[-1][0]
    for k, leaf in enumerate(leaves):
        assert bytes(frontier.siblings[k]).hex() == "".join(plain_proof(levels, k))
        assert m.fold(leaf, bytes(frontier.path[k]), bytes(frontier.siblings[k])) == root


def test_witnesses_grow_as_siblings_are_completed():
    frontier = m.Frontier()
    digests = [bytes([k]) * 32 for k in range(5)]
    seen = []
    for d in digests:
        frontier.append(d)
        seen.append(len(frontier.siblings[0]) // 32)
    assert seen == [0, 1, 2, 2, 2]
    frontier.append(bytes([5]) * 32)  # completes the second run, a sibling one level up
    assert len(frontier.siblings[0]) // 32 == 3 and len(frontier.siblings[4]) // 32 == 3


def proved(df, partitions=5, levels=m.LEVELS):
    leaf = m.leaf_digest([F.col("doc_id"), F.col("source"), F.col("text")])
    return m.verify(m.manifest(df.repartition(partitions), leaf, "source", ["doc_id"], levels)).collect()


def check(rows, documents):
    groups = {}
    for doc_id, source, text in documents:
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf_of(doc_id, source, text)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([d for *_, d in sorted(groups[s])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    assert len(rows) == len(documents)
    for r in rows:
        levels = trees[r.source]
        want = plain_proof(levels, r.pos) + plain_proof(top, order.index(r.source))
        assert r.digest.hex() == levels[0][r.pos] == leaf_of(r.doc_id, r.source, r.text)
        assert (r.subroot.hex(), r.root.hex(), r.siblings.hex()) == (levels[-1][0], top[-1][0], "".join(want))
        assert r.verified and r.folded_root == r.root


@pytest.mark.parametrize("shape", ["hot", "many", "one", "single"])
def test_manifest_matches_plain_trees(spark, shape):
    rng = random.Random(shape)
    sources = {"hot": lambda k: "hot" if k % 3 else rng.choice(["a", None, "é", "Z", ""]), "many": lambda k: f"s{k}", "one": lambda k: "x", "single": lambda k: None}[shape]
    documents = [(k, sources(k), rng.choice([None, "", "text\n", "日本" * k])) for k in range(1 if shape == "single" else 150)]
    documents += [(7, "x", "again"), (7, "x", "again"), (None, "x", "no id"), (-3, "x", "first")] * (shape != "single")
    df = spark.createDataFrame([(*d, "clash", 1) for d in documents], "doc_id bigint, source string, text string, root string, pos int")
    check(proved(df, levels=2), documents)  # several blocks, and blocks of blocks


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(500).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'t' AS text")
    roots = {r.root for n in (1, 3, 20) for r in proved(df, n)}
    assert len(roots) == 1


def test_tampering_is_seen(spark):
    df = spark.createDataFrame([(k, "s", f"line {k}\n") for k in range(20)], "doc_id bigint, source string, text string")
    leaf = lambda text: m.leaf_digest([F.col("doc_id"), F.col("source"), text])
    rows = df.withColumn("given", F.when(F.col("doc_id") == 3, leaf(F.lit("other"))).when(F.col("doc_id") != 4, leaf(F.col("text"))))
    out = m.verify(m.manifest(rows, leaf(F.col("text")), "source", ["doc_id"]), "given").collect()
    assert {r.doc_id for r in out if not r.verified} == {3, 4}  # an altered leaf and one that is gone
    assert {r.doc_id for r in out if r.folded_root is None} == {4}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert proved(df) == []


def test_query_of_a_small_fixture_matches_sql(spark, tmp_path):
    """Nulls in every column, line ends in tampered and other rows, groups that are alone."""
    rows = [
        (1, "a", "en", 3, "x\ny"), (2, "a", None, None, None), (3, None, "de", 0, ""), (4, "é", "en", 4, "\n\n"), (5, "a", "en", 5, "plain"), (None, "b", "en", 1, "z\n"),
        (6, "", "fr", 6, "\n"), (7, "a", "en", 1, "é\n"), (7, "a", "en", 1, "é\n"), (8, "Z", "en", -1, "q"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = queries.ORACLES["op11_merkle"].replace(f"CASE WHEN {queries.CRC_SQL}", f"CASE WHEN doc_id IS NOT NULL AND {queries.CRC_SQL}")
    want = con.execute(sql)
    columns = [d[0] for d in want.description]
    got = queries.QUERIES["op11_merkle"](spark, str(tmp_path))
    assert bag(got.columns, [tuple(r) for r in got.collect()]) == bag(columns, want.fetchall())
    assert {r.verified for r in got.collect()} == {True, False}
