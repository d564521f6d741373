import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import jaccard
from plumbline.llm.components import components
from plumbline.llm.store import written
from tests.llm.test_words import plain


def brute(docs):
    sets = []
    for _, t in docs:
        w = plain(t)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    n = len(docs)
    link = [[i != j and bool(sets[i]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            todo += [j for j in range(n) if link[k][j] and j not in seen]
            seen |= {j for j in range(n) if link[k][j]}
        ids = [docs[j][0] for j in seen if docs[j][0] is not None]
        out.append((docs[i][0], min(ids, default=None), sum(link[i])))
    return out


@pytest.mark.parametrize("block, family", [(1024, 32), (3, 32), (1024, 3), (3, 5)])
def test_groups_of_edited_copies_match_brute_force(spark, documents, block, family, monkeypatch):
    """Near copies of all degrees, beyond one block, with exact copies, equal ids and null ids among them, in families or not."""
    rng = random.Random(block)
    docs = []
    for g in range(4):
        base = [f"g{g}w{rng.randint(0, 500)}" for _ in range(rng.choice([8, 40, 90]))]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = f"n{rng.randint(0, 10**6)}"
            docs.append((len(docs) * 7 % 1000 + 1, " ".join(w)))
    docs += [(None, docs[3][1]), (5000, docs[3][1]), (5000, docs[3][1]), (6000, None), (6001, ""), (6002, "--")]
    # the block size reaches the plan as a literal, so a small one makes many blocks meet
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FAMILY", family)
    got = [(r.doc_id, r.class_id, r.n_links) for r in jaccard.similar(documents(*docs)).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(brute(docs), key=key)


def test_sets_around_a_middle_decide_like_whole_sets():
    """What is a link for sure, what is none and what is open, against the sets, for any middle."""
    rng = random.Random(5)
    open_pairs = 0
    for _ in range(3000):
        middle = set(rng.sample(range(40), rng.choice([0, 10, 30, 40])))
        x, y = (set(rng.sample(sorted(middle), rng.randint(max(0, len(middle) - 4), len(middle)))) | set(rng.sample(range(100, 110), rng.randint(1, 3))) for _ in "xy")
        far = [5 * len(middle - z) + 4 * len(z - middle) for z in (x, y)]
        shared = len((x ^ middle) & (y ^ middle))
        link = 5 * len(x & y) >= 4 * len(x | y)
        assert link == (9 * shared >= sum(far) - len(middle))
        if sum(far) <= len(middle):
            assert link
        elif 9 * min(len(x ^ middle), len(y ^ middle)) < sum(far) - len(middle):
            assert not link
        else:
            open_pairs += 1
    assert open_pairs > 100


def test_open_ranges():
    group = np.array([0, 0, 0, 0, 0, 1, 1])
    family = np.array([-5, 7, 7, 7, 9, 7, 7])
    open_end, family_end, group_end = jaccard._open_ranges(group, family, np.full(7, 100), np.array([0, 90, 60, 5, 40, 50, 50]))
    assert open_end.tolist() == [1, 3, 3, 4, 5, 6, 7]
    assert family_end.tolist() == [1, 4, 4, 4, 5, 7, 7] and group_end.tolist() == [5] * 5 + [7] * 2


def stored(monkeypatch):
    """What the operator writes, as (label, rows, entries of lists) in order."""
    seen = {}

    def note(df, label):
        out = written(df, label)
        entries = out.agg(F.sum(F.size("partners"))).first()[0] if "partners" in out.columns else 0
        seen[label] = (out.count(), entries or 0)
        return out

    monkeypatch.setattr(jaccard, "written", note)
    return seen


def test_a_large_group_is_stored_in_proportion(spark, documents, monkeypatch):
    """Near copies, each with a word of its own: every one is linked to all others, and no pair is stored."""
    seen = stored(monkeypatch)
    rows = {}
    for m in (500, 2000):
        rng = random.Random(m)
        base = [f"w{k}" for k in range(200)]
        docs = [(k, " ".join(base[:p] + [f"own{k}"] + base[p + 1 :])) for k, p in enumerate(rng.choices(range(200), k=m))]
        got = jaccard.similar(documents(*docs)).collect()
        assert {(r.class_id, r.n_links) for r in got} == {(0, m - 1)} and len(got) == m
        rows[m] = dict(seen)
    for label in ("nodes", "texts", "members", "links"):
        assert rows[2000][label][0] <= 4.2 * rows[500][label][0]
    assert rows[2000]["pairs"] == rows[500]["pairs"] == (0, 0)


def test_far_members_of_a_large_group(spark, documents):
    """Two variants and stragglers beside a large group, all in one family or several, as brute force has them."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(80)]
    variant = base[:30] + [f"v{k}" for k in range(9)] + base[39:]
    docs = []
    for k in range(160):
        w = list(rng.choice([base, base, variant]))
        for p in rng.sample(range(80), rng.choice([0, 1, 1, 2, 3])):
            w[p] = f"n{rng.randint(0, 40)}"
        docs.append((k, " ".join(w)))
    docs += [(200 + k, " ".join([f"z{k}"] + base[:70])) for k in range(3)]
    got = [(r.doc_id, r.class_id, r.n_links) for r in jaccard.similar(documents(*docs)).collect()]
    assert sorted(got) == sorted(brute(docs))


def test_pruning_keeps_similar_and_drops_others():
    least = jaccard.least_matches()
    assert len(least) == jaccard.STEPS and (np.diff(least) >= 0).all() and least[-1] > 25
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**32, jaccard.VALUES, dtype=np.uint32)
    rows = [base]
    for share in [0.8] * 300 + [0.2] * 300:
        rows.append(np.where(rng.random(jaccard.VALUES) < share, base, rng.integers(0, 2**32, jaccard.VALUES, dtype=np.uint32)))
    kept = jaccard.survivors(np.array(rows), np.zeros(600, int), np.arange(1, 601), least)
    assert (kept < 300).sum() == 300 and (kept >= 300).sum() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(k, 100) for k in range(101, 130)] + [(200, 200)] + [(300, 299), (299, 300)]
    rng = random.Random(2)
    rng.shuffle(chain)
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 130)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_one_of_each(spark, documents):
    near = " ".join(f"w{i}" for i in range(50))
    df = documents((3, near), (2, near + " x"), (2, "something else entirely"), (9, "a b"), (9, "a b"), (4, None), (5, None), (6, "!"), (None, near))
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text)
    assert got == sorted([("2", near + " x"), ("2", "something else entirely"), ("6", "!"), ("9", "a b")])
    assert sorted(str(r.doc_id) for r in kept.filter("text IS NULL").collect()) == ["4", "5"]


def test_empty_table(spark, documents):
    assert jaccard.similar(documents((1, "a")).limit(0)).collect() == []
    assert jaccard.similar(documents((1, None), (2, ""))).count() == 2
