import random

import numpy as np
import pytest

from plumbline.llm import decontaminate as d
from tests.llm.test_words import plain


def brute(documents, items):
    """Windows compared word by word."""
    windows = []
    for item, text in items:
        w = plain(text)
        n = min(13, len(w))
        windows += [(item, w[k : k + n]) for k in range(len(w) - n + 1) if n]
    out = []
    for doc, text in documents:
        w = plain(text)
        hit, found = set(), set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    if item is not None:
                        found.add(str(item))
        out.append((doc, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(spark, documents, docs, items):
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    got = d.decontaminate(spark, documents(*docs), benchmark).collect()
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in got]


def test_matches_brute_force(spark, documents):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(9)] + ["É", "X"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate((1, 2, 5, 12, 13, 14, 30, 60))] + [(10, None), (11, "..."), (12, ""), (None, text(20)), (3, text(16)), (100, text(4)), (9, text(4))]
    items += [items[5], (21, items[6][1])]
    docs = [(k, text(n)) for k, n in enumerate((0, 1, 3, 13, 40, 200))] + [(20, None), (21, "?!"), (None, text(30))]
    for k, (_, t) in enumerate(items):
        w = (t or "").split()
        docs.append((30 + k, " ".join([text(25), *w[rng.randint(0, 2) : 17], text(300)])))
        docs.append((60 + k, "; ".join(w).upper()))
    docs += [docs[4], docs[4], (4, text(10))]
    key = lambda r: str(r)
    assert sorted(run(spark, documents, docs, items), key=key) == sorted(brute(docs, items), key=key)


def test_share_of_words_decides(spark, documents):
    item = " ".join(f"i{k}" for k in range(13))
    docs = [(1, item + " pad" * 247), (2, item + " pad" * 248), (3, item[:-2] + " pad" * 20)]
    got = {r[0]: r[5] for r in run(spark, documents, docs, [(1, item)])}
    assert got == {1: True, 2: False, 3: False}


def test_empty_tables(spark, documents):
    assert run(spark, documents, [(1, "a b")], []) == [(1, 2, 0, 0, [], False)]
    empty = documents((1, "a")).limit(0)
    assert d.decontaminate(spark, empty, spark.createDataFrame([(1, "a")], "item_id bigint, text string")).collect() == []


def test_accepted_documents_keep_their_columns(spark, documents):
    item = " ".join(f"i{k}" for k in range(20))
    df = documents((1, item), (2, "clean"), (None, item), (None, None), (2, "clean"))
    kept = d.accepted(spark, df, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) + str(r.text) for r in kept.collect()) == ["2clean", "2clean", "NoneNone"]


@pytest.mark.parametrize("n", [0, 5, 300_000])
def test_map_grows_with_the_fingerprints(spark, n):
    marks = np.random.default_rng(1).integers(-(2**63), 2**63, n)
    windows = spark.createDataFrame([(int(m),) for m in marks.tolist() * (2 if n == 5 else 1)], "mark bigint")
    held = d.bit_map(windows)
    assert 8 * len(held) == max(d.LEAST, 1 << (64 * n).bit_length() if n else 0)
    assert d.in_map(held, marks.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63, 100_000).astype(np.uint64)
    assert d.in_map(held, others).mean() <= 1.2 / d.SPARSE
