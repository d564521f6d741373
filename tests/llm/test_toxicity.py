import math
import random
import sys
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import toxicity as t
from plumbline.llm.words import _mixed, words_of

sys.setrecursionlimit(10_000)


def maximal(scores):
    """Ruzzo and Tompa's definition: take the best segment (the shortest, leftmost), then go on left and right of it."""
    best = None
    for a in range(len(scores)):
        total = 0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 0 and (best is None or (total, -(b - a), -a) > (best[2], -(best[1] - best[0] - 1), -best[0])):
                best = (a, b + 1, total)
    if best is None:
        return []
    a, b, s = best
    return maximal(scores[:a]) + [best] + [(x + b, y + b, z) for x, y, z in maximal(scores[b:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-6, 6).filter(bool), max_size=14))
def test_segments_match_the_definition(scores):
    # distinct sums, so that no ties decide
    values = [s + (2.0**-k) / 100 for k, s in enumerate(scores, 3)]
    got, want = t.segments(np.array(values)), maximal(values)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_segments_of_a_long_text_take_time_in_proportion():
    """Toxic words each followed by a worse clean one: every one is a segment of its own, and none is looked at twice."""
    scores = np.tile([1.0, -1.5], 300_000)
    begun = time.process_time()
    found = t.segments(scores)
    assert len(found) == 300_000 and time.process_time() - begun < 5
    # rising and falling, so that earlier segments are joined and passed over
    rng = np.random.default_rng(2)
    mixed = np.round(rng.normal(0, 1, 400), 3)
    assert [(a, b) for a, b, _ in t.segments(mixed)] == [(a, b) for a, b, _ in maximal(mixed.tolist())]


def test_surprise_grows_with_score_and_falls_with_length():
    m = t.Model(np.zeros(0, np.uint64), np.zeros(0), -0.1, 1.0, 0.01, 1.0, 0.0)
    one = lambda s, n: t.surprise([(0, 1, s)], n, m)
    assert one(12, 100) > one(8, 100) > one(8, 10_000) > 0 == t.surprise([], 5, m)
    assert t.surprise([(0, 1, 8), (4, 5, 8)], 100, m) > one(8, 100)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for k in range(600):
        w = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randint(1, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "nasty", "rotten"]))
        docs.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    return docs, labels


def test_planted_words_are_found_and_clean_text_left(spark, documents, corpus):
    docs, labels = corpus
    train = spark.createDataFrame([x for x in labels if x[0] < 400] + [(1, None), (10**9, 1)], "doc_id bigint, toxic int")
    more = [(None, "vile vile nasty"), (10_000, None), (10_001, ""), (10_002, "?!"), (10_003, "w1 " * 5000 + "rotten vile nasty " + "w2 " * 5000)]
    df = documents(*docs, *more, docs[0])
    model = t.train(spark, df, train)
    assert len(model.hashes) == 3 and model.slope > 0
    got = t.score(spark, df, model).collect()
    assert len(got) == len(docs) + 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[k].predicted == bad for k, bad in labels)
    assert by[None].predicted == by[10_003].predicted == 1
    assert by[10_000].score == by[10_001].score == by[10_002].score < 0.5
    p = by[10_003].passages
    assert [(x.start, x.end) for x in p] == [(5000, 5003)]
    assert {r.doc_id for r in t.accepted(spark, df, model).select("doc_id").collect()} == {r.doc_id for r in got if not r.predicted}


def test_word_scores_and_calibration_match_plain_sums(spark, documents, corpus):
    """Counts of distinct pairs, smoothed log-odds, lambda and K, recomputed without Spark."""
    docs, labels = corpus
    known = dict(labels)
    train = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = t.train(spark, documents(*docs, docs[5]), train)
    draws = {}
    for k, text in docs:
        w = words_of(pa.array([text]))
        before = np.concatenate([[np.uint64(0)], w.hash[:-1]])
        draw = _mixed(w.hash ^ _mixed(before + np.uint64(1)) ^ _mixed(np.uint64(k) + np.zeros(len(w.hash), np.uint64) + np.uint64(2))) & ~np.uint64(1) | np.uint64(known[k])
        for pair in zip(w.hash.tolist(), before.tolist(), draw.view(np.int64).tolist()):
            draws[pair[:2]] = min(draws.get(pair[:2], 1 << 63), pair[2])
    counts = {}
    for (word, _), draw in draws.items():
        counts.setdefault(word, [0, 0])[draw & 1] += 1
    good, bad = (sum(c[k] for c in counts.values()) for k in (0, 1))
    ratio = lambda c: 2 * sum(x * math.log(x * (good + bad) / (sum(c) * total)) for x, total in zip(c, (good, bad)) if x)
    chosen = {w: c for w, c in counts.items() if c[1] * good > c[0] * bad and ratio(c) >= 2 * math.log(len(counts))}
    assert set(chosen) == set(model.hashes.tolist()) and 0 < len(chosen) < t.LEXICON
    share = lambda x, c, total: (x + t.PRIOR * sum(c) / (good + bad)) / (total + t.PRIOR)
    q, p = ({w: share(c[k], c, (good, bad)[k]) for w, c in chosen.items()} for k in (1, 0))
    for w, s in zip(model.hashes.tolist(), model.scores.tolist()):
        assert math.isclose(s, math.log(q[w] / p[w]), rel_tol=1e-9)
    rest_q, rest_p = 1 - sum(q.values()), 1 - sum(p.values())
    assert math.isclose(model.other, math.log(rest_q / rest_p), rel_tol=1e-9)
    # random clean text scores so that the expectation of e^(lambda s) is 1
    assert abs(sum(p[w] * math.exp(model.decay * math.log(q[w] / p[w])) for w in p) + rest_p * math.exp(model.decay * model.other) - 1) < 1e-6
    # K makes the best segments of clean documents likeliest under exp(-K n e^(-lambda s))
    number = total = 0.0
    for k, text in [*docs, docs[5]]:
        if not known[k]:
            w = words_of(pa.array([text]))
            best = max((s for *_, s in maximal([float(x) for x in t.word_scores(w.hash, model)])), default=0.0)
            number, total = number + 1, total + len(w.hash) * math.exp(-model.decay * best)
    assert math.isclose(model.scale, number / total, rel_tol=1e-6)


def test_without_labels_of_both_kinds(spark, documents):
    df = documents((1, "a b"), (2, None))
    for labels, low in (([], 0.5), ([(1, 1)], 0.5), ([(1, 0)], 0.0)):
        model = t.train(spark, df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert {r.score >= low for r in t.score(spark, df, model).collect()} == {True}
    assert t.score(spark, df.limit(0), model).collect() == []


def test_held_out_accuracy(rows, duck):
    truth = dict(duck.execute("SELECT doc_id, toxic FROM labels").fetchall())
    held = [(r.predicted, truth[r.doc_id]) for r in rows("op3_toxicity") if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([p == x for p, x in held]) > 0.9
    assert not any(p for p, x in held if not x)
