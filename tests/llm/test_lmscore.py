import math
import random

import numpy as np
import pyarrow as pa

from plumbline.llm import lmscore as lm
from plumbline.llm.words import Lookup, words_of


def small(seed=0):
    rng = np.random.default_rng(seed)
    net = lm.untrained(rng.integers(0, 100, lm.IDS).astype(float), seed)
    return lm.unpacked(net.packed())


def test_probabilities_sum_to_one_and_do_not_see_the_token():
    net = small()
    rng = np.random.default_rng(1)
    around = rng.integers(0, lm.IDS + 1, (1, 2 * lm.SIDE))
    total = np.exp(lm.log_probabilities(net, np.repeat(around, lm.IDS, axis=0), np.arange(lm.IDS))).sum()
    assert abs(total - 1) < 1e-4
    ids, first = np.array([5, 6, 7, 8, 9]), np.array([0, 2, 2, 5])
    got = lm.windows(ids, first, np.arange(5))
    pad = lm.IDS
    assert got.tolist() == [[pad] * 3 + [6, pad, pad], [pad, pad, 5] + [pad] * 3, [pad] * 3 + [8, 9, pad], [pad, pad, 7, 9, pad, pad], [pad, 7, 8] + [pad] * 3]


def test_gradient_matches_differences():
    net = lm.Network(*(x.astype(np.float64) for x in small(2)))
    rng = np.random.default_rng(3)
    around, ids = rng.integers(0, lm.IDS + 1, (6, 2 * lm.SIDE)), rng.integers(0, lm.IDS, 6)
    after = lm.Network(*(x.copy() for x in net))
    grown = lm.Network(*(np.full_like(x, 1e-30) for x in net))
    lm.learn(after, around, ids, grown)  # the squared gradient is left in ``grown``
    for part, total, at in ((0, grown.embedding, (around[2, 1], 3)), (1, grown.hidden, (7, 2)), (3, grown.to_class, (4, ids[0] // lm.CLASS)), (5, grown.to_id, (ids[1] // lm.CLASS, 3, ids[1] % lm.CLASS)), (2, grown.hidden_bias, (5,))):
        values = []
        for step in (1e-5, -1e-5):
            moved = lm.Network(*(x.copy() for x in net))
            moved[part][at] += step
            values.append(lm.log_probabilities(moved, around, ids).mean())
        assert abs(abs(values[0] - values[1]) / 2e-5 - math.sqrt(total[at])) < 1e-6


def test_training_learns_what_follows(spark, documents):
    """Words that always come in one order are foretold from their neighbours."""
    rng = random.Random(0)
    cycle = [f"w{i}" for i in range(12)]
    docs = []
    for k in range(300):
        s = rng.randrange(12)
        docs.append((k, " ".join(cycle[(s + j) % 12] for j in range(150))))
    shuffled = " ".join(rng.choice(cycle) for _ in range(150))
    df = documents(*docs, (1000, shuffled), (1001, None), (1002, ""), (None, "unheard"), (0, docs[0][1]))
    words, flat = lm.train(spark, df)
    assert len(words.ids.keys) >= 12
    got = {r.doc_id: r for r in lm.score(spark, df, (words, flat)).collect()}
    assert got[5]["mean"] > got[1000]["mean"] + 0.5 and got[5]["mean"] > -math.log(12) + 0.5
    assert got[1001].score == got[1002].score == 0 and got[1001]["mean"] is None and got[1001].n_tokens == 0
    assert got[None].n_tokens == 1 and got[None].score < got[5]["mean"]
    # the sum is that of the tokens
    w = words_of(pa.array([docs[5][1]]))
    assert np.isclose(lm.token_scores(w, words, lm.unpacked(flat)).sum(), got[5].score)


def test_every_token_is_trained_on_once(spark, documents, monkeypatch):
    """The rounds' weights are the tokens they trained on: together all of the corpus, repeated rows included."""
    rng = random.Random(3)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60)))) for k in range(400)]
    weights, average = [], lm.averaged

    def counted(parts):
        parts = parts.cache()
        weights.append(sum(r.n for r in parts.select("n").collect()))
        return average(parts)

    monkeypatch.setattr(lm, "averaged", counted)
    lm.train(spark, documents(*docs, docs[5], (900, None), (901, "")))
    assert sum(weights) == sum(len(t.split()) for _, t in [*docs, docs[5]]) and all(weights) and len(weights) == lm.ROUNDS


def test_rare_words_take_their_share_of_the_bucket(spark, documents, monkeypatch):
    """The probabilities of all words, and of one unseen word a bucket, sum to one; held or joined, the counts are the same."""
    often = [f"r{k}" for k in range(3000) for _ in range(1 + k % 3)]
    random.Random(1).shuffle(often)
    docs = [(k, " ".join(["a b c d"] * 5 + often[100 * k : 100 * k + 100])) for k in range(60)]
    df = documents(*docs, (60, "a r5 r5 never"), (60, "a r5 r5 never"), (61, None))
    words, flat = lm.train(spark, df, rounds=0)
    assert words.table is None
    net = lm.unpacked(flat)
    ids = np.arange(lm.IDS)
    every = np.exp(lm.log_probabilities(net, np.full((lm.IDS, 2 * lm.SIDE), lm.IDS), ids))
    w = words_of(pa.array([x for x in {"a", "b", "c", "d", "never", *often}]))  # each without neighbours
    own = np.exp(lm.token_scores(w, words, net))
    assert abs(own.sum() + (every[lm.FREQUENT:] * np.exp(-words.totals)).sum() - 1) < 1e-3
    want = {r.doc_id: r for r in lm.score(spark, df, (words, flat)).collect()}
    monkeypatch.setattr(lm, "COMMON", 50)
    other, _ = lm.train(spark, df, rounds=0)
    got = lm.score(spark, df, (other, flat)).collect()
    assert other.table is not None and len(other.common.keys) <= 50 and len(got) == 63
    assert all(r.n_tokens == want[r.doc_id].n_tokens and np.isclose(r.score, want[r.doc_id].score) for r in got)
    # two words of a bucket differ by the ratio of their counts, unseen words count as one
    n = {x: 1 + int(x[1:]) % 3 for x in often}
    place = {x: int(words(words_of(pa.array([x])).hash)[0]) for x in [*n, "unseen"]}
    asked = [x for x in place if place[x] >= lm.FREQUENT]
    alone = lm.score(spark, documents(*enumerate(asked)), (other, flat)).collect()
    assert {n.get(x, 1) for x in asked} == {1, 2}
    for r in alone:
        x = asked[r.doc_id]
        assert np.isclose(r.score, np.log(every[place[x]]) - words.totals[place[x] - lm.FREQUENT] + math.log(n.get(x, 1)), atol=1e-4)


def test_averages_are_weighted_and_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN", 3)
    size = len(small().packed())
    rows = [(n, (np.full(size, v, np.float32) * n).tobytes()) for n, v in ((k + 1, float(k)) for k in range(11))]
    got = lm.averaged(spark.createDataFrame(rows, "n bigint, sums binary"))
    assert np.allclose(got, sum(k * (k + 1) for k in range(11)) / sum(range(1, 12)))
    assert lm.averaged(spark.createDataFrame([], "n bigint, sums binary")) is None


def test_empty_table(spark, documents):
    df = documents((1, "a")).limit(0)
    assert lm.score(spark, df, lm.train(spark, df)).collect() == []


def test_ids_of_rare_words_are_buckets():
    words = lm.Vocabulary(Lookup(np.array([5, 9], np.uint64), np.arange(2), -1))
    ids = words(np.array([9, 5, 1 << 21, 3 << 20], np.uint64))
    assert ids.tolist() == [1, 0, lm.FREQUENT + 2, lm.FREQUENT + 3]


def test_scores_of_the_corpus_beat_word_frequencies(rows, duck):
    """A network that had learnt nothing would be no better than the best model without context: each word's share of the corpus."""
    got = rows("op7_lmscore")
    assert all((r.n_tokens == 0) == (r["mean"] is None) and r.score <= 0 for r in got)
    texts = pa.array([t for (t,) in duck.execute("SELECT text FROM documents").fetchall()])
    counts = np.unique(words_of(texts).hash, return_counts=True)[1]
    tokens = sum(r.n_tokens for r in got)
    assert tokens == counts.sum()
    shares = float((counts * np.log(counts / tokens)).sum() / tokens)
    assert sum(r.score for r in got) / tokens > shares + 0.2


def test_a_task_gives_each_word_on_once(monkeypatch):
    """Slices are added up before Spark gets them, where each slice gave its words on before; a full task goes on with new ones."""
    text = "alpha beta alpha gamma " * 60_000  # 1.4 MB, so each text is a slice
    batch = pa.RecordBatch.from_arrays([pa.array([text, None, text, "", text + "delta"])], names=["text"])
    want = {int(h): n for h, n in zip(words_of(pa.array(["alpha beta gamma delta"])).hash.view(np.int64), (360_000, 180_000, 180_000, 1))}
    for held, most in ((lm.HELD, 4), (3, 8)):
        monkeypatch.setattr(lm, "HELD", held)
        got, rows = {}, 0
        for part in lm._count(iter([batch])):
            for word, n in zip(*(c.to_pylist() for c in part.columns)):
                got[word], rows = got.get(word, 0) + n, rows + 1
        assert got == want and rows <= most
    assert list(lm._count(iter([batch.slice(1, 1), batch.slice(3, 1)]))) == []


def test_windows_stay_within_their_texts():
    rng = np.random.default_rng(4)
    size = np.array([0, 1, 0, 5, 2, 9, 0, 3, 0])
    first = np.concatenate([[0], np.cumsum(size)])
    ids = rng.integers(0, lm.IDS, first[-1])
    texts = [ids[a:b].tolist() for a, b in zip(first, first[1:])]
    want = [[t[i + k] if 0 <= i + k < len(t) else lm.IDS for k in lm._OFFSETS] for t in texts for i in range(len(t))]
    assert lm.windows(ids, first, np.arange(len(ids))).tolist() == want
    some = rng.permutation(len(ids))[:7]
    assert lm.windows(ids, first, some).tolist() == [want[i] for i in some]
    assert lm.Surroundings.of(ids, first).windows(slice(2, 6)).tolist() == want[2:6]


def test_large_exponents_do_not_overflow():
    net = small(5)
    net.class_bias[:4] = [500, -500, 90, 0]
    net.id_bias[:, :3] = [300, -300, 70]
    wide = lm.Network(*(x.astype(np.float64) for x in net))
    rng = np.random.default_rng(6)
    around, ids = rng.integers(0, lm.IDS + 1, (500, 2 * lm.SIDE)), rng.integers(0, lm.IDS, 500)
    got, want = (lm.log_probabilities(n, around, ids) for n in (net, wide))
    assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-4, atol=1e-3)
    lm.learn(net, around, ids, lm.Network(*(np.full_like(x, 1e-7) for x in net)))
    assert all(np.isfinite(x).all() for x in net)


def test_tokens_are_drawn_in_an_order_of_all():
    hashes = np.tile(np.arange(50, dtype=np.uint64), 400)
    order = lm.drawn(hashes)
    assert sorted(order.tolist()) == list(range(20_000)) and lm.drawn(hashes).tolist() == order.tolist()
    assert abs(np.corrcoef(order, np.arange(20_000))[0, 1]) < 0.05


def test_long_products_go_in_blocks(monkeypatch):
    """A step's products with the hidden layer take NEAR rows at a time; of more rows they took thrice as long."""
    rng = np.random.default_rng(7)
    around, ids = rng.integers(0, lm.IDS + 1, (lm.LONGEST, 2 * lm.SIDE)).astype(np.int16), rng.integers(0, lm.IDS, lm.LONGEST)
    rows, product = [], np.matmul
    monkeypatch.setattr(np, "matmul", lambda a, b, out: rows.append(len(a)) or product(a, b, out=out))
    whole, cut, grown = small(), small(), [lm.Network(*(np.full_like(x, 1e-7) for x in small())) for _ in range(2)]
    lm.learn(cut, around, ids, grown[0])
    assert rows.count(lm.NEAR) == 2 * lm.LONGEST // lm.NEAR and max(rows) == lm.NEAR
    monkeypatch.setattr(lm, "NEAR", lm.LONGEST)
    lm.learn(whole, around, ids, grown[1])
    assert all(np.allclose(x, y, rtol=1e-4, atol=1e-5) for x, y in zip(cut, whole))
