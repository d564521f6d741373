import random

import numpy as np
import pytest

from plumbline.llm import langid


def brute(emitted, start, moves):
    """Marginals by summing over all label sequences."""
    n, k = emitted.shape
    out = np.zeros((n, k))
    for number in range(k**n):
        path = [(number // k**i) % k for i in range(n)]
        weight = np.exp(start[path[0]] + sum(emitted[i, path[i]] for i in range(n)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for i in range(n):
            out[i, path[i]] += weight
    return out / out.sum(axis=1, keepdims=True)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 4, 9])
    emitted, start, moves = rng.normal(0, 2, (9, 3)), rng.normal(0, 1, 3), rng.normal(0, 1, (3, 3))
    share, _, _ = langid.forward_backward(emitted, first, start, moves)
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            assert np.allclose(share[a:b], brute(emitted[a:b], start, moves))


ENDINGS = {"xx": ["tion", "ing", "the"], "yy": ["keit", "ung", "der"], "zz": ["ción", "mente", "los"]}


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    texts, langs = [], []
    for lang, ends in ENDINGS.items():
        for _ in range(60):
            texts.append(" ".join(rng.choice("abcdef") + rng.choice(ends) for _ in range(20)))
            langs.append(lang)
    return langid.fit(texts, langs)


def test_code_switched_words_get_their_language(model):
    import pyarrow as pa

    text = "ation bing athe cung bder akeit fung ación bmente"
    names, score, spans = langid.predict(pa.array([text, "atión", None, "12 34", "—!", "日本"]), model)
    assert [(s["start"], s["end"], s["lang"]) for s in spans[0]] == [(0, 3, "xx"), (3, 7, "yy"), (7, 9, "zz")]
    assert names[0] == "yy" and 0.3 < score[0] < 0.6
    assert list(names[2:5]) == ["und"] * 3 and list(score[2:5]) == [0] * 3 and names[5] != "und"


def test_on_a_table(spark, documents):
    rng = random.Random(4)
    lines = {k: [" ".join(rng.choice("abcdef") + rng.choice(v) for _ in range(30)) for _ in range(40)] for k, v in ENDINGS.items()}
    rows = [(100 * j + i, t, lang) for j, (lang, ts) in enumerate(lines.items()) for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows + [(None, "ation", None), (900, None, "xx"), (901, "", None), (902, "ation " * 20000, None), (902, "ation " * 20000, None)], "doc_id bigint, text string, lang string")
    df = df.selectExpr("*", "1 AS score", "'x' AS spans")
    found = langid.train(df)
    assert found.languages == ["xx", "yy", "zz"]
    got = langid.identify(spark, df, found).collect()
    assert len(got) == len(rows) + 5
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == lang for i, _, lang in rows)
    assert by[None].lang_pred == by[902].lang_pred == "xx" and by[900].lang_pred == by[901].lang_pred == "und"
    kept = langid.accepted(spark, df, found)
    assert kept.columns == df.columns and kept.count() == len(rows) + 3


def test_every_language_is_learned_beside_long_texts_and_copies(spark):
    rng = random.Random(6)
    line = lambda lang, n: " ".join(rng.choice("abcdef") + rng.choice("ghijkl") + rng.choice(ENDINGS[lang]) for _ in range(n))
    copy = line("yy", 24)
    rows = [(1, line("xx", 60_000), "xx"), *((10 + k, copy, "yy") for k in range(500)), (600, line("yy", 200), "yy"), (700, line("zz", 10), "zz"), (None, "日" * 3000, "ja")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    for per_language in (1000, 1):
        found = langid.train(df, per_language=per_language, chunks=40)
        assert found.languages == ["ja", "xx", "yy", "zz"]
    seen = []
    keep, langid.fit = langid.fit, lambda texts, langs: seen.append(list(zip(langs, texts)))
    try:
        langid.train(df, chunks=40)
    finally:
        langid.fit = keep
    count = {lang: sum(x == lang for x, _ in seen[0]) for lang in ("ja", "xx", "yy", "zz")}
    assert count == {"ja": 1, "xx": 10, "yy": 10, "zz": 1} and len(set(seen[0])) == len(seen[0])


def test_nothing_to_learn(spark, documents):
    df = documents((1, "abc"), (2, None), lang=None)
    assert langid.train(df) is None
    assert {(r.lang_pred, r.score) for r in langid.identify(spark, df, None).collect()} == {("und", 0.0)}
    assert langid.train(documents((1, "..."), (2, ""))) is None
    assert langid.identify(spark, df.limit(0), None).collect() == []


def test_held_out_accuracy(rows, duck):
    truth = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in rows("op6_langid") if r.held_out]
    assert len(held) > 200 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in held)


def test_first_step_follows_the_gradient_of_the_likelihood():
    """From zero weights every labelling is equally likely, so seen less expected counts are known; a step is their sign, nearly."""
    words = ["ab", "cd", "ab", "ef", "gh"]
    got = langid.fit([" ".join(words), ""], ["xx", "yy"], passes=1)
    step = lambda g: 0.2 * g / np.sqrt(g**2 + 1e-6)
    assert np.allclose(got.start, step(np.array([0.5, -0.5])))
    pairs = len(words) - 1
    assert np.allclose(got.moves, step(np.array([[pairs - pairs / 4, -pairs / 4], [-pairs / 4, -pairs / 4]])))
    import pyarrow as pa

    from plumbline.llm.words import words_of

    w = words_of(pa.array([" ".join(words)]))
    slots, owners = langid.features(w, np.arange(len(words)), got.lexicon)
    gradient = np.zeros((langid.SLOTS, 2))
    np.add.at(gradient, slots, np.array([0.5, -0.5]))
    assert np.allclose(got.weights, step(gradient))
