import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import words

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return PATTERN.findall((text or "").translate(LOWER))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="abAZ09 .,é日\x00\x7f—", max_size=30), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    w = words.words_of(pa.array(texts, pa.string()))
    found = [[w.text(k) for k in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    assert found == [plain(t) for t in texts]
    flat = [x for t in found for x in t]
    assert len(set(zip(flat, w.hash.tolist()))) == len(set(flat)) == len(set(w.hash.tolist()))


def test_blocks_do_not_cut_words(monkeypatch):
    texts = ["alpha beta " * 50, "x" * 500, None, "", "é" * 300 + " end", "gamma"]
    whole = words.words_of(pa.array(texts, pa.string()))
    for block in (1, 7, 64, 333):
        monkeypatch.setattr(words, "BLOCK", block)
        cut = words.words_of(pa.array(texts, pa.string()))
        assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


def test_pieces_cover_every_row_once():
    texts = pa.array(["a" * n for n in (0, 10, 100, 5, 5, 0, 60)])
    for most in (1, 20, 1000):
        assert [i for a, b in words.pieces(texts, most) for i in range(a, b)] == list(range(7))
    assert list(words.pieces(pa.array([], pa.string()))) == []
    assert len(words.words_of(pa.array(["", "ab cd"]).slice(1)).hash) == 2


@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=200))
@settings(deadline=None)
def test_lookup(keys):
    table = words.Lookup(np.array(keys, np.uint64), np.arange(len(keys)), -1)
    asked = np.array(keys + [1, 2, 2**63], np.uint64)
    assert table(asked).tolist() == [keys.index(k) if k in keys else -1 for k in asked.tolist()]


def test_grams_tell_order_apart():
    h = words.words_of(pa.array(["a b c a c b"])).hash
    assert len(set(words.grams(h, 3).tolist())) == 4 and len(words.grams(h, 7)) == 0
    assert words.grams(h, 1).tolist() != h.tolist() and len(set(words.grams(h, 1).tolist())) == 3


def test_tokens_tell_case_and_punctuation_apart():
    w = words.tokens_of(pa.array(["Ab ab!! é?,x"]))
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)] == ["Ab", "ab", "!!", "é", "?,", "x"]
    assert len(set(w.hash.tolist())) == 6


def test_samples_are_bounded_and_the_same_each_time(spark):
    from plumbline.llm.store import sampled_rows

    rows = spark.range(5000).selectExpr("id", "id * 2 AS twice").repartition(7)
    got = sampled_rows(rows, "id", 100)
    assert len(got) == 100 and all(r.twice == 2 * r.id for r in got)
    assert [r.id for r in got] == [r.id for r in sampled_rows(rows.repartition(3), "id", 100)]
    assert len(sampled_rows(rows, "id", 9999)) == 5000 and sampled_rows(rows.limit(0), "id", 5) == []


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_long_words_made_to_agree_are_told_apart():
    """Sums of powers modulo 2**64 agree on such a word and its complement, whatever the base."""
    for n in (32, 64, 65, 256, 1024, 4096):
        word = thue_morse(n)
        other = word.translate(str.maketrans("ab", "ba"))
        h = words.words_of(pa.array([word, other, word.upper(), f"x {word}"])).hash
        assert h[0] != h[1] and h[0] == h[2] == h[4]
