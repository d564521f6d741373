import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import bpe
from plumbline.llm.queries import tokenizer_file

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(open(tokenizer_file(), encoding="utf-8").read())


def words(own, texts):
    split = own.split(texts)
    found, which, n = split.distinct()
    assert n.sum() == len(which)
    return [[found[k] for k in which[split.first[i] : split.first[i + 1]]] for i in range(len(texts))]


def ids(own, *texts):
    return [[i for w in part for i in ([own.special[w]] if w in own.special else own.merge(w))] for part in words(own, texts)]


def decoded(own, ids):
    raw, begin = own.decode(np.array(ids, np.int32), np.array([0, len(ids)]))
    return raw[begin[0] : begin[1]].tobytes().decode()


TRICKY = [
    "", " ", "\n\t", "<|endoftext|>Hello<|startoftext|> it's WE'RE", "<|endoftext", "ΣΑΣ Σ İstanbul ǅ ﬁ é é ẛ̣", "a\x1cb \x85 c​d﻿", "1²3½ ٣٤ Ⅷ 'S 'sx ''ll",
    "'", "s", "'s", "'re'r'e 'l", "x'll!'s''t", "<|endoftext|><|endoftext|>'<|endoftext|>s a'<|startoftext|>", "日本語テキスト 😀😀 ́́", "a b c　d", "x" * 400, "ab" * 300 + "!" * 50, "thethethe" * 40,
]


def test_tricky_texts(own, library):
    want = [library.encode(text, add_special_tokens=False).ids for text in TRICKY]
    assert ids(own, *TRICKY) == want
    for one in want:
        assert decoded(own, one) == library.decode(one, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=40) | st.text(alphabet="'strevlmdx 1!", max_size=12), max_size=4))
def test_any_texts(own, library, texts):
    assert ids(own, *texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_blocks_do_not_matter(own, monkeypatch):
    want = own.split(TRICKY)
    for block in (1, 5, 100):
        monkeypatch.setattr(bpe, "BLOCK", block)
        assert own.split(TRICKY).hash.tolist() == want.hash.tolist()
        assert decoded(own, list(range(300))) == " ".join(own.tokens[:300])


def test_long_and_short_merging_agree(own):
    for word in ("international", "antidisestablishment", "a", "aaaaaaaaaaaaaaaaaaaaaaa", "thethethethe"):
        parts = [own.letter[b] for b in word.encode()]
        parts[-1] += own.end
        assert [own.vocab[p] for p in own._merge_long(parts)] == own.merge(word)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(max_size=6).filter(lambda b: b), st.lists(st.integers(0, 50_000), max_size=4), max_size=40), st.lists(st.binary(max_size=7), max_size=10))
def test_transducer_holds_exactly_its_words(tmp_path_factory, entries, others):
    path = tmp_path_factory.mktemp("lexicon") / "t"
    path.write_bytes(bpe.Transducer.compiled(entries).saved())
    t = bpe.Transducer.mapped(str(path))
    asked = [*entries, *others]
    for word, place in zip(asked, t.places(asked).tolist()):
        assert (place >= 0) == (word in entries)
        if place >= 0:
            assert t.output(place).tolist() == entries[word]


def test_suffixes_are_shared():
    words = [a + b"tion" for a in (b"na", b"sta", b"mo", b"po")]
    t = bpe.Transducer.compiled({w: [k] for k, w in enumerate(words)})
    assert len(t.final) < sum(map(len, words)) - 8
    assert bpe.Transducer.compiled({}).places([b"a", b""]).tolist() == [-1, -1]


def test_any_lexicon_gives_the_same_ids(spark, documents, library):
    pairs = [(k, t) for k, t in enumerate(TRICKY)] + [(50, None), (51, "the cat"), (51, "the cat"), (None, "the the cat")]
    for size in (1, 5, 1000):
        got = bpe.decode(spark, bpe.encode(spark, documents(*pairs), tokenizer_file(), size), tokenizer_file()).collect()
        assert len(got) == len(pairs)
        key = lambda r: str(r)
        want = []
        for i, t in pairs:
            e = library.encode(t or "", add_special_tokens=False).ids
            want.append((i, e, library.decode(e, skip_special_tokens=False), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()))
        assert sorted([(r.doc_id, r.ids, r.decoded, r.ids_sha256) for r in got], key=key) == sorted(want, key=key)
    assert bpe.encode(spark, documents(*pairs).limit(0), tokenizer_file()).count() == 0


def test_unknown_ids_are_left_out(spark):
    df = spark.createDataFrame([(1, [0, -1, 10**6, 1]), (2, None)], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(spark, df, tokenizer_file()).collect()} == {1: '! "', 2: ""}


def test_query_matches_the_library(rows, duck, library):
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    assert len(rows("op5_bpe")) == len(texts)
    for r in rows("op5_bpe"):
        e = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        text = library.decode(e, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_long_words_made_to_agree_keep_their_own_ids(spark, documents, library):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    pairs = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word)]
    got = {r.doc_id: r.ids for r in bpe.encode(spark, documents(*pairs), tokenizer_file()).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in pairs} and got[1] != got[2]


def test_working_memory_of_a_batch_is_bounded(own):
    """One tokenizer for both directions, and slices of a large batch: 106 MB with two tokenizers and slices of 2 MB, 35 MB now."""

    class Shared:
        def __init__(self, value):
            self.value = value

    file, lexicon = Shared(open(tokenizer_file(), encoding="utf-8").read()), Shared(bpe.Transducer.compiled({}).saved())
    made = ["w" + "".join(chr(97 + i // k % 26) for k in (1, 26, 676)) for i in range(5000)]
    text = (" ".join(made) + " ") * 10
    batch = pa.RecordBatch.from_arrays([pa.array(range(16)), pa.array([text] * 16)], names=["doc_id", "text"])

    def run(rows):
        # the tokenizer is made inside, as in a task
        return [r for part in bpe._decoder(file)(bpe._encoder(file, lexicon)(iter([rows]))) for r in part.column("ids_sha256").to_pylist()]

    one = run(batch.slice(0, 1))
    tracemalloc.start()
    try:
        assert run(batch) == one * 16
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()
    assert bpe.tokenizer_of(file.value) is bpe.tokenizer_of(file.value)
