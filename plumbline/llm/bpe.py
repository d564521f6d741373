"""BPE encoding and decoding of whole texts with a public tokenizer file.

The frequent words of the corpus, counted over all documents, are compiled once with their ids
into a minimal acyclic transducer: words share prefixes and suffixes, arcs add up to a word's
number, and the number selects its ids. Workers map its file into memory and run all new words of
a slice through it at once; words it does not hold are merged exactly, by rank. So the lexicon
only saves time: any lexicon gives the same ids.

Tokenizer files must be of the kind NFC, white space, lower case; split by a pattern; byte level;
BPE with a word-end suffix; no decoder (tokens are joined by spaces). Anything else is refused.

Defined results: a null text is an empty text and has no tokens; repeated rows give repeated rows;
a null id stays null; ids outside the vocabulary are left out by decoding; extra columns are
ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import written
from plumbline.llm.words import LONG, _long_hash, _mixed, _powers, pieces

#: Words compiled into the transducer, the most frequent ones, and bytes of the longest.
LEXICON_WORDS, LEXICON_BYTES = 131_072, 64
#: Words a worker remembers before it starts afresh, and characters or ids that are worked on at a time.
REMEMBERED, BLOCK = 200_000, 1 << 18
#: Bytes of texts that are encoded or counted at a time; working arrays take some 50 times as much.
SLICE = 1 << 19
#: The one pattern of words that is supported: contractions, runs of letters, single numerals, runs of the rest.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, NUMERAL, REST, SPECIAL = range(5)


# ------------------------------------------------------------------ the tokenizer


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    every = "".join(map(chr, range(0x110000)))
    out = np.full(len(every), REST, np.uint8)
    for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMERAL, r"\p{N}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return out


class Split(NamedTuple):
    """Words of consecutive texts: word k is whole[start[k]:end[k]]; text i owns words first[i]:first[i + 1]."""

    whole: str
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def distinct(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, which of them each word is, and how often each occurs."""
        _, one, which, n = np.unique(self.hash, return_index=True, return_inverse=True, return_counts=True)
        return [self.whole[a:b] for a, b in zip(self.start[one].tolist(), self.end[one].tolist())], which, n


class Tokenizer:
    """Normalisation, splitting and exact merging as the tokenizer file states them."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or level["type"] != "ByteLevel" or spec["decoder"] is not None:
            raise ValueError("a tokenizer of another kind")
        if model["unk_token"] is not None or model["byte_fallback"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError("a BPE model with settings that are not supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.ranks = {tuple(m): k for k, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if split["pattern"] != {"Regex": PATTERN}:
            raise ValueError("a tokenizer that splits in another way")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else lambda t: [t]
        self.tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in (self.vocab | self.special).items():
            self.tokens[i] = token
        # bytes as printable characters: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in set(plain))
        self.letter = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}

    def split(self, texts: Sequence[str | None]) -> Split:
        """Normalised words of all texts at once, by the kinds of their characters; a special token is a word."""
        parts: list[str] = []
        first, special, at = [0], [], 0
        for text in texts:
            for part in self.cut(text) if text and any(t in text for t in self.special) else [text or ""]:
                if part in self.special:
                    special.append((at, at + len(part)))
                else:
                    # lower case character by character: a final sigma is not treated apart
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                parts.append(part)
                at += len(part)
            first.append(at)
        whole = "".join(parts)
        code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _kinds()[code]
        for a, b in special:
            kind[a:b] = SPECIAL
        new = kind > SPACE
        new[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMERAL)
        last = kind > SPACE
        forced = np.array([a for a, _ in special] + first, np.int64)  # words never run over the start of a text or special token
        forced = forced[forced < len(code)]
        new[forced] = kind[forced] > SPACE
        last[:-1] &= (kind[1:] == SPACE) | new[1:]
        start, end = np.flatnonzero(new), np.flatnonzero(last) + 1
        # an apostrophe by itself takes the letters of a contraction from the word after it
        mark = np.flatnonzero((code[start] == ord("'")) & (end - start == 1)) if len(start) else start
        mark = mark[mark + 1 < len(start)]
        mark = mark[(start[mark + 1] == end[mark]) & (kind[end[mark]] == LETTER) & ~np.isin(end[mark], first)]
        one, two = code[end[mark]], code[np.minimum(end[mark] + 1, len(code) - 1)]
        two = np.where(end[mark + 1] - start[mark + 1] > 1, two, 0)
        letters = np.isin(one, [ord(c) for c in "stmd"]) + 2 * sum((one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll"))
        end[mark] += letters
        start[mark + 1] += letters
        some = start < end
        start, end = start[some], end[some]
        hashes = np.zeros(len(start), np.uint64)
        k = 0
        while k < len(start):
            stop = max(k + 1, int(np.searchsorted(end, start[k] + BLOCK, side="right")))
            low = start[k]
            part = code[low : end[stop - 1]].astype(np.uint64)
            up, down = _powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_mixed(part + np.uint64(1)) * up[: len(part)], out=sums[1:])
            hashes[k:stop] = _mixed((sums[end[k:stop] - low] - sums[start[k:stop] - low]) * down[start[k:stop] - low])
            k = stop
        for k in np.flatnonzero(end - start > LONG).tolist():
            hashes[k] = _long_hash(code[start[k] : end[k]])
        return Split(whole, start, end, hashes, np.searchsorted(start, first))

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the pair of lowest rank is merged first, the leftmost of equals."""
        parts = [self.letter[b] for b in word.encode("utf-8")]
        parts[-1] += self.end
        if len(parts) > 64:
            parts = self._merge_long(parts)
        elif len(parts) > 1:
            rank, none = self.ranks.get, len(self.ranks)
            order = [rank(p, none) for p in zip(parts, parts[1:])]
            while order and (best := min(order)) < none:
                i = order.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del order[i]
                if i:
                    order[i - 1] = rank((parts[i - 1], parts[i]), none)
                if i < len(order):
                    order[i] = rank((parts[i], parts[i + 1]), none)
        return [self.vocab[p] for p in parts]

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a queue of pairs over a linked list, for words of any length."""
        ranks, n = self.ranks, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [(ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if parts[i] is None or j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (parts[a], parts[b]) in ranks:
                    heapq.heappush(queue, (ranks[parts[a], parts[b]], a, (parts[a], parts[b])))
        return [p for p in parts if p is not None]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of the texts that the ids from first[i] to first[i + 1] stand for, tokens joined by spaces, and where each begins.

        Bytes are copied from a table of all tokens, each with a space before it.
        """
        known = (ids >= 0) & (ids < len(self.tokens))
        if not known.all():
            first = np.concatenate([[0], np.cumsum(known)])[first]
            ids = ids[known]
        table, begin = self._table()
        out = []
        for k in range(0, len(ids), BLOCK):
            part = ids[k : k + BLOCK]
            start, size = begin[part].copy(), (begin[part + 1] - begin[part])
            heads = first[(first >= k) & (first < k + len(part))] - k  # no space before the first token of a text
            start[heads] += 1
            size[np.unique(heads)] -= 1
            start[heads] = begin[part[heads]] + 1
            to = np.cumsum(size) - size
            out.append((table[np.repeat(start - to, size) + np.arange(int(size.sum()))], size))
        if not out:
            return np.zeros(0, np.uint8), np.zeros(len(first), np.int64)
        ends = np.concatenate([[0], np.cumsum(np.concatenate([s for _, s in out]))])
        return np.concatenate([b for b, _ in out]), ends[first]

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_spaced"):
            raw = [b" " + t.encode() for t in self.tokens]
            self._spaced = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        return self._spaced


@functools.lru_cache(maxsize=1)
def tokenizer_of(file: str) -> Tokenizer:
    """One for all tasks of a worker, and for both directions."""
    return Tokenizer(file)


# ------------------------------------------------------------------ the transducer


class Transducer:
    """A minimal acyclic automaton over bytes whose arcs carry numbers; a word's numbers add up to its place in ``ids``."""

    FIELDS = ("arcs", "target", "add", "final", "first", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arcs, self.target, self.add, self.final, self.first, self.ids = (arrays[f] for f in self.FIELDS)

    @classmethod
    def compiled(cls, entries: dict[bytes, Sequence[int]]) -> Transducer:
        """From words and their ids, by adding the sorted words one by one and sharing equal suffixes at once."""
        known: dict[tuple, int] = {}
        counts: list[int] = []
        final: list[bool] = []
        arcs, target, add = [], [], []
        open_nodes: list[list] = [[False, []]]  # from the root along the last word: is it an end, its finished arcs
        labels: list[int] = []

        def close() -> None:
            ends, own = open_nodes.pop()
            key = (ends, tuple(own))
            node = known.get(key)
            if node is None:
                node = known[key] = len(counts)
                total = int(ends)
                for label, child in own:
                    arcs.append(node * 256 + label)
                    target.append(child)
                    add.append(total)
                    total += counts[child]
                counts.append(total)
                final.append(ends)
            if labels:
                open_nodes[-1][1].append((labels.pop(), node))

        words = sorted(entries)
        last = b""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            while len(labels) > shared:
                close()
            for byte in word[shared:]:
                labels.append(byte)
                open_nodes.append([False, []])
            open_nodes[-1][0] = True
            last = word
        while open_nodes:
            close()
        ids = [entries[w] for w in words]
        return cls(
            {
                "arcs": np.array(arcs, np.int64), "target": np.array(target, np.int32), "add": np.array(add, np.int32), "final": np.array(final, bool),
                "first": np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int64),
                "ids": np.array([i for x in ids for i in x], np.int32),
            }
        )

    def saved(self) -> bytes:
        """One block: the lengths of the arrays, then the arrays, each from a multiple of 8 bytes."""
        arrays = [np.ascontiguousarray(getattr(self, f)) for f in self.FIELDS]
        padded = [a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays]
        return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(padded)

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        raw = np.memmap(path, np.uint8, "r")
        sizes = raw[: 8 * len(cls.FIELDS)].view(np.int64)
        at, arrays = 8 * len(cls.FIELDS), {}
        for field, size, kind in zip(cls.FIELDS, sizes, (np.int64, np.int32, np.int32, bool, np.int64, np.int32)):
            n = int(size) * np.dtype(kind).itemsize
            arrays[field] = raw[at : at + n].view(kind)
            at += n + -n % 8
        return cls(arrays)

    def places(self, words: Sequence[bytes]) -> np.ndarray:
        """The place of each word, -1 where the lexicon lacks it; all words step through the arcs together."""
        n = len(words)
        if not n or not len(self.arcs):
            return np.full(n, -1, np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        length = np.fromiter(map(len, words), np.int64, n)
        begin = np.cumsum(length) - length
        state, place = np.full(n, len(self.final) - 1, np.int64), np.zeros(n, np.int64)
        live = np.flatnonzero(length <= LEXICON_BYTES)
        place[length > LEXICON_BYTES] = -1
        step = 0
        while len(go := live[length[live] > step]):
            key = state[go] * 256 + flat[begin[go] + step]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            there = self.arcs[arc] == key
            place[go[~there]] = -1
            on, arc = go[there], arc[there]
            place[on] += self.add[arc]
            state[on] = self.target[arc]
            live, step = on, step + 1
        place[(place >= 0) & ~self.final[state]] = -1
        return place

    def output(self, place: int) -> np.ndarray:
        return self.ids[self.first[place] : self.first[place + 1]]


# ------------------------------------------------------------------ on Spark


def _counts(file):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, seen = tokenizer_of(file.value), Counter()

        def flushed() -> pa.RecordBatch:
            short = {w: n for w, n in seen.items() if len(w.encode()) <= LEXICON_BYTES}
            return pa.RecordBatch.from_arrays([pa.array(short.keys(), pa.string()), pa.array(short.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for a, b in pieces(batch.column(0), SLICE):
                words, _, n = tokenizer.split(batch.column(0).slice(a, b - a).to_pylist()).distinct()
                seen.update(dict(zip(words, n.tolist())))
                if len(seen) > REMEMBERED:
                    yield flushed()
                    seen.clear()
        yield flushed()

    return run


def lexicon(documents: DataFrame, file, size: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts, at most ``size`` of at most LEXICON_BYTES bytes: a bounded list.

    Words are taken down to the lowest count that still fits, words of one count all or none, so
    only a histogram of counts and the words themselves reach the driver.
    """
    counts = documents.select(F.col("text").cast("string")).mapInArrow(_counts(file), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.filter("n > 1"), "words")
    total, least = 0, None
    # each of the highest counts has a word at least, so no more than ``size`` of them matter
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(size).toLocalIterator():
        total += r.words
        if total > size:
            break
        least = r.n
    return [] if least is None else [r.word for r in counts.filter(F.col("n") >= least).select("word").collect()]


def _mapped(block: bytes) -> Transducer:
    """The transducer, mapped from a file of this worker that has no name any more and goes with the worker."""
    handle, path = tempfile.mkstemp(prefix="plumbline-lexicon-")
    with os.fdopen(handle, "wb") as f:
        f.write(block)
    try:
        return Transducer.mapped(path)
    finally:
        os.unlink(path)


def _encoder(file, block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, transducer = tokenizer_of(file.value), _mapped(block.value)
        known: dict[str, bytes] = {t: np.int32(i).tobytes() for t, i in tokenizer.special.items()}
        specials = dict(known)

        def learn(words: list[str]) -> dict[str, bytes]:
            places = transducer.places([w.encode() for w in words]).tolist()
            return {w: (transducer.output(p) if p >= 0 else np.array(tokenizer.merge(w), np.int32)).tobytes() for w, p in zip(words, places)}

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for a, b in pieces(texts, SLICE):
                split = tokenizer.split(texts.slice(a, b - a).to_pylist())
                words, which, _ = split.distinct()
                if len(known) > REMEMBERED:
                    known = dict(specials)
                known |= learn([w for w in words if w not in known])
                outputs = [known[w] for w in words]
                size = np.fromiter(map(len, outputs), np.int64, len(outputs)) // 4
                flat, begin = np.frombuffer(b"".join(outputs), np.int32), np.cumsum(size) - size
                n = size[which]
                to = np.cumsum(n) - n
                values = flat[np.repeat(begin[which] - to, n) + np.arange(int(n.sum()))]
                first = np.append(to, n.sum())[split.first].astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.ListArray.from_arrays(pa.array(first), pa.array(values))], names=["doc_id", "ids"])

    return run


def _shared(spark: SparkSession, documents: DataFrame, path: str, size: int):
    """The tokenizer file at ``path`` of the driver and the compiled lexicon of the documents, for all tasks."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    file, tokenizer = spark.sparkContext.broadcast(text), Tokenizer(text)
    entries = {w.encode(): tokenizer.merge(w) for w in lexicon(documents, file, size) if w not in tokenizer.special}
    return file, spark.sparkContext.broadcast(Transducer.compiled(entries).saved())


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(spark: SparkSession, documents: DataFrame, path: str, size: int = LEXICON_WORDS) -> DataFrame:
    """Rows (doc_id, ids) of whole texts, with the tokenizer file at ``path`` of the driver."""
    return _texts(documents).mapInArrow(_encoder(*_shared(spark, documents, path, size)), "doc_id bigint, ids array<int>")


def _decoder(file):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(file.value)
        for batch in batches:
            lists = batch.column("ids")
            values, first = lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            raw, begin = tokenizer.decode(values, first)
            texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(raw)).cast(pa.string())
            little = values.astype("<u4")
            digests = [hashlib.sha256(little[a:b]).hexdigest() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, texts, pa.array(digests, pa.string())], names=["doc_id", "ids", "decoded", "ids_sha256"])

    return run


def decode(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, ids, decoded, ids_sha256) of encoded documents; the digest is of the ids as little-endian unsigned 32-bit integers."""
    with open(path, encoding="utf-8") as f:
        file = spark.sparkContext.broadcast(f.read())
    lists = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return lists.mapInArrow(_decoder(file), "doc_id bigint, ids array<int>, decoded string, ids_sha256 string")


def round_trip(spark: SparkSession, documents: DataFrame, path: str, size: int = LEXICON_WORDS) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): documents encoded, and the ids decoded, in the same tasks."""
    file, block = _shared(spark, documents, path, size)
    encoder, decoder = _encoder(file, block), _decoder(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decoder(encoder(batches)):
            texts = batch.column("decoded").cast(pa.binary())
            digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in texts]
            n = batch.column("ids").value_lengths().cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, batch.column("ids_sha256"), pa.array(digests, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(documents).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
