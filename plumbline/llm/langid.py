"""Language identification by a linear-chain conditional random field over the words of a text.

A word's features are its affixes, its byte n-grams and, if the training words hold it often
enough, itself; transitions between the languages of neighbouring words are learned with them.
Forward-backward gives each word's language in code-switched text, and a text's language is the
one with the largest share of its words.

Fitted on a bounded sample of labelled documents: about ``per_language`` of each language, by a
hash of id and text, and ``chunks`` distinct runs of their words, as many of each language. Every
document of a language gives one run before any gives a second one. Training sequences join runs of words, of one
language or of two, so that switches are learned. Defined results: a null text or one without a
letter is ``und`` with score 0, as is every text if nothing could be learned; repeated rows are
predicted alike; ties go to the language that sorts first; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import written
from plumbline.llm.words import LOWER, Words, _mixed, pieces, words_of

#: The bounded sample: documents per language, runs of words in all, words and bytes of a run (longer words are cut).
PER_LANGUAGE, CHUNKS, RUN, RUN_BYTES = 1_000, 8_000, 24, 2048
#: Feature weights per language (a power of two), training passes, and how often a word must occur to be in the lexicon.
SLOTS, PASSES, LEAST = 1 << 18, 3, 3
#: Distinct words whose features are laid out at a time.
AT_ONCE = 1 << 15


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # SLOTS x languages
    lexicon: np.ndarray  # sorted hashes of the words that are features themselves
    start: np.ndarray
    moves: np.ndarray  # languages x languages, log


def features(w: Words, which: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, owner) of all features of the chosen words; owner is the index in ``which``, in order within each kind."""
    begin = w.start[which]
    size = w.end[which] - begin
    owner = np.repeat(np.arange(len(which)), size)
    first = np.cumsum(size) - size
    inside = np.arange(len(owner)) - first[owner]
    flat = LOWER[w.data[begin[owner] + inside]].astype(np.uint64) if len(owner) else np.zeros(0, np.uint64)
    left = size[owner] - inside  # bytes from here to the word's end
    slots, owners = [], []

    def put(kind: int, code: np.ndarray, own: np.ndarray) -> None:
        slots.append((_mixed(code + np.uint64(kind << 40)) & np.uint64(SLOTS - 1)).astype(np.int64))
        owners.append(own)

    code = np.zeros(len(flat), np.uint64)
    for n in range(1, 5):
        code = code[: len(flat) - n + 1] * np.uint64(257) + flat[n - 1 :] + np.uint64(1) if len(flat) >= n else code[:0]
        fits = left[: len(code)] >= n
        here, pos, rest = owner[: len(code)], inside[: len(code)], left[: len(code)]
        if n > 1:
            put(n, code[fits], here[fits])
        put(10 + n, code[fits & (pos == 0)], here[fits & (pos == 0)])
        put(20 + n, code[fits & (rest == n)], here[fits & (rest == n)])
    if len(lexicon):
        hashes = w.hash[which]
        known = lexicon[np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)] == hashes
        slots.append(((hashes[known] ^ np.uint64(0x5BD1E995)) & np.uint64(SLOTS - 1)).astype(np.int64))
        owners.append(np.flatnonzero(known))
    return np.concatenate(slots), np.concatenate(owners)


def emissions(w: Words, model: Model) -> np.ndarray:
    """Log-potential of every language for every word, computed once per distinct word."""
    _, which, back = np.unique(w.hash, return_index=True, return_inverse=True)
    out = np.empty((len(which), len(model.languages)))
    for a in range(0, len(which), AT_ONCE):
        part = which[a : a + AT_ONCE]
        slots, owners = features(w, part, model.lexicon)
        for k in range(out.shape[1]):
            out[a : a + len(part), k] = np.bincount(owners, model.weights[slots, k], minlength=len(part))
    return out[back]


def forward_backward(emitted: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of each word's language, and the scaled forward and backward vectors; all sequences step together."""
    potential = np.exp(emitted - emitted.max(axis=1, keepdims=True)) if len(emitted) else emitted
    forward, backward = np.ones_like(potential), np.ones_like(potential)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, longest = first[:-1][order], int(size.max(initial=0))
    alive = len(size) - np.searchsorted(np.sort(size), np.arange(longest + 1), side="right")  # sequences longer than t
    move = np.exp(moves)
    state = None
    for t in range(longest):
        at = begin[: alive[t]] + t
        state = (np.exp(start) if t == 0 else state[: alive[t]] @ move) * potential[at]
        state /= state.sum(axis=1, keepdims=True)
        forward[at] = state
    for t in range(longest - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        state = (potential[at + 1] * backward[at + 1]) @ move.T
        backward[at] = state / state.sum(axis=1, keepdims=True)
    share = forward * backward
    return share / share.sum(axis=1, keepdims=True) if len(share) else share, forward, backward


def fit(texts: list[str], langs: list[str], passes: int = PASSES, seed: int = 7) -> Model:
    """Train on runs of words of known language, by stochastic gradient steps of the conditional likelihood."""
    languages = sorted(set(langs))
    label = np.searchsorted(languages, langs)
    w = words_of(pa.array(texts, pa.string()))
    words, n = np.unique(w.hash, return_counts=True)
    count = len(languages)
    model = Model(languages, np.zeros((SLOTS, count)), words[n >= LEAST], np.zeros(count), np.zeros((count, count)))
    rng = np.random.default_rng(seed)
    grown = [np.full_like(x, 1e-6) for x in (model.weights, model.start, model.moves)]
    truth = np.repeat(label, np.diff(w.first))
    runs = np.flatnonzero(np.diff(w.first))
    for _ in range(passes):
        rng.shuffle(runs)
        # half of the sequences join two runs, half one
        cuts = np.concatenate([[0], np.cumsum(rng.integers(1, 3, len(runs)))])
        cuts = np.append(cuts[cuts < len(runs)], len(runs))
        for k in range(0, len(cuts) - 1, 64):
            bounds = cuts[k : k + 65]
            mine = [runs[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            at = np.concatenate([np.arange(w.first[r], w.first[r + 1]) for s in mine for r in s])
            first = np.concatenate([[0], np.cumsum([sum(w.first[r + 1] - w.first[r] for r in s) for s in mine])])
            slots, owners = features(w, at, model.lexicon)
            emitted = np.column_stack([np.bincount(owners, model.weights[slots, c], minlength=len(at)) for c in range(count)])
            share, forward, backward = forward_backward(emitted, first, model.start, model.moves)
            wrong = -share
            wrong[np.arange(len(at)), truth[at]] += 1
            # transitions: seen less expected
            inner = np.ones(len(at), bool)
            inner[first[:-1]] = False
            to = np.flatnonzero(inner)
            potential = np.exp(emitted[to] - emitted[to].max(axis=1, keepdims=True)) * backward[to]
            pair = forward[to - 1][:, :, None] * np.exp(model.moves)[None] * potential[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            moved = -pair.sum(axis=0)
            np.add.at(moved, (truth[at][to - 1], truth[at][to]), 1)
            used, back = np.unique(slots, return_inverse=True)
            step = np.column_stack([np.bincount(back, wrong[owners, c], minlength=len(used)) for c in range(count)])
            for whole, part, where, total in ((model.weights, step, used, grown[0]), (model.start, wrong[first[:-1]].sum(axis=0), ..., grown[1]), (model.moves, moved, ..., grown[2])):
                total[where] += part**2
                whole[where] += 0.2 * part / np.sqrt(total[where])
    return model


# ------------------------------------------------------------------ on Spark


def _runs(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            for a, b in pieces(texts):
                w = words_of(texts.slice(a, b - a))
                out, lang, turns, hashed = [], [], [], []
                for i in range(b - a):
                    cuts, k, last = [], int(w.first[i]), int(w.first[i + 1])
                    while k < last:
                        stop = min(k + RUN, last)
                        stop = max(k + 1, k + int(np.searchsorted(w.end[k:stop], w.start[k] + RUN_BYTES, side="right")))
                        cuts.append((k, stop))
                        k = stop
                    at = np.array([_mixed(w.hash[k:stop].sum(keepdims=True))[0] >> np.uint64(1) for k, stop in cuts], np.int64)
                    # turns of the document's distinct runs, by their hash
                    at, which = np.unique(at, return_index=True)
                    for turn, (h, c) in enumerate(zip(at[:most].tolist(), which[:most].tolist())):
                        text = w.span(*cuts[c])
                        out.append(text if len(text) <= RUN_BYTES // 4 else text.encode()[:RUN_BYTES].decode("utf-8", "ignore"))
                        lang.append(langs[a + i])
                        turns.append(turn)
                        hashed.append(h)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(lang, pa.string()), pa.array(turns, pa.int64()), pa.array(hashed, pa.int64())], names=["run", "lang", "turn", "at"])

    return run


def train(documents: DataFrame, per_language: int = PER_LANGUAGE, chunks: int = CHUNKS) -> Model | None:
    """Fit on labelled documents (text, lang); None if there is nothing to learn from."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    # each language is thinned to about the same number of documents, by a hash
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).collect()
    if not sizes:
        return None
    quota = -(-chunks // len(sizes))
    keep = F.lit(False)
    for r in sizes:
        keep = keep | ((F.col("lang") == r.lang) & (place <= max(int(per_language / r.n * (1 << 30)), r.least)))
    runs = rows.filter(keep).select("text", "lang").mapInArrow(_runs(quota), "run string, lang string, turn bigint, at bigint")
    runs = written(runs.groupBy("lang", "run").agg(F.min("turn").alias("turn"), F.min("at").alias("at")), "runs")
    # the turns that fit into a language's share, and of the next one about twice what is missing
    counts: dict[str, list[tuple[int, int]]] = {}
    for r in runs.groupBy("lang", "turn").count().collect():  # `quota` turns of each language at most
        counts.setdefault(r.lang, []).append((r.turn, r["count"]))
    keep, place = F.lit(False), F.pmod(F.xxhash64("run"), F.lit(1 << 30))
    for lang, found in counts.items():
        left = quota
        for turn, n in sorted(found):
            if n > left:
                part = int(min(1.0, (2 * left + 16) / n) * (1 << 30))
                keep = keep | ((F.col("lang") == lang) & ((F.col("turn") < turn) | (F.col("turn") == turn) & (place < part)))
                break
            left -= n
        else:
            keep = keep | (F.col("lang") == lang)
    chosen = runs.filter(keep).toPandas()  # about twice `chunks` runs of RUN words at most
    chosen = chosen.sort_values(["lang", "turn", "at", "run"]).groupby("lang").head(quota).sort_values(["at", "run", "lang"])
    return fit(chosen["run"].tolist(), chosen["lang"].tolist()) if len(chosen) else None


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def predict(texts: pa.Array, m: Model | None) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """Language, its share of the words, and runs of words of one language, for each text."""
    count = len(texts)
    w = words_of(texts)
    n = np.diff(w.first)
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    letters = np.concatenate([[0], np.cumsum(ascii_letter[w.data])])
    sizes = pc.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    has = letters[ends] > letters[ends - sizes]
    for i in np.flatnonzero(~has & (n > 0)).tolist():  # letters beyond ASCII
        has[i] = any(map(str.isalpha, texts[i].as_py()))
    names, score = np.full(count, "und", object), np.zeros(count)
    spans: list[list[dict]] = [[] for _ in range(count)]
    if m is None or not len(w.hash):
        return names, score, spans
    share, _, _ = forward_backward(emissions(w, m), w.first, m.start, m.moves)
    sums = np.concatenate([np.zeros((1, share.shape[1])), np.cumsum(share, axis=0)])
    total = (sums[w.first[1:]] - sums[w.first[:-1]]) / np.maximum(n, 1)[:, None]
    best = total.argmax(axis=1)
    names[has] = np.array(m.languages, object)[best[has]]
    score[has] = np.clip(total[np.arange(count), best][has], 0, 1)
    label = share.argmax(axis=1)
    edge = np.zeros(len(label) + 1, bool)
    edge[1:-1] = label[1:] != label[:-1]
    edge[w.first] = True
    at = np.flatnonzero(edge)
    owner = np.searchsorted(w.first, at[:-1], side="right") - 1
    for s, e, i in zip(at[:-1].tolist(), at[1:].tolist(), owner.tolist()):
        if has[i]:
            spans[i].append({"start": s - int(w.first[i]), "end": e - int(w.first[i]), "lang": m.languages[label[s]]})
    return names, score, spans


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in pieces(texts):
                names, score, spans = predict(texts.slice(a, b - a), model.value)
                arrays = [batch.column("doc_id").slice(a, b - a), pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", "spans"])

    return run


def _accept(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in pieces(texts):
                names, _, _ = predict(texts.slice(a, b - a), model.value)
                yield batch.slice(a, b - a).filter(pa.array((names != "und").astype(bool)))

    return run


def accepted(spark: SparkSession, documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents, all columns, whose text has a language; without a model none has."""
    return documents.mapInArrow(_accept(spark.sparkContext.broadcast(model)), documents.schema)


def identify(spark: SparkSession, documents: DataFrame, model: Model | None) -> DataFrame:
    """Rows (doc_id, lang_pred, score, spans): the language of most words, its share, and runs of words of one language."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_predict(spark.sparkContext.broadcast(model)), "doc_id bigint, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
