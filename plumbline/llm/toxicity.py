"""Toxic passages by maximum-scoring segments.

A word scores the log of its odds in toxic against clean text, smoothed by a Dirichlet prior; all
words without significantly toxic odds share one score, that of their joint share. One scan finds every
maximal segment (Ruzzo and Tompa). Segment scores of clean text follow an extreme-value law, whose
parameters come from the word shares and from the clean training documents; it turns the segments
of a document into one p-value, and a logistic curve turns that into a probability.

The model is fitted on a bounded sample of labelled documents (``sample``); every document is
scored over its whole text. Defined results: null, empty and wordless texts have no segment and
get the score of a p-value of 1; a document labelled more than once is toxic if any label says so;
null labels and labels of unknown documents are not used; repeated rows score alike; extra columns
are ignored. Without labels of both kinds there are no word scores, and every document gets the
smoothed share of toxic labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import sampled_rows
from plumbline.llm.words import _mixed, pieces, words_of

#: Labelled documents that are fitted on, and words that get a score of their own.
SAMPLE, LEXICON = 8_000, 65_536
#: Weight of the Dirichlet prior, in words.
PRIOR = 100.0
#: Expected number of equally high segments in clean text of the same length, for a segment to be reported.
SIGNIFICANT = 0.05


class Model(NamedTuple):
    hashes: np.ndarray  # sorted
    scores: np.ndarray
    other: float  # score of every other word
    decay: float  # lambda of the extreme-value law
    scale: float  # K
    slope: float
    offset: float


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in one scan.

    Runs of scores without a positive one cannot begin or end a segment, so only positive
    positions are visited, with running sums in between.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    lower: list[int] = []  # of each, the nearest earlier one that begins lower, -1 for none
    for i in np.flatnonzero(scores > 0).tolist():
        start, left, right = i, float(sums[i]), float(sums[i + 1])
        j = len(held) - 1
        while True:
            # those passed over can never join a later one first, and later searches pass over them at once
            while j >= 0 and held[j][2] >= left:
                j = lower[j]
            if j < 0 or held[j][3] >= right:
                held.append((start, i + 1, left, right))
                lower.append(j)
                break
            start, left = held[j][0], held[j][2]
            before = lower[j]
            del held[j:], lower[j:]
            j = before
    return [(s, e, r - l) for s, e, l, r in held]


def surprise(found: list[tuple[int, int, float]], n: int, model: Model) -> float:
    """-ln of the p-value of the segments of a text of n words: the best of the sums of its r highest (Karlin and Altschul)."""
    if not found:
        return 0.0
    level = math.log(max(model.scale * n, 1e-300))
    total, best = 0.0, 0.0
    for r, score in enumerate(sorted((s for _, _, s in found), reverse=True), 1):
        total += model.decay * score - level
        if r == 1:
            p = -math.expm1(-math.exp(min(-total, 700.0)))
            here = -math.log(max(p, 1e-300)) if total < 600 else total
        elif total > r:
            here = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2)
        else:
            break
        best = max(best, here)
    return best


def word_scores(hashes: np.ndarray, model: Model) -> np.ndarray:
    out = np.full(len(hashes), model.other)
    if len(model.hashes):
        at = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
        known = model.hashes[at] == hashes
        out[known] = model.scores[at[known]]
    return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, word before it, draw): a random number for pair and document, whose last bit says whether the document is toxic."""
    for batch in batches:
        texts, toxic = batch.column("text"), np.asarray(batch.column("toxic").to_pylist(), np.uint64)
        ids = np.asarray(batch.column("doc_id").to_pylist(), np.int64).view(np.uint64)
        for a, b in pieces(texts):
            w = words_of(texts.slice(a, b - a))
            before = np.concatenate([[np.uint64(0)], w.hash[:-1]]) if len(w.hash) else w.hash
            before[w.first[:-1][np.diff(w.first) > 0]] = 0
            doc, label = (np.repeat(x[a:b], np.diff(w.first)) for x in (ids, toxic))
            draw = _mixed(w.hash ^ _mixed(before + np.uint64(1)) ^ _mixed(doc + np.uint64(2))) & ~np.uint64(1) | label
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (w.hash, before, draw)], names=["word", "before", "draw"])


_SEGMENTS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def judge(texts: pa.Array, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[dict]], np.ndarray]:
    """Words, best segment, surprise, significant passages and probability of each text."""
    w = words_of(texts)
    count, n = len(texts), np.diff(w.first)
    scores = word_scores(w.hash, m)
    passages: list[list[dict]] = [[] for _ in range(count)]
    top, rare = np.zeros(count), np.zeros(count)
    marked = np.unique(np.searchsorted(w.first, np.flatnonzero(scores > 0), side="right") - 1)
    for i in marked.tolist():
        found = segments(scores[w.first[i] : w.first[i + 1]])
        rare[i] = surprise(found, int(n[i]), m)
        top[i] = max(s for _, _, s in found)
        least = math.log(max(m.scale * n[i], 1e-300) / SIGNIFICANT) / m.decay
        passages[i] = [{"start": s, "end": e, "score": x} for s, e, x in found if x >= least]
    return n, top, rare, passages, 1 / (1 + np.exp(-np.clip(m.offset + m.slope * rare, -700, 700)))


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in pieces(texts):
                n, top, rare, passages, score = judge(texts.slice(a, b - a), model.value)
                arrays = [batch.column("doc_id").slice(a, b - a), pa.array(n), pa.array(top), pa.array(rare), pa.array(passages, _SEGMENTS), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "top", "rare", "passages", "score"])

    return run


def _accept(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in pieces(texts):
                yield batch.slice(a, b - a).filter(pa.array(judge(texts.slice(a, b - a), model.value)[-1] < 0.5))

    return run


SCORED = "doc_id bigint, n_words bigint, top double, rare double, passages array<struct<start:int,end:int,score:double>>, score double"


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _scores(spark: SparkSession, texts: DataFrame, model: Model) -> DataFrame:
    return texts.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), SCORED)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (0 at least) and offset of a lightly penalised logistic fit, by Newton's method."""
    design = np.column_stack([np.minimum(x, 50.0), np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        gradient = design.T @ (y - p) - np.array([1e-2, 1e-2]) * beta
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag([1e-2, 1e-2])
        step = np.linalg.solve(curve, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (0.0, float(beta[1]))


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the ``sample`` labelled documents that come first by a hash of their id; rows of ``labels`` are (doc_id, toxic)."""
    one = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("bigint").alias("toxic")).dropna()
    one = one.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("bigint")).alias("toxic"))
    chosen = sampled_rows(one, "doc_id", sample)
    if not chosen:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -1.0, 1.0, 1.0, 0.0, math.log(0.5 / 0.5))
    n_bad = sum(r.toxic for r in chosen)
    base = math.log((n_bad + 0.5) / (len(chosen) - n_bad + 0.5))
    picked = F.broadcast(spark.createDataFrame([tuple(r) for r in chosen], "doc_id bigint, toxic bigint"))
    fitted = _texts(documents).join(picked, "doc_id").select("doc_id", "text", "toxic")
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), -1.0, 1.0, 1.0, 0.0, base)

    # a word counts once for each word it follows, for a random document that has the pair: copies and
    # repetitions weigh no more than one passage, and common pairs fall to either side by its share
    pairs = fitted.mapInArrow(_contexts, "word bigint, before bigint, draw bigint").groupBy("word", "before").agg(F.min("draw").alias("draw"))
    bit = F.col("draw").bitwiseAND(1)
    counts = pairs.groupBy("word").agg(F.sum(bit).alias("bad"), F.sum(1 - bit).alias("good"))
    bad, good, words = counts.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0)), F.count(F.lit(1))).first()
    if not bad or not good:
        return empty
    # significance of a word's odds: likelihood ratio against equal shares, beyond what the best of so many words reaches by chance
    n = F.col("bad") + F.col("good")
    ratio = 2 * sum(F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * (bad + good) / (n * total))).otherwise(0.0) for c, total in (("bad", bad), ("good", good)))
    toxic_words = counts.withColumn("ratio", ratio).filter((F.col("bad") * good > F.col("good") * bad) & (F.col("ratio") >= 2 * math.log(words)))
    rows = toxic_words.orderBy(F.desc("ratio"), "word").limit(LEXICON).collect()  # bounded
    if not rows:
        return empty
    y1, y0 = (np.array([r[c] + PRIOR * (r.bad + r.good) / (bad + good) for r in rows]) for c in ("bad", "good"))
    q, p = y1 / (bad + PRIOR), y0 / (good + PRIOR)
    rest_q, rest_p = max(1 - q.sum(), 1e-9), max(1 - p.sum(), 1e-9)
    scores, other = np.log(q / p), math.log(rest_q / rest_p)
    hashes = np.array([r.word for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    # lambda: the positive root of sum p e^(lambda s) = 1
    low, high = 1e-6, 1.0
    mean = lambda x: float(p @ np.exp(x * scores) + rest_p * math.exp(x * other)) - 1
    while mean(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 0 else (low, mid)
    model = Model(hashes[order], scores[order], other, high, 1.0, 0.0, base)

    # K from the best segments of clean documents, by maximum likelihood
    scored = _scores(spark, _texts(fitted), model).join(picked, "doc_id")
    law = scored.filter("toxic = 0 AND n_words > 0").agg(F.count(F.lit(1)), F.sum(F.col("n_words") * F.exp(-model.decay * F.col("top")))).first()
    if law[0]:
        model = model._replace(scale=law[0] / max(law[1], 1e-300))
    sample_scores = _scores(spark, _texts(fitted), model).join(picked, "doc_id").select("rare", "toxic").toPandas()  # rows of the sample
    slope, offset = logistic(sample_scores["rare"].to_numpy(), sample_scores["toxic"].to_numpy(float))
    return model._replace(slope=slope, offset=offset)


def score(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, n_words, passages, score, predicted): the significant passages in words, and the probability of label 1."""
    scored = _scores(spark, _texts(documents), model)
    return scored.select("doc_id", "n_words", "passages", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    return documents.mapInArrow(_accept(spark.sparkContext.broadcast(model)), documents.schema)
