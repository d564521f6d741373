"""Language-model scores by masked pseudo-likelihood.

A network with one hidden layer predicts every token from the ``SIDE`` tokens on either side of it,
never from itself; the summed conditional log-probabilities score a document. Tokens are words:
the most frequent ones of the whole corpus have ids of their own, all others share buckets by
hash. The output layer is a softmax over classes of ids, then over the ids of the class; a word of
a bucket also takes its share of the bucket's tokens, from the counts of all words of the corpus.
One count a bucket is left for words the corpus does not hold.

The network is trained in numpy on every token of all documents: each text belongs to one of
``ROUNDS`` rounds, by its hash. In a round every task starts from the common parameters, takes gradient
steps on all tokens of its texts of the round, in an order drawn by hash within some 2 MB of text, and
the parameters of all tasks are averaged, weighted by tokens, in a tree of Spark aggregations. So what is gathered grows with the corpus, and no task or driver holds more
than a few parameter sets. Defined results: null and wordless texts have 0 tokens, score 0 and no
mean (null); repeated rows score alike; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import new_path, written
from plumbline.llm.words import Lookup, Words, _mixed, pieces, words_of

#: Ids of frequent words, buckets of all others (together IDS, the pad comes last), and ids of a class.
FREQUENT, BUCKETS, CLASS = 1536, 512, 64
IDS = FREQUENT + BUCKETS
CLASSES = IDS // CLASS
#: Tokens seen on either side, and sizes of an embedding and of the hidden layer.
SIDE, EMBEDDING, HIDDEN = 3, 16, 32
#: Rounds of averaging, tokens of a task's first gradient steps and of its last ones, and the size of a step.
ROUNDS, STEP, LONGEST, RATE = 2, 512, 4096, 0.05
#: Words whose counts every task holds; the counts of all others are joined.
COMMON = 131_072
#: Tokens scored at once, and parameter sets added up by one task.
CHUNK, FAN = 1 << 15, 16
#: Counts that a task holds before it gives them on.
HELD = 1 << 19
#: Tokens whose arrays stay in a core's own cache.
NEAR = 2048
#: Exponents up to which sums of exponentials stay well inside single precision.
SAFE = 60
_OFFSETS = [k for k in range(-SIDE, SIDE + 1) if k]


class Network(NamedTuple):
    embedding: np.ndarray  # IDS + 1 x EMBEDDING
    hidden: np.ndarray  # 2 SIDE EMBEDDING x HIDDEN
    hidden_bias: np.ndarray
    to_class: np.ndarray  # HIDDEN x CLASSES
    class_bias: np.ndarray
    to_id: np.ndarray  # CLASSES x HIDDEN x CLASS
    id_bias: np.ndarray  # CLASSES x CLASS

    def packed(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self]).astype(np.float32)


_SHAPES = Network(
    (IDS + 1, EMBEDDING), (2 * SIDE * EMBEDDING, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (CLASSES, HIDDEN, CLASS), (CLASSES, CLASS)
)


def unpacked(flat: np.ndarray) -> Network:
    cuts = np.cumsum([int(np.prod(s)) for s in _SHAPES])
    return Network(*(part.reshape(shape).copy() for part, shape in zip(np.split(flat, cuts[:-1]), _SHAPES)))


def untrained(counts: np.ndarray, seed: int = 3) -> Network:
    """Small random weights; the biases start at the corpus frequencies of the ids."""
    rng = np.random.default_rng(seed)
    net = [rng.normal(0, 0.1, shape).astype(np.float32) for shape in _SHAPES]
    share = (counts.reshape(CLASSES, CLASS) + 0.5) / (counts.sum() + 0.5 * IDS)
    net[2][:] = 0
    net[4][:] = np.log(share.sum(axis=1))
    net[6][:] = np.log(share / share.sum(axis=1, keepdims=True))
    return Network(*net)


class Vocabulary(NamedTuple):
    ids: Lookup
    common: Lookup | None = None  # log of the counts of the most frequent words; 0 for others, as for words met once
    totals: np.ndarray | None = None  # log of the tokens of each bucket, and one for unseen words
    table: str | None = None  # where the counts above 1 of all other words are, if there are any

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found = self.ids(hashes)
        return np.where(found >= 0, found, FREQUENT + (hashes >> np.uint64(20)).astype(np.int64) % BUCKETS)

    def looked_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id of each word, which words are in buckets, and the log of their counts as far as they are held."""
        ids = self(hashes)
        shared = np.flatnonzero(ids >= FREQUENT)
        return ids, shared, self.common(hashes[shared])


class Surroundings(NamedTuple):
    """Ids of consecutive texts with SIDE pads before, between and after them, and where each token is in that."""

    ids: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, first: np.ndarray) -> Surroundings:
        place = np.arange(len(ids)) + np.repeat(SIDE * np.arange(1, len(first)), np.diff(first))
        padded = np.full(len(ids) + SIDE * len(first), IDS, np.int16)
        padded[place] = ids
        return cls(padded, place)

    def windows(self, at: np.ndarray | slice) -> np.ndarray:
        return np.ascontiguousarray(np.take(self.ids, self.place[at] + np.array(_OFFSETS)[:, None]).T)


def windows(ids: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids around the positions ``at``, the pad beyond the ends of a text."""
    return Surroundings.of(ids, first).windows(at)


def log_probabilities(net: Network, around: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each id, given the ids around it."""
    kind = (ids // CLASS).astype(np.int16)
    order = np.argsort(kind, kind="stable")
    cuts = np.searchsorted(kind[order], np.arange(CLASSES + 1)).tolist()
    h = np.empty((len(ids), HIDDEN), net.hidden.dtype)  # tokens of a class side by side
    around, kind, inside = np.take(around, order, axis=0), np.take(kind, order), np.take(ids, order) % CLASS
    found, out = np.empty(len(ids)), np.empty(len(ids))
    for k in range(0, len(ids), NEAR):
        rows = slice(k, k + NEAR)
        x = np.take(net.embedding, around[rows], axis=0, mode="clip").reshape(-1, 2 * SIDE * EMBEDDING)
        part = np.tanh(_plus(x @ net.hidden, net.hidden_bias), out=h[rows])
        found[rows] = _log_softmax(_plus(part @ net.to_class, net.class_bias), kind[rows])
    for c, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for k in range(a, b, NEAR):
            rows = slice(k, min(k + NEAR, b))
            found[rows] += _log_softmax(_plus(h[rows] @ net.to_id[c], net.id_bias[c]), inside[rows])
    out[order] = found
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product, NEAR rows at a time: products of more rows than that can take thrice as long."""
    out = np.empty((len(a), b.shape[1]), np.result_type(a, b))
    for k in range(0, len(a), NEAR):
        np.matmul(a[k : k + NEAR], b, out=out[k : k + NEAR])
    return out


def _plus(z: np.ndarray, bias: np.ndarray) -> np.ndarray:
    z += bias
    return z


def _exponentials(z: np.ndarray) -> np.ndarray:
    """The exponentials of each row, up to a factor, in place, and their sums; products with ones are the fastest sums."""
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], z.dtype)


def _bounded(z: np.ndarray) -> np.ndarray:
    """Rows less their maxima, if exponentials could leave the range of numbers."""
    if not (z.max() < SAFE and z.min() > -SAFE):
        z -= z.max(axis=1, keepdims=True)
    return z


def _flat(z: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Where the picked entry of each row is in the rows laid end to end."""
    return np.arange(0, z.size, z.shape[1]) + picked


def _log_softmax(z: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Of each row, the log of the picked entry's share."""
    z = _bounded(z)
    chosen = np.take(z, _flat(z, picked))
    return chosen - np.log(_exponentials(z))


def _errors(z: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """One for the picked entry of each row, less the row's softmax, over the number of rows; in place."""
    z = _bounded(z)
    z *= (-1 / (len(z) * _exponentials(z)))[:, None]
    z.reshape(-1)[_flat(z, picked)] += 1 / len(z)
    return z


def learn(net: Network, around: np.ndarray, ids: np.ndarray, grown: Network) -> None:
    """One gradient step (Adagrad) on the mean log-probability, in place."""
    n = len(ids)
    order = np.argsort((ids // CLASS).astype(np.int16), kind="stable")  # tokens of a class side by side
    around, ids = np.take(around, order, axis=0), np.take(ids, order)
    kind, inside = ids // CLASS, ids % CLASS
    cuts = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    some = [(c, a, b) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    x = np.take(net.embedding, around.ravel(), axis=0, mode="clip").reshape(n, -1)
    h = _plus(_times(x, net.hidden), net.hidden_bias)
    np.tanh(h, out=h)
    one = np.ones(n, h.dtype)
    dz = _errors(_plus(h @ net.to_class, net.class_bias), kind)
    dh = dz @ net.to_class.T
    to_id, id_bias = np.zeros_like(net.to_id), np.zeros_like(net.id_bias)
    d = np.empty((n, CLASS), h.dtype)
    for c, a, b in some:
        np.matmul(h[a:b], net.to_id[c], out=d[a:b])
    _errors(_plus(d, np.repeat(net.id_bias, np.diff(cuts), axis=0)), inside)  # of all classes at once
    for c, a, b in some:
        dh[a:b] += d[a:b] @ net.to_id[c].T
        np.matmul(h[a:b].T, d[a:b], out=to_id[c])
        id_bias[c] = one[a:b] @ d[a:b]
    da = dh * (1 - h * h)
    dx = _times(da, net.hidden.T).reshape(n * len(_OFFSETS), EMBEDDING)
    flat = around.ravel().astype(np.int16, copy=False)
    order = np.argsort(flat, kind="stable")
    flat = np.take(flat, order)
    begin = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    pairs = np.take(dx, order, axis=0).view(np.result_type(dx, np.complex64))  # two entries are added at a time
    embedding = np.zeros_like(net.embedding)
    embedding[flat[begin]] = np.add.reduceat(pairs, begin, axis=0).view(dx.dtype)
    for whole, total, part in (
        (net.embedding, grown.embedding, embedding), (net.hidden, grown.hidden, (da.T @ x).T), (net.hidden_bias, grown.hidden_bias, one @ da),
        (net.to_class, grown.to_class, h.T @ dz), (net.class_bias, grown.class_bias, one @ dz), (net.to_id, grown.to_id, to_id), (net.id_bias, grown.id_bias, id_bias),
    ):
        total += part * part
        part /= np.sqrt(total)
        part *= RATE
        whole += part


# ------------------------------------------------------------------ on Spark


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, added up over as many slices as have HELD words together."""
    held, size = [], 0

    def added() -> pa.RecordBatch:
        words, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(words, kind="stable")
        words = words[order]
        begin = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        return pa.RecordBatch.from_arrays([pa.array(words[begin].view(np.int64)), pa.array(np.add.reduceat(n[order], begin))], names=["word", "n"])

    for batch in batches:
        for a, b in pieces(batch.column(0)):
            words, n = np.unique(words_of(batch.column(0).slice(a, b - a)).hash, return_counts=True)
            if len(words):
                held.append((words, n.astype(np.int64)))
                size += len(words)
            if size > HELD:
                yield added()
                held, size = [], 0
    if held:
        yield added()


def least_common(counts: DataFrame, most: int) -> int:
    """The lowest count, 2 or more, down to which at most ``most`` words are counted."""
    total, least = 0, None
    # each of the highest counts has a word at least, so no more than ``most`` of them matter
    for r in counts.filter("n > 1").groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(most + 1).toLocalIterator():
        total += r.words
        if total > most:
            return r.n + 1 if least is None else least
        least = r.n
    return 2


def vocabulary(texts: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Ids of words by their counts over all texts, and the count of every id."""
    spark = texts.sparkSession
    counts = written(texts.select("text").mapInArrow(_count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = written(counts.orderBy(F.desc("n"), "word").limit(FREQUENT), "frequent").collect()  # bounded, and merged before it reaches the driver
    top.sort(key=lambda r: (-r.n, r.word))
    ids = Lookup(np.array([r.word for r in top], np.int64).view(np.uint64), np.arange(len(top)), -1)
    out = np.zeros(IDS)
    out[: len(top)] = [r.n for r in top]
    known = F.broadcast(spark.createDataFrame([(r.word,) for r in top], "word bigint"))
    bucket = F.pmod(F.shiftrightunsigned("word", 20), F.lit(BUCKETS))
    for r in counts.join(known, "word", "left_anti").groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[FREQUENT + r.b] = r.n
    least = least_common(counts, COMMON)
    held = counts.filter(F.col("n") >= least).toArrow()  # COMMON rows at most
    common = Lookup(held.column("word").to_numpy().view(np.uint64), np.log(held.column("n").to_numpy()), 0.0)
    table = None
    if least > 2:
        table = new_path(spark, "rare")
        counts.filter((F.col("n") > 1) & (F.col("n") < least)).write.parquet(table)
    return Vocabulary(ids, common, np.log(out[FREQUENT:] + 1), table), out


def drawn(hashes: np.ndarray) -> np.ndarray:
    """An order of all tokens, by 16 bits of a hash of each and its place, which sort in linear time."""
    mixed = _mixed(hashes + np.arange(len(hashes), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.argsort((mixed >> np.uint64(48)).astype(np.uint16), kind="stable")


def _train(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, flat = shared.value
        net = unpacked(flat)
        grown = Network(*(np.full_like(x, 1e-7) for x in net))
        seen = 0
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                w = words_of(batch.column(0).slice(a, b - a))
                ids = words(w.hash)
                near = Surroundings.of(ids, w.first)
                order = drawn(w.hash)
                while len(order):
                    # steps are short at first, and grow with what the task has seen
                    part, order = np.split(order, [min(max(seen // 16, STEP), LONGEST)])
                    learn(net, near.windows(part), ids[part], grown)
                    seen += len(part)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([(net.packed() * np.float32(seen)).tobytes()], pa.binary())], names=["n", "sums"])

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.float32).astype(np.float64) for x in table.column("sums"))
    return pa.table([pa.array([sum(table.column("n").to_pylist())], pa.int64()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["n", "sums"])


def averaged(parts: DataFrame) -> np.ndarray | None:
    """The weighted mean of parameter sets, FAN of them in a task at a time."""
    now = written(parts, "parameters")
    while (rows := now.count()) > FAN:
        groups = -(-rows // FAN)
        dealt = now.withColumn("part", F.pmod(F.xxhash64("sums"), F.lit(groups)))
        now = written(dealt.groupBy("part").applyInArrow(lambda t: _add(t.drop_columns(["part"])), "n bigint, sums binary"), "parameters")
    found = now.collect()  # FAN sets at most
    if not found:
        return None
    total = sum(np.frombuffer(bytes(r.sums), np.float32).astype(np.float64) for r in found)
    return (total / sum(r.n for r in found)).astype(np.float32)


def train(spark: SparkSession, documents: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray]:
    texts = documents.select(F.col("text").cast("string").alias("text"))
    words, counts = vocabulary(texts)
    flat = untrained(counts).packed()
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((words, flat))
        share = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn)
        found = averaged(share.mapInArrow(_train(shared), "n bigint, sums binary"))
        flat = flat if found is None else found
    return words, flat


def token_scores(w: Words, words: Vocabulary, net: Network, known: tuple | None = None) -> np.ndarray:
    ids, shared, common = known or words.looked_up(w.hash)
    out = np.zeros(len(ids))
    near = Surroundings.of(ids, w.first)
    for k in range(0, len(ids), CHUNK):
        at = slice(k, k + CHUNK)
        out[at] = log_probabilities(net, near.windows(at), ids[at])
    out[shared] += common - words.totals[ids[shared] - FREQUENT]
    return out


def rare_words(w: Words, known: tuple) -> pa.ListArray:
    """The words of each text whose counts only the table may have."""
    _, shared, common = known
    rare = shared[common == 0]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, w.first), pa.int32()), pa.array(w.hash[rare].view(np.int64)))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, flat = shared.value
        net = unpacked(flat)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                w = words_of(batch.column("text").slice(a, b - a))
                known = words.looked_up(w.hash)
                sums = np.concatenate([[0.0], np.cumsum(token_scores(w, words, net, known))])
                total = sums[w.first[1:]] - sums[w.first[:-1]]
                rare = rare_words(w, known) if words.table else pa.nulls(b - a, pa.list_(pa.int64()))
                arrays = [pa.array(np.arange(row, row + b - a)), batch.column("doc_id").slice(a, b - a), pa.array(np.diff(w.first)), pa.array(total), rare]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_tokens", "score", "rare"])
                row += b - a

    return run


def score(spark: SparkSession, documents: DataFrame, model: tuple[Vocabulary, np.ndarray]) -> DataFrame:
    """Rows (doc_id, n_tokens, score, mean): the sum and the mean of the tokens' log-probabilities."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(_score(spark.sparkContext.broadcast(model)), "row bigint, doc_id bigint, n_tokens bigint, score double, rare array<bigint>")
    if model[0].table:
        scored = written(scored, "scores")  # rows keep their numbers
        counts = spark.read.schema("word bigint, n bigint").parquet(model[0].table)
        more = scored.select("row", F.explode("rare").alias("word")).join(counts, "word").groupBy("row").agg(F.sum(F.log("n")).alias("more"))
        scored = scored.drop("rare").join(more, "row", "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0)))
    return scored.select("doc_id", "n_tokens", "score", F.when(F.col("n_tokens") > 0, F.col("score") / F.col("n_tokens")).alias("mean"))
