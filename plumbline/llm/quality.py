"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Words and runs of punctuation, case told apart, are the tokens of a trigram model. It is fitted on
all trusted documents of one half, by runs of RUN tokens, each distinct run once. Counts, counts
of contexts and continuation counts are made where all trigrams with the same last two words meet.

A token's log-probability is a sum: the floor of unknown words, what each known n-gram that ends
in it gains over the shorter one, and the weights of its known contexts. So a document's is a sum
over its n-grams, in any order. A model of up to HELD n-grams is held by every task. A larger one
is never there as a whole: all that a token needs of a trigram's middle word is one slice of the
model, so slices are made, looked up and joined one after the other, and each adds its part to the
sums of all documents. Of a slice the HELD most frequent n-grams are looked up where documents are
read, all others that a bit map lets pass are joined; then its tables are removed.

A document is kept if its perplexity is at most the ``level`` quantile of the trusted documents of
its language that the model was not fitted on; a language without such documents takes the
quantile of all of them. Scores and quantiles cover all documents. Defined results: null and
tokenless texts have no perplexity (null) and are not kept; a null language is a group of its own;
without trusted documents there is no threshold (null) and every document with tokens is kept; a
document labelled more than once is trusted if all labels say so; repeated rows score alike; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.decontaminate import LEAST, MOST, in_map, map_of
from plumbline.llm.store import passing, tidy, written
from plumbline.llm.words import Lookup, Words, _mixed, pieces, tokens_of

#: Tokens of a run, and runs that a task takes up at a time.
RUN, TAKEN = 256, 1024
#: N-grams (of a slice) whose values every task holds; those of all others are joined.
HELD = 1 << 20
#: Slices of a model of more n-grams, and those in which they are counted first.
SLICES, COUNTED = 8, 2
#: Buckets that a slice's entries and what is asked of them meet in, at least; more if one would have over a million entries.
BUCKETS = 256
#: Bits of a slice's map for each n-gram that is joined.
SPARSE = 8
#: The quantile of trusted perplexities up to which documents are kept.
LEVEL = 0.995
#: Stands before the first token of a text.
START = np.uint64(0x5354415254)
#: Tells an n-gram as a context from the same one as an end.
CONTEXT = 0x434F4E54455854


class Counts(NamedTuple):
    """What slices of the model are made from."""

    fitted: DataFrame  # (run): the text
    words: DataFrame  # (w, c, p, gain): words with their probabilities
    two: list[float]  # discounts of bigrams
    three: list[float]  # and of trigrams
    slices: int
    size: int  # how many n-grams there are


class Model(NamedTuple):
    """What the held n-grams add to log-probabilities; if not all are held, none is, and the table tells what they are made from."""

    first: Lookup  # gain of a word or a longer n-gram over the shorter one without its first token
    rest: Lookup  # log of the mass that an n-gram leaves to shorter contexts where it is the context
    floor: float  # log-probability of an unknown word
    table: Counts | None = None


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * np.uint64(0x9FB21C651E98DF25) + b)


def contexts(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per token: hashes of u v w, of u v, of v w, and v, w, for texts that begin at ``first``."""
    w = hashes
    v = np.concatenate([[START], w[:-1]]) if len(w) else w
    u = np.concatenate([[START], v[:-1]]) if len(w) else w
    begin = first[:-1][np.diff(first) > 0]
    v[begin] = u[begin] = START
    second = begin + 1
    u[second[second < len(w)]] = START
    before = pair(u, v)
    return pair(before, w), before, pair(v, w), v, w


def log_probabilities(hashes: np.ndarray, first: np.ndarray, m: Model) -> np.ndarray:
    """As far as the held n-grams tell them."""
    uvw, uv, vw, v, w = contexts(hashes, first)
    return m.floor + m.first(uvw) + m.rest(uv) + m.first(vw) + m.rest(v) + m.first(w)


def slice_of(words: np.ndarray, slices: int) -> np.ndarray:
    return (words >> np.uint64(40)) % np.uint64(slices)


def asked(w: Words, at: int, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all that tokens need of a slice, and the text of each."""
    uvw, uv, vw, v, last = contexts(w.hash, w.first)
    here, there = (np.flatnonzero(slice_of(x, slices) == at) for x in (v, last))
    context = np.uint64(CONTEXT)
    whose = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    keys = np.concatenate([uvw[here], vw[here], last[there], uv[here] ^ context, v[here] ^ context])
    return keys, np.concatenate([whose[x] for x in (here, here, there, here, here)])


def runs_of(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, owner and hash of the runs of RUN tokens of each text."""
    n = -(-np.diff(w.first) // RUN)
    owner = np.repeat(np.arange(len(n)), n)
    start = w.first[owner] + RUN * (np.arange(len(owner)) - (np.cumsum(n) - n)[owner])
    if not len(start):
        return start, owner, np.zeros(0, np.int64)
    inside = np.arange(len(w.hash)) - np.repeat(start, np.diff(np.append(start, len(w.hash))))
    sums = np.add.reduceat(_mixed(w.hash + inside.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), start)
    return start, owner, (_mixed(sums) >> np.uint64(1)).astype(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in pieces(texts):
            _, owner, at = runs_of(tokens_of(texts.slice(a, b - a)))
            whose = pa.array(a + owner)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(whose), batch.column("lang").take(whose), pa.array(at)], names=["doc_id", "lang", "at"])


def _chosen(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, given = bits.value, np.zeros(0, np.int64)
        for batch in batches:
            texts = batch.column("text")
            for a, b in pieces(texts):
                w = tokens_of(texts.slice(a, b - a))
                start, _, at = runs_of(w)
                if not len(start):
                    continue
                stop = w.end[np.append(start[1:], len(w.hash)) - 1]
                start = w.start[start]
                fresh, k = np.unique(at, return_index=True)
                new = in_map(there, fresh.view(np.uint64)) & ~np.isin(fresh, given)
                fresh, k = fresh[new], k[new]
                given = np.concatenate([given, fresh])  # a task gives a run once
                runs = [w.data[start[j] : stop[j]].tobytes() for j in k.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(fresh), pa.array(runs, pa.binary())], names=["at", "run"])

    return run


def quotas(sizes: dict, total: int) -> dict:
    """Even shares of ``total``; what a small group leaves goes to the others. Every group gets one at least."""
    out = {}
    for left, (key, n) in zip(range(len(sizes), 0, -1), sorted(sizes.items(), key=lambda x: (x[1], str(x[0])))):
        out[key] = min(n, max(1, total // left))
        total -= out[key]
    return out


def _trigrams(at: int, slices: int):
    """Distinct trigrams of a slice of some runs at a time, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, TAKEN):
                words = tokens_of(batch.column("run").slice(k, TAKEN))
                uvw, uv, _, v, w = contexts(words.hash, words.first)
                here = np.flatnonzero(slice_of(v, slices) == at)
                _, first, n = np.unique(uvw[here], return_index=True, return_counts=True)
                arrays = [pa.array(x[here[first]].view(np.int64)) for x in (uv, v, w)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(n.astype(np.int32))], names=["uv", "v", "w", "n"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray] | None:
    """Trigrams of a partition with their counts ``c``, those with the same last two words side by side; ``lead`` is the first of ``size`` such."""
    batches = [x for x in batches if x.num_rows]
    if not batches:
        return None
    rows = pa.Table.from_batches(batches)
    uv, v, w = (rows.column(x).to_numpy().view(np.uint64) for x in ("uv", "v", "w"))
    uvw, vw = pair(uv, w), pair(v, w)
    order = np.lexsort((uvw, vw))
    sorted_ = uvw[order]
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    out = {"c": np.add.reduceat(rows.column("n").to_numpy().astype(np.int64)[order], first)}
    take = order[first]
    out |= {"uvw": uvw[take], "uv": uv[take], "vw": vw[take], "v": v[take], "w": w[take]}
    out["lead"] = np.append(True, out["vw"][1:] != out["vw"][:-1])
    out["size"] = np.diff(np.append(np.flatnonzero(out["lead"]), len(take)))
    return out


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (order, key, n): how many trigrams and bigrams have the counts 1 to 4, or any (0), and how many bigrams end in each word."""
    m = _merged(batches)
    if m is None:
        return
    words, n = np.unique(m["w"][m["lead"]], return_counts=True)
    few = [(3, 0, len(m["c"])), (2, 0, len(m["size"]))] + [(order, k, int((x == k).sum())) for order, x in ((3, m["c"]), (2, m["size"])) for k in (1, 2, 3, 4)]
    order, key, count = zip(*few)
    arrays = [np.append(np.array(order), np.ones(len(words), np.int64)), np.append(np.array(key), words.view(np.int64)), np.append(np.array(count), n)]
    yield pa.RecordBatch.from_arrays([pa.array(arrays[0], pa.int32()), pa.array(arrays[1]), pa.array(arrays[2])], names=["order", "key", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (uvw, uv, vw, c) of trigrams; the first of each bigram vw has its words and count too."""
    m = _merged(batches)
    if m is None:
        return
    size = np.zeros(len(m["lead"]), np.int64)
    size[m["lead"]] = m["size"]
    arrays = [pa.array(m[x].view(np.int64)) for x in ("uvw", "uv", "vw", "c")]
    more = [pa.array(x.view(np.int64), mask=~m["lead"]) for x in (m["v"], m["w"], size)]
    yield pa.RecordBatch.from_arrays([*arrays, *more], names=["uvw", "uv", "vw", "c", "v", "w", "size"])


def trigrams(fitted: DataFrame, at: int, slices: int) -> DataFrame:
    """Rows (uv, v, w, n) of a slice, those of a bigram vw in one partition."""
    return fitted.mapInArrow(_trigrams(at, slices), "uv bigint, v bigint, w bigint, n int").repartition("v", "w")


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The three discounts of modified Kneser-Ney, from how many n-grams have the counts 1 to 4."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [k - (k + 1) * y * b / a if a else 0.0 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)]


def discounted(by: list[float]):
    return F.when(F.col("c") == 1, by[0]).when(F.col("c") == 2, by[1]).otherwise(by[2])


def shares(counts: DataFrame, context: str, by: list[float]) -> tuple[DataFrame, DataFrame]:
    """The counts with ``share``, discounted within the context, and (context, total, rest), the mass that the discounts leave."""
    totals = counts.groupBy(context).agg(F.sum("c").alias("total"), F.sum(discounted(by)).alias("taken"))
    totals = totals.select(context, "total", (F.col("taken") / F.col("total")).alias("rest"))
    return counts.join(totals, context).withColumn("share", (F.col("c") - discounted(by)) / F.col("total")).drop("total"), totals


def entries(counts: Counts, at: int, slices: int, put) -> DataFrame:
    """Rows (key, context, c, gain) of a slice: what n-grams gain, and the log of what contexts leave; ``put`` writes what they are made from."""
    rows = put(trigrams(counts.fitted, at, slices).mapInArrow(_counted, "uvw bigint, uv bigint, vw bigint, c bigint, v bigint, w bigint, size bigint"), "trigrams")
    second, after_word = shares(rows.filter("size IS NOT NULL").select("vw", "v", "w", F.col("size").alias("c")), "v", counts.two)
    second = second.join(counts.words.select("w", F.col("p").alias("shorter")), "w")
    second = second.withColumn("p", F.col("share") + F.col("rest") * F.col("shorter")).withColumn("gain", F.log("p") - F.log("rest") - F.log("shorter"))
    second = put(second.select("vw", "c", "p", "gain"), "bigrams")
    third, after_pair = shares(rows.select("uvw", "uv", "vw", "c"), "uv", counts.three)
    third = third.join(second.select("vw", F.col("p").alias("shorter")), "vw")
    third = third.withColumn("gain", F.log(F.col("share") + F.col("rest") * F.col("shorter")) - F.log("rest") - F.log("shorter"))
    first = counts.words.filter(F.pmod(F.shiftrightunsigned("w", 40), F.lit(slices)) == at)
    ends = [x.select(F.col(key).alias("key"), F.lit(False).alias("context"), "c", "gain") for x, key in ((third, "uvw"), (second, "vw"), (first, "w"))]
    left = [x.select(F.col(key).bitwiseXOR(F.lit(CONTEXT)).alias("key"), F.lit(True).alias("context"), F.col("total").alias("c"), F.log("rest").alias("gain")) for x, key in ((after_pair, "uv"), (after_word, "v"))]
    return reduce(DataFrame.union, ends + left)


def _packed(buckets: int):
    """Entries as a row for each bucket and batch: arrays of keys, counts and gains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            order, ends = dealt(keys, buckets)
            columns = [x[order] for x in (keys, batch.column("c").to_numpy(), batch.column("gain").to_numpy())]
            yield cut(ends, *columns, names=["keys", "counts", "gains"])

    return run


def dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by the bucket, the leading bits of a key, and where each bucket ends."""
    bucket = keys >> np.uint64(65 - buckets.bit_length())
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets, dtype=np.uint64), side="right")


def cut(ends: np.ndarray, *columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """A row for each bucket that has any."""
    there = np.flatnonzero(np.diff(ends, prepend=0))
    first = np.append(0, ends)[there].tolist()
    parts = [pa.array([x[a:b].tobytes() for a, b in zip(first, ends[there].tolist())], pa.binary()) for x in columns]
    return pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), *parts], names=["bucket", *names])


def _of(batch: pa.RecordBatch, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in batch.column(name).to_pylist() if x]



def _how_often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (n, words): how many entries have a count, per batch."""
    for batch in batches:
        c, n = np.unique(np.concatenate([np.zeros(0, np.int64), *_of(batch, "counts", np.int64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n)], names=["n", "words"])


def least_held(often: DataFrame, most: int) -> int:
    """The lowest count, 2 or more, down to which there are at most ``most`` entries."""
    # each of the highest counts has an entry at least, so no more than ``most`` of them matter
    rows = often.filter("n > 1").orderBy(F.desc("n")).limit(most + 1).toArrow()
    n, fits = rows.column("n").to_numpy(), np.cumsum(rows.column("words").to_numpy()) <= most
    if fits.all():
        return 2
    return int(n[fits][-1]) if fits.any() else int(n[0]) + 1


def _frequent(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = np.zeros(0, np.int64)
            c, keys, gains = (np.concatenate([none.view(kind), *_of(batch, x, kind)]) for x, kind in (("counts", np.int64), ("keys", np.int64), ("gains", np.float64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[c >= least]), pa.array(gains[c >= least])], names=["key", "gain"])

    return run


def _bits(least: int, buckets: int, bits: int):
    """The map's bytes of each bucket of a partition, for entries that are joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, maps = bits // buckets, {}
        for batch in batches:
            for bucket, keys, c in zip(batch.column("bucket").to_pylist(), _of(batch, "keys", np.uint64), _of(batch, "counts", np.int64)):
                there = maps.setdefault(bucket, np.zeros(size, bool))
                there[((keys[c < least] >> np.uint64(65 - bits.bit_length())) & np.uint64(size - 1)).astype(np.int64)] = True
        for bucket, there in maps.items():
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([np.packbits(there, bitorder="little").tobytes()], pa.binary())], names=["bucket", "bits"])

    return run


def _answers(least: int):
    """Rows (row, n, total): sums of what the entries of a partition's buckets answer, and sums that are there already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, asks = {}, {}
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("bucket", "keys", "counts", "gains", "rows")]
            for bucket, keys, c, gains, rows in zip(*columns):
                if bucket < 0:
                    arrays = [np.frombuffer(rows, np.int64), np.frombuffer(c, np.int64), np.frombuffer(gains)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["row", "n", "total"])
                elif rows is None:
                    rare = np.frombuffer(c, np.int64) < least
                    tables.setdefault(bucket, []).append((np.frombuffer(keys, np.uint64)[rare], np.frombuffer(gains)[rare]))
                else:
                    asks.setdefault(bucket, []).append((np.frombuffer(rows, np.int64), np.frombuffer(keys, np.uint64)))
        whose, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
        for bucket, asked in asks.items():
            if bucket in tables:
                keys, gains = (np.concatenate(x) for x in zip(*tables.pop(bucket)))
                rows, wanted = (np.concatenate(x) for x in zip(*asked))
                found = Lookup(keys, gains, math.nan)(wanted)
                known = ~np.isnan(found)
                whose.append(rows[known])
                sums.append(found[known])
        rows, at = np.unique(np.concatenate(whose), return_inverse=True)
        total = np.bincount(at, np.concatenate(sums), len(rows)).astype(np.float64)  # of nothing it counts in integers
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.nulls(len(rows), pa.int64()), pa.array(total)], names=["row", "n", "total"])

    return run


def trusted(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say quality 1, and which half they fall into: 0 to fit on, 1 for the thresholds."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("bigint").alias("quality")).dropna()
    good = rows.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    return good.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"))


def runs_to_fit(documents: DataFrame, labels: DataFrame, runs: int | None = None) -> DataFrame:
    """Rows (at, run): the distinct runs (their text) of all trusted documents of the half to fit on, or about ``runs`` of them."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    # distinct first: copies are one run, of the language that sorts first
    keys = texts.mapInArrow(_keys, "doc_id bigint, lang string, at bigint").join(trusted(labels).filter("half = 0").select("doc_id"), "doc_id", "left_semi")
    keys = written(keys.groupBy("at").agg(F.min("lang").alias("lang")), "runs")
    if runs is not None:
        sizes = {r.lang: r["count"] for r in keys.groupBy("lang").count().collect()}
        quota, thin, place = quotas(sizes, runs), F.lit(False), F.pmod(F.xxhash64("at"), F.lit(1 << 30))
        for lang, n in sizes.items():
            thin = thin | (F.col("lang").eqNullSafe(F.lit(lang)) & (place < int(min(1.0, (2 * quota[lang] + 16) / n) * (1 << 30))))
        picked, left = [], dict(quota)
        for r in sorted(keys.filter(thin).collect(), key=lambda r: r["at"]):  # about twice ``runs``
            if left[r.lang]:
                left[r.lang] -= 1
                picked.append((r["at"],))
        keys = documents.sparkSession.createDataFrame(picked, "at bigint")
    bits = documents.sparkSession.sparkContext.broadcast(map_of(keys.select(F.col("at").alias("mark"))))
    found = texts.select("text").mapInArrow(_chosen(bits), "at bigint, run binary")
    return found.join(keys.select("at"), "at", "left_semi").groupBy("at").agg(F.any_value("run").alias("run"))


def train(documents: DataFrame, labels: DataFrame, runs: int | None = None) -> Model | None:
    """The model of all trusted text to fit on; of about ``runs`` of its runs, if that is given."""
    spark = documents.sparkSession
    fitted = written(runs_to_fit(documents, labels, runs).select("run"), "fitted")
    with passing(spark) as put:
        tallies = [put(trigrams(fitted, k, COUNTED).mapInArrow(_tallies, "order int, key bigint, n bigint"), "tallies") for k in range(COUNTED)]
        tally = written(reduce(DataFrame.union, tallies).groupBy("order", "key").agg(F.sum("n").alias("n")), "tally")
    some = {(r.order, r.key): r.n for r in tally.filter("order > 1").collect()}  # ten rows
    one = tally.filter("order = 1").select(F.col("key").alias("w"), F.col("n").alias("c"))
    words = one.count()
    if not words:
        return None
    by = discounts(*one.agg(*(F.count(F.when(F.col("c") == k, 1)) for k in (1, 2, 3, 4))).first())
    total, taken = one.agg(F.sum("c"), F.sum(discounted(by))).first()
    unknown = taken / total / (words + 1)  # shared evenly by all known words and one for the unknown
    one = one.withColumn("p", (F.col("c") - discounted(by)) / F.lit(total) + F.lit(unknown)).withColumn("gain", F.log("p") - math.log(unknown))
    two, three = (discounts(*(some[order, k] for k in (1, 2, 3, 4))) for order in (2, 3))
    there = some[3, 0] + some[2, 0] + words
    counts = Counts(fitted, one, two, three, min(SLICES, -(-there // max(HELD, 1))), there)
    none = np.zeros(0, np.uint64), np.zeros(0)
    if there > HELD:
        return Model(Lookup(*none, 0.0), Lookup(*none, 0.0), math.log(unknown), counts)
    with passing(spark) as put:
        table = entries(counts, 0, 1, put).toArrow()  # of HELD n-grams at most
    keys, gains, context = table.column("key").to_numpy().view(np.uint64), table.column("gain").to_numpy(), table.column("context").to_numpy()
    return Model(Lookup(keys[~context], gains[~context], 0.0), Lookup(keys[context] ^ np.uint64(CONTEXT), gains[context], 0.0), math.log(unknown))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = model.value
        for batch in batches:
            texts = batch.column("text")
            for a, b in pieces(texts):
                w = tokens_of(texts.slice(a, b - a))
                n = np.diff(w.first)
                logs = np.zeros(len(w.hash)) if m is None else log_probabilities(w.hash, w.first, m)
                total = np.bincount(np.repeat(np.arange(b - a), n), logs, b - a).astype(np.float64)
                arrays = [batch.column("doc_id").slice(a, b - a), batch.column("lang").slice(a, b - a), pa.array(n), pa.array(total, mask=(n == 0) | (m is None))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", "n_tokens", "total"])

    return run


def _parts(model, floor: float, at: int, slices: int, buckets: int):
    """Sums of what a slice's held entries add to texts (bucket -1), and for each bucket the keys that only its table may have, and who asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bits = model.value
        for batch in batches:
            texts, names = batch.column("text"), batch.column("row").to_numpy()
            for a, b in pieces(texts):
                w = tokens_of(texts.slice(a, b - a))
                n = np.diff(w.first)
                keys, whose = asked(w, at, slices)
                gains = held(keys)
                open_ = np.isnan(gains)
                total = np.bincount(whose[~open_], gains[~open_], b - a) + (floor * n if at == 0 else 0.0)
                columns = [pa.array([x.tobytes()], pa.binary()) for x in (n.astype(np.int64), total, names[a:b])]
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.nulls(1, pa.binary()), *columns], names=["bucket", "keys", "counts", "gains", "rows"])
                if bits is None:
                    continue
                keys, whose = keys[open_], whose[open_]
                rare = np.flatnonzero(in_map(bits, keys >> np.uint64(64 - (8 * len(bits)).bit_length() + 1)))
                keys, whose = keys[rare], whose[rare]
                order, ends = dealt(keys, buckets)
                found = cut(ends, keys[order], names[a:b][whose[order]], names=["keys", "rows"])
                none = pa.nulls(found.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([found.column(0), found.column(1), none, none, found.column(2)], names=["bucket", "keys", "counts", "gains", "rows"])

    return run


def part(rows: DataFrame, model: Model, at: int) -> DataFrame:
    """Rows (row, n, total), written: tokens of each text and what a slice of the model adds to its log-probability."""
    spark, counts = rows.sparkSession, model.table
    buckets = max(BUCKETS, 1 << (counts.size // counts.slices >> 20).bit_length())
    with passing(spark) as put:
        with passing(spark) as first:
            made = entries(counts, at, counts.slices, first).select("key", "c", "gain")
            table = put(made.mapInArrow(_packed(buckets), "bucket int, keys binary, counts binary, gains binary"), "model")
        often = table.select("counts").mapInArrow(_how_often, "n bigint, words bigint").groupBy("n").agg(F.sum("words").alias("words"))
        there = often.agg(F.sum("words")).first()[0] or 0
        least = 1 if there <= HELD else least_held(often, HELD)
        held = table.select("keys", "counts", "gains").mapInArrow(_frequent(least), "key bigint, gain double").toArrow()  # HELD rows at most
        held = Lookup(held.column("key").to_numpy().view(np.uint64), held.column("gain").to_numpy(), math.nan)
        there, bits = there - len(held.keys), None
        if there:
            size = min(MOST, max(LEAST, 8 * buckets, 1 << (SPARSE * there).bit_length()))
            bits = np.zeros((buckets, size // buckets // 8), np.uint8)
            maps = table.select("bucket", "keys", "counts").repartition("bucket").mapInArrow(_bits(least, buckets, size), "bucket int, bits binary")
            for r in maps.collect():  # the size of the map
                bits[r.bucket] = np.frombuffer(r.bits, np.uint8)
            bits = bits.ravel()
        shared = spark.sparkContext.broadcast((held, bits))
        columns = "bucket int, keys binary, counts binary, gains binary, rows binary"
        asks = rows.mapInArrow(_parts(shared, model.floor, at, counts.slices, buckets), columns)
        # what is summed already is dealt evenly
        spread = F.when(F.col("bucket") < 0, F.xxhash64("rows")).otherwise(F.col("bucket"))
        both = asks.union(table.withColumn("rows", F.lit(None).cast("binary"))).repartition(spread)
        sums = both.mapInArrow(_answers(least), "row bigint, n bigint, total double")
        # repeated rows are one, each of which has asked
        out = written(sums.groupBy("row").agg(F.max("n").alias("n"), (F.sum("total") / F.count("n")).alias("total")), "part")
        shared.destroy()
    return out


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """Rows (doc_id, lang, n_tokens, perplexity), one per document row."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    if model is None or model.table is None:
        shared = documents.sparkSession.sparkContext.broadcast(model)
        scored = rows.mapInArrow(_score(shared), "doc_id bigint, lang string, n_tokens bigint, total double")
    else:
        rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
        parts = reduce(DataFrame.union, [part(rows.select("row", "text"), model, k) for k in range(model.table.slices)])
        sums = parts.groupBy("row").agg(F.max("n").alias("n_tokens"), F.sum("total").alias("total"))
        scored = rows.select("row", "doc_id", "lang").join(sums, "row", "left")
    return scored.select("doc_id", "lang", "n_tokens", F.when(F.col("n_tokens") > 0, F.exp(-F.col("total") / F.col("n_tokens"))).alias("perplexity"))


def classify(documents: DataFrame, labels: DataFrame, level: float = LEVEL) -> DataFrame:
    """Rows (doc_id, lang, n_tokens, perplexity, threshold, keep), one per document row."""
    with tidy(documents.sparkSession):
        scored = written(score(documents, train(documents, labels)), "perplexities")
    known = scored.join(trusted(labels).filter("half = 1").select("doc_id"), "doc_id", "left_semi").filter("perplexity IS NOT NULL")
    quantile = F.percentile_approx("perplexity", level, 10_000)
    by_lang = known.groupBy("lang").agg(quantile.alias("own")).withColumnRenamed("lang", "of")  # a row per language
    overall = known.agg(quantile).first()[0]
    joined = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    limited = joined.select("doc_id", "lang", "n_tokens", "perplexity", F.coalesce("own", F.lit(overall).cast("double")).alias("threshold"))
    return limited.withColumn("keep", (F.col("n_tokens") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
