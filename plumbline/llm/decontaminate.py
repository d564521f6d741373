"""Benchmark decontamination by winnowing.

A window is 13 consecutive words of a benchmark item; an item of fewer words (but not none) is one
window. A document's fingerprints are the minimum k-gram hashes of its sliding windows, so a span
shared with an item over a whole window always shares a fingerprint: the minimum over the same
k-grams on both sides. Documents' and items' fingerprints are joined, each hit is extended to the
full window, and the words decide, not the hash.

Defined results: null or wordless texts have no words and no windows; an item without id marks
words but is not counted or named; repeated items count once per id; one result row per document
row, repeated rows included. An empty benchmark finds nothing. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import same_rows, text_digest, written
from plumbline.llm.words import grams, pieces, words_of

#: Words of a window, and of the k-grams whose minimum is its fingerprint.
WINDOW, K = 13, 7
#: Bits of the map that tells which fingerprints the benchmark can have: so many for each different one, from 2 MB to 32 MB.
SPARSE, LEAST, MOST = 64, 1 << 24, 1 << 28
#: One window may be in a large part of all documents: its join is split over so many keys.
SALTS = 16


def fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of every window of ``length`` words: the minimum hash of its k-grams."""
    k = min(K, length)
    g = grams(hashes, k)
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    low = g[:n].copy()
    for j in range(1, length - k + 1):
        np.minimum(low, g[j : j + n], out=low)
    return low


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _windows_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("item_id"), batch.column("text")
        for a, b in pieces(texts):
            w = words_of(texts.slice(a, b - a))
            item, length, mark, window = [], [], [], []
            for i in range(b - a):
                lo, hi = int(w.first[i]), int(w.first[i + 1])
                size = min(WINDOW, hi - lo)
                if not size:
                    continue
                found = _signed(fingerprints(w.hash[lo:hi], size)).tolist()
                item += [ids[a + i].as_py()] * len(found)
                length += [size] * len(found)
                mark += found
                window += [w.span(lo + j, lo + j + size) for j in range(len(found))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(length, pa.int32()), pa.array(mark, pa.int64()), pa.array(window, pa.string())],
                names=["item_id", "length", "mark", "words"],
            )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Rows (item_id, length, mark, words): every window of every item, once per item, with its fingerprint."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(_windows_of_items, "item_id bigint, length int, mark bigint, words string").distinct()


def bit_map(windows: DataFrame) -> np.ndarray:
    """Which fingerprints there are, modulo the number of bits, as bytes whose lowest bit comes first.

    Its size follows the number of different fingerprints, so that few others pass it, up to a bound.
    """
    return map_of(windows.select("mark").distinct())


def map_of(marks: DataFrame) -> np.ndarray:
    """The bit map of different fingerprints."""
    bits = min(MOST, max(LEAST, 1 << (SPARSE * marks.count()).bit_length()))
    at = F.shiftright(F.pmod("mark", F.lit(bits)), 6).alias("at")
    table = marks.groupBy(at).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(mark, 64) AS int))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, "<i8")
    out[table["at"].to_numpy()] = table["bits"].to_numpy()
    return out.view(np.uint8)


def in_map(held: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = marks & np.uint64(8 * len(held) - 1)
    return (held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


_HITS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("mark", pa.int64()), ("words", pa.string())]))


def _seeds(lengths: list[int], bits):
    """Per document: its number of words, and its windows whose fingerprint the benchmark may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for a, b in pieces(texts):
                w = words_of(texts.slice(a, b - a))
                starts, sizes, marks = [], [], []
                for length in lengths:
                    found = fingerprints(w.hash, length)
                    at = np.flatnonzero(in_map(there, found))
                    # windows are taken over all texts at once; those that run into the next text are dropped
                    text = np.searchsorted(w.first, at, side="right") - 1
                    at = at[at + length <= w.first[text + 1]]
                    starts.append(at)
                    sizes.append(np.full(len(at), length, np.int32))
                    marks.append(found[at])
                start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
                size = np.concatenate(sizes) if sizes else np.zeros(0, np.int32)
                mark = np.concatenate(marks) if marks else np.zeros(0, np.uint64)
                order = np.argsort(start, kind="stable")
                start, size, mark = start[order], size[order], mark[order]
                text = np.searchsorted(w.first, start, side="right") - 1
                spans = [w.span(s, s + n) for s, n in zip(start.tolist(), size.tolist())]
                hit = pa.StructArray.from_arrays(
                    [pa.array((start - w.first[text]).astype(np.int32)), pa.array(size, pa.int32()), pa.array(_signed(mark)), pa.array(spans, pa.string())],
                    fields=list(_HITS.value_type),
                )
                first = np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), batch.column("digest").slice(a, b - a), pa.array(np.diff(w.first)), pa.ListArray.from_arrays(pa.array(first), hit)],
                    names=["doc_id", "digest", "n_words", "seeds"],
                )

    return run


def decontaminate(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """Rows (doc_id, digest, n_words, n_hit, n_items, items, contaminated), one per document row; the digest is of the text.

    ``items`` are the ids of items with a window in the document, sorted as strings. A document is
    contaminated if any word is hit and the hit words are at least one in ``share``.
    """
    windows = written(item_windows(benchmark), "windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most WINDOW values
    bits = spark.sparkContext.broadcast(bit_map(windows).tobytes())
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seeds = texts.withColumn("digest", text_digest()).mapInArrow(
        _seeds(lengths, bits), "doc_id bigint, digest binary, n_words bigint, seeds array<struct<start:int,length:int,mark:bigint,words:string>>"
    )
    scanned = written(seeds.withColumn("row", F.monotonically_increasing_id()), "seeds")

    # the join of fingerprints, extended to whole windows: equal mark and equal words
    salted = scanned.select("row", F.explode("seeds").alias("s")).select("row", "s.*", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
    known = windows.select("mark", "length", "words").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = written(salted.join(known, ["mark", "length", "words", "salt"]).select("row", "start", "length", "words", "salt"), "hits")

    # words in the union of the hit windows of a document
    reach = "max(start + length) OVER (PARTITION BY row ORDER BY start, length ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    fresh = hits.select("row", F.expr(f"greatest(0, start + length - greatest(start, coalesce({reach}, 0)))").alias("fresh"))
    covered = fresh.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    # items, by way of the distinct windows of a document
    owners = windows.filter("item_id IS NOT NULL").select("words", "item_id").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    owned = hits.select("row", "words", "salt").distinct().join(owners, ["words", "salt"]).select("row", F.col("item_id").cast("string").alias("item")).distinct()
    named = owned.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (
        scanned.select("row", "doc_id", "digest", "n_words").join(covered, "row", "left").join(named, "row", "left")
        .select(
            "doc_id", "digest", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def accepted(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that are not contaminated."""
    found = decontaminate(spark, documents, benchmark).filter("contaminated")
    return same_rows(documents, found, "left_anti").drop("__digest")
