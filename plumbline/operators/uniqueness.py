"""Uniqueness of a key that is believed to be nearly unique, without shuffling its rows.

A frequency table shuffles every distinct key. Here a first pass folds the keys' hashes into two
mergeable sets per task, those seen once and those seen more often, cut into buckets by their
leading bits and stored as gaps of a few bytes; merging the tasks' sets of a bucket tells which hashes
may repeat. Keys that are equal have equal hashes, so all other rows are known to be unique. A second pass reads the keys
again, keeps the rows of those hashes and counts them by the keys themselves: what it shuffles are repeats and the
few rows whose hashes collide, and the verdict is exact.

Where too many hashes repeat for that, the frequency table is the better plan, and is used.
The sets are numpy arrays in the tasks: a set that counts to two and merges is nothing Spark's own aggregates offer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.functions.local import local_frame
from plumbline.operators.frequency import frequency_verdicts, judge_of, key_names
from plumbline.operators.verdict import rows
from plumbline.rules import FrequencyRule

#: Bits of a hash that are kept: among 10**10 rows some 700 share theirs with another key.
BITS = 56
#: Hashes that may repeat, at most; they are sent to every executor.
SUSPECTS = 1 << 18
#: Rows a task folds before it passes its sets on.
FOLD = 1 << 23

JUDGES = ("unique", "unique_proportion", "unique_count")
SETS = "bucket int, rows bigint, missing bigint, once binary, more binary"
MERGED = "bucket int, rows bigint, missing bigint, n bigint, suspects binary"


def filtered(df: DataFrame, rules: Sequence[FrequencyRule]) -> bool:
    """Whether these rules on the same columns ask for the filter, and for nothing that needs the frequency table."""
    plain = all(not isinstance(t, T.StringType) or t == T.StringType() for t in (df.schema[c].dataType for c in rules[0].columns))
    return plain and any(r.few_repeats for r in rules) and all(r.judge in JUDGES for r in rules)


def packed(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers: the first, then the gaps, all in as many bytes as the widest needs."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values[:1].astype("<u8").tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    gaps = np.zeros(((len(data) - 9) // width, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1, 1), gaps.view("<u8").ravel()]), dtype=np.uint64)


def fingerprints(df: DataFrame, names: Sequence[str], policy: str) -> DataFrame:
    """The keys as k0, k1, .. and ``print``, the leading bits of their hash; null for rows that are left out."""
    keys = [C.column(n).alias(k) for n, k in zip(names, key_names(names))]
    held = df.select(*keys)
    cols = [F.col(k) for k in key_names(names)]
    return held.withColumn("print", F.when(~C.missing(cols, policy), F.shiftrightunsigned(F.xxhash64(*cols), 64 - BITS)))


def _folded(buckets: int):
    def sets(parts: list[np.ndarray], count: int, missing: int) -> Iterator[pa.RecordBatch]:
        values, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, int))
        edges = np.searchsorted(values, np.array([(k << BITS) // buckets for k in range(1, buckets)], np.uint64))
        out: list[tuple] = []
        for k, (a, b) in enumerate(zip([0, *edges], [*edges, len(values)])):
            if a < b or (k == 0 and not len(values)):
                once = n[a:b] == 1
                out.append((k, 0 if out else count, 0 if out else missing, packed(values[a:b][once]), packed(values[a:b][~once])))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["bucket", "rows", "missing", "once", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        count = held = 0
        for batch in batches:
            prints = batch.column(0).drop_null().to_numpy().astype(np.uint64)
            parts.append(prints)
            count, held = count + batch.num_rows, held + len(prints)
            if held >= FOLD:
                yield from sets(parts, count, count - held)
                parts, count, held = [], 0, 0
        if count:
            yield from sets(parts, count, count - held)

    return run


def _merged(most: int):
    def run(table: pa.Table) -> pa.Table:
        once = np.sort(np.concatenate([unpacked(b) for b in table.column("once").to_pylist()]))
        again = once[1:][once[1:] == once[:-1]]
        suspects = np.unique(np.concatenate([again, *[unpacked(b) for b in table.column("more").to_pylist()]]))
        few = len(suspects) <= most
        counts = [sum(table.column(c).to_pylist()) for c in ("rows", "missing")]
        return pa.table(
            [table.column("bucket").slice(0, 1), *[pa.array([c], pa.int64()) for c in (*counts, len(suspects))], pa.array([packed(suspects) if few else None], pa.binary())],
            names=["bucket", "rows", "missing", "n", "suspects"],
        )

    return run


def folded(prints: DataFrame, buckets: int) -> DataFrame:
    """Each task's sets, a row per bucket that it met."""
    return prints.select("print").mapInArrow(_folded(buckets), SETS)


def suspected(prints: DataFrame) -> tuple[int, int, np.ndarray | None]:
    """Rows, rows left out, and the hashes that may repeat (None if they are more than ``SUSPECTS``)."""
    buckets = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(64, 4 * SUSPECTS // buckets)  # of one bucket; hashes are spread evenly
    found = folded(prints, buckets).groupBy("bucket").applyInArrow(_merged(most), MERGED).collect()  # a row per bucket
    count, missing, n = (sum(r[c] for r in found) for c in ("rows", "missing", "n"))
    if n > SUSPECTS or any(r["suspects"] is None for r in found):
        return count, missing, None
    return count, missing, np.concatenate([np.zeros(0, np.uint64), *[unpacked(bytes(r["suspects"])) for r in found]])


def possible_repeats(prints: DataFrame, suspects: np.ndarray) -> DataFrame:
    """The rows whose hash may repeat; the hashes are few enough for every executor."""
    side = local_frame(prints.sparkSession, {"suspect": "bigint"}, [(int(s),) for s in suspects])
    return prints.join(F.broadcast(side), F.col("print") == F.col("suspect"), "left_semi")


def unique_verdicts(df: DataFrame, rules: Sequence[FrequencyRule]) -> DataFrame:
    """Verdicts of rules on one key that count its distinct or repeated values, the same as of its frequency table."""
    names, policy = rules[0].columns, rules[0].ignore_row_if
    prints = fingerprints(df, names, policy)
    count, missing, suspects = suspected(prints)
    if suspects is None:
        return frequency_verdicts(df, rules)
    total = count - missing
    distinct, repeated = total, 0
    if len(suspects):
        groups = possible_repeats(prints, suspects).groupBy(*key_names(names)).agg(F.count(F.lit(1)).alias("n"))
        n = F.col("n")
        seen = groups.agg(F.sum(n).alias("rows"), F.count(n).alias("distinct"), F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("repeated")).first()
        distinct, repeated = total - seen["rows"] + seen["distinct"], seen["repeated"]
    facts = {"elements": count, "missing": missing, "total": total, "distinct": distinct, "repeated": repeated}
    one = local_frame(df.sparkSession, dict.fromkeys(facts, "bigint"), [list(facts.values())])
    return rows(one, [judge_of(rule, None, [df.schema[c].dataType for c in names]) for rule in rules])
