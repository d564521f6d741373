"""Whitening of embeddings: leading principal components found by spectrum slicing, scaled to unit variance.

The vectors of the fit list (each distinct one once) give their sums and, in a second pass over centred vectors, their
covariance: tasks add up matrices of their own, rows of which are added per row number. The matrix has as
many entries as a vector has components squared, whatever the table's size, and is taken apart on the driver:

- the inertia of V - s I, by LDL' with symmetric pivots of one and two, counts the eigenvalues above s;
- counts bisect an interval for each leading eigenvalue until it holds no other one;
- Rayleigh quotient iteration from inside the interval converges cubically to its pair, deflated by those found;
- counts just above and just below the eigenvalue certify its number; a pair that fails is sought again in
  a narrower interval. Eigenvalues too close to be told apart in double precision are certified together.

Defined results: rows whose vector is null, empty, or holds a null or a component that is not finite are left out; rows without id
are kept with a null id, repeated rows each have their own result. Components become ``floor(64 c) + 1000000``, and beyond 2**52
in magnitude they saturate. Vectors of different lengths are fitted apart, each length with its own n; the identity error
is the largest of all. A component without variance (fewer distinct vectors than components, say) has a null
``whitened`` and no part in the identity error, which is 0 if there are none. A deviation beyond 64 bits is null. An empty table gives an empty one; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.store import written

#: Components asked for, scale and shift of the entries, and where they saturate.
COMPONENTS, SCALE, SHIFT, EDGE = 16, 64.0, 1_000_000, float(1 << 52)
#: Rows added up at a time.
BATCH = 4096

# ------------------------------------------------------------------ eigenvalues by counting


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues of a symmetric matrix are negative, zero and positive, by LDL' with Bunch and Kaufman's pivots."""
    a = np.array(a, dtype=np.float64)
    n, k = len(a), 0
    negative = zero = 0
    alpha = (1 + 17**0.5) / 8
    while k < n:
        rest = a[k:, k:]
        column = np.abs(rest[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        most = column[r - 1] if len(column) else 0.0
        own = abs(rest[0, 0])
        if max(own, most) == 0:
            zero += 1
            k += 1
            continue
        wide = False
        if own < alpha * most:
            row = np.abs(rest[r])
            row[r] = 0
            other = row.max()
            if own * other >= alpha * most * most:
                pass
            elif abs(rest[r, r]) >= alpha * other:
                _swap(rest, 0, r)
            else:
                _swap(rest, 1, r)
                wide = True
        if not wide:
            d = rest[0, 0]
            negative += d < 0
            l = rest[1:, 0].copy()
            rest[1:, 1:] -= np.outer(l / d, l)
            k += 1
        else:
            d = rest[:2, :2].copy()
            negative += 1  # such a block has an eigenvalue of each sign
            l = rest[2:, :2].copy()
            rest[2:, 2:] -= l @ np.linalg.solve(d, l.T)
            k += 2
    return int(negative), int(zero), int(n - negative - zero)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


@dataclass
class Pairs:
    """Leading eigenpairs: falling values, unit vectors as columns, and whether counts certify each one's number."""

    values: np.ndarray
    vectors: np.ndarray
    certified: np.ndarray


def leading_pairs(v: np.ndarray, k: int) -> Pairs:
    """The k largest eigenvalues of a symmetric matrix and their vectors."""
    d = len(v)
    k = min(k, d)
    scale = float(np.abs(v).sum(axis=1).max()) if d else 0.0
    if scale == 0:
        return Pairs(np.zeros(k), np.eye(d)[:, :k], np.ones(k, bool))
    m = v / scale  # all eigenvalues within [-1, 1]
    fine = 64 * d * np.finfo(float).eps
    seen: dict[float, int] = {}

    def above(s: float) -> int:
        if s not in seen:
            seen[s] = inertia(m - s * np.eye(d))[2]
        return seen[s]

    low, high = -1 - fine, 1 + fine
    seen[low], seen[high] = d, 0
    values, vectors, certified = np.zeros(k), np.zeros((d, k)), np.zeros(k, bool)
    for i in range(k):
        # the narrowest counted interval that holds eigenvalue i, and no other if they can be told apart
        a = max(s for s, c in seen.items() if c > i)
        b = min(s for s, c in seen.items() if c <= i)
        tries = 0
        while True:
            while b - a > 2 * fine and (above(a) > i + 1 or above(b) < i):
                mid = (a + b) / 2
                a, b = (mid, b) if above(mid) > i else (a, mid)
            value, vector = _rayleigh(m, vectors[:, :i], (a + b) / 2, i + 101 * tries)
            slack = fine
            right = above(value + slack) <= i < above(value - slack)
            if right or b - a <= 2 * fine or tries > 60:
                break
            for _ in range(3):  # the iteration left the interval: begin again in a narrower one
                mid = (a + b) / 2
                a, b = (mid, b) if above(mid) > i else (a, mid)
            tries += 1
        values[i], vectors[:, i], certified[i] = value, vector, right
    order = np.argsort(-values, kind="stable")
    return Pairs(values[order] * scale, vectors[:, order], certified[order])


def _rayleigh(m: np.ndarray, found: np.ndarray, shift: float, seed: int) -> tuple[float, np.ndarray]:
    """An eigenpair near the shift, orthogonal to those found: two steps at the shift, then at the Rayleigh quotient."""
    d = len(m)
    x = np.random.default_rng(seed).standard_normal(d)

    def clean(y: np.ndarray) -> np.ndarray:
        for _ in range(2):
            y = y - found @ (found.T @ y)
        return y / np.sqrt(y @ y)

    x = clean(x)
    mu, best = shift, np.inf
    for step in range(40):
        try:
            y = np.linalg.solve(m - mu * np.eye(d), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(m - (mu + 4 * np.finfo(float).eps) * np.eye(d), x)
        if not np.isfinite(y).all() or not y.any():
            break
        x = clean(y / np.abs(y).max())
        quotient = float(x @ (m @ x))
        residual = float(np.linalg.norm(m @ x - quotient * x))
        if step >= 3:
            if residual >= best / 2:
                break
            best = residual
        mu = quotient if step >= 2 else shift
    return float(x @ (m @ x)), x


# ------------------------------------------------------------------ sums of tasks


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x, size): the entries as whole numbers, of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bounded = lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c * SCALE, F.lit(EDGE)), F.lit(-EDGE))), F.lit(int(EDGE))), F.lit(-int(EDGE)))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fine).select(
        "vec_id", F.transform("v", lambda c: bounded(c) + F.lit(SHIFT).cast("bigint")).alias("x"), F.size("v").alias("size")
    )


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix of x) for each length in the batch, some rows at a time."""
    sizes = batch.column(batch.schema.get_field_index("size")).to_numpy()
    held = batch.column(batch.schema.get_field_index("x"))
    for size in np.unique(sizes).tolist():
        of = np.flatnonzero(sizes == size)
        for a in range(0, len(of), BATCH):
            rows = of[a : a + BATCH]
            yield size, rows, held.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def added(rows: DataFrame, of: Callable[[int, np.ndarray], np.ndarray], kind: str) -> dict[int, np.ndarray]:
    """Sums over all rows of what ``of(length, x)`` returns: a matrix whose shape depends on the length alone.

    Each task adds up its own; matrices are then added row by row in parallel, and only the sums reach the driver.
    """
    dtype = np.dtype({"double": np.float64, "bigint": np.int64}[kind])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _entries(batch):
                sums[size] = sums[size] + of(size, x) if size in sums else of(size, x)
        for size, matrix in sums.items():
            n = len(matrix)
            columns = [pa.array([size] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([r.astype(dtype).tobytes() for r in matrix], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "i", "held"])

    def total(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(b, dtype) for b in table.column("held").to_pylist()]
        out = np.sum(rows, axis=0, dtype=dtype)
        return pa.table([table.column("size").slice(0, 1), table.column("i").slice(0, 1), pa.array([out.tobytes()], pa.binary())], names=["size", "i", "held"])

    shape = "size int, i int, held binary"
    got = rows.mapInArrow(partial, shape).groupBy("size", "i").applyInArrow(total, shape).collect()
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in got:
        out.setdefault(r["size"], {})[r["i"]] = np.frombuffer(r["held"], dtype)
    return {size: np.array([held[i] for i in range(len(held))]) for size, held in out.items()}


@dataclass
class Fit:
    """What one length's fit list gives: n, sums, their whole part of the mean, components and eigenvalues."""

    n: int
    sums: list[int]
    base: np.ndarray  # sums // n
    rest: np.ndarray  # the remainder over n, below 1
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    certified: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean: a whole difference, then one rounding."""
        return (x - self.base).astype(np.float64) - self.rest

    @property
    def scales(self) -> np.ndarray:
        """Square roots of the eigenvalues; 0 for components without variance."""
        nil = self.values <= self.trace * len(self.sums) * np.finfo(float).eps
        return np.where(nil, 0.0, np.sqrt(np.maximum(self.values, 0)))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One column per component; NaN where it has no variance."""
        scales = self.scales
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(scales > 0, (self.centred(x) @ self.vectors) / np.where(scales > 0, scales, 1.0), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exactly; None beyond 64 bits."""
        gap = x - self.base
        left = np.array([s - int(b) * self.n for s, b in zip(self.sums, self.base)], dtype=object)
        most = self.n * (int(np.abs(gap).max(initial=0)) + 1)
        if most * most * len(self.sums) < 1 << 63:
            away = gap * self.n - left.astype(np.int64)
            return (away * away).sum(axis=1).tolist()
        away = gap.astype(object) * self.n - left
        return [t if t < 1 << 63 else None for t in (away * away).sum(axis=1)]


def fit(distinct: DataFrame, k: int = COMPONENTS) -> dict[int, Fit]:
    """Fit of every length among the distinct vectors (x, size)."""
    high = 1 << 26  # sums of the high and low parts of the entries, neither of which overflows below 10**10 rows

    def parts(size: int, x: np.ndarray) -> np.ndarray:
        return np.array([np.full(size, len(x)), (x // high).sum(axis=0), (x % high).sum(axis=0)], dtype=np.int64)

    out: dict[int, Fit] = {}
    for size, (n, upper, lower) in added(distinct, parts, "bigint").items():
        n = int(n[0])
        sums = [int(u) * high + int(l) for u, l in zip(upper, lower)]
        base = np.array([s // n for s in sums], dtype=np.int64)
        rest = np.array([(s % n) / n for s in sums])
        out[size] = Fit(n, sums, base, rest, np.zeros(0), np.zeros((size, 0)), 0.0, np.zeros(0, bool))

    def products(size: int, x: np.ndarray) -> np.ndarray:
        c = out[size].centred(x)
        return c.T @ c

    for size, total in added(distinct, products, "double").items() if out else ():
        f = out[size]
        v = (total + total.T) / (2 * f.n)
        pairs = leading_pairs(v, k)
        f.values, f.vectors, f.trace, f.certified = pairs.values, pairs.vectors, float(np.trace(v)), pairs.certified
    return out


def identity_error(distinct: DataFrame, fits: dict[int, Fit]) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, over components with variance."""
    if not fits:
        return 0.0

    def kept(size: int, x: np.ndarray) -> np.ndarray:
        return fits[size].whitened(x)[:, fits[size].scales > 0]

    means = {size: s[0] / fits[size].n for size, s in added(distinct, lambda size, x: kept(size, x).sum(axis=0)[None, :], "double").items()}

    def products(size: int, x: np.ndarray) -> np.ndarray:
        c = kept(size, x) - means[size]
        return c.T @ c

    worst = 0.0
    for size, total in added(distinct, products, "double").items():
        if len(total):
            worst = max(worst, float(np.abs(total / fits[size].n - np.eye(len(total))).max()))
    return worst


RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part and each of its first ``k`` components."""
    rows = written(whole_numbers(vectors), "whole-numbers")
    distinct = written(rows.select("x", "size").distinct(), "fit-list")
    fits = fit(distinct, k)
    error = identity_error(distinct, fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for size, own, x in _entries(batch):
                f = fits[size]
                w = f.whitened(x)
                m = w.shape[1]
                nil = np.isnan(w).ravel()
                explained = f.values / f.trace if f.trace > 0 else np.zeros(m)
                again = pa.array(np.repeat(own, m))
                columns = [
                    ids.take(again), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(own))), pa.array(np.full(len(own) * m, f.n)),
                    pa.array([d for d in f.deviations(x) for _ in range(m)], pa.int64()), pa.array(w.ravel(), mask=nil),
                    pa.array(np.tile(explained, len(own))), pa.array(np.full(len(own) * m, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in RESULT.split(", ")])

    return rows.mapInArrow(run, RESULT)
