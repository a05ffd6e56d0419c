"""Whitening of embeddings by a compensated covariance.

Components are whole numbers, so sums and deviations from the mean are exact: n * x - S. Their quotients by n are kept as
pairs of doubles (high, low), whose outer products are taken and added up in double-double arithmetic by error-free
transformations (Dekker, Knuth; Hida, Li and Bailey). Tasks give partial sums as high and low parts, by block of the
upper triangle, and these are merged over rounds of a tree. The covariance, a square of the dimensions, goes to the
driver and is solved there by tridiagonal divide and conquer (LAPACK's syevd, which numpy's eigh calls).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Doubles of one array while products are added up, pairs of a block of the upper triangle, partial sums merged at once.
AT_ONCE, BLOCK, MERGED = 1 << 18, 1 << 14, 64
#: Larger components of a vector couldn't be told apart as whole numbers.
LARGEST = 2.0**52


# ---------------------------------------------------------------- double-double arithmetic


def two_sum(a, b):
    """a + b and what rounding took from it."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _split(a):
    c = 134217729.0 * a  # 2**27 + 1
    high = c - (c - a)
    return high, a - high


def two_product(a, b):
    """a * b and what rounding took from it."""
    p = a * b
    (a1, a2), (b1, b2) = _split(a), _split(b)
    return p, ((a1 * b1 - p) + a1 * b2 + a2 * b1) + a2 * b2


def add(x, y):
    """Of two double-doubles, renormalised."""
    s, e = two_sum(x[0], y[0])
    t, f = two_sum(x[1], y[1])
    s, e = two_sum(s, e + t)
    return two_sum(s, e + f)


def times(x, y):
    p, e = two_product(x[0], y[0])
    return two_sum(p, e + (x[0] * y[1] + x[1] * y[0]))


def total(x):
    """The sum over the first axis, by halves."""
    high, low = x
    while len(high) > 1:
        half = len(high) // 2
        rest = high[2 * half :], low[2 * half :]
        high, low = add((high[:half], low[:half]), (high[half : 2 * half], low[half : 2 * half]))
        high, low = np.concatenate([high, rest[0]]), np.concatenate([low, rest[1]])
    return high[0], low[0]


# ---------------------------------------------------------------- vectors


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): vectors of doubles without nulls and non-finite components, of the table's most frequent length.

    Of two lengths as frequent the larger one holds. Empty vectors, and those with a component of 2**52 / scale or
    more, take no part.
    """
    one = vectors.select(vectors[id_col].alias("id"), vectors[vec_col].cast("array<double>").alias("v"))
    one = one.where((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < LARGEST / SCALE)))
    sizes = one.groupBy(F.size("v").alias("d")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return one.where(F.size("v") == (most.d if most else 0))


def _whole(column, dims: int) -> np.ndarray:
    """Rows of long components of an Arrow column of lists."""
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)).astype(np.int64) + SHIFT


def sums(rows: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """Number of vectors, sum of each component, largest magnitude of one; exact."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low, most = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in batches:
            x = _whole(b.column("v"), dims)
            n, high, low = n + len(x), high + (x >> 30).sum(axis=0), low + (x & ((1 << 30) - 1)).sum(axis=0)
            most = np.maximum(most, np.abs(x).max(axis=0, initial=0))
        yield pa.RecordBatch.from_pydict({"i": np.arange(dims, dtype=np.int32), "n": np.full(dims, n), "high": high, "low": low, "most": most})

    partial = rows.select("v").mapInArrow(each, "i int, n long, high long, low long, most long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = partial.groupBy("i").agg(F.sum("n").alias("n"), *exact, F.max("most").alias("most")).orderBy("i").collect()  # a row a dimension
    return found[0].n, [(int(r.high) << 30) + int(r.low) for r in found], max(r.most for r in found)


class Centre:
    """Deviations from the mean, exact: n * x - S as whole numbers, of Python where a long can't hold them."""

    def __init__(self, n: int, s: list[int], most: int):
        self.n = n
        self.narrow = 2 * n * most < 1 << 62
        self.s = np.array(s, np.int64 if self.narrow else object)

    def exact(self, x: np.ndarray) -> np.ndarray:
        return self.n * (x if self.narrow else x.astype(object)) - self.s

    def mean_free(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - S / n as high and low doubles."""
        a = self.exact(x)
        if not self.narrow:
            high = (a / self.n).astype(float)
            low = np.array([float(Fraction(v) / self.n - Fraction(h)) for v, h in zip(a.ravel(), high.ravel(), strict=True)])
            return high, low.reshape(high.shape)
        top = a.astype(np.float64)
        rest = (a - top.astype(np.int64)).astype(np.float64)
        high = top / self.n
        p, e = two_product(high, float(self.n))
        return two_sum(high, ((top - p) - e + rest) / self.n)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)**2 of each row; none where it exceeds a long."""
        a = self.exact(x)
        if self.narrow and float(np.abs(a).max(initial=0)) ** 2 * a.shape[1] < 1 << 62:
            return (a * a).sum(axis=1).tolist()
        found = [int(v) for v in (a.astype(object) ** 2).sum(axis=1)]
        return [v if v < 1 << 63 else None for v in found]


# ---------------------------------------------------------------- covariance and components


def covariance(rows: DataFrame, dims: int, centre: Centre) -> np.ndarray:
    """Of the vectors, with divisor n, from outer products of mean-free vectors added up as double-doubles.

    A task holds the upper triangle's sums once (16 bytes a pair) and a block's products of a few rows.
    """
    left, right = np.triu_indices(dims)
    blocks = [slice(k, k + BLOCK) for k in range(0, len(left), BLOCK)]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [(np.zeros(len(left[b])), np.zeros(len(left[b]))) for b in blocks]
        for batch in batches:
            high, low = centre.mean_free(_whole(batch.column("v"), dims))
            for k, b in enumerate(blocks):
                i, j = left[b], right[b]
                step = max(1, AT_ONCE // len(i))
                for at in range(0, len(high), step):
                    h, m = high[at : at + step], low[at : at + step]
                    state[k] = add(state[k], total(times((h[:, i], m[:, i]), (h[:, j], m[:, j]))))
        part = TaskContext.get().partitionId()
        for k, (h, m) in enumerate(state):
            yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "part": pa.array([part], pa.int32()), "high": pa.array([h.tolist()]), "low": pa.array([m.tolist()])})

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        h, m = total((np.stack(pdf["high"].to_list()), np.stack(pdf["low"].to_list())))
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "part": pdf["part"].iloc[:1] // MERGED, "high": [h], "low": [m]})

    kind = "block int, part int, high array<double>, low array<double>"
    partial = rows.select("v")
    partial, parts = partial.mapInArrow(products, kind), partial.rdd.getNumPartitions()
    while parts > MERGED:
        partial = partial.groupBy("block", F.expr(f"part div {MERGED}").alias("of")).applyInPandas(lambda _, pdf: merged(pdf), kind)
        parts = -(-parts // MERGED)
    found = partial.groupBy("block").applyInPandas(merged, kind).collect()  # the covariance itself: a square of the dimensions
    upper = np.concatenate([(np.array(r.high) + np.array(r.low)) / centre.n for r in sorted(found, key=lambda r: r.block)])
    out = np.zeros((dims, dims))
    out[left, right] = upper
    out[right, left] = upper
    return out


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues, falling, their unit eigenvectors as columns, and the trace.

    Eigenvalues that rounding can't tell from 0 have no component. A vector's largest entry is positive.
    """
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > len(e) * np.finfo(float).eps * max(e[0], 0)).sum()))
    signs = np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return e[:k], (u * signs)[:, :k], float(np.trace(v))


def _identity_error(white: DataFrame, k: int) -> float:
    """How far the covariance of white (w) is from the identity; built-in aggregates, which centre as they go and merge."""

    def cov(i: int, j: int) -> Column:
        return F.covar_pop(F.col("w")[i], F.col("w")[j])

    # Spark's own expressions, a few at a time: 36 in all.
    found = white.agg(*(cov(i, j).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k))).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i, k))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: n, deviation, whitened, explained, identity_error.

    See usable for vectors that take no part. Repeated rows and null ids count and come back each. There are fewer components
    than asked for where the vectors span fewer dimensions, and no rows where they are all equal or none is usable. Other columns
    are ignored, whatever their names.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    empty = vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = usable(vectors, id_col, vec_col)
    first = rows.first()
    if first is None:
        return empty
    dims = len(first.v)
    n, s, largest = sums(rows, dims)
    centre = Centre(n, s, largest)
    values, axes, trace = components(covariance(rows, dims, centre), most)
    if not len(values):
        return empty
    root = np.sqrt(values)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _whole(b.column("v"), dims)
            high, low = centre.mean_free(x)
            w = (high @ axes + low @ axes) / root
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(centre.deviation(x), pa.int64()), pa.array(w.tolist(), pa.list_(pa.float64()))], ["id", "deviation", "w"])

    white = written(rows.mapInArrow(each, f"id {kind}, deviation long, w array<double>"), "white")
    error = _identity_error(white, len(values))
    explained = F.array(*(F.lit(float(e) / trace) for e in values))
    each_one = white.select(F.col("id").alias(id_col), "deviation", F.posexplode("w").alias("k", "whitened"))
    return each_one.select(
        id_col,
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("k")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
