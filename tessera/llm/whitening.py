"""Embedding whitening (operator 11): polarisation covariance in exact integers.

Every entry c becomes the integer ``x = floor(SCALE * c) + SHIFT``.

1. One pass sums x per dimension.  With the sums S over n vectors, m = S // n is
   each dimension's whole mean and r = S - n m what is left, so ``d = x - m`` are
   small integers whose sum is exactly r.
2. A second pass aggregates the exact squares of the centred values, for every
   dimension (d_i^2) and every sum of two dimensions ((d_i + d_j)^2).  Each gives
   a variance, n^2 Var = n Q - (sum of d)^2, without rounding; by polarisation
   ``2 Cov(i, j) = Var(i + j) - Var(i) - Var(j)``.
3. The covariance matrix, whose size depends on the dimensions alone, is
   assembled on the driver and decomposed with ``eigh``.
4. Rows are projected on the leading eigenvectors, each over the root of its
   eigenvalue, and landed; the covariance of what was landed is measured against
   the identity.

Squares are added as 64-bit integers where they fit and as Python integers
elsewhere, and leave tasks in limbs of 30 bits, so no sum overflows.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are dropped; if vectors differ in length, those of the most frequent
length count (ties: the longest) and the others are dropped; entries beyond
2^60 / SCALE count as that limit; null or repeated ids and repeated rows are rows
like others; a component whose eigenvalue is zero (to double precision) cannot
be whitened and is left out, so constant or too few vectors give fewer
components; a deviation beyond 64 bits is null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
_FAR = 1 << 60
_LIMB = 30
_LIMBS = [f"l{i}" for i in range(5)]
_ROWS = 4096


def _valid(batch):
    """(row numbers, integer matrix) of each length among a batch's vectors."""
    lists = batch.column("vector")
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    present = lists.is_valid().to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()[:-1]
    for length in np.unique(lengths[present & (lengths > 0)]):
        rows = np.flatnonzero(present & (lengths == length))
        for i in range(0, len(rows), _ROWS):
            some = rows[i: i + _ROWS]
            entries = values[starts[some][:, None] + np.arange(length)]
            fine = np.isfinite(entries).all(axis=1)
            with np.errstate(over="ignore"):
                scaled = np.clip(np.floor(entries[fine] * SCALE), -float(_FAR), float(_FAR))
            yield some[fine], scaled.astype(np.int64) + SHIFT


def _sum_task(batches):
    """Per length and dimension: vectors, and the sum of x in two halves."""
    totals: dict[int, list] = {}
    for batch in batches:
        for _, x in _valid(batch):
            held = totals.setdefault(x.shape[1], [0, np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)])
            held[0] += len(x)
            held[1] += (x >> 32).sum(axis=0)
            held[2] += (x & 0xFFFFFFFF).sum(axis=0)
    for length, (n, high, low) in totals.items():
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(length, length)), pa.array(np.arange(length)), pa.array(np.full(length, n)),
                 pa.array(high), pa.array(low)], names=["length", "dim", "n", "high", "low"])


def _square_sums(d: np.ndarray) -> np.ndarray:
    """Sum of d_i^2 for every dimension, then of (d_i + d_j)^2 for every i < j
    in row order, as Python integers."""
    dims = d.shape[1]
    if len(d) * (2 * int(np.abs(d).max(initial=0))) ** 2 >= 1 << 62:
        d = d.astype(object)
    sums = [(d * d).sum(axis=0)]
    for i in range(dims - 1):
        both = d[:, i: i + 1] + d[:, i + 1:]
        sums.append((both * both).sum(axis=0))
    return np.concatenate(sums).astype(object)


def _square_task(means: np.ndarray):
    dims = len(means)

    def run(batches):
        total = None
        for batch in batches:
            for _, x in _valid(batch):
                if x.shape[1] == dims and len(x):
                    found = _square_sums(x - means)
                    total = found if total is None else total + found
        if total is not None:
            limbs = [((total >> (_LIMB * i)) & ((1 << _LIMB) - 1)).astype(np.int64) for i in range(len(_LIMBS))]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *map(pa.array, limbs)],
                                             names=["place", *_LIMBS])

    return run


@dataclass
class Whitening:
    """What a fit knows: vectors n, whole means and remainders of the sums,
    eigenvalues and unit eigenvectors (columns) by falling eigenvalue, trace."""

    n: int
    means: np.ndarray
    remainders: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def usable(self, components: int) -> int:
        """How many of the leading components have a positive eigenvalue."""
        least = len(self.values) * np.finfo(float).eps * max(float(self.values[0]), 0.0)
        return min(components, int((self.values > least).sum()))


def covariance(n: int, remainders: list[int], squares: list[int]) -> np.ndarray:
    """Covariance matrix from the exact squared sums, each entry rounded once."""
    dims = len(remainders)
    own = [n * squares[i] - remainders[i] ** 2 for i in range(dims)]
    out, place = np.zeros((dims, dims)), dims
    for i in range(dims):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, dims):
            both = n * squares[place] - (remainders[i] + remainders[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**2)
            place += 1
    return out


def _vectors(rows: DataFrame, vector_col: str, *more) -> DataFrame:
    return rows.select(*more, F.col(vector_col).cast("array<double>").alias("vector"))


def fit(rows: DataFrame, vector_col: str = "embedding") -> Whitening | None:
    """Whitening of all vectors of ``rows``; None if there are none."""
    ship_package(rows.sparkSession)
    only = _vectors(rows, vector_col)
    sums = land(only.mapInArrow(_sum_task, "length bigint, dim bigint, n bigint, high bigint, low bigint")
                .groupBy("length", "dim").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]), "vector-sums")
    usual = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if usual is None:
        return None
    n, dims = usual["n"], usual["length"]
    total = [0] * dims
    for r in sums.where(F.col("length") == dims).collect():  # one row a dimension
        total[r["dim"]] = (r["high"] << 32) + r["low"]
    means, remainders = [s // n for s in total], [s % n for s in total]
    squares = [0] * (dims * (dims + 1) // 2)
    parts = only.mapInArrow(_square_task(np.array(means, np.int64)),
                            "place bigint, " + ", ".join(f"{c} bigint" for c in _LIMBS))
    for r in parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in _LIMBS]).collect():  # one row a pair of dimensions
        squares[r["place"]] = sum(r[c] << (_LIMB * i) for i, c in enumerate(_LIMBS))
    matrix = covariance(n, remainders, squares)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(dims)] < 0, -1.0, 1.0)
    return Whitening(n, np.array(means, np.int64), remainders, values, vectors, float(np.trace(matrix)))


def _deviations(d: np.ndarray, n: int, remainders: list[int]) -> list[int | None]:
    """Per row, the sum over dimensions of (n x - S)^2 = (n d - r)^2."""
    reach = n * int(np.abs(d).max(initial=0)) + n
    if d.shape[1] * reach**2 < 1 << 63:
        return ((d * n - np.array(remainders, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((d.astype(object) * n - np.array(remainders, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _project_task(fitted: Whitening, components: int):
    dims, n = len(fitted.means), fitted.n
    rest = np.array([r / n for r in fitted.remainders])
    weights = np.ascontiguousarray(fitted.vectors[:, :components] / np.sqrt(fitted.values[:components]))

    def run(batches):
        for batch in batches:
            for rows, x in _valid(batch):
                if x.shape[1] != dims or not len(rows):
                    continue
                d = x - fitted.means
                white = (d - rest) @ weights
                lists = pa.ListArray.from_arrays(np.arange(0, white.size + 1, components, dtype=np.int32)
                                                 if components else np.zeros(len(rows) + 1, np.int32), white.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(_deviations(d, n, fitted.remainders), pa.int64()),
                     lists], names=["vec_id", "deviation", "white"])

    return run


def _moment_task(components: int):
    """Sums and products of whitened values, which are centred already."""
    def run(batches):
        total = np.zeros((components + 1, components))
        for batch in batches:
            white = batch.column("white").flatten().to_numpy().reshape(batch.num_rows, components)
            total[0] += white.sum(axis=0)
            total[1:] += white.T @ white
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "v"])

    return run


def identity_error(white: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    total = np.zeros((components + 1) * components)
    moments = white.select("white").mapInArrow(_moment_task(components), "place bigint, v double")
    for r in moments.groupBy("place").agg(F.sum("v").alias("v")).collect():  # one row a pair of components
        total[r["place"]] = r["v"]
    total = total.reshape(components + 1, components) / n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(components)).max(initial=0.0))


def project(rows: DataFrame, fitted: Whitening, components: int = COMPONENTS, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``vec_id, deviation, white`` (whitened values of the leading components)."""
    ship_package(rows.sparkSession)
    keyed = _vectors(rows, vector_col, F.col(id_col).alias("vec_id"))
    id_type = keyed.schema["vec_id"].dataType.simpleString()
    return keyed.mapInArrow(_project_task(fitted, fitted.usable(components)),
                            f"vec_id {id_type}, deviation bigint, white array<double>")


_RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector and component: ``vec_id, component`` (from 1),
    ``n, deviation, whitened, explained`` (the component's share of the whole
    variance) and ``identity_error``."""
    spark = rows.sparkSession
    fitted = fit(rows, vector_col)
    if fitted is None:
        id_type = rows.select(id_col).schema[0].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {id_type}, {_RESULT}")
    white = land(project(rows, fitted, components, id_col, vector_col), "whitened")
    used = fitted.usable(components)
    shares = [F.lit(float(v / fitted.trace)) for v in fitted.values[:used]]
    explained = F.array(*shares) if used else F.lit(None).cast("array<double>")
    return white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("at")).alias("explained"),
        F.lit(identity_error(white, fitted.n, used)).alias("identity_error"))
