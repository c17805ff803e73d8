"""Whitening of embeddings by spectrum slicing.

Every entry c of a vector becomes the whole number x = floor(1024 c) + 100000. Spark sums the x exactly,
then the products of what is left after the mean is taken off; only a matrix of dimension x dimension
reaches the driver, whatever the number of rows. There the leading eigenvalues are isolated by
bisection: V - sI = L D L^T (symmetric pivoting, blocks of one or two) has as many positive pivots as V has
eigenvalues above s (Sylvester). Inside an interval that holds one eigenvalue, Rayleigh quotient
iteration converges cubically; counts just below and just above the result certify its number. A
second pass projects the rows.

Rows: a vector that is NULL, empty, or holds NULL or non-finite entries is left out. Repeated rows and
ids, and a NULL vec_id, keep rows of their own. Where lengths differ, only vectors of the commonest
length take part (of equally common ones, the longest). Entries of x beyond +-2^52 count as that. Equal
eigenvalues get an orthonormal basis of their space. A component without variance above rounding
has whitened NULL and does not enter identity_error; without any variance explained is 0. A deviation
too large for a long is NULL. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyreel.llm.common import settle, tree_sum

SCALE, LIFT, LIMIT = 1024.0, 100_000, float(1 << 52)
COMPONENTS = 8
# Rows that one matrix product takes, and bytes of a piece of a matrix on its way to the sum.
ROWS, PIECE = 4096, 1 << 20
# Bunch and Parlett's bound between pivots of one and of two rows.
ALPHA = (1 + 17**0.5) / 8
EPS = float(np.finfo(np.float64).eps)
OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double"
)


def whole_rows(column: pa.Array, dim: int | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: (row numbers, x as long) of the vectors that take part."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()  # without what NULL lists may hide
    starts = np.concatenate([[0], np.cumsum(lengths)])
    values = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (lengths > 0) & (bad[starts[1:]] == bad[starts[:-1]])
    out = {}
    for length in [dim] if dim else np.unique(lengths[good]).tolist():
        rows = np.flatnonzero(good & (lengths == length))
        x = np.clip(np.floor(SCALE * values[starts[rows][:, None] + np.arange(length)]), -LIMIT, LIMIT)
        out[length] = rows, x.astype(np.int64) + LIFT
    return out


@dataclass
class FitList:
    """Number of vectors, their length, and the exact sum of x in each dimension."""

    n: int
    sums: list[int]

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in double precision: whole means go first, exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 of each row, exactly."""
        most = int(np.abs(x).max(initial=0))
        if (self.n * most + max(map(abs, self.sums))) ** 2 * self.dim < 1 << 63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        near = x - whole
        if (self.n * (int(np.abs(near).max(initial=0)) + 1)) ** 2 * self.dim < 1 << 63:
            return ((self.n * near - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in near.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def fit_list(vectors: DataFrame) -> FitList | None:
    """One pass; None where no vector takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, (rows, x) in whole_rows(batch.column("vector")).items():
                # Halves keep the sums of a batch inside a long.
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                columns = [np.full(length, length), np.arange(length), np.full(length, len(rows)), high, low]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "i", "n", "high", "low"])

    big = "decimal(38,0)"
    parts = vectors.select("vector").mapInArrow(run, "dim long, i long, n long, high long, low long")
    totals = parts.groupBy("dim", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast(big)).alias("high"), F.sum(F.col("low").cast(big)).alias("low")
    )
    totals = settle(totals)
    top = totals.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not top:
        return None
    rows = totals.filter(F.col("dim") == top[0]["dim"]).orderBy("i").collect()  # one row a dimension
    return FitList(top[0]["n"], [int(r["high"]) * (1 << 32) + int(r["low"]) for r in rows])


def products(vectors: DataFrame, dim: int, values: Callable[[np.ndarray], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Over all rows: the sum of ``values`` (rows x width), and the sum of their outer products."""
    piece = max(1, PIECE // (8 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width + 1, width), np.longdouble)
        for batch in batches:
            _, x = whole_rows(batch.column("vector"), dim)[dim]
            for at in range(0, len(x), ROWS):
                y = values(x[at : at + ROWS])
                sums[0] += y.sum(axis=0)
                sums[1:] += y.T @ y
        pieces = [sums[i : i + piece].astype(np.float64).tobytes() for i in range(0, width + 1, piece)]
        me = TaskContext.get().partitionId()
        columns = [pa.array(range(len(pieces)), pa.int32()), pa.array([me] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "slice", "data"])

    parts = settle(vectors.select("vector").mapInArrow(run, "part int, slice int, data binary"))
    last = parts.agg(F.max("slice")).first()[0]
    rows = tree_sum(parts, "float64", last + 1).orderBy("part").collect()  # one matrix
    flat = np.frombuffer(b"".join(bytes(r["data"]) for r in rows)).reshape(width + 1, width)
    return flat[0], flat[1:]


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above the shift, from the pivots of LDL^T."""
    a = v - shift * np.eye(len(v))
    positive = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal().copy()
        i = int(diagonal.argmax())
        np.fill_diagonal(size, 0)
        r, s = divmod(int(size.argmax()), len(a))
        if max(diagonal[i], size[r, s]) == 0:
            break
        pivots = [i] if diagonal[i] >= ALPHA * size[r, s] else [r, s]
        rest = np.delete(np.arange(len(a)), pivots)
        block, side = a[np.ix_(pivots, pivots)], a[np.ix_(rest, pivots)]
        # A block of two is chosen only where its determinant is negative: one pivot of each sign.
        positive += int(block[0, 0] > 0) if len(pivots) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return positive


def rayleigh(v: np.ndarray, start: np.ndarray, shift: float, found: np.ndarray, size: float) -> tuple[float, np.ndarray, float]:
    """(eigenvalue, unit vector, residual): two inverse iterations at the shift, then Rayleigh quotients."""

    def clean(y: np.ndarray) -> np.ndarray:
        for _ in range(2):
            y = y - found.T @ (found @ y)
        return y / np.linalg.norm(y)

    def step(at: float, y: np.ndarray) -> np.ndarray:
        for nudge in (0.0, EPS, 16 * EPS, 1024 * EPS):
            try:
                z = np.linalg.solve(v - (at + nudge * size) * np.eye(len(v)), y)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(z).all():
                return clean(z / np.abs(z).max())
        return y

    y = clean(start)
    for _ in range(2):
        y = step(shift, y)
    best = (shift, y, np.inf)
    for _ in range(12):
        value = float(y @ v @ y)
        residual = float(np.linalg.norm(v @ y - value * y))
        if residual < best[2]:
            best = value, y, residual
        elif np.isfinite(best[2]):
            break
        y = step(value, y)
    return best


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as rows; each one's number is certified."""
    radius = np.abs(v).sum(axis=1) - np.abs(v.diagonal())
    size = max(float((np.abs(v.diagonal()) + radius).max()), 1e-280)
    ground, ceiling = float((v.diagonal() - radius).min()) - size * 1e-3, float((v.diagonal() + radius).max()) + size * 1e-3
    least = 32 * len(v) * EPS * size
    counts = {ground: len(v), ceiling: 0}
    random = np.random.default_rng(13)
    values, vectors = [], np.zeros((0, len(v)))

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(v, shift)
        return counts[shift]

    for number in range(1, min(wanted, len(v)) + 1):
        low = max(s for s, c in counts.items() if c >= number)
        high = min(s for s, c in counts.items() if c < number)
        while True:
            alone = above(low) == number and above(high) == number - 1
            if alone or high - low <= least:
                value, vector, residual = rayleigh(v, random.standard_normal(len(v)), (low + high) / 2, vectors, size)
                slack = max(4 * residual, least)
                certified = above(value - slack) >= number and above(value + slack) < number
                if certified and residual <= least:
                    break
                if high - low <= least:
                    raise ArithmeticError(f"component {number} cannot be certified")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        values.append(value)
        vectors = np.vstack([vectors, vector])
    return np.array(values), vectors


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector (vec_id, vector) that takes part and component, see the columns of ``OUT``."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    fitted = fit_list(vectors)
    if fitted is None:
        return spark.createDataFrame([], OUT)
    n, dim = fitted.n, fitted.dim
    _, total = products(vectors, dim, fitted.centred, dim)
    v = (total + total.T) / (2 * n)
    values, rows = leading(v, components)
    trace = float(np.trace(v))
    real = values > dim * EPS * trace
    count = len(values)
    scaled = (rows[real] / np.sqrt(values[real])[:, None]).T
    explained = values / trace if trace > 0 else np.zeros(count)
    error = 0.0
    if real.any():
        width = int(real.sum())
        sums, _ = products(vectors, dim, lambda x: fitted.centred(x) @ scaled, width)
        mean = sums / n
        _, square = products(vectors, dim, lambda x: fitted.centred(x) @ scaled - mean, width)
        error = float(np.abs(square / n - np.eye(width)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, all_x = whole_rows(batch.column("vector"), dim)[dim]
            for at in range(0, len(taken), ROWS):
                x, some = all_x[at : at + ROWS], taken[at : at + ROWS]
                whitened = np.zeros((len(some), count))
                whitened[:, real] = fitted.centred(x) @ scaled
                ids = batch.column("vec_id").take(pa.array(np.repeat(some, count)))
                deviation = pa.array(fitted.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(some)), count)))
                many = len(some)
                columns = [
                    ids,
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * count, n)),
                    deviation,
                    pa.array(whitened.ravel(), mask=np.tile(~real, many)),
                    pa.array(np.tile(explained, many)),
                    pa.array(np.full(many * count, error)),
                    pa.array(np.tile(values, many)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [c.split()[0] for c in OUT.split(", ")]
    return vectors.mapInArrow(run, OUT)
