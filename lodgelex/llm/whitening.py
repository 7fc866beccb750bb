"""Whitening of embeddings by spectrum slicing.

Vectors become whole numbers, so that counts, sums and products over all of them are exact: whatever
the order in which tasks add them up, the covariance is one rounding away from the true one.  Its
leading eigenvalues are then found one by one.  An LDLᵀ factorisation of the covariance minus a shift
tells by its inertia how many eigenvalues lie above the shift; halving isolates the i-th in an
interval of its own, Rayleigh quotient iteration converges to it from there, and two more counts
around the value certify that it is the i-th.

Tables are read by tasks that give out sums only; the driver holds one d x d matrix, whose size does
not depend on the number of vectors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
#: Rows that a task holds as a matrix.
BLOCK = 4096
#: Eigenvalues closer than this, relative to the largest, are taken as one cluster.
CLOSE = 1e-9


# Linear algebra on the driver -------------------------------------------------------------------


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` lie above ``shift``.

    LDLᵀ with the symmetric pivoting of Bunch and Kaufman: the blocks of D are single numbers or
    2 x 2 with one eigenvalue of either sign, and by Sylvester's law their signs are those of the
    shifted matrix.
    """
    a = matrix - shift * np.eye(len(matrix))
    alpha = (1 + np.sqrt(17)) / 8
    positive, k, n = 0, 0, len(a)
    while k < n:
        size, swap = 1, k
        if k < n - 1:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            biggest = column[r - k - 1]
            if biggest > 0 and abs(a[k, k]) < alpha * biggest:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                widest = row.max()
                if abs(a[k, k]) * widest < alpha * biggest**2:
                    swap = r
                    if abs(a[r, r]) < alpha * widest:
                        size = 2
        into = k + size - 1
        if swap != into:
            a[[into, swap]] = a[[swap, into]]
            a[:, [into, swap]] = a[:, [swap, into]]
        if size == 1:
            pivot = a[k, k]
            positive += pivot > 0
            if pivot and k < n - 1:
                below = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(below, below) / pivot
        else:
            block = a[k : k + 2, k : k + 2].copy()
            determinant = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            positive += 1 if determinant < 0 else 2 * (block[0, 0] > 0)
            if k + 2 < n:
                below = a[k + 2 :, k : k + 2].copy()
                a[k + 2 :, k + 2 :] -= below @ np.linalg.solve(block, below.T)
        k += size
    return int(positive)


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """Solve with the shifted matrix; a shift that hits an eigenvalue exactly is moved by a rounding."""
    scale = np.abs(matrix).max()
    for k in range(8):
        moved = shift + k * np.finfo(float).eps * scale
        try:
            found = np.linalg.solve(matrix - moved * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    raise ArithmeticError("no shift near the eigenvalue can be factorised")


def _start(size: int, number: int) -> np.ndarray:
    return np.random.default_rng(1000 + number).standard_normal(size)


class Counts:
    """Inertia counts of one matrix.  Each shift cuts the spectrum for all eigenvalues to come."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.known: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = inertia(self.matrix, shift)
        return self.known[shift]

    def bracket(self, number: int) -> tuple[float, float]:
        """The tightest known shifts around the eigenvalue of this number."""
        low = max(s for s, n in self.known.items() if n >= number)
        return low, min(s for s, n in self.known.items() if n < number and s > low)

    def isolate(self, number: int, close: float) -> tuple[float, float]:
        """An interval with one eigenvalue in it, or one narrower than ``close``."""
        low, high = self.bracket(number)
        while not (self.above(low) == number and self.above(high) == number - 1):
            if high - low <= close:
                break
            self.above((low + high) / 2)
            low, high = self.bracket(number)
        return low, high


def _quotient_iteration(counts: Counts, low, high, before: np.ndarray, number, rounding):
    """Value and vector of the one eigenvalue between ``low`` and ``high``.

    Inverse iteration at the middle until the quotient lies inside, then Rayleigh quotient iteration.
    A quotient that leaves the interval has gone to another eigenvalue: the interval is halved first.
    """
    matrix = counts.matrix
    while True:
        vector = _start(len(matrix), number)
        shift, settled = (low + high) / 2, False
        for turn in range(60):
            vector -= before @ (before.T @ vector)
            vector /= np.linalg.norm(vector)
            image = matrix @ vector
            value = float(vector @ image)
            if np.linalg.norm(image - value * vector) <= rounding:
                settled = low <= value <= high
                break
            inside = turn > 1 and low < value < high
            vector = _solve(matrix, value if inside else shift, vector)
        if settled or high - low <= rounding:
            return value, vector
        counts.above((low + high) / 2)
        low, high = counts.bracket(number)


def _cluster(matrix, low, high, before, count):
    """Values and vectors of ``count`` eigenvalues that lie too close to be told apart."""
    basis = np.stack([_start(len(matrix), before.shape[1] + k) for k in range(count)], 1)
    for _ in range(6):
        basis -= before @ (before.T @ basis)
        basis, _ = np.linalg.qr(_solve(matrix, (low + high) / 2, basis))
    basis -= before @ (before.T @ basis)
    basis, _ = np.linalg.qr(basis)
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], (basis @ turn)[:, ::-1]


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a covariance, falling, and their unit vectors as columns.

    Values that are not above rounding are left out.  The largest entry of a vector is positive.
    """
    size = len(matrix)
    scale = float(np.abs(matrix).sum(1).max()) if size else 0.0  # no eigenvalue is above it
    values, vectors = [], np.zeros((size, 0))
    rounding = 8 * size * np.finfo(float).eps * scale
    counts = Counts(matrix)
    positive = 0
    if scale:
        counts.above(scale * (1 + 1e-9))
        positive = counts.above(rounding)
    while len(values) < min(count, positive):
        number = len(values) + 1
        low, high = counts.isolate(number, CLOSE * scale)
        inside = counts.above(low) - counts.above(high)
        if inside == 1 and counts.above(high) == number - 1:
            value, vector = _quotient_iteration(counts, low, high, vectors, number, rounding)
            found, basis = [value], vector[:, None]
        else:
            missing = counts.above(low) - number + 1
            found, basis = _cluster(matrix, low, high, vectors, missing)
        for value, vector in zip(found, basis.T, strict=True):
            values.append(float(value))
            vectors = np.column_stack([vectors, vector])
        certify(counts, values, rounding, len(found))
    values, vectors = values[:count], vectors[:, :count]
    for k in range(vectors.shape[1]):
        if vectors[np.abs(vectors[:, k]).argmax(), k] < 0:
            vectors[:, k] *= -1
    return np.array(values), vectors


def certify(counts: Counts, values: list[float], rounding: float, fresh: int) -> None:
    """By counts: the last ``fresh`` values carry the numbers that they are given."""
    scale = float(np.abs(counts.matrix).sum(1).max())
    width = 4 * rounding + (0 if fresh == 1 else CLOSE * scale)
    first = len(values) - fresh + 1
    if (
        counts.above(values[first - 1] + width) > first - 1
        or counts.above(values[-1] - width) < len(values)
    ):
        raise ArithmeticError(f"eigenvalue {first} is not certified")


# Spark ------------------------------------------------------------------------------------------


def usable(column: str) -> Column:
    """Not null, not empty, and every entry a finite number."""
    entry = F.col(column)
    bad = F.exists(
        entry,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return entry.isNotNull() & (F.size(entry) > 0) & ~F.coalesce(bad, F.lit(False))


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors.astype(np.float64)).astype(np.int64) + OFFSET


def matrices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The whole numbers of a batch in blocks of rows, and where each block begins."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    for at in range(0, len(flat), BLOCK):
        yield at, whole(flat[at : at + BLOCK])


def exact_products(rows: np.ndarray) -> np.ndarray:
    """The sum over rows of all products of two entries, as whole numbers."""
    widest = int(np.abs(rows).max(initial=0))
    if widest**2 * len(rows) < 1 << 53:
        real = rows.astype(np.float64)
        return np.rint(real.T @ real).astype(np.int64)
    wide = rows.astype(object)
    return wide.T @ wide


def _totals(rows: DataFrame, run, count: int) -> list[int]:
    """Sums of the lists of whole numbers that tasks give out, place by place, exactly."""
    digits = rows.mapInArrow(run, "place int, part string")
    summed = digits.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    out = [0] * count
    for row in summed.collect():  # one row per entry of the d x d matrix
        out[row.place] = int(row.part)
    return out


def _given(sums) -> pa.RecordBatch:
    parts = [str(int(v)) for v in sums]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())],
        names=["place", "part"],
    )


class Whitener:
    """What the fit list says: count, sums, eigenvalues, and the matrix that whitens."""

    def __init__(self, n: int, sums: list[int], products: list[int], middle: list[int], count: int):
        size = len(sums)
        self.n, self.sums, self.size = n, sums, size
        # Sums about the whole part of the mean; what is left of the mean is taken off exactly.
        rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
        covariance = np.zeros((size, size))
        place = 0
        for i in range(size):
            for j in range(i, size):
                exact = (n * products[place] - rest[i] * rest[j]) / (n * n)
                covariance[i, j] = covariance[j, i] = exact
                place += 1
        self.covariance = covariance
        self.middle = np.array(middle, np.int64)
        self.rest = np.array([r / n for r in rest])
        self.trace = float(np.trace(covariance))
        self.values, self.vectors = leading(covariance, count)
        self.turn = self.vectors / np.sqrt(self.values)
        self.identity_error: float | None = None

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.middle) - self.rest) @ self.turn

    def deviations(self, rows: np.ndarray) -> list[int]:
        """The exact sum over dimensions of (n * x - S) squared."""
        sums = np.array(self.sums, object)
        off = np.abs(rows - self.middle).max(initial=0) + 1
        if int(off) * self.n < 1 << 31 and self.size * (int(off) * self.n) ** 2 < 1 << 62:
            far = self.n * (rows - self.middle) - np.array(
                [s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)], np.int64
            )
            return (far * far).sum(1).tolist()
        far = rows.astype(object) * self.n - sums
        return (far * far).sum(1).tolist()


def _kept(vectors: DataFrame, id_col: str, vector_col: str, carry: tuple[str, ...]) -> DataFrame:
    return vectors.where(usable(vector_col)).select(
        F.col(id_col).alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("__v"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )


def fit(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> Whitener | None:
    """Fit on all usable vectors; ``None`` where there is none.

    Usable are vectors without null or non-finite entries, and of several lengths those of the most
    frequent one (of equals the longest).  Entries count as floor(1024 * entry) + 100000.  Repeated
    rows and ids count as often as they occur.
    """
    kept = _kept(vectors, id_col, vector_col, ())
    lengths = kept.groupBy(F.size("__v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return None
    size, n = int(best["size"]), int(best["n"])
    fitted = kept.where(F.size("__v") == size).select("__v")

    def add_up(batches):
        sums = np.zeros(size, object)
        for batch in batches:
            for _, rows in matrices(batch, "__v", size):
                sums = sums + rows.sum(0).astype(object)
        yield _given(sums)

    sums = _totals(fitted, add_up, size)
    middle = [s // n for s in sums]

    def multiply(batches):
        corner = np.triu_indices(size)
        total = np.zeros(len(corner[0]), object)
        for batch in batches:
            for _, rows in matrices(batch, "__v", size):
                total = total + exact_products(rows - np.array(middle))[corner].astype(object)
        yield _given(total)

    products = _totals(fitted, multiply, size * (size + 1) // 2)
    whitener = Whitener(n, sums, products, middle, components)
    whitener.identity_error = measured_error(fitted, whitener)
    return whitener


def measured_error(fitted: DataFrame, whitener: Whitener) -> float:
    """How far the covariance of the whitened vectors, all of them, is from the identity.

    Their mean is zero up to rounding; it is taken off all the same, in a second pass.
    """
    count = len(whitener.values)
    if not count:
        return 0.0

    def sums(batches):
        total = np.zeros(count)
        for batch in batches:
            for _, rows in matrices(batch, "__v", whitener.size):
                total += whitener.whiten(rows).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(count), pa.int32()), pa.array(total)], names=["place", "part"]
        )

    def add(run):
        rows = fitted.mapInArrow(run, "place int, part double").groupBy("place").agg(F.sum("part"))
        return np.array([r[1] for r in sorted(rows.collect())]) / whitener.n

    mean = add(sums)

    def products(batches):
        total = np.zeros((count, count))
        for batch in batches:
            for _, rows in matrices(batch, "__v", whitener.size):
                centred = whitener.whiten(rows) - mean
                total += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(count * count), pa.int32()), pa.array(total.ravel())],
            names=["place", "part"],
        )

    return float(np.abs(add(products).reshape(count, count) - np.eye(count)).max())


RESULT = {
    "component": "int", "n": "long", "deviation": "long", "whitened": "double",
    "explained": "double", "identity_error": "double",
}


def whiten(
    vectors: DataFrame,
    whitener: Whitener | None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row per usable vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Vectors of another length than the fitted ones give no row, and neither do components whose
    eigenvalue is not above rounding (fewer dimensions than components, equal vectors).  A deviation
    beyond a long is an error.
    """
    kept = _kept(vectors, id_col, vector_col, ())
    kind = kept.schema["vec_id"].dataType.simpleString()
    ddl = f"vec_id {kind}, " + ", ".join(f"{n} {t}" for n, t in RESULT.items())
    if whitener is None:
        return vectors.sparkSession.createDataFrame([], ddl)
    count, size = len(whitener.values), whitener.size
    explained = whitener.values / whitener.trace if count else np.zeros(0)

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            for at, rows in matrices(batch, "__v", size):
                n = len(rows)
                ids = batch.column("vec_id").slice(at, n).take(pa.array(np.repeat(np.arange(n), count)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * count, whitener.n, np.int64)),
                        pa.array(whitener.deviations(rows), pa.int64()).take(
                            pa.array(np.repeat(np.arange(n), count))
                        ),
                        pa.array(whitener.whiten(rows).ravel()),
                        pa.array(np.tile(explained, n)),
                        pa.array(np.full(n * count, whitener.identity_error)),
                    ],
                    names=["vec_id", *RESULT],
                )

    return kept.where(F.size("__v") == size).mapInArrow(run, ddl)
