"""Centroid clustering over space-filling-curve zone maps.

Vectors are put in the order of a Hilbert curve over their leading bits, so that neighbours on the
curve are neighbours in space, and written once as blocks of ``BLOCK`` vectors.  A block carries its
zone map: the smallest and the largest value of each dimension, and the sum of its vectors.  A round
reads the blocks.  The least and the greatest distance from a box to a centroid say which centroids
can be nearest to any vector of the block; with one left, the block is counted from its zone map
alone, with several its vectors are compared with those, exactly and in whole numbers.

A third of all vectors may be equal and share one place on the curve; ties on the curve are ordered
by a hash of the row, so that such a run is cut into ranges like any other.  Tasks give out one sum per
centroid, so a round moves k rows a task.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelex.llm.common import scratch
from lodgelex.llm.whitening import usable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
BLOCK = 256
#: Bits of each dimension that place a vector on the curve.
BITS = 4
#: Whole numbers stay below this in size, so that distances and their sums of a block are exact.
WIDEST = 1 << 26


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (0 to 2**bits - 1) on the Hilbert curve, as bytes to sort by.

    The transposed form of J. Skilling ("Programming the Hilbert curve", 2004), all rows at once.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        mask = np.uint32(q - 1)
        for i in range(n):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & mask).astype(np.uint32)
            x[0] = np.where(on, x[0] ^ mask, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = top
    while q > 1:
        turn = np.where((x[n - 1] & q) > 0, turn ^ np.uint32(q - 1), turn)
        q >>= 1
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def grid(rows: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """Cells of equal width between the least and the largest value of each dimension."""
    width = np.maximum(1, high - low + 1)
    return ((rows - low) * (1 << bits) // width).clip(0, (1 << bits) - 1)


def box_bounds(low: np.ndarray, high: np.ndarray, centroids: np.ndarray):
    """The least and the greatest squared distance from a box to every centroid."""
    beside = np.maximum(0, np.maximum(low - centroids, centroids - high))
    across = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return (beside * beside).sum(1), (across * across).sum(1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that are nearest to some vector of the box, or may be; equals stay."""
    least, greatest = box_bounds(low, high, centroids)
    return np.flatnonzero(least <= greatest.min())


def nearest(rows: np.ndarray, centroids: np.ndarray, near: np.ndarray):
    """Cluster and squared distance of every row among the centroids ``near``, smaller numbers first."""
    far = np.empty((len(near), len(rows)), np.int64)
    for k, c in enumerate(near):
        off = rows - centroids[c]
        far[k] = np.einsum("ij,ij->i", off, off)
    pick = far.argmin(0)
    return near[pick], far[pick, np.arange(len(rows))]


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def whole(batch: pa.RecordBatch, column: str, dimensions: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    found = np.floor(SCALE * flat.astype(np.float64)).reshape(-1, dimensions)
    if np.abs(found).max(initial=0) >= WIDEST:
        raise ValueError(f"an entry of a vector is {WIDEST // SCALE} or more in size")
    return found.astype(np.int64)


class Blocks:
    """The vectors in Hilbert order, in blocks with zone maps, below the shared folder."""

    def __init__(
        self,
        vectors: DataFrame,
        id_col: str = "vec_id",
        vector_col: str = "embedding",
        dimensions: int = DIMENSIONS,
        block: int = BLOCK,
        bits: int = BITS,
    ):
        self.dimensions = dimensions
        self.spark = vectors.sparkSession
        self.kept = vectors.where(usable(vector_col) & (F.size(vector_col) == dimensions)).select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("v"),
        )
        low, high = self._limits()
        self.count = 0 if low is None else 1
        path = scratch(self.spark, "zone-maps")
        if low is not None:
            self._write(path, low, high, block, bits)
            self.table = self.spark.read.parquet(path)

    def _limits(self):
        size = self.dimensions

        def limits(batches):
            low, high = np.full(size, WIDEST), np.full(size, -WIDEST)
            for batch in batches:
                if batch.num_rows:
                    rows = whole(batch, "v", size)
                    low, high = np.minimum(low, rows.min(0)), np.maximum(high, rows.max(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array(low), pa.array(high)],
                names=["place", "low", "high"],
            )

        found = (
            self.kept.select("v").mapInArrow(limits, "place int, low long, high long")
            .groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
        )
        found = sorted(found)
        if not found or found[0]["low"] > found[0]["high"]:
            return None, None
        return np.array([r["low"] for r in found]), np.array([r["high"] for r in found])

    def _write(self, path: str, low: np.ndarray, high: np.ndarray, block: int, bits: int) -> None:
        size = self.dimensions

        def place(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                rows = whole(batch, "v", size)
                keys = hilbert(grid(rows, low, high, bits), bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"),
                        pa.array([k.tobytes() for k in keys], pa.binary()),
                        pa.array([r.tobytes() for r in rows.astype(np.int32)], pa.binary()),
                    ],
                    names=["vec_id", "curve", "row"],
                )

        def pack(batches):
            ids, rows, held = [], [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, block):
                    part = batch.slice(at, block)
                    ids.append(part.column("vec_id"))
                    rows.append(np.frombuffer(b"".join(part.column("row").to_pylist()), np.int32))
                    held += part.num_rows
                    if held >= block:
                        joined, own = pa.concat_arrays(ids), np.concatenate(rows).reshape(-1, size)
                        yield made(joined.slice(0, block), own[:block])
                        ids, rows, held = [joined.slice(block)], [own[block:].ravel()], held - block
            if held:
                yield made(pa.concat_arrays(ids), np.concatenate(rows).reshape(-1, size))

        def made(ids, rows) -> pa.RecordBatch:
            zone = np.stack([rows.min(0), rows.max(0)]).astype(np.int64)
            columns = [
                pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                pa.array([len(rows)], pa.int32()),
                pa.array([zone[0].tolist()], pa.list_(pa.int64())),
                pa.array([zone[1].tolist()], pa.list_(pa.int64())),
                pa.array([rows.sum(0, dtype=np.int64).tolist()], pa.list_(pa.int64())),
                pa.array([np.ascontiguousarray(rows).tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(
                columns, names=["ids", "n", "low", "high", "sums", "rows"]
            )

        placed = self.kept.mapInArrow(place, "vec_id long, curve binary, row binary")
        salted = placed.withColumn("salt", F.xxhash64("vec_id", "row"))
        ranges = salted.repartitionByRange("curve", "salt").sortWithinPartitions("curve", "salt")
        ranges.select("vec_id", "row").mapInArrow(
            pack,
            "ids array<long>, n int, low array<long>, high array<long>, sums array<long>, rows binary",
        ).write.parquet(path)

    def starts(self, clusters: int, salt: int) -> np.ndarray:
        """The vectors whose ids hash lowest; rows without an id never start a cluster."""
        key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
        first = (
            self.kept.where("vec_id is not null")
            .select(key.alias("key"), F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))
            .orderBy("key", "v").limit(clusters).collect()
        )
        return np.array([r["v"] for r in first], np.int64).reshape(-1, self.dimensions)

    def totals(self, centroids: np.ndarray) -> dict[int, tuple[int, list[int], int]]:
        """Per centroid that has vectors: their number, their sums, and their summed distances."""
        size = self.dimensions

        def add(batches):
            found: dict[int, list] = {}

            def take(c: int, n: int, sums, far: int) -> None:
                own = found.setdefault(c, [0, np.zeros(size, object), 0])
                own[0], own[1], own[2] = own[0] + n, own[1] + sums, own[2] + far

            for n, low, high, sums, raw in _blocks(batches, ["low", "high", "sums"]):
                near = candidates(low, high, centroids)
                rows = np.frombuffer(raw, np.int32).reshape(n, size).astype(np.int64)
                if len(near) == 1:
                    off = rows - centroids[near[0]]
                    take(int(near[0]), n, sums.astype(object), int((off * off).sum()))
                    continue
                cluster, far = nearest(rows, centroids, near)
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    take(c, int(own.sum()), rows[own].sum(0).astype(object), int(far[own].sum()))
            rows = [(c, p, str(v)) for c, (n, s, f) in found.items() for p, v in enumerate([n, f, *s])]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["cluster", "place", "part"],
            )

        summed = (
            self.table.select("n", "low", "high", "sums", "rows")
            .mapInArrow(add, "cluster int, place int, part string")
            .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
        )
        out: dict[int, list[int]] = {}
        for row in summed.collect():  # centroids times dimensions, whatever the number of vectors
            out.setdefault(row["cluster"], [0] * (size + 2))[row["place"]] = int(row["part"])
        return {c: (v[0], v[2:], v[1]) for c, v in out.items()}


def _blocks(batches: Iterator[pa.RecordBatch], arrays: list[str]):
    for batch in batches:
        parts = [batch.column(a).to_pylist() for a in arrays]
        for n, *lists, raw in zip(
            batch.column("n").to_pylist(), *parts, batch.column("rows"), strict=True
        ):
            yield n, *(np.array(x, np.int64) for x in lists), raw.as_buffer()


def moved(centroids: np.ndarray, totals: dict[int, tuple[int, list[int], int]]) -> np.ndarray:
    """Centroids at the whole part of the mean of their vectors; empty ones stay."""
    out = centroids.copy()
    for c, (n, sums, _) in totals.items():
        out[c] = [s // n for s in sums]
    return out


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    salt: int = 3,
    block: int = BLOCK,
) -> DataFrame:
    """A row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Usable are vectors of exactly ``dimensions`` finite entries; each counts as floor(1024 * entry).
    Repeated rows and ids are vectors of their own.  With fewer vectors that have an id than
    ``clusters``, there are as many centroids as those; with none, no row.  Of equally near centroids
    the one with the smaller number is taken.  Entries of 65,536 or more in size are an error.
    """
    spark = vectors.sparkSession
    ddl = (
        "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
        "centroid_sha256 string"
    )
    blocks = Blocks(vectors, id_col, vector_col, dimensions, block)
    centroids = blocks.starts(clusters, salt) if blocks.count else np.zeros((0, dimensions), np.int64)
    if not len(centroids):
        return spark.createDataFrame([], ddl)
    for _ in range(rounds):
        fresh = moved(centroids, blocks.totals(centroids))
        if (fresh == centroids).all():  # the rounds to come would change nothing
            break
        centroids = fresh
    totals = blocks.totals(centroids)
    inertia = {c: far for c, (_, _, far) in totals.items()}
    every = sum(inertia.values())
    digests = [digest(c) for c in centroids]

    def assign(batches):
        for batch in batches:
            for (n, low, high, raw), ids in zip(
                _blocks([batch], ["low", "high"]), batch.column("ids"), strict=True
            ):
                rows = np.frombuffer(raw, np.int32).reshape(n, dimensions).astype(np.int64)
                own, far = nearest(rows, centroids, candidates(low, high, centroids))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values,
                        pa.array(own, pa.int32()),
                        pa.array(far, pa.int64()),
                        pa.array([inertia[c] for c in own.tolist()], pa.int64()),
                        pa.array([every] * n, pa.int64()),
                        pa.array([digests[c] for c in own.tolist()], pa.string()),
                    ],
                    names=[
                        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        "centroid_sha256",
                    ],
                )

    return blocks.table.select("ids", "n", "low", "high", "rows").mapInArrow(assign, ddl)
