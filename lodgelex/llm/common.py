"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space of the contracts: the bytes 0x20 and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares; below the warehouse where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/lodgelex-scratch"
    path = f"{qualified(spark, base).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


#: Folders that ``scratch`` named in this session and that ``release`` has not removed.
_made: list[str] = []


def named() -> list[str]:
    """The scratch folders that are still there, oldest first."""
    return list(_made)


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark resolves it against, so that tasks that open files
    themselves find the place where Spark reads and writes."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()


def release(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Remove scratch folders: these, or all that the session named.

    For the caller, once the results that were made through them have been written or collected.
    """
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    for folder in named() if folders is None else folders:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        _made.remove(folder)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: the lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the value's decimal text, modulo ``divisor``; 0 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(0))


def thinned(rows: DataFrame, by: str, draw: str, per_group: int, most: int) -> tuple[DataFrame, int]:
    """``rows`` whose ``draw``, a 64-bit hash of a content, is among the lowest of its group.

    About four times ``per_group`` different draws of every group are left, all of a small one, so
    that no later sort sees more; a group counts its different draws, not its rows, so copies of one
    content take no place.  Also how many may be taken of a group if all are to be ``most`` at most.
    ``by`` has few values: one row for each goes through the driver.
    """
    counts = rows.groupBy(by).agg(F.approx_count_distinct(draw).alias("n")).collect()
    if not counts:
        return rows, 0
    take = max(1, min(per_group, most // len(counts)))
    kind = rows.schema[by].dataType.simpleString()
    shares = rows.sparkSession.createDataFrame(
        [(r[0], min(1.0, 4.0 * take / max(1, r[1]) + 1e-9)) for r in counts],
        f"__group {kind}, __share double",
    )
    place = F.shiftrightunsigned(F.col(draw), 11) / F.lit(float(1 << 53))
    kept = rows.join(F.broadcast(shares), F.col(by).eqNullSafe(F.col("__group")))
    few = kept.where((place < F.col("__share")) | (F.col("__share") >= 1.0))
    return few.drop("__group", "__share"), take


def giving_back(run: Callable) -> Callable:
    """``run`` over Arrow batches; before each further one the worker gives back what its Arrow pool no
    longer uses, and at the end also what the C library holds for freed Python objects.

    Workers are kept for later tasks and stages, and would hold on to the most they ever needed.
    """

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pa.default_memory_pool()
        for batch in batches:
            yield batch
            del batch
            pool.release_unused()

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(freed(batches))
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only where the library has it
                trim(0)

    return wrapped


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows, without copies."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]
