"""Contiguous row numbers without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise


def contiguous_ids(
    df: DataFrame,
    key: str,
    name: str = "document_id",
    then: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Number the rows 1..n in the order of ``key`` and then of ``then``, missing values first.

    The key may be of any type that has an order.  Rows are dealt to tasks by ranges of key, ``then``,
    a hash of the row and its place in the input, so a key that many rows share, or lack, is cut like
    any other.  The place of a row in its sorted range is written down with the rows; how many rows
    each range holds then gives its first number, and a row's number is the sum of the two.  Rows equal
    in key and ``then`` follow the hash of the row; wholly equal rows are interchangeable.
    """
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tied = df.withColumn("_salt", F.xxhash64(*[F.col(f"`{c}`") for c in hashed])).withColumn(
        "_came", F.monotonically_increasing_id()
    )
    order = [F.col(f"`{c}`").asc_nulls_first() for c in (key, *then)]
    order += [F.col("_salt").asc(), F.col("_came").asc()]
    ranges = (
        tied.repartitionByRange(*order) if buckets is None else tied.repartitionByRange(buckets, *order)
    )
    # The number of the task and the row's place in it, in one long: 31 and 33 bits.
    placed = ranges.sortWithinPartitions(*order).drop("_salt", "_came").withColumn(
        "_at", F.monotonically_increasing_id()
    )
    written = materialise(placed)
    task, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = written.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per task of the range exchange: this window and the broadcast are bounded by their number.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        written.join(F.broadcast(offsets), task == F.col("_task"))
        .withColumn(name, F.col("_offset") + place + 1)
        .drop("_at", "_task", "_offset")
    )
