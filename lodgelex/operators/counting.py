"""Counts and their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Into how many parts a group's rows are dealt where something is attached to them.
SALTS = 16


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def round_half_up(value: str, digits: int = 6) -> Column:
    """``round(value, digits)`` of a double column, to the last bit.

    ``round`` writes every double as a decimal text.  Where the scaled value is clearly off the middle of
    two whole numbers, the nearer one is the same result: it is exact, and so is dividing it back to the
    nearest double.  Ties, huge values, infinities and NaN take ``round`` itself.
    """
    scaled = F.col(value) * F.lit(float(10**digits))
    nearest = F.rint(scaled)
    clear = (F.abs(scaled) < 1e12) & (F.abs(scaled - nearest) < 0.499)
    plain = (nearest + F.lit(0.0)) / F.lit(float(10**digits))  # no negative zero
    return F.when(clear, plain).otherwise(F.round(value, digits))


def descending(df: DataFrame, measure: str, *then: str) -> DataFrame:
    """Presentation order: the measure downwards, ties by the columns in ``then``."""
    return df.orderBy(F.desc(measure), *then)


def matches(keys: Sequence[str], prefix: str = "_") -> Column:
    """Equality of ``key`` and ``_key`` where a missing key equals a missing key."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(prefix + key))
    return condition


def _attach(df: DataFrame, small: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Inner join with a table of a few rows per group of ``by``.

    Nothing is known of the number of groups beforehand.  Rows of a group are dealt over ``SALTS`` parts
    and the group's rows are repeated for each, so a group with a third of all rows meets in no task.
    Where the run-time size of the small side turns out to be small, as with countries, adaptive
    execution broadcasts it instead.  Without groups it has a handful of rows and is broadcast at once.
    """
    right = small.withColumnsRenamed({c: f"_{c}" for c in keys})
    if not by:
        return df.join(F.broadcast(right), matches(keys)).drop(*[f"_{c}" for c in keys])
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(SALTS)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    joined = df.withColumn("_salt", salt).join(
        right.withColumn("_part", parts), matches(keys) & (F.col("_salt") == F.col("_part"))
    )
    return joined.drop("_salt", "_part", *[f"_{c}" for c in keys])


def per_group(df: DataFrame, groups: DataFrame, by: Sequence[str], *values: str) -> DataFrame:
    """Add the ``values`` columns of ``groups``, one row per group, to the rows of ``df``."""
    if not by:
        return df.withColumns({v: groups.select(v).scalar() for v in values})
    return _attach(df, groups.select(*by, *values), by, by)


def top_with_ties(df: DataFrame, by: Sequence[str], measure: str, k: int) -> DataFrame:
    """Rows of rank ``k`` or better by ``measure`` within ``by``, all ties kept, as ``rank``.

    ``row_number() <= k`` finds the leading values first.  It is limited inside every task before
    the exchange, so no task ever sees more than ``k`` rows per group and input task, however long
    the run of equal values at the cut is.  The rows are then looked up by value where they are.
    """
    order = F.desc(measure)
    known = df.where(F.col(measure).isNotNull())
    if by:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(order))
        leaders = known.select(*by, measure).withColumn("_place", place).where(f"_place <= {k}")
    else:
        top = known.select(measure).orderBy(order).limit(k)
        leaders = top.withColumn("_place", F.row_number().over(Window.orderBy(order)))
    ranks = leaders.groupBy(*by, measure).agg(F.min("_place").cast("long").alias("rank"))
    if by:
        # No leader of any group lies below the lowest of them: the other rows are not dealt out.
        known = known.where(F.col(measure) >= leaders.agg(F.min(measure)).scalar())
    return _attach(known, ranks, [*by, measure], by)


def value_frequency(df: DataFrame, key: str, name: str, hot: int = 10_000) -> DataFrame:
    """Add to every row how many rows share its ``key``, for keys of any frequency.

    Fewer than ``hot`` keys can hold more than one ``hot``-th of all rows each: those are broadcast.
    What is left is joined by key, no key of it being large enough to hold a task up.
    """
    frequency = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    rows = frequency.agg(F.sum(name).alias("rows")).scalar()
    frequent = frequency.where(F.col(name) > rows / F.lit(hot))
    marked = df.join(F.broadcast(frequent), key, "left")
    rest = marked.where(F.col(name).isNull()).drop(name).join(frequency, key)
    return marked.where(F.col(name).isNotNull()).unionByName(rest)
