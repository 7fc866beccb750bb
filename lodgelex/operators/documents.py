"""Find and aggregate by query documents: nested dictionaries of conditions and stages.

Every document becomes column expressions and DataFrame operations, so comparisons reach the scan and
aggregations combine before they shuffle.  A missing field is a null.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARISONS = {"$gt": gt, "$gte": ge, "$lt": lt, "$lte": le}
AVERAGES = {"$avg": F.avg, "$min": F.min, "$max": F.max}


def condition(query: Mapping[str, Any]) -> Column:
    """The rows that ``query`` describes: ``{"bedrooms": 2, "price": {"$gt": 50}}``.

    Fields are names or dotted paths.  Operators: ``$eq $ne $gt $gte $lt $lte $in $nin $exists $regex
    $not`` on a field, ``$and $or $nor`` on lists of documents.  Comparisons never hold for a missing
    field, ``None`` is equal to it, and ``$ne``, ``$nin``, ``$not`` and ``$nor`` include it.
    """
    return _every(_term(name, value) for name, value in query.items())


def find(
    df: DataFrame, query: Mapping[str, Any], fields: Sequence[str] | None = None
) -> DataFrame:
    """Rows that satisfy ``query``, with the named fields only if there are any."""
    found = df.where(condition(query))
    return found if fields is None else found.select(*fields)


def aggregate(df: DataFrame, stages: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Apply ``$match``, ``$group``, ``$project``, ``$sort``, ``$limit`` and ``$count`` in order.

    ``$group`` takes ``_id`` as ``None``, as ``"$field"`` (the result has a column ``_id``) or as
    ``{name: "$field"}`` (a column for each name), and ``$avg $sum $min $max`` of a field or number.
    """
    for stage in stages:
        if len(stage) != 1:
            raise ValueError(f"a stage has one operator, not {list(stage)}")
        ((name, value),) = stage.items()
        if name not in STAGES:
            raise ValueError(f"stage {name!r} is not known, only {list(STAGES)}")
        df = STAGES[name](df, value)
    return df


def _every(terms: Iterable[Column]) -> Column:
    return reduce(and_, terms, F.lit(True))


def _any(queries: Iterable[Mapping[str, Any]]) -> Column:
    return reduce(or_, [condition(query) for query in queries], F.lit(False))


def _holds(term: Column) -> Column:
    return F.coalesce(term, F.lit(False))


def _term(name: str, value: Any) -> Column:
    if name == "$and":
        return _every(condition(query) for query in value)
    if name == "$or":
        return _any(value)
    if name == "$nor":
        return ~_holds(_any(value))
    if name.startswith("$"):
        raise ValueError(f"operator {name!r} is not known")
    field = F.col(name)
    if isinstance(value, Mapping):
        return _every(_test(field, operator, operand) for operator, operand in value.items())
    return _equal(field, value)


def _equal(field: Column, value: Any) -> Column:
    return field.isNull() if value is None else eq(field, value)


def _among(field: Column, values: Sequence[Any]) -> Column:
    known = [value for value in values if value is not None]
    listed = field.isin(known) if known else F.lit(False)
    return listed if len(known) == len(values) else listed | field.isNull()


def _test(field: Column, operator: str, value: Any) -> Column:
    if operator in COMPARISONS:
        return COMPARISONS[operator](field, value)
    if operator == "$eq":
        return _equal(field, value)
    if operator == "$ne":
        return ~_holds(_equal(field, value))
    if operator == "$in":
        return _among(field, value)
    if operator == "$nin":
        return ~_holds(_among(field, value))
    if operator == "$exists":
        return field.isNotNull() if value else field.isNull()
    if operator == "$regex":
        return field.rlike(value)
    if operator == "$not":
        return ~_holds(_every(_test(field, name, operand) for name, operand in value.items()))
    raise ValueError(f"operator {operator!r} is not known")


def _value(expression: Any) -> Column:
    if isinstance(expression, str) and expression.startswith("$"):
        return F.col(expression[1:])
    return F.lit(expression)


def _group(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    by = spec["_id"]
    keys = by if isinstance(by, Mapping) else {} if by is None else {"_id": by}
    results = [
        _accumulated(accumulator).alias(name) for name, accumulator in spec.items() if name != "_id"
    ]
    grouped = df.groupBy(*[_value(value).alias(name) for name, value in keys.items()])
    return grouped.agg(*results) if results else grouped.agg(F.count(F.lit(1))).select(*keys)


def _accumulated(accumulator: Mapping[str, Any]) -> Column:
    ((name, expression),) = accumulator.items()
    if name == "$sum":
        return F.coalesce(F.sum(_value(expression)), F.lit(0))
    if name not in AVERAGES:
        raise ValueError(f"accumulator {name!r} is not known")
    return AVERAGES[name](_value(expression))


def _project(df: DataFrame, fields: Mapping[str, Any]) -> DataFrame:
    kept = {name: value for name, value in fields.items() if value not in (0, False)}
    if not kept:
        return df.drop(*fields)
    return df.select(
        *[(F.col(n) if v in (1, True) else _value(v)).alias(n) for n, v in kept.items()]
    )


def _sort(df: DataFrame, fields: Mapping[str, int]) -> DataFrame:
    """Missing fields are the smallest."""
    return df.orderBy(
        *[
            F.col(name).asc_nulls_first() if way > 0 else F.col(name).desc_nulls_last()
            for name, way in fields.items()
        ]
    )


STAGES = {
    "$match": find,
    "$group": _group,
    "$project": _project,
    "$sort": _sort,
    "$limit": lambda df, rows: df.limit(rows),
    "$count": lambda df, name: df.agg(F.count(F.lit(1)).alias(name)),
}
