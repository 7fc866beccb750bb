import pytest
from conftest import listing, rows

from lodgelex.operators.documents import aggregate, condition, find
from lodgelex.schema import LISTING_SCHEMA
from lodgelex.sources.listings import read_listings

#: a, b
TABLE = [(1, "x"), (2, "y"), (3, None), (None, "x"), (None, None)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(TABLE)], "id int, a int, b string")


@pytest.mark.parametrize("query, expected", [
    ({}, [0, 1, 2, 3, 4]),
    ({"a": 2}, [1]),
    ({"a": None}, [3, 4]),
    ({"a": {"$eq": 2}}, [1]),
    ({"a": {"$ne": 2}}, [0, 2, 3, 4]),
    ({"a": {"$ne": None}}, [0, 1, 2]),
    ({"a": {"$gt": 1, "$lte": 3}}, [1, 2]),
    ({"a": {"$in": [1, 3]}}, [0, 2]),
    ({"a": {"$in": [1, None]}}, [0, 3, 4]),
    ({"a": {"$in": []}}, []),
    ({"a": {"$nin": [1, 3]}}, [1, 3, 4]),
    ({"a": {"$nin": [1, None]}}, [1, 2]),
    ({"a": {"$not": {"$gte": 2}}}, [0, 3, 4]),
    ({"a": {"$exists": True}, "b": {"$exists": False}}, [2]),
    ({"b": {"$regex": "^[xz]"}}, [0, 3]),
    ({"$or": [{"a": 1}, {"b": "y"}]}, [0, 1]),
    ({"$nor": [{"a": 1}, {"b": "y"}]}, [2, 3, 4]),
    ({"$and": [{"a": {"$lt": 3}}, {"$or": [{"b": "x"}, {"b": None}]}]}, [0]),
])
def test_conditions(table, query, expected):
    assert [r.id for r in find(table, query).orderBy("id").collect()] == expected


@pytest.mark.parametrize("query", [{"$where": "1"}, {"a": {"$near": 1}}, {"a": {"b": 1}}])
def test_unknown_operators(table, query):
    with pytest.raises(ValueError, match="not known"):
        condition(query)


def test_comparisons_reach_the_scan(spark, tmp_path):
    nested = spark.createDataFrame([listing(i, "t", rooms=i, price=40.0 * i) for i in range(4)], LISTING_SCHEMA)
    nested.write.parquet(str(tmp_path / "l"))
    read = read_listings(spark, str(tmp_path / "l"))
    found = find(read, {"bedrooms": 2, "price": {"$gt": 50}, "address.country": "en"}, ["_id", "price"])
    assert rows(found) == [(2, 80.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for wanted in ("EqualTo(bedrooms,2)", "GreaterThan(price,50.0)", "EqualTo(address.country,en)"):
        assert wanted in pushed
    assert "summary" not in pushed


def test_groups(table):
    got = aggregate(table, [
        {"$group": {"_id": "$b", "n": {"$sum": 1}, "total": {"$sum": "$a"}, "mean": {"$avg": "$a"}}},
        {"$sort": {"_id": 1}},
    ]).collect()
    assert [tuple(r) for r in got] == [(None, 2, 3, 3.0), ("x", 2, 1, 1.0), ("y", 1, 2, 2.0)]
    whole = aggregate(table, [{"$group": {"_id": None, "low": {"$min": "$a"}, "high": {"$max": "$a"}}}])
    assert rows(whole) == [(1, 3)]
    assert rows(aggregate(table, [{"$match": {"a": 9}}, {"$count": "n"}])) == [(0,)]
    distinct = aggregate(table, [{"$match": {"b": {"$ne": None}}}, {"$group": {"_id": "$b"}}])
    assert rows(distinct) == [("x",), ("y",)]


def test_sort_limit_project(table):
    stages = [{"$sort": {"a": -1, "id": 1}}, {"$limit": 4}, {"$project": {"id": 1, "c": "$b"}}]
    got = aggregate(table, stages)
    assert [tuple(r) for r in got.collect()] == [(2, None), (1, "y"), (0, "x"), (3, "x")]
    assert aggregate(table, [{"$project": {"a": 0}}]).columns == ["id", "b"]
    with pytest.raises(ValueError, match="not known"):
        aggregate(table, [{"$lookup": {}}])
    with pytest.raises(ValueError, match="one operator"):
        aggregate(table, [{"$limit": 1, "$count": "n"}])
