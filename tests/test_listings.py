import json

import pytest
from conftest import listing, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgelex.operators import listings as li
from lodgelex.operators.identifiers import contiguous_ids
from lodgelex.schema import LISTING_SCHEMA
from lodgelex.sources.listings import read_listings


@pytest.fixture(scope="module")
def flat(make):
    return make(
        {"rating": 99, "reviews": 6, "country": "Spain", "rooms": 2, "price": 50.0},
        {"rating": 100, "reviews": 6, "country": "Spain", "rooms": 2, "price": 51.0},
        {"rating": 100, "reviews": 5, "country": "Turkey", "rooms": 2, "price": 90.0},
        {"rating": None, "reviews": 9, "country": "Turkey", "room_type": "Shared room"},
        {"rating": 20, "reviews": 3, "country": None, "room_type": "Shared room", "price": 20.0},
    )


def test_boundaries(flat):
    assert rows(li.high_rated(flat), "document_id") == [(2,)]
    assert rows(li.at_least_rated(flat, 99), "document_id") == [(1,), (2,), (3,)]
    assert rows(li.more_reviews_than(flat, 5), "document_id") == [(1,), (2,), (4,)]
    assert rows(li.find_by_rooms_and_price(flat), "document_id") == [(2,), (3,)]


def test_country_filters_and_counts(flat):
    assert rows(li.market_slice(flat, "Turkey"), "document_id") == [(3,), (4,)]
    assert rows(li.in_countries(flat, ("Spain", "China")), "document_id") == [(1,), (2,)]
    counted = {r.country: r["count"] for r in li.country_counts(flat).collect()}
    assert counted == {"Spain": 2, "Turkey": 2, None: 1}


def test_average_price(flat):
    assert rows(li.average_price(flat)) == [
        ("Private room", pytest.approx(191 / 3)), ("Shared room", 40.0),
    ]


def test_projections(flat):
    assert li.descriptions(flat).columns == ["document_id", "country", "text", li.RATING]
    assert li.rated_texts(flat).columns[2] == "success"


def test_map_points_need_both_coordinates(make):
    flat = make(
        {"coordinates": (1.5, 2.5)}, {"coordinates": (None, 2.0)}, {"coordinates": (1.0,)},
        {"coordinates": None}, {"coordinates": ()},
    )
    assert rows(li.map_points(flat)) == [(1.5, 2.5)]


def test_json_lines_with_unknown_and_missing_fields(spark, tmp_path):
    documents = [
        {"_id": 1, "summary": "Cozy flat", "address": {"country": "Brazil", "zip": "x"},
         "review_scores": {"review_scores_rating": 97, "cleanliness": 10}, "extra": [1, 2]},
        {"_id": 2, "number_of_reviews": 4},
    ]
    path = tmp_path / "listings.json"
    path.write_text("\n".join(json.dumps(d) for d in documents))
    loaded = read_listings(spark, str(path), "json")
    assert loaded.schema == LISTING_SCHEMA
    assert rows(li.flatten(loaded), "document_id", "country", li.RATING) == [
        (1, "Brazil", 97), (2, None, None),
    ]
    with pytest.raises(ValueError):
        read_listings(spark, str(path), "xml")


def test_nested_predicates_and_columns_reach_the_scan(spark, tmp_path):
    data = [listing(i, f"text {i}", country="en" if i % 2 else "de") for i in range(10)]
    path = str(tmp_path / "listings")
    spark.createDataFrame(data, LISTING_SCHEMA).write.parquet(path)
    flat = li.flatten(read_listings(spark, path))
    query = li.at_least_rated(li.market_slice(flat, "de"), 90).select("document_id", "text")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(address.country,de)" in plan
    assert "GreaterThanOrEqual(review_scores.review_scores_rating,90)" in plan
    schema = plan.split("ReadSchema:")[1]
    assert "description" not in schema and "market" not in schema
    assert query.count() == 5
    found = li.find_by_rooms_and_price(flat, 1, 50).select("document_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(bedrooms,1)" in plan and "GreaterThan(price,50.0)" in plan


def test_decimal_prices_and_orc(spark, tmp_path):
    data = [listing(i, f"text {i}", price=10.25 * i) for i in range(4)]
    made = spark.createDataFrame(data, LISTING_SCHEMA)
    stored = made.withColumn("price", F.col("price").cast("decimal(10,2)"))
    for fmt in ("parquet", "orc", "json"):
        path = str(tmp_path / fmt)
        stored.write.format(fmt).save(path)
        loaded = read_listings(spark, path, fmt, price_type=T.DecimalType(10, 2))
        assert loaded.schema == LISTING_SCHEMA
        assert rows(loaded, "_id", "price") == [(i, 10.25 * i) for i in range(4)]


def test_json_numbers_in_any_spelling(spark, tmp_path):
    lines = [
        '{"_id": "10006546", "price": "80.00", "review_scores": {"review_scores_rating": 90.0}}',
        '{"_id": 7, "price": "$1,080.50", "bedrooms": "2", "number_of_reviews": 3.0}',
        '{"_id": null, "review_scores": {"review_scores_rating": null}}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    loaded = read_listings(spark, str(tmp_path / "a.json"), "json")
    assert loaded.schema == LISTING_SCHEMA
    got = {(r._id, r.price, r.bedrooms, r.number_of_reviews,
            r.review_scores and r.review_scores.review_scores_rating) for r in loaded.collect()}
    assert got == {(10006546, 80.0, None, None, 90), (7, 1080.5, 2, 3, None), (None, None, None, None, None)}
    keyed = read_listings(spark, str(tmp_path / "a.json"), "json", key_type=T.StringType())
    assert {r._id for r in keyed.collect()} == {"10006546", "7", None}


@pytest.mark.parametrize("line", [
    '{"_id": "x1"}', '{"_id": 1, "price": "cheap"}', '{"_id": 1, "bedrooms": "two"}', '{"_id": 1, ',
])
def test_junk_is_an_error(spark, tmp_path, line):
    (tmp_path / "a.json").write_text(line)
    with pytest.raises(Exception, match="(?i)not a number|cast|malformed|parse"):
        read_listings(spark, str(tmp_path / "a.json"), "json").collect()


@pytest.mark.parametrize("buckets", [1, 3, 8])
def test_contiguous_ids(spark, buckets):
    keys = [((i * 7919) % 1009) * 3 - 500 for i in range(1009)]
    df = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
    numbered = contiguous_ids(df, "key", buckets=buckets).orderBy("key").collect()
    assert [r.document_id for r in numbered] == list(range(1, 1010))
    assert [r.key for r in numbered] == sorted(keys)


def test_contiguous_ids_of_little_or_nothing(spark):
    empty = spark.createDataFrame([], "key long")
    assert contiguous_ids(empty, "key").count() == 0
    one = spark.createDataFrame([(5,)], "key long")
    assert [r.document_id for r in contiguous_ids(one, "key").collect()] == [1]


def test_contiguous_ids_keep_rows_without_a_key(spark):
    df = spark.createDataFrame([(7,), (None,), (3,), (9,), (1,)], "key long").repartition(3)
    got = contiguous_ids(df, "key", buckets=3).orderBy("document_id").collect()
    assert [(r.document_id, r.key) for r in got] == [(1, None), (2, 1), (3, 3), (4, 7), (5, 9)]


@pytest.mark.parametrize("kind", ["string", "date", "decimal(10,2)", "double"])
def test_contiguous_ids_of_any_key_type(spark, kind):
    key = "date_add(date'2020-01-01', cast(id as int))" if kind == "date" else f"cast(id * 7 % 101 as {kind})"
    df = spark.range(101).selectExpr(f"{key} as key")
    got = contiguous_ids(df, "key", buckets=4).orderBy("document_id").collect()
    keys = [r.key for r in got]
    assert [r.document_id for r in got] == list(range(1, 102)) and keys == sorted(keys)


def test_a_key_of_a_third_of_the_rows_is_cut(spark):
    """Equal keys, missing keys and wholly equal rows are numbered by many tasks."""
    for expr in ("if(id % 3 = 0, 'hot', concat('k', id))", "if(id % 3 = 0, null, id)", "'one'"):
        df = spark.range(30_000).selectExpr(f"{expr} as key", "id").repartition(6)
        df = df.drop("id") if expr == "'one'" else df
        numbered = contiguous_ids(df, "key", buckets=10)
        sizes = numbered.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 4 and max(r["count"] for r in sizes) < 9_000
        assert numbered.select("document_id").distinct().count() == 30_000
        assert numbered.agg(F.max("document_id")).first()[0] == 30_000


def test_numbered_listings(spark):
    rows = [("b", None), ("a", "x"), (None, "y"), ("a", "z")]
    schema = "_id string, summary string"
    nested = spark.createDataFrame(rows, schema)
    for field in LISTING_SCHEMA.fields[2:]:
        nested = nested.withColumn(field.name, F.lit(None).cast(field.dataType))
    got = li.flatten(nested, numbered=True).orderBy("document_id").collect()
    assert [r.document_id for r in got] == [1, 2, 3, 4]
    assert got[0].text == "y" and {got[1].text, got[2].text} == {"x", "z"} and got[3].text is None
