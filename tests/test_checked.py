import json

import pytest
from pyspark.sql import types as T

from lodgelex.schema import LISTING_SCHEMA
from lodgelex.sources.checked import check_class_lexicon, check_listings, check_score_lexicon
from lodgelex.sources.listings import read_listings

GOOD = [
    '{"_id": "10006546", "price": "$1,080.00", "review_scores": {"review_scores_rating": 90.0}}',
    '{"_id": 7, "price": 80.5, "bedrooms": "2", "number_of_reviews": 3.0, "extra": [1]}',
    '{"_id": null, "review_scores": {"review_scores_rating": null}}',
    "{}",
]
BAD = {
    '{"_id": 1, ': "malformed",
    "no json": "malformed",
    '[{"_id": 1}, {"_id": 2}]': "malformed",
    '{"_id": 1, "address": "Rome"}': "malformed",
    '{"_id": "x1"}': "_id",
    '{"_id": 1, "price": "cheap", "bedrooms": "two"}': "price",
    '{"_id": 1, "number_of_reviews": "1e12"}': "number_of_reviews",
    '{"_id": 1, "bedrooms": "two"}': "bedrooms",
    '{"_id": 1, "review_scores": {"review_scores_rating": "A"}}': "review_scores.review_scores_rating",
}


def test_every_line_is_a_row_or_rejected(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(GOOD + ["", "  "]))
    (tmp_path / "b.json").write_text("\n".join(BAD))
    checked = check_listings(spark, str(tmp_path))
    assert {r.line: r.reason for r in checked.rejected.collect()} == BAD
    assert {r.file.rsplit("/", 1)[1] for r in checked.rejected.collect()} == {"b.json"}
    strict = read_listings(spark, str(tmp_path / "a.json"), "json")
    assert checked.rows.schema == strict.schema == LISTING_SCHEMA
    assert sorted(map(str, checked.rows.collect())) == sorted(map(str, strict.collect()))


def test_counts_do_not_depend_on_the_columns_read(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([*GOOD, *BAD]))
    checked = check_listings(spark, str(tmp_path))
    assert checked.rows.count() == len(GOOD) == checked.rows.select("summary").count()
    assert checked.rejected.count() == len(BAD) == checked.rejected.select("reason").count()
    plan = checked.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_text_keys(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"_id": "x1"}')
    checked = check_listings(spark, str(tmp_path), T.StringType())
    assert [r._id for r in checked.rows.collect()] == ["x1"] and checked.rejected.isEmpty()


def test_lexicons(spark, tmp_path):
    (tmp_path / "a.csv").write_text("word,value\ngood,3\n,2\nbad,\nfair,much\nfine,2\n")
    checked = check_score_lexicon(spark, str(tmp_path / "a.csv"), "csv")
    assert sorted(map(tuple, checked.rows.collect())) == [("fine", 2), ("good", 3)]
    got = {(json.loads(r.line).get("word"), r.reason) for r in checked.rejected.collect()}
    assert got == {(None, "no word"), ("bad", "no value"), ("fair", "value is no int")}
    spark.createDataFrame([("a", "joy"), ("b", None)], "word string, sentiment string").write.parquet(
        str(tmp_path / "c")
    )
    checked = check_class_lexicon(spark, str(tmp_path / "c"))
    assert checked.rows.count() == 1
    assert [r.reason for r in checked.rejected.collect()] == ["no sentiment"]
    with pytest.raises(ValueError, match="value"):
        check_score_lexicon(spark, str(tmp_path / "c"))
