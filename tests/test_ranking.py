import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodgelex.operators.counting import (
    descending,
    per_group,
    round_half_up,
    top_with_ties,
    value_frequency,
)


@pytest.fixture(scope="module")
def scores(spark):
    data = [("a", f"t{i}", 20 - i) for i in range(14)]
    data += [("a", "x", 6), ("a", "y", 6), ("a", "z", 5)]
    data += [("b", f"u{i}", 3) for i in range(40)]
    data += [(None, "n1", 2), (None, "n2", 1), ("c", "m", None)]
    return spark.createDataFrame(data, "country string, term string, n long").repartition(7)


def test_ties_at_the_cut_are_all_kept(scores):
    top = top_with_ties(scores.where("country = 'a'"), ["country"], "n", 15)
    assert top.count() == 16
    assert {r.rank for r in top.where("n = 6").collect()} == {15}


def test_a_group_of_nothing_but_ties_stays_whole(scores):
    assert top_with_ties(scores, ["country"], "n", 15).where("country = 'b'").count() == 40


def test_missing_group_key_is_a_group_and_missing_measure_is_dropped(scores):
    top = top_with_ties(scores, ["country"], "n", 1)
    assert rows(top.where("country is null"), "term", "rank") == [("n1", 1)]
    assert top.where("country = 'c'").count() == 0


@pytest.mark.parametrize("k", [1, 2, 5, 15, 100])
@pytest.mark.parametrize("by", [["country"], []])
def test_equals_the_plain_rank(scores, by, k):
    order = Window.partitionBy(*by).orderBy(F.desc("n"))
    expected = scores.where("n is not null").withColumn("rank", F.rank().over(order)).where(
        F.col("rank") <= k
    )
    as_text = lambda df: sorted(map(str, df.select("country", "term", "n", "rank").collect()))
    assert as_text(top_with_ties(scores, by, "n", k)) == as_text(expected)


def test_fractional_measures(spark):
    df = spark.createDataFrame([(i, i % 5 / 7) for i in range(30)], "id int, weight double")
    top = top_with_ties(df, [], "weight", 3)
    assert rows(top, "id", "rank") == [(i, 1) for i in range(30) if i % 5 == 4]


def test_descending_breaks_ties_by_name(scores):
    first = descending(scores.where("country = 'b'"), "n", "term").limit(3).collect()
    assert [r.term for r in first] == ["u0", "u1", "u10"]


def test_per_group_without_groups_is_a_scalar(scores):
    total = scores.agg(F.count(F.lit(1)).alias("all"))
    assert {r["all"] for r in per_group(scores, total, [], "all").collect()} == {60}


def test_many_groups_are_not_broadcast(scores):
    """No group column is broadcast by its name, whatever it is called."""
    by_term = top_with_ties(scores, ["term"], "n", 1)
    assert by_term.count() == scores.where("n is not null").count()
    for by in ("term", "country"):
        plan = top_with_ties(scores, [by], "n", 1)._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" not in plan


@pytest.mark.parametrize("hot", [1, 3, 10, 10_000])
def test_value_frequency(spark, hot):
    keys = ["a"] * 50 + ["b"] * 20 + ["c"] * 20 + [f"k{i % 7}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(keys)), "id int, word string").repartition(5)
    got = rows(value_frequency(df, "word", "n", hot), "id", "n")
    assert got == [(i, keys.count(word)) for i, word in enumerate(keys)]


def test_many_groups_and_a_hot_one(spark):
    """100,000 groups and one with a third of all rows: nothing is broadcast by name or by force."""
    df = spark.range(300_000).selectExpr("if(id % 3 = 0, -1, id % 100000) as country", "id % 997 as n")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = df.groupBy("country").agg(F.count(F.lit(1)).alias("rows"))
        joined = per_group(df, totals, ["country"], "rows")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "_salt" in plan
        assert joined.where("country = -1").agg(F.min("rows"), F.count("*")).first()[:] == (100_000, 100_000)
        assert joined.count() == 300_000
        order = Window.partitionBy("country").orderBy(F.desc("n"))
        expected = df.withColumn("rank", F.rank().over(order)).where("rank <= 2")
        top = top_with_ties(df, ["country"], "n", 2)
        mark = lambda t: t.agg(F.count("*"), F.sum(F.hash("country", "n", "rank"))).first()[:]
        cast = expected.withColumn("rank", F.col("rank").cast("long"))
        assert mark(top.select("country", "n", "rank")) == mark(cast.select("country", "n", "rank"))
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_below_every_leader_are_not_dealt_out(spark):
    """The lowest leader of any group bounds what the lookup of the leaders moves."""
    from lodgelex.operators.counting import top_with_ties

    counts = spark.range(5000).selectExpr(
        "cast(id % 3 as string) as g", "id as word", "if(id < 60, 1000 - id div 6, 1) as n"
    )
    top = top_with_ties(counts, ["g"], "n", 4)
    rows_ = top.collect()
    assert len(rows_) == 12 and min(r.n for r in rows_) == 999
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan
    empty = top_with_ties(counts.where("n > 5000"), ["g"], "n", 4)
    assert empty.collect() == []


def test_rounding_is_that_of_round_to_the_last_bit(spark):
    odd = [0.0, -0.0, 1e-7, -1e-7, 5e-7, -5e-7, 1.5e-6, 1.0000005, -2.5e-6, 999999.9999995, 1e300]
    odd += [float("nan"), float("inf"), float("-inf"), None, 123456789.1234565]
    values = spark.createDataFrame([(v,) for v in odd], "x double").unionByName(
        spark.range(50_000).selectExpr("ln((id % 760 + 1) / (id % 151 + 1)) * (id % 151 + 1) / 760 as x")
    ).unionByName(spark.range(50_000).selectExpr("(id - 25000) / 2e6 as x"))
    both = values.select("x", F.round("x", 6).alias("a"), round_half_up("x").alias("b"))
    # As texts, since 0.0 equals -0.0.
    assert both.where(~F.expr("cast(a as string) <=> cast(b as string)")).collect() == []
