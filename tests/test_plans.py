"""What the physical plans of the registered queries must and must not contain."""

import re

import pytest

from registry.spark_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TEXT_FREE = ("country_counts", "find_bedrooms_price", "avg_price_by_room_type", "map_points")
TOKENISING = (
    "word_counts_by_country", "word_counts_no_stopwords", "word_tf_idf", "bing_by_country",
    "afinn_occurrences", "mostly_used_words", "polarity_table", "sentiment_comparison", "bigrams",
    "bigram_top15", "bigram_nodes", "bigram_tf_idf", "total_documents", "panel_bigrams",
    "panel_sentiment", "panel_tf_idf_top10", "unstemmed_doc_terms", "stemmed_doc_terms",
    "processed_descriptions_unstemmed", "processed_descriptions",
)


def planned(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def executed(spark, name):
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The final plans of the query and of its subqueries, without the initial ones: those are the
    # lines below such a heading that are indented as deep as it is.
    kept, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = line.index("== Initial") if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


@pytest.mark.parametrize("name", TEXT_FREE)
def test_text_is_not_read_when_not_needed(spark, name):
    assert "text" not in planned(spark, name).split("ReadSchema:")[1]


@pytest.mark.parametrize("name", TOKENISING)
def test_tokeniser_runs_once(spark, name):
    assert executed(spark, name).count("regexp_extract_all(") == 1


@pytest.mark.parametrize("name", TOKENISING)
def test_python_only_for_stems(spark, name):
    plan = planned(spark, name)
    stems = name in ("stemmed_doc_terms", "processed_descriptions")
    assert ("Python" in plan) == stems
    assert plan.count("ArrowEvalPython") == (1 if stems else 0)


@pytest.mark.parametrize("name", TOKENISING)
def test_no_join_without_a_key_and_no_shuffled_join(spark, name):
    """What is attached to groups is planned as a join and broadcast by its size at run time."""
    plan = executed(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["unstemmed_doc_terms", "stemmed_doc_terms", "bigrams"])
def test_document_work_is_narrow(spark, name):
    """The only exchange is the spreading of the small test file."""
    plan = planned(spark, name)
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("name", ["bigram_top15", "high_rated_bigram_top15"])
def test_ranks_are_limited_before_the_exchange(spark, name):
    plan = planned(spark, name)
    assert re.search(r"WindowGroupLimit .*row_number\(\), 15, Partial", plan)


def test_pooled_rank_uses_a_bounded_heap(spark):
    assert "TakeOrderedAndProject(limit=15" in planned(spark, "panel_bigrams")


@pytest.mark.parametrize("name", ["bigram_top15", "bigram_tf_idf", "word_tf_idf"])
def test_counts_are_shuffled_once(spark, name):
    assert "ReusedExchange" in executed(spark, name)


@pytest.mark.parametrize("name", ["bigram_tf_idf", "bigram_tf_idf_pinned_market"])
def test_pairs_come_out_of_the_compiled_stage_that_counts_them(spark, name):
    plan = executed(spark, name)
    assert plan.count("Generate posexplode") == len(re.findall(r"\*\(\d+\) Generate posexplode", plan))


def test_market_filter_reaches_the_scan(spark):
    assert "EqualTo(lang,de)" in planned(spark, "word_tf_idf_one_country")
    assert "In(lang, [de,en])" in planned(spark, "panel_map").replace("[en,de]", "[de,en]")
