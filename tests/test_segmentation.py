import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgelex.functions import segmentation as functions
from lodgelex.functions.segmentation import Trie, best_path, cut_together, put_back
from lodgelex.operators.counting import count_by
from lodgelex.operators.segmentation import segmented, word_costs
from lodgelex.operators.tokens import bigrams, words

# Words of a small dictionary of our own.
WORDS = ["香港", "中環", "地鐵", "地鐵站", "站", "附近", "公寓", "近", "乾淨", "乾淨公寓"]


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame([(w,) for w in [*WORDS, None, "香港"]], "word string")


def split(make, dictionary, text, limit):
    frame = segmented(make(*[{"text": t} for t in text]), dictionary, limit=limit)
    return {r.document_id: r.tokens for r in frame.collect()}


@pytest.mark.parametrize("limit", [1000, 0])
def test_runs_become_dictionary_words(make, dictionary, limit):
    text = [
        "香港中環地鐵站附近公寓", "Clean乾淨公寓 near 地鐵", "don't walk 3.5 km", None, "", "未知香港字",
        "香港。香港", "ｶﾞ 東京タワー",
    ]
    got = split(make, dictionary, text, limit)
    assert got[1] == ["香港", "中環", "地鐵站", "附近", "公寓"]
    assert got[2] == ["clean", "乾淨公寓", "near", "地鐵"]
    assert got[3] == ["don't", "walk", "3.5", "km"]
    assert got[4] is None and got[5] == []
    assert got[6] == ["未", "知", "香港", "字"] and got[7] == ["香港", "香港"]
    assert got[8][-5:] == ["東", "京", "タ", "ワ", "ー"]


@pytest.mark.parametrize("limit", [1000, 0])
def test_weights_decide_between_cuts(spark, make, limit):
    near = spark.createDataFrame([("研究", 100), ("研究生", 5), ("生命", 100), ("命", 5)], "word string, n long")
    assert split(make, near, ["研究生命"], limit)[1] == ["研究", "生命"]
    far = spark.createDataFrame([("研究", 1), ("研究生", 900), ("生命", 1), ("命", 900)], "word string, n long")
    assert split(make, far, ["研究生命"], limit)[1] == ["研究生", "命"]
    empty = near.limit(0)
    assert split(make, empty, ["研究 生"], limit)[1] == ["研", "究", "生"]


def test_the_path_is_the_cheapest_of_all(spark):
    trie = Trie([("ab", 30), ("abc", 45), ("c", 20), ("bc", 25), ("d", 10), ("cd", 28), ("abcd", 90)])
    costs = {"ab": 30, "abc": 45, "c": 20, "bc": 25, "d": 10, "cd": 28, "abcd": 90}
    for run in map("".join, itertools.product("abcd", repeat=5)):
        options = []
        for cuts in itertools.product([0, 1], repeat=4):
            edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], 5]
            pieces = [run[a:b] for a, b in itertools.pairwise(edges)]
            if all(len(p) == 1 or p in costs for p in pieces):
                options.append(sum(min(costs.get(p, 50), 50) if len(p) == 1 else costs[p] for p in pieces))
        got = best_path(run, trie.found(run), 50)
        assert "".join(got) == run
        assert sum(min(costs.get(p, 50), 50) if len(p) == 1 else costs[p] for p in got) == min(options)


def test_words_and_bigrams_read_the_new_column(make, dictionary):
    frame = segmented(make({"text": "香港中環香港"}, {"text": "sea view"}), dictionary)
    assert rows(count_by(words(frame, "tokens"), "word")) == [("sea", 1), ("view", 1), ("中環", 1), ("香港", 2)]
    assert rows(bigrams(frame, "tokens"), "word1", "word2") == [
        ("sea", "view"), ("中環", "香港"), ("香港", "中環"),
    ]


def test_tokens_that_are_already_made_and_repeated_rows(make, dictionary):
    frame = make({"text": "香港中環"}, {"text": "香港中環"}).withColumn("document_id", F.lit(1))
    made = frame.withColumn("text", F.array(F.lit("香港中環"), F.lit("x")))
    for limit in (1000, 0):
        assert [r.tokens for r in segmented(made, dictionary, limit=limit).collect()] == [
            ["香港", "中環", "x"]
        ] * 2


def test_costs_are_shares(spark, dictionary):
    costs, unknown = word_costs(dictionary)
    by = {r.word: r.cost for r in costs.collect()}
    assert by["香港"] < by["中環"] == by["站"]
    assert spark.range(1).select(unknown).first()[0] > 10_000


def test_the_array_path_equals_the_path_of_each_run():
    """Runs of one batch, mixed tokens and runs longer than the chunk, cut together and one by one."""
    signs = "天地玄黄宇宙"
    draw = random.Random(3)
    words_ = {"".join(draw.choices(signs, k=draw.randint(1, 4))): draw.randint(0, 60) for _ in range(60)}
    trie = Trie(words_.items())
    texts = ["".join(draw.choices(signs, k=draw.randint(1, 30))) for _ in range(300)] + ["", "a天地b玄", "plain", "𠀀é天"]
    pieces, counts = cut_together(pa.array(texts), trie, 70)
    got, flat = [], iter(pieces.to_pylist())
    for n in counts:
        got.append([next(flat) for _ in range(n)])
    for text, own in zip(texts, got, strict=True):
        assert "".join(own) == text
        if text and set(text) <= set(signs):
            cost = [0] + [None] * len(text)
            for end in range(1, len(text) + 1):
                cost[end] = min(
                    cost[end - k] + min([70] * (k == 1) + [words_[w]] * (w in words_))
                    for k in range(1, min(4, end) + 1)
                    for w in [text[end - k : end]] if k == 1 or w in words_
                )
            assert sum(min(words_.get(p, 70), 70) if len(p) == 1 else words_[p] for p in own) == cost[-1]
    assert got[-4:-1] == [[""], ["a", *best_path("天地", trie.found("天地"), 70), "b", "玄"], ["plain"]]


def test_a_token_is_cut_once_however_often_a_batch_holds_it():
    """Millions of equal tokens take the time of one: the old path looked at each of them."""
    tokens = pa.array([["天地玄黄"] * 1_000_000, None, []], pa.list_(pa.string()))
    coded = pc.list_flatten(tokens).dictionary_encode()
    pieces, counts = cut_together(coded.dictionary, Trie([("天地", 5)]), 50)
    assert pieces.to_pylist() == ["天地", "玄", "黄"] and counts.tolist() == [3]
    whole = put_back(tokens, coded.indices, pieces, counts)
    assert len(whole[0]) == 3_000_000 and whole[1].as_py() is None and whole[2].as_py() == []


def test_what_is_dealt_out_are_words_that_pass_the_sieve(spark, make, dictionary):
    """Not every place and size of every run: of ten thousand signs without a word nothing is joined."""
    long = "木" * 10_000
    frame = segmented(make({"text": long}, {"text": "香港中環香港 地鐵"}), dictionary, limit=0)
    plan = frame._jdf.queryExecution().toString()
    assert "sequence(" not in plan and "regexp_extract_all(_token" not in plan
    got = {r.document_id: r.tokens for r in frame.collect()}
    assert got == {1: ["木"] * 10_000, 2: ["香港", "中環", "香港", "地鐵"]}
    none = pa.array([[long], None, [], ["x", "香港"]])
    bits = np.zeros(functions.SIEVE_BITS // 8, np.uint8)
    at = functions.marks_of(pa.array(["香港", "x"])) % functions.SIEVE_BITS
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    assert functions.words_held(none, bits, 2).to_pylist() == [[], [], [], ["香港"]]


def test_both_plans_cut_alike(spark, make):
    draw = random.Random(5)
    signs = "天地玄黄宇宙𠀀"
    known = [("".join(draw.choices(signs, k=draw.randint(1, 4))), draw.randint(1, 90)) for _ in range(80)]
    weighted = spark.createDataFrame(known, "word string, n long")
    frame = make(*[
        {"text": " ".join("".join(draw.choices(signs + "ab", k=draw.randint(1, 25))) for _ in range(20))}
        for _ in range(60)
    ])
    both = [
        {r.document_id: r.tokens for r in segmented(frame, weighted, limit=limit).collect()}
        for limit in (1000, 0)
    ]
    assert both[0] == both[1] and len(both[0]) == 60


def written(plan, metric):
    """What the exchanges of an executed plan have written."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return written(plan.executedPlan(), metric)
    if kind.endswith("QueryStageExec"):
        return written(plan.plan(), metric)
    own = plan.metrics().apply(metric).value() if kind == "ShuffleExchangeExec" else 0
    children = plan.children()
    return own + sum(written(children.apply(i), metric) for i in range(children.size()))


def test_rows_are_dealt_out_packed_and_the_words_of_a_pack_once(spark, dictionary):
    """Not every row with its tokens, and not the words of every row."""
    text = " ".join(["香港中環地鐵站附近公寓"] * 50)
    frame = segmented(
        spark.range(0, 600, 1, 3).withColumn("text", F.lit(text)), dictionary, limit=0
    ).select("id", "tokens")
    want = ["香港", "中環", "地鐵站", "附近", "公寓"] * 50
    assert {r.id: r.tokens for r in frame.collect()} == dict.fromkeys(range(600), want)
    plan = frame._jdf.queryExecution().executedPlan()
    assert written(plan, "shuffleRecordsWritten") < 200


def test_packs_hold_every_row_in_order(monkeypatch):
    monkeypatch.setattr(functions, "PACKED", 5)
    batch = pa.record_batch({
        "id": pa.array(range(7)),
        "tokens": pa.array([["天地", "x"], None, [], ["玄黄宇宙洪荒"], [], ["日"], None], pa.list_(pa.string())),
    })
    packs = list(functions.packs_of(batch, "tokens"))
    assert len(packs) > 1
    again = [functions.unpacked(pa.py_buffer(functions.packed(rows))) for rows in packs]
    assert pa.concat_tables(again).to_pylist() == batch.to_pylist()
    assert list(functions.packs_of(batch.slice(0, 0), "tokens")) == []


def test_columns_of_any_kind_and_rows_without_tokens_go_along(spark, dictionary):
    """Dates, decimals, structs and maps come back as they were; copies of a row stay copies."""
    frame = spark.sql(
        "select id, case id % 4 when 0 then '香港地鐵' when 1 then null when 2 then '' else 'sea 公寓' end as text, "
        "date '2020-01-31' as day, timestamp '2020-01-31 01:02:03' as at, cast(1.25 as decimal(9, 2)) as price, "
        "named_struct('a', id, 'b', array(id, null)) as s, map('k', id) as m, cast('x' as binary) as raw "
        "from (select id div 2 as id from range(0, 24, 1, 5))")
    both = [segmented(frame, dictionary, limit=limit) for limit in (1000, 0)]
    assert both[0].schema.simpleString() == both[1].schema.simpleString()
    assert Counter(map(str, both[0].collect())) == Counter(map(str, both[1].collect()))
    made = spark.createDataFrame([(1, ["", ""]), (2, ["", "香港地鐵"]), (3, [None]), (4, [])], "id long, t array<string>")
    got = {r.id: r.t for r in segmented(made, dictionary, "t", "t", limit=0).collect()}
    assert got == {1: ["", ""], 2: ["香港", "地鐵"], 3: [None], 4: []}
