import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodgelex.functions import stemming
from lodgelex.functions.stemming import letter_shape, measure, porter_stem, stem_tokens
from lodgelex.operators.topics import word_stems

# Examples printed in the published paper, step by step, carried through all steps.
PUBLISHED = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss",
    "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "radicalli": "radic", "differentli": "differ",
    "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam",
    "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "communism": "commun", "activate": "activ",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil",
}


@pytest.mark.parametrize(("word", "stem"), PUBLISHED.items())
def test_published_examples(word, stem):
    assert porter_stem(word) == stem


def test_measure():
    for m, examples in {
        0: ("tr", "ee", "tree", "y", "by"),
        1: ("trouble", "oats", "trees", "ivy"),
        2: ("troubles", "private", "oaten", "orrery"),
    }.items():
        assert {measure(letter_shape(word)) for word in examples} == {m}


def test_words_outside_ascii_and_short_words():
    assert porter_stem("") == ""
    assert porter_stem("s") == ""
    assert porter_stem("été") == "été"
    assert porter_stem("3.5") == "3.5"


def test_arrays_keep_order_nulls_and_empties(spark):
    data = [(1, ["ponies", "sky", "ponies"]), (2, []), (3, None), (4, ["cats", None, "hopping"])]
    df = spark.createDataFrame(data, "id int, tokens array<string>").repartition(2)
    got = {r.id: r.stems for r in df.select("id", stem_tokens("tokens").alias("stems")).collect()}
    assert got == {1: ["poni", "sky", "poni"], 2: [], 3: None, 4: ["cat", None, "hop"]}


def test_arrays_across_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.range(50).select(
            "id", F.array(F.lit("cats"), F.concat(F.lit("w"), F.col("id"))).alias("tokens")
        )
        got = df.select("id", stem_tokens("tokens").alias("stems")).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.stems for r in got] == [["cat", f"w{i}"] for i in range(50)]


def test_vocabulary_table(spark):
    df = spark.createDataFrame([("cats",), ("cats",), ("ties",)], "word string")
    assert sorted(tuple(r) for r in word_stems(df).collect()) == [("cats", "cat"), ("ties", "ti")]


def test_a_large_batch_is_stemmed_in_slices(monkeypatch):
    """A batch of long rows keeps no more beside it than a slice of its tokens, nor words without end."""
    seen, whole = [], stemming._stem_values
    monkeypatch.setattr(stemming, "_stem_values", lambda words: seen.append(len(words)) or whole(words))
    monkeypatch.setattr(stemming, "_seen", [{}, {}])
    monkeypatch.setattr(stemming, "REMEMBERED", 1000)
    words = pa.array([f"walking{k % 3000}" if k % 5 else "views" for k in range(3 * stemming.TOGETHER + 5)])
    got = stemming.stem_slices(words)
    assert seen == [stemming.TOGETHER] * 3 + [5]
    assert got.to_pylist() == [stemming.porter_stem(w) for w in words.to_pylist()]
    assert sum(map(len, stemming._seen)) <= 1000
    assert stemming.stem_slices(pa.array([], pa.string())).to_pylist() == []
