from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodgelex.operators import tokens as tk
from lodgelex.operators import topics as tp
from lodgelex.operators.counting import count_by
from lodgelex.sources.words import default_stop_words


def texts_of(df):
    return [r.word for r in df.orderBy("document_id", "pos").collect()]


def test_case_punctuation_apostrophe_decimal(make):
    assert texts_of(tk.words(make({"text": "Sea-view, SEA view!"}))) == ["sea", "view"] * 2
    assert texts_of(tk.words(make({"text": "don't pay 3.5."}))) == ["don't", "pay", "3.5"]
    assert texts_of(tk.words(make({"text": "l’été été_2"}))) == ["l’été", "été_2"]


def test_null_empty_and_single_word(make):
    flat = make({"text": None}, {"text": ""}, {"text": "cozy"}, {"text": "  !! "})
    assert rows(tk.words(flat), "document_id", "word") == [(3, "cozy")]
    assert tk.bigrams(flat).count() == 0
    kept = rows(tk.words(flat, outer=True).where("word is null"), "document_id")
    assert kept == [(1,), (2,), (4,)]


def test_stop_word_does_not_join_its_neighbours(make, words_of):
    flat = make({"text": "walk to beach"})
    assert tk.bigrams(flat, stop=words_of["stop"]).count() == 0
    assert rows(tk.words(flat, stop=words_of["stop"]), "word") == [("beach",), ("walk",)]


def test_bigrams_stay_inside_a_document(make):
    flat = make({"text": "a b c"}, {"text": "d e"})
    assert rows(tk.bigrams(flat), "document_id", "place", "word1", "word2") == [
        (1, 0, "a", "b"), (1, 1, "b", "c"), (2, 0, "d", "e"),
    ]


def test_array_form_equals_lead_form(make):
    flat = make({"text": "a b a b b"}, {"text": "x"}, {"text": "b a"}, {"text": None})
    by_document = Window.partitionBy("document_id").orderBy("pos")
    lead = tk.words(flat).select(
        "document_id", F.col("word").alias("word1"), F.lead("word").over(by_document).alias("word2")
    ).where("word2 is not null")
    assert rows(tk.bigrams(flat), "document_id", "word1", "word2") == rows(lead)


def test_unite_and_separate_are_inverse(make):
    pairs = tk.bigrams(make({"text": "one two three"}))
    united = tk.unite(pairs)
    assert rows(united, "bigram") == [("one two",), ("two three",)]
    back = tk.separate(united.drop("word1", "word2"))
    assert rows(back, "word1", "word2") == rows(pairs, "word1", "word2")


def test_ngrams(make):
    flat = make({"text": "a b c d"}, {"text": "a b"})
    assert rows(tk.ngrams(flat, 3), "word1", "word2", "word3") == [("a", "b", "c"), ("b", "c", "d")]


def test_long_stop_list_takes_the_join_and_gives_the_same(make, words_of, monkeypatch):
    flat = make({"text": "out of a box to the sea in may"}, {"text": "of of"}, {"text": "x y"})
    short = rows(tk.bigrams(flat, stop=words_of["stop"]), "document_id", "word1", "word2")
    monkeypatch.setattr(tk, "listed_words", lambda stop: None)
    joined = tk.bigrams(flat, stop=words_of["stop"])
    assert joined.columns == tk.bigrams(flat, stop=words_of["stop"]).columns
    assert rows(joined, "document_id", "word1", "word2") == short
    monkeypatch.setattr(tk, "fits_broadcast", lambda df: False)
    shuffled = tk.bigrams(flat, stop=words_of["stop"])
    assert rows(shuffled, "document_id", "word1", "word2") == short


def test_listed_words_limit(spark, words_of):
    assert tk.listed_words(words_of["stop"]) == ["a", "in", "of", "to"]
    assert tk.listed_words(words_of["stop"], limit=3) is None
    assert len(tk.listed_words(default_stop_words(spark))) > 100


def test_counts_do_not_depend_on_partitioning(make):
    texts = [{"text": f"w{i % 7} w{i % 3} the the"} for i in range(40)]
    counts = [
        rows(count_by(tk.words(make(*texts, partitions=p)), "country", "word")) for p in (1, 5, 16)
    ]
    assert counts[0] == counts[1] == counts[2]


def test_saved_tokens_are_taken_as_they_are(make):
    flat = make({"text": "A b c"}, {"text": "d"})
    saved = flat.withColumn("tokens", F.split(F.lower("text"), " "))
    assert rows(tk.bigrams(saved, "tokens")) == rows(tk.bigrams(flat, "text"))
    assert rows(tk.words(saved, "tokens")) == rows(tk.words(flat, "text"))


def test_long_stop_list_shuffles_no_text(spark, make, words_of):
    """Of a long list only the words that occur leave the tasks, once each."""
    flat = make({"text": "out of a box to the sea in may"}, {"text": "of of"}, {"text": None})
    absent = spark.range(tk.LITERAL_WORDS + 1).selectExpr("concat('absent ', id) as word")
    stop = words_of["stop"].unionByName(absent)
    assert tk.dropped_words(flat, "text", stop) == ["a", "in", "of", "to"]
    for made in (tk.bigrams(flat, stop=stop), tp.processed_documents(flat, stop=stop, stem=False)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_row" not in plan and "LeftAnti" not in plan
    assert rows(tk.bigrams(flat, stop=stop)) == rows(tk.bigrams(flat, stop=words_of["stop"]))


def test_places_number_what_remains_of_each_row(spark):
    saved = spark.createDataFrame(
        [
            (1, "x", ["of", "a", "sea", "view", "to", "old", "sea", "view"]), (2, "x", ["sea"]),
            (3, None, []), (4, "x", None), (5, "x", ["of", "to"]), (5, "x", ["b", None, "c", "d"]),
        ],
        "document_id long, country string, tokens array<string>",
    )
    stop = spark.createDataFrame([("of",), ("to",), ("a",)], "word string")
    clean = tk.bigrams(saved, "tokens", stop)
    assert clean.columns == ["document_id", "country", "place", "word1", "word2"]
    assert rows(clean) == [
        (1, "x", 0, "sea", "view"), (1, "x", 1, "old", "sea"), (1, "x", 2, "sea", "view"),
        (5, "x", 0, "c", "d"),
    ]
    assert tk.bigrams(saved, "tokens").where("document_id = 5").count() == 4
