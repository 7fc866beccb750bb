import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgelex.operators import topics as tp
from lodgelex.operators.counting import count_by
from lodgelex.operators.tokens import bigrams, words
from lodgelex.operators.weighting import bigram_tf_idf, total_documents
from lodgelex.schema import TOPIC_TERMS


@pytest.fixture(scope="module")
def corpus(make):
    sea = ["beach", "sand", "wave", "coast"]
    city = ["metro", "museum", "tower", "street"]
    texts = []
    for i in range(50):
        texts.append({"text": " ".join(sea[(i + j) % 4] for j in range(12))})
        texts.append({"text": " ".join(city[(i + j) % 4] for j in range(12))})
    return make(*texts)


@pytest.fixture(scope="module")
def fitted(corpus):
    return tp.fit_topics(tp.processed_documents(corpus), max_iter=40)


def test_texts_keep_their_order(make, words_of):
    flat = make({"text": "Ponies to the sky, ponies of a coast"}, {"text": "to of a"}, {"text": None})
    docs = tp.processed_documents(flat, stop=words_of["stop"])
    assert rows(tp.processed_texts(docs), "document_id", "text") == [
        (1, "poni the sky poni coast"),
    ]
    plain = tp.processed_documents(flat, stop=words_of["stop"], stem=False)
    assert rows(tp.processed_texts(plain), "text") == [("ponies the sky ponies coast",)]


def test_long_stop_list_gives_the_same(spark, make, words_of):
    """More than a literal set takes, with repeated and missing ids."""
    text = ["sea view of sea view", "sea view", "a beach view of sea", "of a", "view view of beach"]
    same = [make({"text": t}).withColumn("document_id", F.lit(i).cast("long"))
            for t, i in zip(text, (1, 1, None, None, 2), strict=True)]
    flat = same[0].unionByName(same[1]).unionByName(same[2]).unionByName(same[3]).unionByName(same[4])
    short = words_of["stop"]
    long = short.unionByName(spark.range(12_000).selectExpr("concat('absent ', id) as word"))
    made = {
        "documents": lambda stop: tp.processed_documents(flat, stop=stop),
        "terms": lambda stop: tp.doc_terms(tp.processed_documents(flat, stop=stop)),
        "pairs": lambda stop: bigrams(flat, "text", stop),
        "total": lambda stop: total_documents(bigrams(flat, "text", stop)),
        "weights": lambda stop: bigram_tf_idf(bigrams(flat, "text", stop)),
    }
    for name, build in made.items():
        few, many = build(short), build(long)
        assert few.columns == many.columns, name
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())), name


def test_token_table_is_put_together_in_order(make):
    texts = [{"text": " ".join(f"w{(i * j) % 11}" for j in range(30))} for i in range(20)]
    flat = make(*texts)
    scattered = words(flat).repartition(9, F.rand(seed=3))
    expected = rows(tp.processed_documents(flat, stem=False))
    assert rows(tp.ordered_tokens(scattered)) == expected


def test_term_counts_equal_a_grouping(make):
    texts = [{"text": " ".join(f"w{(i * j) % 7}" for j in range(i))} for i in range(1, 30)]
    flat = make(*texts)
    counted = tp.doc_terms(tp.processed_documents(flat, stem=False))
    assert rows(counted) == rows(count_by(words(flat), "document_id", "country", "word"))
    assert counted.schema["n"].dataType.simpleString() == "bigint"


def test_short_terms_and_empty_documents_stay_out(make):
    docs = tp.processed_documents(make({"text": "ok ok go"}, {"text": "fine ok"}), stem=False)
    assert rows(tp.long_terms(docs)) == [(2, ["fine"])]


def test_betas_sum_to_one_over_the_vocabulary(spark, fitted):
    beta = tp.topic_term_beta(spark, fitted)
    assert beta.schema == TOPIC_TERMS or beta.dtypes == [
        ("topic", "int"), ("term", "string"), ("beta", "double"),
    ]
    sums = beta.groupBy("topic").agg(F.sum("beta").alias("s"), F.count("*").alias("terms"))
    assert {r.topic for r in sums.collect()} == {1, 2}
    assert all(r.s == pytest.approx(1.0, abs=1e-6) and r.terms == 8 for r in sums.collect())
    assert {r.term for r in beta.collect()} == {r.term for r in fitted[1].collect()}


def test_two_vocabularies_come_apart(spark, fitted):
    leading = tp.top_terms(tp.topic_term_beta(spark, fitted), top=4).collect()
    sea = {"beach", "sand", "wave", "coast"}
    first = {r.term for r in leading if r.topic == 1}
    second = {r.term for r in leading if r.topic == 2}
    assert not first & second
    assert sea in (first, second)
    assert [r.topic for r in leading] == [1] * 4 + [2] * 4
    betas = [r.beta for r in leading]
    assert betas[:4] == sorted(betas[:4], reverse=True)


def test_nothing_to_fit(spark, make, corpus):
    nowhere = tp.processed_documents(corpus.where("country = 'nowhere'"))
    assert tp.fit_topics(nowhere) is None
    assert tp.fit_topics(tp.processed_documents(make({"text": "ok go"}))) is None
    empty = tp.topic_term_beta(spark, None)
    assert empty.count() == 0 and empty.columns == ["topic", "term", "beta"]
    assert tp.top_terms(empty).count() == 0


def test_vocabulary_has_a_fixed_order(make):
    docs = tp.processed_documents(
        make({"text": "wave sand sand coast"}, {"text": "beach coast"}), stem=False
    )
    vocabulary = tp.vocabulary_of(tp.long_terms(docs))
    assert rows(vocabulary) == [
        (0, "coast", 2), (1, "sand", 2), (2, "beach", 1), (3, "wave", 1)
    ]


def test_one_seed_gives_one_model(spark, corpus):
    """Two runs, and other partitionings of the input, lead to the same topics."""
    docs = tp.processed_documents(corpus)

    def leading(frame):
        fitted = tp.fit_topics(frame, max_iter=5)
        top = tp.top_terms(tp.topic_term_beta(spark, fitted), top=8)
        return [(r.topic, r.term, round(r.beta, 9)) for r in top.collect()]

    first = leading(docs)
    assert first == leading(docs) == leading(docs.repartition(2)) == leading(docs.repartition(8))


def test_matrix_is_what_the_model_sees(corpus):
    docs = tp.processed_documents(corpus)
    terms = tp.long_terms(docs)
    vocabulary = tp.vocabulary_of(terms)
    names = {r["index"]: r.term for r in vocabulary.collect()}
    seen = {
        (r.document_id, names[i], int(n))
        for r in tp.term_vectors(terms, vocabulary).collect()
        for i, n in zip(r.features.indices, r.features.values, strict=True)
    }
    assert seen == set(rows(tp.document_term_matrix(docs), "document_id", "term", "n"))


def test_vectors_of_a_joined_vocabulary_and_of_repeated_ids(make, monkeypatch):
    docs = tp.processed_documents(
        make({"text": "wave sand sand"}, {"text": "coast wave"}).withColumn("document_id", F.lit(7)),
        stem=False,
    )
    terms = tp.long_terms(docs)
    vocabulary = tp.vocabulary_of(terms)
    broadcast = sorted(str(r.features) for r in tp.term_vectors(terms, vocabulary).collect())
    monkeypatch.setattr(tp, "small_side", lambda df: df)
    joined = sorted(str(r.features) for r in tp.term_vectors(terms, vocabulary).collect())
    assert joined == broadcast and len(joined) == 2


def test_betas_are_those_that_the_model_reports(spark, fitted):
    model, vocabulary = fitted
    names = {r["index"]: r.term for r in vocabulary.collect()}
    reported = {
        (r.topic + 1, names[i]): w
        for r in model.describeTopics(len(names)).collect()
        for i, w in zip(r.termIndices, r.termWeights, strict=True)
    }
    read = {(r.topic, r.term): r.beta for r in tp.topic_term_beta(spark, fitted).collect()}
    assert read.keys() == reported.keys()
    assert all(read[key] == pytest.approx(reported[key], abs=1e-12) for key in read)


def test_rare_terms_go_only_when_asked(make):
    docs = tp.processed_documents(make({"text": "beach sand"}, {"text": "beach wave"}))
    every, common = tp.fit_topics(docs, max_iter=2)[1], tp.fit_topics(docs, min_df=2, max_iter=2)[1]
    assert rows(every, "term") == [("beach",), ("sand",), ("wave",)]
    assert rows(common, "term") == [("beach",)]


def test_fit_layout_grows_in_parts_and_then_in_rows():
    """Few documents are several parts; many are not so many that their matrices outweigh the documents."""
    assert [tp.fit_parts(n) for n in (1, 2_000, 2_001, 8_000, 460_000, 1_400_000)] == [1, 1, 2, 4, 11, 11]
    assert tp.fit_parts(6_000_000) == 30


def test_terms_are_made_once(spark, make, words_of):
    """Vocabulary and vectors read one table: the texts are not taken apart for each of them."""
    taken = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        taken.add(1)
        return text

    listings = make(*[{"text": f"garden walks {k} terrace"} for k in range(6)])
    docs = tp.processed_documents(listings.withColumn("text", counted("text")), "text", words_of["stop"])
    tp.long_terms(docs).write.format("noop").mode("overwrite").save()
    once = taken.value
    assert once and tp.fit_topics(docs, max_iter=2) is not None
    assert taken.value == 2 * once
