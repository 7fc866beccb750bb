"""Learning samples and draws that copies, missing ids and clashing names must not bend."""

import random

import numpy as np
from pyspark.sql import functions as F

from lodgelex.llm import bpe, language_id, mixing, quality, url_filter
from lodgelex.llm.queries import URL_RULES

FOLDER = "/root/testdata/sf0.01"


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_copies_of_one_row_take_no_place_in_the_language_sample(spark, monkeypatch):
    docs = documents(spark)
    one = docs.where("lang = 'de' and crc32(cast(string(doc_id) as binary)) % 3 <> 1").limit(1)
    copies = one.crossJoin(spark.range(500)).select(*docs.columns)
    seen = []
    monkeypatch.setattr(language_id, "Model", lambda samples: seen.append(sorted(samples)))
    language_id.fit(docs)
    language_id.fit(docs.unionByName(copies))
    assert seen[0] == seen[1] and sum(lang == "de" for lang, _ in seen[0]) > 50


def test_language_names_may_clash_and_languages_are_never_dropped(spark, monkeypatch):
    docs = documents(spark)
    extra = docs.selectExpr(
        "*", "1 as id", "2 as take", "'x' as lang_of", "3 as size_of", "4 as draw", "5 as turn", "6 as n"
    )
    seen = []
    monkeypatch.setattr(language_id, "Model", lambda samples: seen.append(sorted(samples)))
    language_id.fit(docs, per_language=20)
    language_id.fit(extra, per_language=20)
    assert seen[0] == seen[1]
    many = docs.withColumn("lang", F.concat("lang", F.col("doc_id") % 40))
    language_id.fit(many, sample_rows=200)
    assert len({lang for lang, _ in seen[2]}) == many.where(
        "crc32(cast(string(doc_id) as binary)) % 3 <> 1"
    ).select("lang").distinct().count()


def test_copies_of_one_text_take_no_place_in_the_quality_sample(spark, monkeypatch):
    docs = documents(spark)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    chosen = labels.where("quality = 1 and crc32(cast(string(doc_id) as binary)) % 5 <> 0")
    one = docs.join(chosen, "doc_id").orderBy(F.desc("n_chars")).select(docs.columns).limit(1)
    copies = one.crossJoin(spark.range(400).withColumnRenamed("id", "k")).withColumn(
        "doc_id", F.col("k") + 10_000_000
    ).drop("k")
    marked = copies.selectExpr("doc_id", "1 as quality", "0 as toxic")
    seen = []
    monkeypatch.setattr(quality, "Model", lambda good, bad: seen.append((sorted(good), sorted(bad))))
    clash = docs.unionByName(copies).selectExpr("*", "1 as mark", "2 as doc", "3 as id", "4 as draw")
    quality.fit(docs, labels)
    quality.fit(clash, labels.unionByName(marked))
    assert seen[0] == seen[1] and len(seen[0][0]) > 100


def test_copies_of_one_url_do_not_move_verdicts(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")
    plain = url_filter.judge(pages, URL_RULES)
    ruled = plain.where("rule is not null").join(pages, "page_id").select("url").limit(1)
    copies = ruled.crossJoin(spark.range(3000)).selectExpr("id + 1000000 as page_id", "url")
    few = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, URL_RULES, training_rows=60).collect()}
    again = url_filter.judge(pages.unionByName(copies), URL_RULES, training_rows=60)
    moved = {r["page_id"]: r["verdict"] for r in again.where("page_id < 1000000").collect()}
    assert moved == few


def test_trees_on_held_out_labelled_urls(spark):
    """Urls that a rule decides, learnt without their host's rule rows: the verdict of the other rows."""
    rows = [
        (i, f"https://h{i}.{'bad' if i % 3 == 0 else 'good'}.org/{'?q=' + '1' * 30 if i % 3 == 0 else 'a/b'}")
        for i in range(120)
    ]
    rules = [
        url_filter.rule("block" if i % 3 == 0 else "allow", f"h{i}.{'bad' if i % 3 == 0 else 'good'}.org/")
        for i in range(0, 120, 4)
    ]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    held_out = [r for r in got if r["rule"] is None]
    right = sum((r["verdict"] == "block") == (r["page_id"] % 3 == 0) for r in held_out)
    assert len(held_out) == 90 and right >= 0.98 * len(held_out)


def test_mix_draws_rows_without_an_id_by_their_content(spark):
    rows = [(None, f"text number {i} " + "w " * (i % 7), "a") for i in range(1500)]
    rows += [(7, f"shared id {i}", "a") for i in range(700)]
    rows += [(i, f"plain text {i}", "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, content_col="text")
    by = {r["source"]: r for r in got.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most")
    ).collect()}
    assert all(abs(r["taken"] - r["target"]) <= r["most"] for r in by.values())
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(got) == as_rows(mixing.mix(docs.repartition(5), content_col="text"))
    assert got.where("taken > 2 * size").count() == 0


def test_a_long_text_is_encoded_in_parts(tmp_path, monkeypatch):
    import public_tokenizers

    vocabulary = bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    pick = random.Random(4)
    text = "".join(pick.choice(["word ", "  \n", "näive ", "it's ", "x" * 9000, "123 ", "日本"]) for _ in range(4000))
    starts = bpe.piece_starts(bpe.code_points(text), np.array([0]))
    (whole,) = bpe.encode_texts(vocabulary, [text])
    monkeypatch.setattr(bpe, "TOGETHER", 1000)
    assert (np.concatenate(list(bpe.encode_parts(vocabulary, text, starts))) == whole).all()
