"""The pipeline stage by stage against brute force, and as a registered query."""

import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from lodgelex.llm import bpe, mixing, ngram_join
from lodgelex.llm.common import saved

LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = " ".join(f"word{i} and" for i in range(60))
    rows = [(i, f"{base} {i % 7}" if i < 40 else f"text number {i} " + f"w{i} " * (i % 50), "en", f"s{i % 3}", 1)
            for i in range(160)]
    rows += [(200, "ÜBER das Haus", None, None, 1), (201, None, None, "s0", None), (202, "123 !", "en", "s1", 5),
             (203, "", "de", "s1", 0), (204, "text NUMBER 41 " + "w41 " * 41, "en", "s1", 0), (None, "no id at all", "en", "s2", 1)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 160, 3)], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    return path


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, folder), name)
        kept.append(docs.collect())
        assert name == "bpe" or docs.columns == columns
    source = spark.read.parquet(f"{folder}/documents.parquet").collect()
    lettered = [r for r in source if r["text"] and any(c.isalpha() for c in r["text"])]
    assert {r["doc_id"] for r in kept[0]} == {r["doc_id"] for r in lettered}
    assert all(r["lang"] for r in kept[0])
    last = {}
    for r in lettered:
        key = r["text"].translate(LOWER)
        last[key] = max([k for k in (last.get(key), r["doc_id"]) if k is not None], default=None)
    assert Counter(r["doc_id"] for r in kept[1]) == Counter(last.values())
    rows = [r for r in kept[1] if r["doc_id"] is not None]
    smallest = {r["doc_id"]: r["doc_id"] for r in rows}
    changed = True
    while changed:
        changed = False
        for a in rows:
            for b in rows:
                x, y = shingles(a["text"]), shingles(b["text"])
                if 100 * len(x & y) >= 80 * len(x | y) and smallest[a["doc_id"]] < smallest[b["doc_id"]]:
                    smallest[b["doc_id"]], changed = smallest[a["doc_id"]], True
    assert {r["doc_id"] for r in kept[2]} == set(smallest.values()) | {None}
    assert len(kept[2]) < len(kept[1]) < len(kept[0]) < len(source)
    count = Counter(r["doc_id"] for r in kept[3])
    assert set(count) <= {r["doc_id"] for r in kept[2]} and max(count.values()) <= 2
    words = {r["doc_id"]: len(r["text"].split()) for r in kept[2]}
    assert sum(words[k] * n for k, n in count.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.1)
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in kept[2]}
    assert Counter((r["doc_id"], r["n_tokens"]) for r in kept[4]) == Counter(
        {(k, len(library.encode_ordinary(texts[k]))): n for k, n in count.items()})


def test_first_stage_without_any_language_keeps_lettered_texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bare = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    for table in (bare, docs.selectExpr("doc_id", "text", "'und' as lang", "source", "n_chars")):
        kept = corpus_pipeline.identify_language(spark, table, folder).collect()
        want = Counter(r["doc_id"] for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"]))
        assert Counter(r["doc_id"] for r in kept) == want and {r["lang"] for r in kept} == {"und"}


def test_near_stage_takes_five_words_at_point_eight(spark, folder, monkeypatch):
    seen = {}
    monkeypatch.setattr(ngram_join, "survivors", lambda docs, **options: seen.update(options) or docs)
    corpus_pipeline.drop_near_copies(spark, spark.range(1), folder)
    assert seen == {"width": 5, "percent": 80}


def test_run_on_an_empty_table(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_the_first_stage_reaches_the_token_ids(spark, folder):
    """The language it fills in stands beside the ids, and texts it rejects have none."""
    docs = spark.createDataFrame(
        [(1, "a garden", None, "s", 1), (3, "123 !", "en", "s", 1)]
        + [(k, f"the house and the garden {k}", "en", "s", 1) for k in range(10, 22)],
        "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.identify_language(spark, docs, folder)
    ids = corpus_pipeline.encode_tokens(spark, kept, folder)
    assert ids.columns == ["doc_id", *bpe.DIGEST_NAMES, "lang"]
    assert {r["doc_id"]: r["lang"] for r in ids.collect()} == {
        k: "en" for k in (1, *range(10, 22))}


def test_mixing_deals_out_texts_once(spark, folder):
    """The sums of the ranges take no text along, and the table of one row per source moves no row."""
    docs = spark.createDataFrame(
        [(k, f"word {k} " * (1 + k % 7), "en", f"s{k % 3}", 1) for k in range(200)],
        "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mixed = corpus_pipeline.mix_sources(spark, docs, folder)
        plan = mixed._jdf.queryExecution().optimizedPlan().toString()
        got = Counter(r["doc_id"] for r in mixed.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("strategy=broadcast") >= 2
    sized = mixing.with_quality(
        docs.withColumn("size", mixing.word_count("text")),
        spark.read.parquet(f"{folder}/labels.parquet"), name="weight")
    plain = mixing.mix(sized, size_col="size", quality_col="weight", content_col="text").collect()
    assert got == Counter({r["doc_id"]: r["taken"] // r["size"] for r in plain if r["taken"]})
