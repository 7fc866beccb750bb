"""Language ID, quality, BPE and HTML extraction on edge rows, against brute force or held-out rows."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgelex.llm import bpe, html_extraction, language_id, quality

SCHEMA = "doc_id long, text string, lang string, score double, row string, raw string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = {
    "en": "the of and house with thing water there should", "de": "der die und haus mit wasser ding dort soll",
    "fr": "le la et maison avec chose eau être là", "es": "el los y casa con cosa agua allí ser",
}


def made(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(list(WORDS))
        words = [draw.choice(WORDS[lang].split()) for _ in range(draw.randint(8, 60))]
        rows.append((i, " ".join(words), lang, None, "x", "y"))
    return rows


ODD = [
    (None, None, None, None, None, None), (900, "", "en", None, None, None),
    (901, "12 34 !!", "en", None, None, None), (902, "the " * 60_000, "en", 1.0, "r", "s"),
    (903, "der und haus", None, None, None, None), (903, "der und haus", None, None, None, None),
    (904, "é", "fr", None, None, None), (905, " \n\t", None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(600) + ODD, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def languages(docs):
    return language_id.fit(docs)


def test_language_held_out_accuracy(docs, languages):
    got = language_id.identify(docs.where("doc_id < 600 and crc32(cast(string(doc_id) as binary)) % 3 = 1"), languages)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_rows(spark, docs, languages):
    got = language_id.identify(docs.where("doc_id is null or doc_id >= 900"), languages).collect()
    assert len(got) == len(ODD)
    by_id = {r["doc_id"]: r for r in got}
    for key in (None, 900, 901, 905):
        assert (by_id[key]["lang_pred"], by_id[key]["score"]) == ("und", 0.0)
    assert by_id[902]["lang_pred"] == "en" and by_id[903]["lang_pred"] == "de"
    kept = language_id.accepted(docs, languages)
    assert kept.columns == docs.columns and kept.count() == 600 + 4
    assert {r["lang"] for r in kept.where("doc_id = 903").collect()} == {"de"}


def test_labelled_texts_are_identified_too(spark, languages):
    """A label that the text contradicts gives way; one of a language that was not learnt stays."""
    german = "der die und haus mit wasser ding dort soll " * 4
    rows = [(1, german, "de"), (2, german, "en"), (3, german, "xx"), (4, german, None), (5, "12 34", "en"),
            (6, None, "en"), (7, german * 2000, "fr"), (2, german, "en"), (None, german, "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((r["doc_id"] or 0, r["lang"]) for r in language_id.accepted(docs, languages).collect())
    assert got == [(0, "de"), (1, "de"), (2, "de"), (2, "de"), (3, "xx"), (4, "de"), (7, "de")]
    bare = sorted((r["doc_id"] or 0, r["lang"]) for r in language_id.accepted(docs, None).collect())
    assert bare == [(0, "es"), (1, "de"), (2, "en"), (2, "en"), (3, "xx"), (4, "und"), (7, "fr")]


def test_a_label_stays_where_the_machines_are_unsure(spark, languages, monkeypatch):
    monkeypatch.setattr(language_id, "SURE", 1.0)
    docs = spark.createDataFrame([(1, "der die und haus", "en")], "doc_id long, text string, lang string")
    assert [r["lang"] for r in language_id.accepted(docs, languages).collect()] == ["en"]


def test_language_is_a_function_of_the_text(spark, docs, languages):
    shuffled = docs.selectExpr("-doc_id as doc_id", "text", "'xx' as lang")
    a = sorted((r["lang_pred"], r["score"]) for r in language_id.identify(docs, languages).collect())
    b = sorted((r["lang_pred"], r["score"]) for r in language_id.identify(shuffled, languages).collect())
    assert a == b


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert language_id.fit(empty) is None and quality.fit(empty, labels) is None
    assert language_id.identify(empty, None).collect() == []
    assert quality.score(empty, None).collect() == []
    one = spark.createDataFrame([(0, "hello there", "en")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language_id.identify(one, None).collect()] == ["und"]
    assert [r["score"] for r in quality.score(one, None).collect()] == [0.5]


def test_single_language(spark):
    rows = [(i, "the house and water", "en") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.identify(df, language_id.fit(df)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("en", 1.0)}


def test_quality_held_out(spark):
    draw = random.Random(2)
    rows, marks = [], []
    for i in range(800):
        words = [draw.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(60)]
        good = draw.random() < 0.7
        rows.append((i, " ".join(w if good else w.upper() + draw.choice(["!!", "###"]) for w in words)))
        marks.append((i, int(good), 0))
    rows += [(1000, None), (1001, ""), (None, "alpha"), (1002, "alpha beta " * 20_000)]
    marks += [(0, marks[0][1], 0), (None, 1, 0), (5000, 1, 1), (3, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    truth = dict((k, q) for k, q, _ in marks[:800])
    held = [r for r in got if r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_quality_with_one_class_only():
    model = quality.from_sample([(1, b"some text"), (1, b"other text")])
    assert model.slope == 0.0 and 0 < model.prior < 1


@pytest.fixture(scope="module")
def reference():
    tokens = bpe.read_ranks(RANKS)
    ranks = {t: i for i, t in enumerate(tokens)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(RANKS))


SIGNS = st.text(
    st.sampled_from(list("abcXYZ'stremvld  \n\t.,!-12²éß日😀　\xa0")) | st.characters(exclude_categories=["Cs"]),
    max_size=40,
)


@settings(max_examples=300, deadline=None)
@given(st.lists(SIGNS, min_size=1, max_size=4))
def test_bpe_matches_the_library(vocabulary, reference, texts):
    got = [ids.tolist() for ids in bpe.encode_texts(vocabulary, texts)]
    assert got == [reference.encode_ordinary(t) for t in texts]
    for text, ids in zip(texts, got, strict=True):
        assert b"".join(map(vocabulary.tokens.__getitem__, ids)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(SIGNS.filter(bool), st.integers(3, 9), st.integers(6, 9))
def test_stitched_chunks_agree(text, chunk, overlap):
    text = text * 4
    whole = bpe.piece_starts(bpe.code_points(text), [0]).tolist()
    starts = list(range(0, len(text), chunk))
    own = []
    for s in starts:
        part = text[s : s + chunk + overlap]
        last = s + chunk + overlap >= len(text)
        own.append(bpe.sure_starts(bpe.piece_starts(bpe.code_points(part), [0]), len(part), last) + s)
    assert bpe.stitch(text, starts, own).tolist() == whole


def test_bpe_rows(spark, reference):
    long = "".join(random.Random(4).choice(["word ", "x", "\n\n ", "don't ", "日本", "é1 "]) for _ in range(3000))
    texts = [None, "", "one", "one", "Don't stop  now\n", long, "a" * 700, long[:130], " " * 300 + "x"]
    rows = [(None if i == 3 else i, t, "q") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = {r["doc_id"]: r for r in bpe.encode(df, RANKS, chunk=100, overlap=40, with_ids=True, carry=("ids",)).collect()}
    assert len(got) == len(rows)
    for key, text, _ in rows:
        ids = reference.encode_ordinary(text or "")
        r = got[key]
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids) and r["row"]["ids"] == "q"
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode(df.limit(0), RANKS).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav>
<div class="cookie-notice">We use cookies</div><aside>Side</aside>%s
<section id="comments"><p>First!</p></section><form><p>Mail <input name="x"></p></form>
<!-- ad --><div class="ad">Buy</div><footer>&copy; all</footer></body></html>"""


@pytest.mark.parametrize("body, text", [
    ("<article><header><h2>Head</h2></header><p>One &amp; two<br>three</article>", "Head\nOne & two three"),
    ("<article><h1>A</h1><p><b>Bold.<br><p>Next\n  line</p><div class='share'>Tweet</div></article>", "A\nBold.\nNext line"),
    ("<main><p>In <i>ma</i>in</p><ul><li>x<li>y</ul></main>", "In main\nx\ny"),
    ("<div class='content'><p>Plain body</p>tail</div>", "Plain body\ntail"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><p hidden>no</p>&lt;p&gt; &#233;&nbsp;z</article>", "a\nb\nc\n<p> é z"),
    ("<article></article>", ""),
])
def test_extraction_of_one_page(body, text):
    assert html_extraction.extract(PAGE % body, {}) == text


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "</p></b>", "<a title=\"x", "a<b", "<script>x", "&#x110000;"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_extraction.extract(page, {}), str)


def test_template_text_goes(spark):
    """Lines that most pages of a host share are furniture even without a telling element."""
    rows = [(i, f"http://H.example/{i}", f"<body><p>Welcome to us</p><p>Story {i}</p><p>Imprint</p></body>") for i in range(8)]
    rows += [(20, "http://solo.example/", "<body><p>Welcome to us</p></body>"), (21, None, None), (None, "x", ""),
             (22, "http://h.example/22", "<body><p>" + "long " * 50_000 + "</p></body>"), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({})
    got = html_extraction.main_text(df.selectExpr("*", "'c' as text", "1 as host", "2 as template")).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    assert [by_id[i]["text"] for i in range(8)] == [f"Story {i}" for i in range(8)]
    assert by_id[20]["text"] == "Welcome to us" and by_id[21]["text"] == "" and by_id[None]["n_chars"] == 0
    assert by_id[22]["n_chars"] == 50_000 * 5 - 1
    assert html_extraction.main_text(df.limit(0)).collect() == []


def test_long_texts_do_not_end_the_samples(spark):
    rows = made(300)
    first = "crc32(cast(string(doc_id) as binary))"
    df = spark.createDataFrame(rows, SCHEMA)
    # The first drawn texts of one language, and of one class, are longer than the whole budget.
    low = df.where(f"lang = 'de' and {first} % 3 != 1").orderBy("doc_id").limit(40).select("doc_id")
    lows = [r["doc_id"] for r in low.collect()]
    long = df.selectExpr(
        "doc_id", f"case when doc_id in ({','.join(map(str, lows))}) then repeat(concat(text, ' '), 2000) else text end as text",
        "lang")
    model = language_id.fit(long, sample_bytes=200_000)
    assert sorted(sum(model.families.values(), [])) == sorted(WORDS)
    got = language_id.identify(long, model).join(long.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    labels = spark.createDataFrame([(r[0], int(r[2] in ("en", "de")), 0) for r in rows], "doc_id long, quality int, toxic int")
    assert quality.fit(long, labels, sample_bytes=200_000).slope != 0
    # Labels without documents take no draws.
    absent = spark.range(10_000, 12_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    a, b = (quality.fit(df, t, per_class=20) for t in (labels, labels.unionByName(absent)))
    assert (a.good, a.bad, a.slope, a.prior) == (b.good, b.bad, b.slope, b.prior)


def texts_of(spark, bodies):
    """Main text of each page of one host."""
    rows = [(i, "http://h.example/", f"<body>{body}</body>") for i, body in enumerate(bodies)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r["page_id"]: r["text"] for r in html_extraction.main_text(df).collect()}
    return [found[i] for i in range(len(bodies))]


@pytest.mark.parametrize("layout", ["<main>%s</main>", "<div class='content'>%s</div>"])
def test_copies_keep_their_main_text(spark, layout):
    copy = layout % "<h1>Head</h1><p>One.</p><p>Two.</p>"
    others = [layout % f"<h1>Head {i}</h1><p>Story {i}</p>" for i in range(3)]
    kept = ["Head 0\nStory 0", "Head 1\nStory 1", "Head 2\nStory 2"]
    assert texts_of(spark, [copy] * 4) == ["Head\nOne.\nTwo."] * 4
    assert texts_of(spark, [copy] * 4 + others) == ["Head\nOne.\nTwo."] * 4 + kept
    # Copies but for a comment are pages of their own with nothing else in their slots.
    marked = [f"{copy}<!-- {i} -->" for i in range(4)]
    assert texts_of(spark, marked) == ["Head\nOne.\nTwo."] * 4


def test_copies_in_main_keep_their_text_beside_other_slots(spark):
    beside = [f"<main><p>One.</p><p>Two.</p></main><p>Visit {i}</p>" for i in range(4)]
    assert all("One.\nTwo." in text for text in texts_of(spark, beside))


def test_shared_passage_stays_and_furniture_goes(spark):
    bodies = [f"<main><p>Welcome</p><p>Story {i}</p>{'<p>Passage.</p>' * (i < 3)}</main>" for i in range(5)]
    bodies += bodies[:1] * 5
    want = [f"Story {i}" + "\nPassage." * (i < 3) for i in range(5)]
    assert texts_of(spark, bodies) == want + want[:1] * 5


def test_classes_of_a_page_nest():
    items = html_extraction.tokens("<body><ul><li>a</li><li>b</li></ul><p>x</p></body>")
    codes = [i.code for i in items]
    template = {c: 1 for c in codes if codes.count(c) == 1} | {c: 2 for c in codes if codes.count(c) == 2}
    classes = html_extraction.classes_on(items, template)
    assert 1 in classes and 2 in classes
    crossed = {c: (3 if n % 2 else 4) for n, c in enumerate(dict.fromkeys(codes))}
    assert len(set(html_extraction.classes_on(items, crossed)) - {0}) <= 1
