"""The registered queries once more in plain SQL for DuckDB.

Written from the definitions, not from the Spark plans: bigrams come from a ``lead`` window, document
counts from ``count(distinct)``, ranks from ``rank()``, and the stemmer is a chain of regular
expressions over a vowel/consonant string.
"""

from __future__ import annotations

# The suffix tables of the published stemmer, written out once more so that a slip in the
# code under test shows.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)

# The default English stop words.
DEFAULT_STOP = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she "
    "her hers herself it its itself they them their theirs themselves what which who whom this that "
    "these those am is are was were be been being have has had having do does did doing a an the and "
    "but if or because as until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again further then once here "
    "there when where why how all any both each few more most other some such no nor not only own same "
    "so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd "
    "you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've "
    "isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's "
    "when's where's who's why's would"
)

TOKEN = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"


LISTING = """
listing as (
  select doc_id as document_id, text,
    text || ' ' || source as description, lang as country, source as market,
    case when doc_id % 13 = 0 then null
         else cast(least(100, 20 + (doc_id * 7) % 101) as int) end as review_scores_rating,
    cast(n_chars % 20 as int) as number_of_reviews,
    cast(doc_id % 4 as int) as bedrooms,
    cast(20 + doc_id % 200 as double) as price,
    case doc_id % 3 when 0 then 'Entire home/apt'
                    when 1 then 'Private room' else 'Shared room' end as room_type,
    case when doc_id % 11 = 0 then null
         else cast((doc_id * 37) % 360 - 180 as double) end as longitude,
    case when doc_id % 17 = 0 then null
         else cast((doc_id * 53) % 180 - 90 as double) end as latitude
  from documents)"""

HIGH = "review_scores_rating > 99 and number_of_reviews > 5"
CHOSEN = "review_scores_rating >= 50 and country in ('en', 'de')"

WORDS = """
listed as (select unnest(['of', 'a', 'to', 'in']) as word),
afinn as (select * from (values ('scum', -4), ('idiot', -3), ('trash', -2), ('worthless', -2),
  ('pathetic', -2), ('best', 3), ('with', 1)) as t(word, value)),
bing as (select * from (values ('scum', 'negative'), ('idiot', 'negative'), ('trash', 'negative'),
  ('best', 'positive'), ('with', 'positive'), ('clown', 'negative'), ('clown', 'positive'))
  as t(word, sentiment)),
nrc as (select * from (values ('scum', 'negative'), ('scum', 'anger'), ('idiot', 'negative'),
  ('idiot', 'disgust'), ('best', 'positive'), ('best', 'joy'), ('for', 'trust'),
  ('with', 'positive'), ('moron', 'negative')) as t(word, sentiment))"""


def _with(where: str = "true", *more: str, text: str = "text") -> str:
    """The common tables over the listings that satisfy ``where``, from one of their texts."""
    tokens = f"""
token as (
  select document_id, country, unnest(range(len(t))) as pos, unnest(t) as word
  from (select document_id, country, regexp_extract_all(lower({text}), $${TOKEN}$$, 0) as t
        from listing where {where}))"""
    pairs = """
pair as (
  select document_id, country, pos, word1, word2, word1 || ' ' || word2 as bigram
  from (select document_id, country, pos, word as word1,
               lead(word) over (partition by document_id order by pos) as word2
        from token)
  where word2 is not null
    and word1 not in (select word from listed) and word2 not in (select word from listed))"""
    return "with " + ", ".join([LISTING, WORDS, tokens, pairs, *more])


COUNTED = """
counted as (select country, word1, word2, count(*) as n from pair group by all)"""
TOP15 = """
top15 as (
  select * from (
    select *, rank() over (partition by country order by n desc) as rank from counted)
  where rank <= 15)"""
COMPARED = """
score as (
  select country, 'AFINN' as method, sum(value) as sentiment
  from token join afinn using (word) group by country
  union all
  select country, 'Bing et al.', sum(case sentiment when 'positive' then 1 else -1 end)
  from token join bing using (word) where sentiment in ('positive', 'negative') group by country
  union all
  select country, 'NRC', sum(case sentiment when 'positive' then 1 else -1 end)
  from token join nrc using (word) where sentiment in ('positive', 'negative') group by country),
method as (select unnest(['AFINN', 'Bing et al.', 'NRC']) as method)"""


def _comparison(where: str, listed: str | None = None) -> str:
    """Scores over the listings that satisfy ``where``, for the markets of those in ``listed``."""
    return (
        _with(where, COMPARED)
        + f"""
select country, method, cast(coalesce(sum(sentiment), 0) as bigint) as sentiment
from (select distinct country from listing where {listed or where}) cross join method
  left join score using (country, method)
group by country, method"""
    )


def _bigram_weights(documents: str, where: str = "true") -> str:
    return (
        _with(
            where,
            """
weighed as (select country, bigram, count(*) as n from pair group by all),
total as (select country, count(distinct document_id) as documents from pair group by country)""",
        )
        + f"""
select country, bigram, n,
       round(n / {documents}, 6) as tf,
       round(ln({documents} / n), 6) as idf,
       round((n / {documents}) * ln({documents} / n), 6) as tf_idf
from weighed join total using (country)"""
    )


def _word_weights(where: str) -> str:
    return (
        _with(
            where,
            """
counted as (
  select country, word, count(*) as n from token
  where word not in (select word from listed) group by all),
total as (select country, cast(sum(n) as bigint) as total_words from counted group by country),
freq as (select word, count(*) as doc_freq from counted group by word)""",
            text="description",
        )
        + """
select country, word, n, total_words, doc_freq,
       round(n / total_words, 6) as tf,
       round(ln((select count(*) from total) / doc_freq), 6) as idf,
       round((n / total_words) * ln((select count(*) from total) / doc_freq), 6) as tf_idf
from counted join total using (country) join freq using (word)"""
    )


def _edges(where: str, more_than: int | None) -> str:
    kept = "" if more_than is None else f"where n > {more_than}"
    return (
        _with(where, COUNTED, TOP15)
        + f"""
select country, word1 as src, word2 as dst, n, round(sqrt(n), 6) as width from top15 {kept}"""
    )


def _nodes(where: str, more_than: int | None) -> str:
    kept = "" if more_than is None else f"where n > {more_than}"
    return (
        _with(where, COUNTED, TOP15)
        + f"""
select country, word1 as name from top15 {kept}
union select country, word2 from top15 {kept}"""
    )


PANEL_TF_IDF = (
    _with(
        CHOSEN,
        """
total as (select count(distinct document_id) as documents from pair),
weighed as (
  select bigram, count(*) as n, count(*) / any_value(documents) as tf,
         ln(any_value(documents) / count(*)) as idf
  from pair cross join total group by bigram)""",
    )
    + """
select bigram, n, round(tf, 6) as tf, round(idf, 6) as idf, round(tf * idf, 6) as tf_idf
from (select *, rank() over (order by tf * idf desc) as place from weighed) where place <= 10"""
)


# The stemmer: each step is one common table over (word, s), s being the word so far.


def _shape(s: str) -> str:
    return (
        f"list_reduce(string_split({s}, ''), lambda a, c: a || case when c in ('a','e','i','o','u') "
        "or (c = 'y' and right(a, 1) = 'c') then 'v' else 'c' end, '')"
    )


def _m(s: str) -> str:
    return f"len(regexp_extract_all({_shape(s)}, 'v+c+'))"


def _cut(s: str, suffix: str) -> str:
    return f"left({s}, length({s}) - {len(suffix)})"


def _short(s: str) -> str:
    return f"({_shape(s)} like '%cvc' and right({s}, 1) not in ('w', 'x', 'y'))"


def _double(s: str) -> str:
    return (
        f"(length({s}) > 1 and right({s}, 1) = left(right({s}, 2), 1) "
        f"and right({_shape(s)}, 1) = 'c')"
    )


def _longest_first(suffixes) -> list[str]:
    return sorted(suffixes, key=len, reverse=True)


def _table_step(table: dict[str, str]) -> str:
    cases = " ".join(
        f"when ends_with(s, '{x}') then case when {_m(_cut('s', x))} > 0 "
        f"then {_cut('s', x)} || '{table[x]}' else s end"
        for x in _longest_first(table)
    )
    return f"case {cases} else s end"


def _step_4() -> str:
    cases = []
    for x in _longest_first(STEP_4):
        stem = _cut("s", x)
        also = f" and right({stem}, 1) in ('s', 't')" if x == "ion" else ""
        cases.append(
            f"when ends_with(s, '{x}') then case when {_m(stem)} > 1{also} then {stem} else s end"
        )
    return "case " + " ".join(cases) + " else s end"


def _steps() -> list[str]:
    has_vowel = "contains({}, 'v')".format
    ed, ing, eed = _cut("s", "ed"), _cut("s", "ing"), _cut("s", "eed")
    tidy = f"""case
      when not cut then s
      when ends_with(s, 'at') or ends_with(s, 'bl') or ends_with(s, 'iz') then s || 'e'
      when {_double('s')} and right(s, 1) not in ('l', 's', 'z') then {_cut('s', 'x')}
      when {_m('s')} = 1 and {_short('s')} then s || 'e' else s end"""
    e = _cut("s", "e")
    return [
        f"""case when ends_with(s, 'sses') then {_cut('s', 'es')}
             when ends_with(s, 'ies') then {_cut('s', 'es')}
             when ends_with(s, 'ss') then s
             when ends_with(s, 's') then {_cut('s', 's')} else s end""",
        f"""case when ends_with(s, 'eed') then case when {_m(eed)} > 0 then {_cut('s', 'd')} else s end
             when ends_with(s, 'ed') then
               case when {has_vowel(_shape(ed))} then '>' || {ed} else s end
             when ends_with(s, 'ing') then
               case when {has_vowel(_shape(ing))} then '>' || {ing} else s end
             else s end""",
        tidy,
        f"""case when ends_with(s, 'y') and {has_vowel(_shape(_cut('s', 'y')))}
             then {_cut('s', 'y')} || 'i' else s end""",
        _table_step(STEP_2),
        _table_step(STEP_3),
        _step_4(),
        f"""case when ends_with(s, 'e') and ({_m(e)} > 1 or ({_m(e)} = 1 and not {_short(e)}))
             then {e} else s end""",
        f"""case when ends_with(s, 'll') and {_m(_cut('s', 'l'))} > 1
             then {_cut('s', 'l')} else s end""",
    ]


def _stem_tables() -> str:
    tables = ["stem0 as (select distinct word, word as s from token)"]
    for i, step in enumerate(_steps(), start=1):
        source = f"stem{i - 1}"
        if i == 3:  # the tidying applies only to words that just lost "ed" or "ing"
            source = (
                f"(select word, starts_with(s, '>') as cut, "
                f"case when starts_with(s, '>') then substr(s, 2) else s end as s from stem{i - 1})"
            )
        tables.append(f"stem{i} as materialized (select word, {step} as s from {source})")
    tables.append(f"stem as (select word, s as stem from stem{len(_steps())})")
    return ",\n".join(tables)


FOUND = f"with {LISTING} select document_id, bedrooms, price, room_type from listing where "

#: Folded texts: outside one market e and o have accents, in that market the capital I is dotless.
FOLDED = LISTING.replace(
    "doc_id as document_id, text,",
    "doc_id as document_id, case when lang = 'de' then lower(replace(text, 'I', 'ı')) "
    "else lower(replace(replace(text, 'e', 'é'), 'o', 'ö')) end as text,",
)


NESTED = (
    f"with {LISTING} select document_id, country, market, text, description, review_scores_rating, "
    "number_of_reviews, bedrooms, price, room_type from listing"
)
CLASSES = """
class as (
  select country, 'Bing et al.' as method, sentiment, count(*) as n
  from token join bing using (word) group by all
  union all
  select country, 'NRC', sentiment, count(*)
  from token join nrc using (word) where sentiment in ('positive', 'negative') group by all)"""
TOPICS = "(select cast(unnest([1, 2]) as integer) as topic)"
DEFAULT_LISTED = ", ".join("'" + w.replace("'", "''") + "'" for w in DEFAULT_STOP.split())
KEPT = "token.word not in (select word from listed)"


# Segmentation: candidate words of every distinct run, the cheapest path by a recursion over its ends
# (cost and length of the best last word in one number: cheaper first, then longer), and the way back.
LATIN, SIGNS = "abcdefghijklmnopqrstuvwxyz", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"


def _segmented() -> str:
    signs = f"translate(lower({{}}), '{LATIN}', '{SIGNS}')".format
    return f"""
with recursive {LISTING}, {WORDS.strip()},
lexeme as (
  select word, count(*) as n from (
    select unnest(regexp_extract_all({signs('text')}, $${TOKEN}$$, 0)) as word from benchmark)
  where regexp_full_match(word, '[一-鿿]+') group by word),
price as (
  select word, cast(round(ln((total + 1) / n) * 1000) as bigint) as cost
  from lexeme cross join (select sum(n) as total from lexeme)),
alone as (select cast(round(ln(sum(n) + 1) * 1000) as bigint) + 10000 as cost from lexeme),
whole as (
  select document_id, country, unnest(range(len(t))) as spot, unnest(t) as token from (
    select document_id, country, regexp_extract_all(
      regexp_replace({signs('text')}, '([一-鿿]+) ([一-鿿]+)', '\\1\\2', 'g'), $${TOKEN}$$, 0) as t
    from listing)),
part as (
  select document_id, country, spot, unnest(range(len(p))) as place, unnest(p) as run from (
    select *, regexp_extract_all(token, '[一-鿿]+|[^一-鿿]+') as p from whole)),
run as (select distinct run from part where regexp_matches(run, '^[一-鿿]')),
edge as materialized (
  select run, e, l, case when l = 1 then least(coalesce(price.cost, alone.cost), alone.cost)
                         else price.cost end as cost
  from (select run, unnest(range(1, length(run) + 1)) as e from run)
    cross join (select unnest(range(1, (select max(length(word)) from price) + 1)) as l)
    cross join alone left join price on price.word = substr(run, e - l + 1, l)
  where l <= e and (l = 1 or price.cost is not null)),
best as (
  select run, cast(0 as bigint) as e, [cast(0 as bigint)] as costs, [cast(0 as bigint)] as sizes from run
  union all
  select b.run, b.e + 1, list_append(any_value(b.costs), min((b.costs[b.e + 2 - l] + cost) * 64 + 63 - l) // 64),
    list_append(any_value(b.sizes), 63 - min((b.costs[b.e + 2 - l] + cost) * 64 + 63 - l) % 64)
  from best b join edge on edge.run = b.run and edge.e = b.e + 1 group by b.run, b.e),
cut as (
  select run, sizes, cast(length(run) as bigint) as e from best where e = length(run)
  union all
  select run, sizes, e - sizes[e + 1] from cut where e - sizes[e + 1] > 0),
piece as (select run, e, substr(run, e - sizes[e + 1] + 1, sizes[e + 1]) as word from cut),
token as (
  select document_id, country,
    row_number() over (partition by document_id order by spot, place, e) as pos,
    coalesce(word, part.run) as word
  from part left join piece on piece.run = part.run)"""


SEGMENTED_COUNTS = _segmented() + " select country, word, count(*) as n from token group by all"
SEGMENTED_TOP15 = (
    _segmented()
    + """
, pair as (
  select country, word1, word2 from (
    select country, word as word1, lead(word) over (partition by document_id order by pos) as word2
    from token)
  where word2 is not null
    and word1 not in (select word from listed) and word2 not in (select word from listed)),"""
    + COUNTED.strip() + "," + TOP15.strip() + " select country, word1, word2, n, rank from top15"
)

_PANEL_BIGRAMS = (
    _with(
        CHOSEN, "counted as (select word1, word2, count(*) as n from pair group by all)"
    )
    + " select word1 as src, word2 as dst, n, round(sqrt(n), 6) as width from"
    " (select *, rank() over (order by n desc) as place from counted) where place <= 15"
)
_PANEL_SENTIMENT = (
    _with(CHOSEN, COMPARED)
    + " select method, cast(coalesce(sum(sentiment), 0) as bigint) as sentiment"
    " from method left join score using (method) group by method"
)

ORACLES: dict[str, str] = {
    "listings_flat": f"with {LISTING} select document_id, country, market, text, "
    "review_scores_rating from listing",
    "rated_texts": f"with {LISTING} select document_id, country, review_scores_rating as success, "
    "text, number_of_reviews from listing",
    "country_counts": f'with {LISTING} select country, count(*) as "count" from listing '
    "group by country",
    "market_slice": f"with {LISTING} select document_id, country, text, review_scores_rating "
    "from listing where country = 'de'",
    "find_bedrooms_price": f"with {LISTING} select document_id, bedrooms, price, room_type "
    "from listing where bedrooms = 2 and price > 50",
    "avg_price_by_room_type": f"with {LISTING} select room_type, round(avg(price), 6) as avg_price "
    "from listing group by room_type",
    "high_rated": f"with {LISTING} select document_id, country, review_scores_rating, "
    f"number_of_reviews from listing where {HIGH}",
    "document_ids": f"with {LISTING} select document_id as id, "
    "row_number() over (order by document_id) as document_id from listing",
    "document_ids_text_key": f"with {LISTING}, keyed as (select market || '/' || document_id as key "
    "from listing) select key, row_number() over (order by key nulls first) as document_id from keyed",
    "document_ids_hot_key": f"with {LISTING}, keyed as (select nullif(country, 'de') as key, "
    "document_id as id from listing) select key, id, "
    "row_number() over (order by key nulls first, id) as document_id from keyed",
    "listings_numbered": f"with {LISTING} select row_number() over (order by document_id) as "
    "document_id, country, market, description from listing",
    "map_points": f"with {LISTING} select document_id, longitude, latitude from listing "
    "where country = 'en' and longitude is not null and latitude is not null",
    "word_counts_by_country": _with(text="description")
    + " select country, word, count(*) as n from token group by all",
    "word_counts_no_stopwords": _with(text="description")
    + f" select country, word, count(*) as n from token where {KEPT} group by all",
    "word_tf_idf": _word_weights("true"),
    "word_tf_idf_one_country": _word_weights("country = 'de'"),
    "nrc_by_country": _with(text="description")
    + " select country, sentiment, count(*) as n from (select distinct country, word from token)"
    " join nrc using (word) group by all",
    "bing_by_country": _with(text="description")
    + " select country, sentiment, count(*) as n from (select distinct country, word from token)"
    " join bing using (word) group by all",
    "bing_occurrences": _with(text="description")
    + " select country, sentiment, count(*) as n from token join bing using (word) group by all",
    "afinn_by_country": _with(text="description")
    + " select country, cast(sum(value) as bigint) as total_afinn_score, sum(value) > 0 as"
    " is_positive from (select distinct country, word from token) join afinn using (word)"
    " group by country",
    "afinn_occurrences": _with(text="description")
    + " select country, cast(sum(value) as bigint) as total_afinn_score, sum(value) > 0 as"
    " is_positive from token join afinn using (word) group by country",
    "mostly_used_words": _with()
    + " select country, word, count(*) as n from token join afinn using (word) group by all",
    "polarity_table": _with()
    + """
, hit as (
  select country, 'Bing et al.' as method, sentiment from token join bing using (word)
  union all select country, 'NRC', sentiment from token join nrc using (word))
select country, method,
  count(sentiment) filter (sentiment = 'negative') as negative,
  count(sentiment) filter (sentiment = 'positive') as positive,
  count(sentiment) filter (sentiment = 'positive')
    - count(sentiment) filter (sentiment = 'negative') as sentiment_score
from (select distinct country from listing)
  cross join (select unnest(['Bing et al.', 'NRC']) as method)
  left join hit using (country, method)
group by country, method""",
    "sentiment_comparison": _comparison("true"),
    "high_rated_sentiment": _comparison(HIGH, "true"),
    "bigrams": _with() + " select document_id, country, word1, word2, bigram from pair",
    "bigram_split": _with()
    + " select document_id, bigram, split_part(bigram, ' ', 1) as word1,"
    " split_part(bigram, ' ', 2) as word2 from pair",
    "bigram_top15": _with("true", COUNTED, TOP15)
    + " select country, word1, word2, n, rank from top15",
    "bigram_edges": _edges("true", 15),
    "bigram_nodes": _nodes("true", 15),
    "total_documents": _with()
    + " select country, count(distinct document_id) as total_documents from pair group by country",
    "bigram_tf_idf": _bigram_weights("documents"),
    "bigram_tf_idf_pinned_n": _bigram_weights("145"),
    "bigram_tf_idf_pinned_market": _bigram_weights(
        "(select documents from total where country = 'de')"
    ),
    "bigram_tf_idf_sorted": _bigram_weights("documents", "country = 'de'")
    + " order by (n / documents) * ln(documents / n) desc, bigram",
    "high_rated_bigram_top15": _with(HIGH, COUNTED, TOP15)
    + " select country, word1, word2, n, rank from top15",
    "high_rated_bigram_edges": _edges(HIGH, None),
    "high_rated_bigram_nodes": _nodes(HIGH, None),
    "unstemmed_doc_terms": _with()
    + f" select document_id, country, word, count(*) as n from token where {KEPT} group by all",
    "processed_descriptions_unstemmed": _with()
    + " select document_id, country, string_agg(word, ' ' order by pos) as text from token"
    f" where {KEPT} group by document_id, country",
    "vocabulary_stems": _with("true", _stem_tables()) + " select word, stem from stem",
    "stemmed_doc_terms": _with("true", _stem_tables())
    + " select document_id, country, stem as word, count(*) as n"
    f" from token join stem using (word) where {KEPT} group by all",
    "processed_descriptions": _with("true", _stem_tables())
    + " select document_id, country, string_agg(stem, ' ' order by pos) as text"
    f" from token join stem using (word) where {KEPT} group by document_id, country",
    "panel_bigrams": _PANEL_BIGRAMS,
    "panel_sentiment": _PANEL_SENTIMENT,
    "panel_tf_idf_top10": PANEL_TF_IDF,
    "panel_map": f"with {LISTING} select longitude, latitude from listing where {CHOSEN}"
    " and number_of_reviews > 2 and text is not null"
    " and longitude is not null and latitude is not null",
    "listings_json_round_trip": NESTED,
    "listings_parquet_round_trip": NESTED,
    "word_counts_default_stopwords": _with(text="description")
    + f" select country, word, count(*) as n from token where word not in ({DEFAULT_LISTED})"
    " group by all",
    "sentiment_from_tables": _comparison("true"),
    "slice_class_counts": _with("true", CLASSES) + " select * from class",
    "bigrams_long_stop_list": _with()
    + " select document_id, country, cast(row_number() over (partition by document_id order by pos)"
    " - 1 as integer) as place, word1, word2, bigram from pair",
    "doc_terms_long_stop_list": _with()
    + f" select document_id, country, word, count(*) as n from token where {KEPT} group by all",
    "document_term_matrix": _with("true", _stem_tables())
    + " select document_id, stem as term, count(*) as n from token join stem using (word)"
    f" where {KEPT} and length(stem) >= 3 group by all",
    "topic_vocabulary": _with("country = 'de'", _stem_tables())
    + f" select distinct topic, stem as term from token join stem using (word) cross join {TOPICS}"
    f" where {KEPT} and length(stem) >= 3",
    "topic_totals": _with("country = 'de'", _stem_tables())
    + " select topic, count(distinct stem) as terms, cast(1 as double) as beta_sum"
    f" from token join stem using (word) cross join {TOPICS}"
    f" where {KEPT} and length(stem) >= 3 group by topic",
    "saved_tables": _with("country = 'de'", CLASSES, COMPARED, _stem_tables())
    + f"""
, term as (select document_id, stem, count(*) as n from token join stem using (word)
           where {KEPT} group by all),
kept as (select distinct document_id from term)
select 'tokens' as name, count(*) as rows, cast(sum(document_id) as bigint) as total from listing
union all select 'market_words', count(*), cast(sum(pos) as bigint) from token
union all select 'market_bing', count(*), cast(sum(n) as bigint) from class where method = 'Bing et al.'
union all select 'market_nrc', count(*), cast(sum(n) as bigint) from class where method = 'NRC'
union all select 'market_bigrams', count(*), cast(sum(document_id) as bigint) from pair
union all select 'market_bigram_tf_idf', count(distinct bigram), count(*) from pair
union all select 'total_documents', 1, count(distinct document_id) from pair
union all select 'processed_words', count(*), cast(sum(document_id) as bigint) from kept
union all select 'doc_terms', count(*), cast(sum(n) as bigint) from term
union all select 'processed_texts', count(*), cast(sum(document_id) as bigint) from kept
union all select 'listings', count(*), cast(sum(number_of_reviews) as bigint) from listing
union all select 'descriptions', count(*), cast(sum(document_id) as bigint) from listing
union all select 'market_polarity', 2,
  (select count(*) from token join bing using (word) where sentiment = 'positive')
  + (select count(*) from token join nrc using (word) where sentiment = 'positive')
union all select 'market_comparison', 3, cast(sum(sentiment) as bigint) from score
union all select 'afinn', count(*), cast(sum(value) as bigint) from afinn
union all select 'bing', count(*), cast(sum(length(word)) as bigint) from bing
union all select 'nrc', count(*), cast(sum(length(word)) as bigint) from nrc
union all select 'top_terms', 20, 30
union all select 'topic_model', 2, count(distinct stem) from token join stem using (word)
  where {KEPT} and length(stem) >= 3""",
    "topic_panel_labels": _with("country in ('de', 'fr')")
    + f""", used as (
  select country, count(distinct substr(word, 1, 1)) as initials from token where {KEPT} group by all)
select cast(row_number() over () as varchar) as topic_label, least(initials, 5) as terms,
  cast(1 as bigint) as markets from used""",
    "topic_leaders": _with("country in ('de', 'fr')")
    + f""", counted as (
  select country, country || '_' || substr(word, 1, 1) as term, count(*) as n from token
  where {KEPT} group by all)
select * from (
  select country, term, rank() over (partition by country order by n desc) as place from counted)
where place <= 5""",
    "segmented_word_counts": SEGMENTED_COUNTS,
    "segmented_word_counts_by_join": SEGMENTED_COUNTS,
    "segmented_bigram_top15": SEGMENTED_TOP15,
    "panel_bigrams_from_sums": _PANEL_BIGRAMS,
    "panel_sentiment_from_sums": _PANEL_SENTIMENT,
    "panel_tf_idf_from_sums": PANEL_TF_IDF,
    "find_by_document": FOUND + "bedrooms = 2 and price > 50",
    "find_any_of": FOUND + "bedrooms in (0, 3) or price between 100 and 139.99",
    "find_missing_rating": FOUND + "review_scores_rating is null",
    "find_none_of": FOUND + "country is distinct from 'de' and country is distinct from 'fr'"
    " and not starts_with(room_type, 'Private') and coalesce(review_scores_rating, 60) >= 60"
    " and bedrooms <> 1",
    "aggregate_by_document": f"with {LISTING} select room_type as _id,"
    " round(avg(price), 6) as avg_price from listing group by room_type",
    "aggregate_markets": f"with {LISTING} select country, room_type, count(*) as listings,"
    " cast(coalesce(sum(number_of_reviews), 0) as bigint) as reviews, min(price) as cheapest,"
    " max(price) as dearest from listing where price > 50 group by country, room_type"
    " having count(*) >= 2",
    "aggregate_leading": f"with {LISTING} select country, count(*) as listings from listing"
    " group by country order by listings desc, country nulls first limit 3",
    "aggregate_count": f"with {LISTING} select count(country) as listings from listing",
    "listings_checked": f"with {LISTING} select document_id, country, market, text,"
    " review_scores_rating, price, room_type from listing"
    " where country is distinct from 'de' and room_type <> 'Shared room'",
    "listings_rejected": f"with {LISTING} select document_id,"
    " case when country = 'de' then 'malformed' else 'price' end as reason from listing"
    " where country = 'de' or room_type = 'Shared room'",
    "lexicon_rejected": _with()
    + " select distinct word, case when length(word) = 2 then 'no value' else 'value is no int' end"
    " as reason from token where length(word) = 2 or length(word) > 8",
    "folded_word_counts": _with().replace(LISTING, FOLDED)
    + " select country, word, count(*) as n from token group by all",
    "folded_score_totals": _with().replace(LISTING, FOLDED)
    + ", folded as (select word, value from afinn union"
    " select replace(word, 'o', 'ö'), value from afinn)"
    " select country, cast(sum(value) as bigint) as total_afinn_score, sum(value) > 0 as"
    " is_positive from token join folded using (word) group by country",
    "published_tables": _bigram_weights("documents", "country = 'de'"),
    "artifact_round_trip": PANEL_TF_IDF,
    "batch_tables": _bigram_weights("documents", "country = 'de'"),
}
