"""The dealt operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lodgelex.llm import (
    bpe,
    centroid_clustering,
    decontamination,
    exact_dedup,
    html_extraction,
    language_id,
    mixing,
    ngram_join,
    quality,
    topk_search,
    url_filter,
    warc,
    whitening,
)
from lodgelex.llm.common import crc_mod, table


def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.withColumn("held_out", crc_mod("doc_id", 3) == 1)


def op2_mixing(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", mixing.word_count("text").alias("size"), F.xxhash64("text").alias("content")
    )
    weighed = mixing.with_quality(docs, table(spark, folder, "labels"))
    return mixing.mix(
        weighed, size_col="size", quality_col="quality_weight", content_col="content"
    ).drop("source")


def op3_html_extraction(spark, folder):
    return html_extraction.main_text(table(spark, folder, "pages"))


def op4_ngram_jaccard(spark, folder):
    return ngram_join.linked_components(table(spark, folder, "documents"))


def op5_topk_search(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return topk_search.search(vectors, F.col("vec_id") % 20 == 0)


TOPK_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
) where rank <= 20
"""


def op6_warc(spark, folder):
    back = warc.round_trip(table(spark, folder, "pages"))
    return back.select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"
    )


URL_RULES = [
    url_filter.rule("allow", "com/"),
    url_filter.rule("block", "example.com/en/"),
    url_filter.rule("allow", "www.example.com/en/"),
    url_filter.rule("block", "net/es/"),
    url_filter.rule("block", "net/fr/"),
]


#: SHA-1 in base 32: five bits at a time from the 40 hexadecimal digits.
WARC_SQL = """
with p as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages
), d as (
  select page_id, octet_length(encode(body)) as payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
      (((instr('0123456789abcdef', substr(h || '0', 1 + ((5 * i) // 4), 1)) - 1) * 16
        + instr('0123456789abcdef', substr(h || '0', 2 + ((5 * i) // 4), 1)) - 1) >> (3 - ((5 * i) % 4))) & 31
      as bigint), 1)), '') as payload_digest
  from p
), g as (select payload_digest, min(page_id) as first_id from d group by payload_digest)
select d.page_id, d.payload_bytes, d.payload_digest,
  case when d.page_id = g.first_id then 'response' else 'revisit' end as record_type,
  case when d.page_id = g.first_id then null else g.first_id end as refers_to
from d join g using (payload_digest)
"""


def op7_url_filter(spark, folder):
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


def op8_quality(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = quality.score(docs, quality.fit(docs, labels))
    return found.withColumn("held_out", crc_mod("doc_id", 5) == 0)


def op9_bpe(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(table(spark, folder, "documents"), ranks)


def op10_exact_dedup(spark, folder):
    return exact_dedup.deduplicate(table(spark, folder, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT_DEDUP_SQL = f"""
with d as (
  select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents
), g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
from d join g on d.t = g.t
"""


def op11_decontamination(spark, folder):
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.report(docs, items).drop("longest_match")


#: Words and windows joined as lists of words; nothing is streamed.
DECONTAMINATION_SQL = f"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, list_slice(w, s + 1, s + least(10, len(w))) as g
  from (select item_id, w, unnest(range(greatest(len(w) - 9, 1))) as s from i where len(w) > 0)
), sizes as (select distinct len(g) as n from windows
), grams as (
  select doc_id, s, n, list_slice(w, s + 1, s + n) as g
  from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as s from d, sizes where len(w) >= n)
), found as (
  select doc_id, s, n, item_id from grams join windows using (g)
), hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(s, s + n)) as p from (select distinct doc_id, s, n from found))
  group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from found where item_id is not null)
  group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join named using (doc_id)
"""


def op12_whitening(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op13_centroid_clustering(spark, folder):
    return centroid_clustering.cluster(table(spark, folder, "embeddings"))


def _clustering_sql() -> str:
    """All rounds written out: every vector against every centroid."""

    def assigned(k: int) -> str:
        return f"""
a{k} as materialized (
  select vec_id, v, number, distance from (
    select v.vec_id, v.v, c.number, list_sum(list_transform(list_zip(v.v, c.v),
        lambda x: (x[1] - x[2]) * (x[1] - x[2]))) as distance,
      row_number() over (partition by v.row order by list_sum(list_transform(list_zip(v.v, c.v),
        lambda x: (x[1] - x[2]) * (x[1] - x[2]))), c.number) as near
    from v, c{k} c) where near = 1)"""

    def centred(k: int) -> str:
        return f"""
m{k} as (
  select number, place, sum(x) as s, count(*) as n
  from (select number, unnest(v) as x, unnest(range(64)) as place from a{k}) group by number, place),
c{k + 1} as materialized (
  select c.number, coalesce(f.v, c.v) as v from c{k} c left join (
    select number, list(cast((s - ((s % n) + n) % n) // n as bigint) order by place) as v
    from m{k} group by number) f using (number))"""

    rounds = ",".join(f"{assigned(k)},{centred(k)}" for k in range(10))
    return f"""
with v as materialized (
  select row_number() over () as row, vec_id,
    list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by key, v) - 1 as number, v
  from (select sha256('3:' || cast(vec_id as varchar)) as key, v from v where vec_id is not null
        order by key, v limit 8)),
{rounds},{assigned(10)}
select vec_id, cast(a.number as integer) as cluster, cast(distance as bigint) as distance,
  cast(sum(distance) over (partition by a.number) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia,
  sha256(array_to_string(c.v, ',')) as centroid_sha256
from a10 a join c10 c using (number)
"""


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_mixing": op2_mixing,
    "op3_html_extraction": op3_html_extraction,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_topk_search": op5_topk_search,
    "op6_warc": op6_warc,
    "op7_url_filter": op7_url_filter,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_decontamination": op11_decontamination,
    "op12_whitening": op12_whitening,
    "op13_centroid_clustering": op13_centroid_clustering,
}

ORACLES = {
    "op6_warc": WARC_SQL,
    "op5_topk_search": TOPK_SQL,
    "op10_exact_dedup": EXACT_DEDUP_SQL,
    "op11_decontamination": DECONTAMINATION_SQL,
    "op13_centroid_clustering": _clustering_sql(),
}
