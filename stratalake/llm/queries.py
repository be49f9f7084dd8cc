"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    bpe,
    decontaminate,
    divergence,
    exact_dedup,
    interaction,
    langid,
    ngram_join,
    pii,
    quality,
    token_counts,
    toxicity,
    url_filters,
    warc,
)
from stratalake.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "evidence",
    )


_B = "[\\t\\n\\x0B\\f\\r ]"


def _sql_text(html: str) -> str:
    """The same rules as regular expressions of the checking engine."""
    c = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for tag in warc.HIDDEN:
        c = f"regexp_replace({c}, '(?is)<{tag}(?:{_B}[^>]*)?>.*?</{tag}{_B}*>', '', 'g')"
    c = f"regexp_replace({c}, '(?i)</?(?:{warc.BREAKS})(?:{_B}[^>]*|/)?>', chr(10), 'g')"
    c = _sql_unescape(f"regexp_replace({c}, '<[A-Za-z/!?][^>]*>', '', 'g')")
    c = f"regexp_replace({c}, '[\\t\\x0B\\f\\r ]+', ' ', 'g')"
    c = f"regexp_replace({c}, ' ?\\n[\\n ]*', chr(10), 'g')"
    return f"regexp_replace({c}, '^[\\n ]+|[\\n ]+$', '', 'g')"


def _sql_unescape(c: str) -> str:
    """Split at ampersands like the operator, with the checking engine's own functions."""
    names = ", ".join("'" + n + "'" for n in warc.NAMED)
    values = ", ".join("chr(" + str(ord(v)) + ")" for v in warc.NAMED.values())
    name = "split_part(x, ';', 1)"
    decimal = f"case when regexp_full_match({name}, '#[0-9]{{1,7}}') then substr({name}, 2)::int end"
    hexadecimal = f"case when regexp_full_match({name}, '#[xX][0-9A-Fa-f]{{1,6}}') then ('0x' || substr({name}, 3))::int end"
    code = f"coalesce({decimal}, {hexadecimal})"
    valid = f"({code} between 1 and 55295 or {code} between 57344 and 1114111)"
    char = f"case when contains(x, ';') then case when {valid} then chr({code}) else map([{names}], [{values}])[{name}] end end"
    piece = f"coalesce({char} || substr(x, strlen({name}) + 2), '&' || x)"
    return f"(select string_split(s, '&')[1] || array_to_string(list_transform(string_split(s, '&')[2:], lambda x: {piece}), '') from (select {c} as s))"


def _sql_uuid(text: str) -> str:
    h = f"sha256({text})"
    cut = ", ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12)))
    return "'<urn:uuid:' || format('{}-{}-8{}-a{}-{}', " + cut + ") || '>'"


@query(f"""
with p as (
  select page_id, coalesce(url, '') as u, coalesce(html, '') as h,
         {_sql_uuid("concat_ws(chr(10), 'response', coalesce(page_id::varchar, ''), coalesce(url, ''))")} as rid
  from pages),
w as (
  select page_id, rid, u, h, strlen(h)::varchar as n, {_sql_text("h")} as txt,
         trim(regexp_replace({_sql_unescape(f"regexp_extract(h, '(?is)<title(?:{_B}[^>]*)?>(.*?)</title', 1)")}, '{_B}+', ' ', 'g')) as title,
         regexp_extract_all(h, '(?i)<a{_B}(?:[^>]*{_B})?href{_B}*={_B}*("[^"]*"|''[^'']*''|[^"''>\\t\\n\\x0B\\f\\r ][^>\\t\\n\\x0B\\f\\r ]*)', 1) as links
  from p),
r as (
  select page_id, 'conversion' as record_type, rid as refers_to, u as target_uri, strlen(txt) as content_length,
         sha256(txt) as block_sha256, sha256(h) as payload_sha256,
         null::varchar as title, null::bigint as n_links, null::varchar as response_sha256, rid
  from w
  union all
  select page_id, 'metadata', rid, u, null, null, sha256(h), title, len(links),
         sha256('HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
           || 'Content-Length: ' || n || chr(13) || chr(10) || chr(13) || chr(10) || h), rid
  from w)
select page_id, record_type, {_sql_uuid("concat_ws(chr(10), record_type, rid)")} as record_id, refers_to, target_uri,
       content_length, block_sha256, payload_sha256, title, n_links, response_sha256
from r
""")
def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both derived records of every page; what is derived from JSON text is read back out of the record."""
    made = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    is_text = F.col("record_type") == "conversion"
    field = lambda name: F.regexp_extract("header", f"\r\n{name}: sha256:([0-9a-f]+)\r\n", 1)
    parsed = F.when(~is_text, F.from_json("block", "title string, links array<string>, block_digest string"))
    return made.withColumn("json", parsed).select(
        "page_id",
        "record_type",
        "record_id",
        "refers_to",
        "target_uri",
        F.when(is_text, F.col("content_length")).alias("content_length"),
        F.when(is_text, field("WARC-Block-Digest")).alias("block_sha256"),
        field("WARC-Source-Payload-Digest").alias("payload_sha256"),
        F.col("json.title").alias("title"),
        F.when(~is_text, F.size("json.links").cast("long")).alias("n_links"),
        F.substring_index("json.block_digest", ":", -1).alias("response_sha256"),
    )


@query()
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    langs, logs = langid.fit_text(table(spark, sf_dir, "documents"))
    return langid.identify(table(spark, sf_dir, "pages"), langs, logs)


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    made = bpe.round_trip(table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query()
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key="stratalake")


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

_RULES_SQL = ", ".join(f"('{a}', '{r}')" for a, r in URL_RULES)


@query(f"""
with rules(action, rule) as (values {_RULES_SQL}),
parts as (
  select page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) as h,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages),
pages2 as (
  select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from parts),
fits as (
  select page_id, rule, action, row_number() over (partition by page_id order by length(rule) desc, strpos(rule, '/') desc) as n
  from pages2, rules
  where (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
    and starts_with(path, substr(rule, strpos(rule, '/'))))
select p.page_id, host, path, rule, coalesce(action, 'allow') as verdict
from pages2 p left join fits f on p.page_id = f.page_id and n = 1
""")
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("""
with t as (
  select doc_id, length(coalesce(text, '')) as n_chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as body
  from documents)
select doc_id,
       first_value(doc_id) over (partition by body order by n_chars desc, doc_id) as keep_id,
       count(*) over (partition by body) as group_size,
       doc_id = first_value(doc_id) over (partition by body order by n_chars desc, doc_id) as kept,
       sha256(body) as text_sha256
from t
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("n_chars")


_TERM = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _sql_share(n: str, total: str) -> str:
    return f"(1 + (1000000000::hugeint * ({n} + 5)) // ({total} + 5 * v))"


@query(f"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
  from documents),
t as (select r, lang, source, unnest(regexp_extract_all(body, '{_TERM}')) as term from d),
vocab as (select lang, term, count(*) as n_lang from t group by lang, term having count(distinct r) >= 30),
langs as (select lang, count(*) as v, sum(n_lang) as total_lang from vocab group by lang),
occ as (select t.lang, source, t.term, count(*) as n from t join vocab w on t.lang = w.lang and t.term = w.term group by all),
totals as (select lang, source, sum(n) as total from occ group by all),
groups as (
  select g.lang, g.source, coalesce(total, 0) as total, coalesce(v, 0) as v, coalesce(total_lang, 0) as total_lang
  from (select distinct lang, source from d) g
  left join totals s on g.lang = s.lang and g.source = s.source left join langs l on g.lang = l.lang),
dense as (
  select g.lang, g.source, w.term, coalesce(o.n, 0) as n, {_sql_share("coalesce(o.n, 0)", "total")} as p,
         {_sql_share("n_lang", "total_lang")} as q
  from groups g join vocab w on g.lang = w.lang
  left join occ o on g.lang = o.lang and g.source = o.source and w.term = o.term),
priced as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
both_parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join priced x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, (p - q)::bigint from dense where n > 0 and p > q)
select lang, source, part, item, value, rank from (
  select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from both_parts)
where part = 'pair' or rank <= 50
""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


_ORDERS = ", ".join(f"('{o}')" for o in interaction.ORDERS)


@query(f"""
with w as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
  from documents),
flags as (
  select part, doc_id,
         (case when len(words) < 100 then 1 else 0 end)
         + (case when 100 * len(list_distinct(words)) < 80 * len(words) then 2 else 0 end)
         + (case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) then 4 else 0 end)
         + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
         + (case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end) as mask
  from w),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
cells as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from flags f left join marks m on f.doc_id = m.doc_id group by all),
orders(filter_order) as (values {_ORDERS}),
steps as (
  select filter_order, step, (1 << (strpos('ABCDE', substr(filter_order, step, 1)) - 1))::int as bit,
         (select coalesce(sum(1 << (strpos('ABCDE', substr(filter_order, j, 1)) - 1)), 0) from range(1, 5) x(j) where j < step)::int as before
  from (select filter_order, unnest([1, 2, 3, 4, 5]) as step from orders)),
figures as (
  select part, filter_order, step::int as step, bit,
         sum(case when mask & bit = 0 and mask & before = 0 then n else 0 end)::bigint as kept,
         sum(case when mask & bit <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
         sum(case when mask & bit <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
         sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
         sum(case when mask & bit <> 0 and mask & before = 0 then good else 0 end)::bigint as good_lost,
         sum(case when mask & bit <> 0 and mask & before = 0 then toxic else 0 end)::bigint as toxic_lost
  from cells, steps group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from figures
""")
def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.json"))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
