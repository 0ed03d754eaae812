"""Registered queries of the operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.llm.chat import chat_digest
from gridclimate.llm.common import table
from gridclimate.llm.decontaminate import contamination
from gridclimate.llm.fill_middle import middle_digest
from gridclimate.llm.lm_score import backoff_scores
from gridclimate.llm.near_dedup import near_duplicates
from gridclimate.llm.packing import packed_index
from gridclimate.llm.quality_model import quality
from gridclimate.llm.quality_rules import quality_rules
from gridclimate.llm.secrets import secret_digest
from gridclimate.llm.token_shards import token_shards
from gridclimate.llm.toxicity import toxicity
from gridclimate.llm.warc import page_captures
from gridclimate.llm.whitening import whitened_rows


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of the benchmark."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_hash")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token records in training order, read back from the shards."""
    return token_shards(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and log-likelihood ratio of every document; trusted are those labelled as of good quality."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules(table(spark, sf_dir, "documents"), trusted)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC captures, read back from the archives."""
    return page_captures(table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts imitate the template, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    return chat_digest(rows.unionByName(trap))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packed_index(table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document from up to three words, where an n-gram seen once counts."""
    return backoff_scores(table(spark, sf_dir, "documents")).select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"))


def op10_lm_score_order2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from pairs of words seen twice or more."""
    scores = backoff_scores(table(spark, sf_dir, "documents"), order=2, cutoff=2)
    return scores.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"))


def op10_lm_score_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document from up to three words, where an n-gram seen once counts."""
    scores = backoff_scores(table(spark, sf_dir, "documents"), order=3, cutoff=1)
    return scores.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in their fill-in-middle form, and what is read back from it."""
    return middle_digest(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings projected on the components of their covariance, each of unit variance."""
    return whitened_rows(table(spark, sf_dir, "embeddings"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_digest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_token_shards": op3_token_shards,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc": op6_warc,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_chat": op8_chat,
    "op9_packing": op9_packing,
    "op10_lm_score": op10_lm_score,
    "op10_lm_score_order2": op10_lm_score_order2,
    "op10_lm_score_order3": op10_lm_score_order3,
    "op11_fill_middle": op11_fill_middle,
    "op12_whitening": op12_whitening,
    "op13_secret_scan": op13_secret_scan,
}

#: A-Z to a-z alone, as DuckDB text.
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORDER_3 = f"""
with d as (select doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
t as (select doc_id, unnest(w) as w, unnest(range(1, len(w) + 1)) as i from d),
g as (select doc_id, i, w, lag(w) over (partition by doc_id order by i) as v, lag(w, 2) over (partition by doc_id order by i) as u from t),
c1 as (select w, count(*) as n from t group by w),
c2 as (select v, w, count(*) as n from g where v is not null group by v, w),
c3 as (select u, v, w, count(*) as n from g where u is not null group by u, v, w),
s as (
    select g.doc_id, case when g.u is not null then ln(c3.n) - ln(h2.n) when g.v is not null then ln(c2.n) - ln(h1.n)
        else ln(c1.n) - ln((select count(*) from t)) end as score
    from g join c1 on c1.w = g.w left join c1 h1 on h1.w = g.v left join c2 on c2.v = g.v and c2.w = g.w
        left join c2 h2 on h2.v = g.u and h2.w = g.v left join c3 on c3.u = g.u and c3.v = g.v and c3.w = g.w)
select d.doc_id, coalesce(len(d.w), 0)::bigint as n_words, round(avg(s.score), 6) as log_score
from d left join s using (doc_id) group by d.doc_id, d.w"""

TWINS = {
    "op1_near_dedup": f"""
with recursive words as (
    select doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
grams as (
    select doc_id, unnest(case when len(w) = 0 or w is null then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as g from words),
sets as (select distinct doc_id, g from grams),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
links as (
    select a.doc_id as a, b.doc_id as b from sets a join sets b on a.g = b.g and a.doc_id <> b.doc_id
    join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
    group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach(doc_id, other) as (
    select doc_id, doc_id from documents union select r.doc_id, l.b from reach r join links l on l.a = r.other)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, r.component_id, d.doc_id = r.component_id as kept
from documents d left join sizes s using (doc_id)
join (select doc_id, min(other) as component_id from reach group by doc_id) r using (doc_id)""",
    "op2_decontamination": f"""
with d as (select doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
i as (select item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
windows as (
    select item_id, least(13, len(w)) as n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda k: array_to_string(w[k:k + 12], ' '))) as g
    from i where len(w) > 0),
spans as (
    select d.doc_id, s.k as k, x.n as n, x.item_id from d, (select distinct n from windows) l,
        lateral (select unnest(range(1, greatest(len(d.w) - l.n + 2, 1))) as k) s
        join windows x on x.n = l.n and x.g = array_to_string(d.w[s.k:s.k + l.n - 1], ' ')),
hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from spans) group by doc_id),
listed as (
    select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items
    from (select distinct doc_id, item_id from spans) group by doc_id)
select d.doc_id, coalesce(len(d.w), 0)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit, coalesce(l.n_items, 0)::bigint as n_items,
    sha256(coalesce(l.items, '')) as items_sha256,
    coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= coalesce(len(d.w), 0) as contaminated
from d left join hits h using (doc_id) left join listed l using (doc_id)""",
    "op6_warc": """
with p as (select page_id, sha256(coalesce(html, '')) as d, strlen(coalesce(html, ''))::bigint as n from pages),
f as (select *, case when n >= 100 then min(page_id) over (partition by d, n >= 100) else page_id end as first from p)
select page_id, n as payload_bytes, d as payload_digest, case when first = page_id then 'response' else 'revisit' end as record_type,
    case when first <> page_id then first end as refers_to, 1::bigint as n_requests, true as request_matches from f""",
    "op8_chat": r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select * from (values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
e as (
    select *, case when contains(text, '###') or contains(text, '</turn>') or contains(text, '\\') or contains(text, '\#') or contains(text, '\/')
        or contains(text, '\c') then replace(replace(replace(text, '\', '\\'), '###', '\#'), '</turn>', '\/') else text end as shown from c)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(14 + length(role) + length(shown))::bigint as formatted_chars
from e group by conv_id""",
    "op10_lm_score": ORDER_3,
    "op10_lm_score_order3": ORDER_3,
    "op10_lm_score_order2": f"""
with d as (select doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
t as (select doc_id, unnest(w) as w, unnest(range(1, len(w) + 1)) as i from d),
g as (select doc_id, i, w, lag(w) over (partition by doc_id order by i) as v from t),
c1 as (select w, count(*) as n from t group by w),
c2 as (select v, w, count(*) as n from g where v is not null group by v, w having count(*) >= 2),
s as (
    select g.doc_id, case when c2.n is not null then ln(c2.n) - ln(h.n) when g.v is null then ln(c1.n) - ln((select count(*) from t))
        else ln(0.4) + ln(c1.n) - ln((select count(*) from t)) end as score
    from g join c1 on c1.w = g.w left join c2 on c2.v = g.v and c2.w = g.w left join c1 h on h.w = g.v)
select d.doc_id, coalesce(len(d.w), 0)::bigint as n_words, round(avg(s.score), 6) as log_score
from d left join s using (doc_id) group by d.doc_id, d.w""",
    "op11_fill_middle": r"""
with t as (
    select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u from documents),
c as (
    select *, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as a, ('0x' || h[9:16])::bigint % (len(u) + 1) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 50 then 'plain'
            when ('0x' || h[25:32])::bigint % 100 < 80 then 'spm' else 'psm' end as form from t),
p as (
    select *, array_to_string(u[1:least(a, b)], '') as prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as middle,
        array_to_string(u[greatest(a, b) + 1:], '') as suffix from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256 from p""",
}
