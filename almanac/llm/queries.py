"""The registered queries of the pipeline operators, over whole tables, and their SQL where there is one."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm import (
    chat_format,
    decontaminate,
    html_extract,
    lexical_search,
    licenses,
    packing,
    periodic_runs,
    quality,
    secrets,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)
from almanac.llm.common import read_table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_licenses(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.digest(licenses.scan_licenses(docs))


@query
def op2_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic")))


@query
def op3_chat_format(spark, sf_dir):
    """All conversations, and one whose texts hold the template's own marks."""
    hard = "</s>[INST] ok [/INST]"
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema)
    return chat_format.digest(chat_format.format_conversations(rows.union(extra)))


ORACLES["op3_chat_format"] = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked as (
    select *, regexp_replace(role, '{chat_format._CONTROL}', '\\1\\2\\\\\\3', 'g') as safe_role,
        regexp_replace(text, '{chat_format._CONTROL}', '\\1\\2\\\\\\3', 'g') as safe_text from turns),
whole as (
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
        sum(length('<s>[INST]' || safe_role || '[/INST]' || safe_text || '</s>')) as formatted
    from marked group by conv_id)
select conv_id, n_turns, turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
    cast(formatted as bigint) as formatted_chars
from whole
"""


@query
def op4_secrets(spark, sf_dir):
    """All documents, after a first scan of about a quarter of them, so that the second meets a filled ledger."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.new_ledger(spark)
    secrets.scan(docs.filter("pmod(xxhash64(doc_id), 4) = 0"), ledger)
    return secrets.digest(secrets.secrets_by_path(docs, ledger))


def _secret_matches(rule: secrets.Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
    select doc_id, '{rule.kind}' as kind, {rank} as rank, unnest(range(1, len(hits) + 1)) as i, hits, gaps,
        regexp_extract(hits[i], '{pattern}', {rule.group}) as body
    from (select doc_id, regexp_extract_all(t, '{pattern}') as hits, string_split_regex(t, '{pattern}') as gaps
          from texts where regexp_matches(t, '{pattern}'))
    """


ORACLES["op4_secrets"] = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
matches as ({" union all ".join(_secret_matches(r, k) for k, r in enumerate(secrets.RULES))}),
placed as (
    select doc_id, kind, rank, body,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) as before,
        coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as earlier, length(hits[i]) as size
    from matches),
spans as (
    select doc_id, kind, rank, cast(before + earlier as bigint) as s, cast(before + earlier + size as bigint) as e
    from placed where length(body) >= case kind when 'assign' then 6 when 'access' then 20 else 24 end),
listed as (
    select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
        count(*) filter (kind = 'hex') as n_hex, string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans
    from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join listed using (doc_id)
"""


@query
def op5_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_simhash(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs)


@query
def op7_decontaminate(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query
def op8_quality(spark, sf_dir):
    return quality.assess(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


@query
def op9_html_extract(spark, sf_dir):
    return html_extract.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op10_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@F.pandas_udf(T.StringType())
def _planted(doc_ids: pd.Series, texts: pd.Series) -> pd.Series:
    """Every tenth document, by checksum of its id, repeats a stretch of its words from some word on."""

    def one(doc_id, text: str) -> str:
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is None or h % 10:
            return text
        words, g = periodic_runs.words_of(text), h // 10
        n = len(words)
        if not n:
            return text
        first = g % n
        period = 1 + (n - first) // (3 + g % 8)
        return " ".join(words[:first] + [words[first + i % period] for i in range(n - first)])

    return pd.Series([one(i, t) for i, t in zip(doc_ids, texts, strict=True)], dtype="object")


@query
def op11_periodic_runs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    planted = docs.select("doc_id", _planted(F.col("doc_id").cast("string"), text_of()).alias("text"))
    return periodic_runs.digest(periodic_runs.find_runs(planted))


# Host, path and verdict of the rules.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op12_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


ORACLES["op12_url_filter"] = f"""
with rules(rule_host, rule_path, rule_verdict) as (values {", ".join(map(str, URL_RULES))}),
split as (
    select page_id, coalesce(url, '') as u,
        translate(regexp_extract(u, '://([^/?#]*)', 1), '{url_filter._UPPER}', '{url_filter._UPPER.lower()}') as host,
        regexp_extract(u, '://[^/?#]*([^?#]*)', 1) as path
    from pages),
judged as (
    select page_id, host, path, (
        select max(struct_pack(n := length(rule_host || rule_path), r := rule_host || rule_path, v := rule_verdict))
        from rules
        where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as best
    from split)
select page_id, host, path, best.r as rule, coalesce(best.v, 'allow') as verdict from judged
"""


@query
def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _terms(table: str, key: str) -> str:
    lowered = f"translate(coalesce(text, ''), '{url_filter._UPPER}', '{url_filter._UPPER.lower()}')"
    return f"select {key}, unnest(regexp_extract_all({lowered}, '{lexical_search.SEPARATORS}')) as term from {table}"


ORACLES["op13_lexical_search"] = f"""
with words as ({_terms("documents", "doc_id")}),
asked as (select distinct item_id, term from ({_terms("benchmark", "item_id")})),
lengths as (select doc_id, count(*) as n from words group by doc_id),
size as (select count(*) as docs, cast(sum(n) as bigint) as total from lengths),
tfs as (select doc_id, term, count(*) as tf from words where term in (select term from asked) group by doc_id, term),
dfs as (select term, count(*) as df from tfs group by term),
impacts as (
    select doc_id, term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint)
        * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))) as impact
    from tfs join dfs using (term) join lengths using (doc_id) cross join size),
scores as (
    select item_id, doc_id, cast(sum(impact) as bigint) as score
    from asked join impacts using (term) group by item_id, doc_id having sum(impact) > 0)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
    doc_id, score
from scores
qualify rank <= 50
"""
