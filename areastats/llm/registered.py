"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.llm import (
    decontamination,
    mixing,
    ngram_lm,
    pii,
    ppm,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    spelling,
    token_files,
    token_pairs,
    warc,
)
from areastats.llm.common import documents, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.histogram_sort(documents(spark, sf_dir), shards=40)


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(documents(spark, sf_dir))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.verdicts(quality_rules.ledger(documents(spark, sf_dir)))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "failed"
    )


SQL["op9_quality_rules"] = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), w as (
  select r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from d
), g as (
  select r, i, array_to_string(ws[i:i + 4], ' ') as gram
  from (select r, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)
), again as (
  select r, i from (select r, i, count(*) over (partition by r, gram) as n from g) where n > 1
), covered as (
  select r, count(distinct p) as n from (select r, i + unnest(range(0, 5)) as p from again) group by r
), m as (
  select doc_id, len(ws)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
    len(lines)::bigint as n_lines
  from w left join covered using (r)
), b as (
  select *, (case when n_words < 10 then 1 else 0 end) + (case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end)
    + (case when 10 * n_symbols > 3 * word_chars then 4 else 0 end)
    + (case when n_dup_lines >= 5 and 10 * n_dup_lines > 7 * n_lines then 8 else 0 end)
    + (case when word_chars > 60 * n_words then 16 else 0 end) as f
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f & 3) <> 0 as base_failed,
  f = 0 as kept, n_lines, f::bigint as failed
from b
"""


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(documents(spark, sf_dir), width=3, radius=2)
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op10_warc"] = """
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), l as (
  select payload_digest, max(page_id) as last from p where payload_bytes >= 1000 group by payload_digest
)
select page_id, payload_bytes, payload_digest,
  case when last is null or page_id is not distinct from last then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from last then last end as refers_to
from p left join l using (payload_digest)
"""


@query
def op6_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = ngram_lm.scores(documents(spark, sf_dir))
    return read.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


@query
def op12_token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    one, two = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_pairs.aligned_documents(documents(spark, sf_dir), one, two)


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.predictions(documents(spark, sf_dir))
