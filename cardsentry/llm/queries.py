"""The ``opN_*`` queries: thin digests of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import (
    conversations,
    decontaminate,
    htmltemplate,
    langid,
    licenses,
    oracles,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    spelling,
    tokenbin,
    urlrules,
)
from cardsentry.llm.common import read_table, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

N_SHARDS = 8
# A deployment passes its own secret; a fixed one makes the queries repeatable.
SURROGATE_KEY = "cardsentry-demo-key"
# The rules of the URL query, host, path, action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, SURROGATE_KEY, count="n_replaced")


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Virtual slots weighted by bytes: the law is ``bytes``; the slots are dealt
    (map version 1), the map is edited by the bytes found (version 2) and read
    back; ``slot`` is the row's place in its shard."""
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), N_SHARDS, scratch_path(spark, "slot-map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltemplate.main_text(read_table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(read_table(spark, sf_dir, "documents"), path, window=4096, end_id=2)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), ngram=3, max_bits=2)


def op7_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", F.round("distance2", 6).alias("distance2"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.remainder(F.col("doc_id")) == 2
    model = langid.fit(docs.where(~held_out), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urlrules.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-shards")
    docs = read_table(spark, sf_dir, "documents")
    manifest = tokenbin.write_shards(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return tokenbin.read_records(spark, folder, manifest)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(read_table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(rows), rows)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_pii_surrogates": op1_pii_surrogates,
        "op2_virtual_slots": op2_virtual_slots,
        "op3_decontamination": op3_decontamination,
        "op4_html_template": op4_html_template,
        "op5_packing": op5_packing,
        "op6_simhash": op6_simhash,
        "op7_quality_outliers": op7_quality_outliers,
        "op8_language_id": op8_language_id,
        "op9_url_rules": op9_url_rules,
        "op10_token_shards": op10_token_shards,
        "op11_license_scan": op11_license_scan,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_conversation_repair": op13_conversation_repair,
    }


def _url_oracle() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    return f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {rules}),
parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
fits AS (
  SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.action,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path
                            ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC, r.action DESC) AS nth
  FROM (SELECT DISTINCT * FROM parts) p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM parts p LEFT JOIN (SELECT * FROM fits WHERE nth = 1) f
  ON p.page_id = f.page_id AND p.host = f.host AND p.path = f.path
"""


def llm_oracles() -> dict[str, str]:
    """The others hash, tokenize, verify edit distances or iterate, and are
    tested by brute force."""
    return {
        "op9_url_rules": _url_oracle(),
        "op12_spelling_variants": oracles.spelling(),
        "op13_conversation_repair": oracles.conversations(),
    }
