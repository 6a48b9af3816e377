"""The operators of this package bound to the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, ctw, decontam, language, line_quality, multi_index, packing, parity_join, prefix_trie, pu_quality, spelling,
               toxicity, url_rules)
from .common import crc_remainder, table
from .oracle import SQL

#: (action, host, path)
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_chat_format(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    return chat_format.format_conversations(spark, rows.unionByName(extra))


def op2_language(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text", "lang")
    held_out = crc_remainder("doc_id", 4) == 2
    model = language.fit(docs.where(~held_out))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op3_line_quality(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "source", "text")
    return line_quality.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_toxicity(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    labels = table(spark, base, "labels").select("doc_id", "toxic")
    held_out = crc_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs.where(~held_out), labels.where(~held_out))
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op5_packing(spark: SparkSession, base: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, base, "documents").select("doc_id", "text")
    return packing.pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


def op6_pu_quality(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    labels = table(spark, base, "labels").select("doc_id", "quality")
    held_out = crc_remainder("doc_id", 4) == 2
    model = pu_quality.fit(docs.where(~held_out), labels.where(~held_out))
    return pu_quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op7_decontamination(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    return decontam.contaminated(docs, table(spark, base, "benchmark"))


def op8_parity_join(spark: SparkSession, base: str) -> DataFrame:
    return parity_join.jaccard_components(table(spark, base, "documents").select("doc_id", "text"))


def op9_url_rules(spark: SparkSession, base: str) -> DataFrame:
    pages = table(spark, base, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op10_ctw(spark: SparkSession, base: str) -> DataFrame:
    held_out = crc_remainder("doc_id", 5) == 1
    docs = table(spark, base, "documents").select("doc_id", "text", (~held_out).alias("training"))
    return ctw.score_streams(docs).select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op11_prefix_trie(spark: SparkSession, base: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, base, "conversations"))


def op12_spelling(spark: SparkSession, base: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, base, "documents"))


def op13_multi_index(spark: SparkSession, base: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, base, "embeddings"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_language": op2_language,
    "op3_line_quality": op3_line_quality,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_pu_quality": op6_pu_quality,
    "op7_decontamination": op7_decontamination,
    "op8_parity_join": op8_parity_join,
    "op9_url_rules": op9_url_rules,
    "op10_ctw": op10_ctw,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling": op12_spelling,
    "op13_multi_index": op13_multi_index,
}

ORACLE = {k: v for k, v in SQL.items() if k in QUERIES}
