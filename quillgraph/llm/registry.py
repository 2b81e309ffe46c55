"""The operators as registered queries, with production parameters over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import class_lm, decontaminate, lsh_forest, packing, prefix_trie, quality_classifier, quality_rules, simhash, sql, suffix_dedup, token_counts, token_files, url_filter, vector_codes
from quillgraph.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE, TOKEN_LIMIT = public_tokenizers.path("word_bpe_49k.json"), 2048
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: Canonical URLs of known spam: a host with `/` lists the whole site.
LISTED_URLS = ["spam-farm.example.org/", "spam-farm.example.com/", "cheap-pills.example.com/", "cheap-pills.example.org/", "example.org/casino/"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "key string, verdict string")
    listed = spark.createDataFrame([(u, "block") for u in LISTED_URLS], "key string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules, listed).drop("url")


_FITS = "(h = '{h}' OR h LIKE '%.{h}') AND starts_with(p, '{p}')"


def _cases(keys: list[tuple[str, str]], what: int) -> str:
    ordered = sorted(keys, key=lambda k: (-len(k[0]), -k[0].index("/")))
    return "CASE " + " ".join(f"WHEN {_FITS.format(h=k[: k.index('/')], p=k[k.index('/') :])} THEN '{(k, v)[what]}'" for k, v in ordered) + " END"


OP1_SQL = f"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
                  coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS p FROM pages)
SELECT page_id, h AS host, p AS path, {_cases(URL_RULES, 0)} AS "rule",
       coalesce({_cases(URL_RULES, 1)}, {_cases([(u, "block") for u in LISTED_URLS], 1)}, 'allow') AS verdict
FROM u
"""


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE, TOKEN_LIMIT)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents").select("doc_id", "text"), quality_classifier.held_out()
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), ~held)
    return quality_classifier.classify(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_files(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE)
    return token_files.read_files(files, with_ids=False)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), BYTE_BPE)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_url_filter, op2_token_counts, op3_suffix_dedup, op4_class_lm, op5_quality_rules, op6_simhash, op7_quality_classifier, op8_token_files, op9_packing, op10_decontaminate, op11_prefix_trie, op12_lsh_forest, op13_vector_codes)}
SQL: dict[str, str] = {"op1_url_filter": OP1_SQL, "op3_suffix_dedup": sql.SUFFIX_DEDUP, "op5_quality_rules": sql.QUALITY_RULES, "op11_prefix_trie": sql.PREFIX_TRIE, "op13_vector_codes": sql.VECTOR_CODES}
