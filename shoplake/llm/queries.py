"""The registered queries over training text: each takes a session and a folder of tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import (
    chat,
    exact,
    merkle,
    mixing,
    near,
    packing,
    runs,
    secret_scan,
    substring,
    token_counts,
    topk,
    toxicity,
    url_rules,
)
from shoplake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(secret_scan.scan(table(spark, sf_dir, "documents")))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    probe = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    trees = chat.conversation_trees(given, "given").unionByName(chat.conversation_trees(probe, "probe"))
    return chat.digested(chat.format_trees(trees))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.largest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages, as known for the documents that people have labelled."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, labelled_languages(spark, sf_dir), mixing.LANGUAGES)


def labelled_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "labels").select("doc_id").distinct()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("domain"))
    return docs.join(known, "doc_id", "left_semi")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*columns, "loss")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(runs.with_tail_repeated(table(spark, sf_dir, "documents")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, received=merkle.without_line_breaks(docs))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.counts_of_documents(table(spark, sf_dir, "documents"), vocabulary)


QUERIES: list[Query] = [
    op1_secret_scan,
    op2_chat_formatting,
    op3_toxicity,
    op4_exact_topk,
    op5_mixing,
    op6_substring_dedup,
    op7_near_dedup,
    op8_url_filters,
    op9_exact_dedup,
    op10_packing,
    op11_periodic_runs,
    op12_merkle_manifest,
    op13_token_counts,
]
SQL = {
    "op2_chat_formatting": chat.SQL,
    "op4_exact_topk": topk.SQL,
    "op6_substring_dedup": substring.SQL,
    "op8_url_filters": url_rules.SQL,
    "op9_exact_dedup": exact.SQL,
    "op12_merkle_manifest": merkle.SQL,
}


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
