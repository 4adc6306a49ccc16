"""Registered queries of the training-data operators: name -> (query, oracle SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, covertree, decontaminate, exactdedup, html, langid, packing, periodic, ranked, sharding,
               simhash, suffix, toxicity)
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", "fingerprint", "component_id")


def op5_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.linked_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_report(table(spark, sf_dir, "documents"), length=200)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=40, overhead=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), max_len=1024)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(periodic.find_runs(table(spark, sf_dir, "documents"), plant=True))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.deduplicate(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


QUERIES = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_decontaminate": (op2_decontaminate, decontaminate.SQL_DECONTAMINATE),
    "op3_langid": (op3_langid, None),
    "op4_simhash": (op4_simhash, None),
    "op5_covertree": (op5_covertree, None),
    "op6_suffix_dedup": (op6_suffix_dedup, None),
    "op7_html": (op7_html, None),
    "op8_sharding": (op8_sharding, None),
    "op9_chat": (op9_chat, chat.SQL_FORMAT_CHATS),
    "op10_packing": (op10_packing, None),
    "op11_ranked_search": (op11_ranked_search, ranked.SQL_RANKED),
    "op12_periodic_runs": (op12_periodic_runs, None),
    "op13_exact_dedup": (op13_exact_dedup, exactdedup.SQL_EXACT_DEDUP),
}
