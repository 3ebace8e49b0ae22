"""The registered queries of this package: each applies an operator, with production parameters,
to its whole table. ORACLES has DuckDB SQL where SQL expresses the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relsync.llm import chat, decontaminate, exact, lexical, licenses, mixing, neighbors, periodic, pii, sharding, simhash, toxicity, urlfilter
from relsync.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(chat.HARD_TEXT).alias("text"))
    return chat.digest_turns(turns.unionByName(hard))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbors.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.fit(docs))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"), shards=40)


def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge_urls(table(spark, sf_dir, "pages"), urlfilter.RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep_text=False)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(periodic.planted(table(spark, sf_dir, "documents")))


def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_digest(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_benchmark_decontamination, op3_chat_formatting, op4_nearest_neighbours, op5_source_mixing,
        op6_personal_data, op7_sharding, op8_simhash_near_duplicates, op9_url_filter, op10_toxicity,
        op11_periodic_runs, op12_exact_duplicates, op13_lexical_search,
    )
}
ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.oracle(),
    "op3_chat_formatting": chat.oracle(),
    "op5_source_mixing": mixing.oracle(),
    "op9_url_filter": urlfilter.oracle(),
    "op12_exact_duplicates": exact.oracle(),
    "op13_lexical_search": lexical.oracle(),
}
