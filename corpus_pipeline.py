"""The corpus pipeline: documents through five of the operators in ``relsync.llm``.

Each stage takes all rows that the one before it kept and returns rows of ``documents``; the
last adds each document's shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relsync.llm import decontaminate, mixing, sharding, simhash, toxicity
from relsync.llm.common import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifiers, trained on ``docs`` and ``labels``, do not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, two bits): the smallest doc_id."""
    return simhash.deduplicate(docs, shingle=3, max_bits=2)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of ``benchmark``."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, whole."""
    return mixing.mix_documents(docs, weights=[3, 1, 2], share=1.5, limit=2.0)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard (of 40) and slot."""
    return sharding.shard_documents(docs, shards=40)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", deduplicate),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

#: Training, fingerprints and greedy placing have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
