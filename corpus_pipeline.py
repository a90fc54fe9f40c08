"""From raw documents to sharded training documents.

Five stages, each an operator of :mod:`medallion.llm` with its production
parameters. A stage reads what its predecessor kept, and what it keeps is
written as Parquet to the shared folder before the next one reads it.

All stages take nulls in any column, empty and very long texts, ties, repeated
rows, empty tables and further columns of any name. All but the last return the
columns of their input as they are. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import jaccard, leaks, mixing, quality, sharding
from medallion.llm.common import ship_code, staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the kernel classifier does not reject. Null and empty
    texts are scored from zero statistics; rows of equal text share a verdict."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at Jaccard 0.8 of five-word shingles:
    the smallest doc_id. Rows without words or doc_id stay; of repeated rows one stays."""
    ship_code(spark)
    return jaccard.keep_one(docs, jaccard.JaccardParams(shingle=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Null and empty texts
    stay; repeated rows share a verdict, and without items all stay."""
    return leaks.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target shares of source, language and topic.
    Null and unnamed categories keep a share; rows of equal doc_id, and all
    rows without one in a cell, share a decision."""
    return mixing.sample(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's shard and place. Null texts have size 8; rows of equal
    doc_id, or without one, share a shard and have places of their own."""
    return sharding.shard_documents(docs, shards=24)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: A trained classifier and an exact similarity join cannot be written in SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; no rows for an empty one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
