"""The corpus pipeline: five stages over ``documents``, each by one operator of trisk.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All stages but the last return the columns of
``documents``. Each stage reads every column by name, passes extra ones on, and gives an
empty table for an empty table; null ids and texts are handled as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trisk.llm import decontaminate, mixing, quality_forest, simhash, token_files
from trisk.llm.store import materialize, ship, work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules or the isolation forest reject go."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality_forest.keep_good(docs, quality_forest.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one of the smallest id."""
    ship(spark)
    return simhash.deduplicate(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go."""
    benchmark = ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files of the mix; one row per document as read back from them."""
    return token_files.token_files(docs, work_path(ship(spark), "pipeline-tokens"))


STAGES = [("quality rules", quality), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", clean_of_benchmark), ("mixing to target weights", mixed),
          ("token-id output", tokens)]

#: SQL has no isolation forest, SimHash or tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
