"""A training-corpus pipeline: language identification, near-duplicate removal, benchmark decontamination,
mixing of sources, sharding. Each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberstat.sources.tables import table

SHARDS = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: no letters, or too far from every centroid. Learned from the
    labelled documents that are not held out."""
    from emberstat.llm.language import fit, held_out, identify

    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    packed = docs.select(F.struct("*").alias("row"), "text")
    return identify(packed, model, keep=["row"]).filter("NOT rejected").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id."""
    from emberstat.llm.near_duplicates import deduplicate

    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with 5 % or more of their words in 13-word benchmark windows go."""
    from emberstat.llm.decontaminate import decontaminate

    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents are left out or repeated, up to 3 times."""
    from emberstat.llm.mixing import mixed

    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``shard``: each document's place in the hash tree of 8 shards."""
    from emberstat.llm.sharding import assign, leaves

    return assign(docs, leaves(SHARDS))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]
#: Language identification learns centroids, so SQL can't express the rows; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    from emberstat.llm.common import stage

    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
