"""Parquet sources (the driver's test tables or any parquet folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder, e.g. ``table(spark, d, "lineitem")``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register each table as a temp view so SQL text can reach it."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
