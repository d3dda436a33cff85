"""Small frame sources: SQL text, literal rows, sequences, temp views, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_sql(spark: SparkSession, text: str) -> DataFrame:
    """A lazy frame from SQL text over registered views / catalog tables."""
    return spark.sql(text)


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a lazy frame in the session (register / copy to the cluster)."""
    df.createOrReplaceTempView(name)
    return df


def literal(spark: SparkSession, columns: dict[str, list], schema: T.StructType | str | None = None) -> DataFrame:
    """Literal frame from column vectors; shorter vectors are recycled
    (R's ``rep`` rule: the longest length must be a multiple of each)."""
    n = max(len(v) for v in columns.values())
    for name, v in columns.items():
        if n % len(v):
            raise ValueError(f"column {name}: length {len(v)} does not divide {n}")
    rows = [tuple(v[i % len(v)] for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, schema=schema or list(columns))


def seq_frame(spark: SparkSession, lo: int, hi: int, by: int = 1, name: str = "value") -> DataFrame:
    """``seq(lo, hi, by)`` as a distributed frame (``spark.range``, inclusive end in either direction)."""
    return spark.range(lo, hi + (1 if by > 0 else -1), by).withColumnRenamed("id", name)


def date_spine(df: DataFrame, date_col: str, step_days: int = 1, name: str = "day") -> DataFrame:
    """Every ``step_days``-th day from the first to the last date of ``df``.

    The bounds come from one aggregate; the days themselves are generated by a
    distributed ``spark.range``, never as one array in one task.
    """
    spark = df.sparkSession
    lo, hi = df.agg(F.unix_date(F.to_date(F.min(date_col))), F.unix_date(F.to_date(F.max(date_col)))).first()
    if lo is None:
        return spark.range(0).select(F.lit(None).cast("date").alias(name))
    return spark.range(lo, hi + 1, step_days).select(F.date_from_unix_date("id").alias(name))


def describe_schema(df: DataFrame) -> DataFrame:
    """``str(df)``: (position, name, type) of each column."""
    spark = df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string")


def read_docs(spark: SparkSession, path: str, fmt: str = "text", text_col: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """A document source: one document per file (``fmt="text"``, read whole)
    or per row of a parquet/json/csv table. Documents without an id get the
    1-based position of their file path, or of their text in a table (a
    distributed order, reproducible; equal texts get neighbouring ones)."""
    from ..operators.joins import row_index
    from ..operators.ranks import rank_keys

    if fmt == "text":
        docs = spark.read.text(path, wholetext=True).select(F.col("value").alias(text_col),
                                                            F.input_file_name().alias("_path"))
        ids = rank_keys(docs.select("_path"), ["_path"], method="dense", name=id_col).select("_path", id_col)
        return docs.join(ids, "_path").select(F.col(id_col).cast("long").alias(id_col), text_col)
    df = spark.read.format(fmt).load(path)
    if id_col in df.columns:
        return df.select(id_col, text_col)
    return row_index(df.select(text_col), [text_col], id_col).select(F.col(id_col).cast("long").alias(id_col), text_col)
