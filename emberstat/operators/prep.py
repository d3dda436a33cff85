"""Projection, filtering and mutation verbs on DataFrames."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """Negative select: ``select(-Date)``."""
    return df.drop(*cols)


def select_pos(df: DataFrame, first: int, last: int) -> DataFrame:
    """Positional select ``df[, first:last]`` (1-based, inclusive)."""
    return df.select(*df.columns[first - 1:last])


def filter_rows(df: DataFrame, *preds: Column) -> DataFrame:
    """Conjunction of predicates (three-valued: NULL drops the row)."""
    out = df
    for p in preds:
        out = out.filter(p)
    return out


def na_omit(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop every row holding a NULL (in ``subset`` if given)."""
    return df.dropna(how="any", subset=subset)


def mutate(df: DataFrame, *steps: tuple[str, Column]) -> DataFrame:
    """Sequential mutate: each step sees the columns made by earlier steps.

    One ``withColumn`` per step is required for correctness: a single
    ``withColumns`` call (or a SQL lateral alias) evaluates every expression
    against the *input* columns, so a column that is overwritten and then
    read again would be read with its old value. Catalyst collapses the
    chained projections into one, so there is no runtime cost.
    """
    out = df
    for name, expr in steps:
        out = out.withColumn(name, expr)
    return out


def separate(df: DataFrame, col: str, parts: dict[str, int], drop: bool = False) -> DataFrame:
    """Element ``i`` (1-based) of a vector or array column into a named column
    (separate a vector column)."""
    dtype = df.schema[col].dataType
    arr = vector_to_array(F.col(col)) if isinstance(dtype, VectorUDT) else F.col(col)
    out = df.select("*", *[F.element_at(arr, i).alias(name) for name, i in parts.items()])
    return out.drop(col) if drop else out


def frame_dim(df: DataFrame) -> DataFrame:
    """(rows, cols) as a one-row frame; the row count is a distributed count."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(df.columns)).alias("cols"))


def ordered_head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """``head(df, n)`` with an explicit total order (plans as a top-k)."""
    return df.orderBy(*order).limit(n)


def bucketize(df: DataFrame, col: str, splits: list[float], out: str = "bucket") -> DataFrame:
    """Apply a feature transformer (here ``Bucketizer``) as a mutate step."""
    from pyspark.ml.feature import Bucketizer

    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)


def arrange(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows sorted by several keys (``F.asc`` / ``F.desc``); equal rows all stay. A range-partitioned global sort."""
    return df.orderBy(*order)
