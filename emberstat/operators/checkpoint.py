"""Lineage cuts in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below the cluster's checkpoint folder (``spark.checkpoint.dir``) and continue
    from the written copy: later branches read the columns they need instead of recomputing it, and a lost executor
    does not force a recompute."""
    path = scratch_path(df.sparkSession, "frame")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_written(df: DataFrame) -> bool:
    """Whether ``df`` is only columns of files or of literal rows: reading it again costs no more than a copy would."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.children().head()
    return plan.nodeName().split(" ")[0] in ("Relation", "LogicalRelation", "LocalRelation")
