"""Sampling and reproducible splits."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import knuth_hash32


def mixed_hash(*key: str, seed: int = 0) -> Column:
    """MD5 of seed and key columns as text: unlike a multiplicative hash, the draws of two seeds have nothing in
    common, and any engine can compute it."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))


def sample_n(df: DataFrame, n: int, seed: int = 0, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows (all rows if fewer): the ``n`` smallest values of a seeded row hash, ties broken by every
    column. Plans as a top-k (``TakeOrderedAndProject``): each partition keeps only n candidates.

    Without ``key`` the hash also takes a row id, so that each of several equal rows draws for itself; the ids follow
    the partitioning. With ``key`` (columns that tell rows apart) the sample is the same whatever the partitioning.
    """
    if key:
        return df.orderBy(mixed_hash(*key, seed=seed), *df.columns).limit(n)
    row = F.monotonically_increasing_id()
    return df.withColumn("_row", row).orderBy(F.xxhash64(*df.columns, "_row", F.lit(seed)), "_row").limit(n).drop("_row")


def sample_frac(df: DataFrame, fraction: float, with_replacement: bool = False, seed: int | None = None) -> DataFrame:
    """Bernoulli (or Poisson, with replacement) sample of about ``fraction``."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def hash_part(key: Column, weights: dict[str, float]) -> Column:
    """Name of the part a key falls into: the 32-bit multiplicative hash of
    the key against cumulative thresholds of ``weights`` (in given order).
    Every row of a key lands in the same part, so no key leaks across parts."""
    total = float(sum(weights.values()))
    h = knuth_hash32(key)
    expr, acc = None, 0.0
    names = list(weights)
    for name in names[:-1]:
        acc += weights[name] / total
        cond = h < F.lit(int(acc * 2 ** 32))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return (expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1]))


def hash_split(df: DataFrame, weights: dict[str, float], key: str) -> dict[str, DataFrame]:
    """Weighted split by key hash: reproducible across runs and partitionings."""
    part = hash_part(F.col(key), weights)
    tagged = df.withColumn("_part", part)
    return {name: tagged.filter(F.col("_part") == name).drop("_part") for name in weights}


def random_split(df: DataFrame, weights: dict[str, float], seed: int) -> dict[str, DataFrame]:
    """Spark's ``randomSplit`` (depends on the partitioning of ``df``). The
    input is written once first: every part re-reads the same rows in the
    same partitions, so the parts stay disjoint and complete and the input
    is not recomputed once per part."""
    from ..operators.checkpoint import materialize

    parts = materialize(df).randomSplit(list(weights.values()), seed=seed)
    return dict(zip(weights, parts))
