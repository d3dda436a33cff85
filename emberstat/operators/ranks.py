"""Exact ranks, running counts and quantiles that stay distributed.

A window ``partitionBy(g).orderBy(v)`` puts a whole group into one task, and
an ordered window without ``partitionBy`` puts the whole frame into one task.
``percentile`` keeps every distinct value of a group in one aggregation
buffer. All three break when one group holds a third of the rows.

``cumulative_counts`` computes the same numbers in blocks instead:

1. collapse to distinct (group, order) keys with their weight — partial
   aggregation, so heavy duplicates shrink map-side;
2. range-partition those keys; the partition id becomes a block number.
   Range bounds come from a sample, so a hot group is cut into many blocks;
   the blocked keys are written once to the shared checkpoint folder.
   Without a fixed count, adaptive execution merges neighbouring ranges
   to its advisory size, so a block holds about max(64 MB, total /
   shuffle partitions) of keys;
3. total each (group, block) — at most blocks + groups rows — and turn the
   totals into block offsets with a window over that small table;
4. a running sum inside each (group, block), bounded by the block size;
5. offset + running sum = the exact count of rows before each key.

Every window partition is bounded by one range partition, whatever the skew.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .checkpoint import materialize
from .joins import join_null_safe


def cumulative_counts(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                      weight_col: str | None = None, blocks: int | None = None,
                      sums: Sequence[str] = ()) -> DataFrame:
    """Distinct (group, order) keys with

    * ``_w`` — total weight (row count if no weight) of the key,
    * ``_before`` — weight of keys of the same group that sort strictly
      before it (ascending, NULLs first),
    * ``_n`` — total weight of the group,
    * one column per name in ``sums``: that column summed over the key.
    """
    g, o = list(group_cols), list(order_cols)
    w = F.col(weight_col) if weight_col else F.lit(1)
    keys = df.groupBy(*g, *o).agg(F.sum(w).alias("_w"), *[F.sum(c).alias(c) for c in sums])
    # Block ids come from a sampled range partitioning. Without an explicit
    # count, adaptive execution merges neighbouring ranges up to its advisory
    # partition size, so block size follows the data (one block for a tiny
    # input, many for a hot group). The blocked keys are written once so both
    # branches below see the very same blocks.
    rp = keys.repartitionByRange(blocks, *g, *o) if blocks else keys.repartitionByRange(*g, *o)
    ranged = materialize(rp.withColumn("_blk", F.spark_partition_id()))

    per_block = ranged.groupBy(*g, "_blk").agg(F.sum("_w").alias("_bw"))
    gw = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    offsets = per_block.select(
        *g, "_blk",
        F.coalesce(F.sum("_bw").over(gw.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_bw").over(gw).alias("_n"))

    inner = Window.partitionBy(*g, "_blk").orderBy(*o).rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.withColumn("_run", F.coalesce(F.sum("_w").over(inner), F.lit(0)))
    return (join_null_safe(running, offsets, [*g, "_blk"])
            .select(*g, *o, "_w", (F.col("_off") + F.col("_run")).alias("_before"), "_n", "_blk", *sums))


def rank_keys(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
              method: str = "dense", name: str = "rank", blocks: int | None = None) -> DataFrame:
    """Rank of every distinct (group, order) key.

    ``dense`` — 1, 2, 3 over distinct keys; ``min`` — 1 + rows before;
    ``average`` — mean row position of the tied rows (R's ``rank``);
    ``row_number`` — 1 + rows before (order keys must be unique).
    """
    g, o = list(group_cols), list(order_cols)
    if method == "row_number" and df.groupBy(*g, *o).count().filter("count > 1").limit(1).count():
        raise ValueError("row_number needs unique order keys; add a tie-break")
    if method == "dense":
        cc = cumulative_counts(df.select(*g, *o).distinct(), o, g, blocks=blocks)
        expr = F.col("_before") + 1
    else:
        cc = cumulative_counts(df, o, g, blocks=blocks)
        if method in ("min", "row_number"):
            expr = F.col("_before") + 1
        elif method == "average":
            expr = F.col("_before") + (F.col("_w") + 1) / 2.0
        else:
            raise ValueError(method)
    return cc.select(*g, *o, expr.alias(name), F.col("_w").alias(f"{name}_ties"), F.col("_n").alias(f"{name}_n"))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = (),
                    blocks: int | None = None, weight_col: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (R type 7, SQL
    ``percentile_cont``) per group: columns group…, ``p``, ``q``, ``n``.

    Rank r (0-based) of the sorted values is held by the key whose
    ``_before <= r < _before + _w``; only the at most two keys per (group, p)
    that hold ranks floor(h) and ceil(h), h = (n-1)p, leave the scan.
    """
    g = list(group_cols)
    w = [F.col(weight_col).alias("_qw")] if weight_col else []
    data = df.filter(F.col(value_col).isNotNull()).select(*g, F.col(value_col).alias("_v"), *w)
    cc = cumulative_counts(data, ["_v"], g, weight_col="_qw" if weight_col else None, blocks=blocks)
    targets = F.array(*[F.struct(F.lit(float(p)).alias("p")) for p in probs])
    x = cc.select(*g, "_v", "_w", "_before", "_n", F.explode(targets).alias("_t"))
    h = (F.col("_n") - 1) * F.col("_t.p")
    lo, hi = F.floor(h), F.ceil(h)
    holds = lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_w"))
    x = (x.withColumn("_lo", holds(lo)).withColumn("_hi", holds(hi))
         .filter(F.col("_lo") | F.col("_hi")))
    agg = x.groupBy(*g, F.col("_t.p").alias("p")).agg(
        F.max(F.when(F.col("_lo"), F.col("_v"))).alias("_qlo"),
        F.max(F.when(F.col("_hi"), F.col("_v"))).alias("_qhi"),
        F.max("_n").alias("n"))
    frac = (F.col("n") - 1) * F.col("p") - F.floor((F.col("n") - 1) * F.col("p"))
    return agg.select(*g, "p", (F.col("_qlo") + (F.col("_qhi") - F.col("_qlo")) * frac).alias("q"),
                      F.col("n").cast("long").alias("n"))


def quantile_columns(df: DataFrame, value_col: str, probs: dict[str, float], group_cols: Sequence[str] = (),
                     blocks: int | None = None, weight_col: str | None = None) -> DataFrame:
    """Exact quantiles pivoted to one column per name: group…, n, names…
    (``weight_col``: each row stands for that many equal values)."""
    g = list(group_cols)
    q = exact_quantiles(df, value_col, list(probs.values()), g, blocks, weight_col)
    cols = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(name) for name, p in probs.items()]
    return q.groupBy(*g).agg(F.max("n").alias("n"), *cols)
