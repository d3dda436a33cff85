"""Joins and row binds.

Broadcast policy: a side is broadcast only when its size is bounded — either
by a parameter (a grid of ``n`` points, 30 bins, a stop list) passed as
``bounded=True``, or by a measured row count after the side has been
materialised in the shared checkpoint folder. Otherwise the join is left to
Catalyst/AQE (sort-merge with skew-partition splitting, or a broadcast that
AQE picks at run time from the real shuffle size).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .checkpoint import is_written, materialize

BROADCAST_MAX_BYTES = 64 * 1024 * 1024
#: Bytes of a row beside its values.
ROW_OVERHEAD = 16

_WIDTH = {"integer": 4, "float": 4, "date": 4, "short": 2, "byte": 1, "boolean": 1, "decimal": 16}


def _value_bytes(f: T.StructField) -> Column:
    """Bytes of one value: the fixed width of its type, or the length of the text it holds (nested values as text)."""
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
    return F.lit(_WIDTH.get(f.dataType.typeName(), 8))


def measured_bytes(df: DataFrame) -> Column:
    """Aggregate: bytes of all rows, from the values themselves."""
    return F.sum(sum((_value_bytes(f) for f in df.schema.fields), F.lit(ROW_OVERHEAD)).cast("long"))


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys in which NULL equals NULL; keys appear once, from the left side."""
    keys = {k: f"_right_{i}" for i, k in enumerate(on)}
    r = right.select(*[F.col(f"`{c}`").alias(keys.get(c, c)) for c in right.columns])
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(v)) for k, v in keys.items()]
    return left.join(r, cond, how).drop(*keys.values())


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", bounded: bool = False,
               unique_on: Sequence[str] | None = None, max_bytes: int = BROADCAST_MAX_BYTES,
               null_safe: bool = False) -> DataFrame:
    """Join ``big`` with a side expected to be small.

    ``bounded=True``: the caller guarantees the size (parameter-sized table) and it is broadcast. Otherwise the
    small side is written once to the shared checkpoint folder (unless it is only read from files) and its bytes are
    measured there (lengths of texts included); it is broadcast only under ``max_bytes``, above that the join stays a
    shuffle join (with adaptive skew-partition splitting). This runs jobs while the plan is built. ``unique_on`` additionally checks that the
    small side has one row per key. ``null_safe``: a NULL key equals a NULL key (group keys).
    """
    if not bounded:
        if not is_written(small):
            small = materialize(small)
        size = small.agg(measured_bytes(small)).first()[0] or 0
        if unique_on:
            most = small.groupBy(*unique_on).count().agg(F.max("count")).first()[0]
            if most is not None and most > 1:
                raise ValueError(f"lookup side is not unique on {list(unique_on)}")
        bounded = size <= max_bytes
    if bounded:
        small = F.broadcast(small)
    return join_null_safe(big, small, on, how) if null_safe and on else big.join(small, on=on, how=how)


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str], unique_right: bool = True,
              **kw) -> DataFrame:
    """Left outer equi-join on same-named keys; keys appear once.

    With ``unique_right`` (the usual lookup table case, e.g. one weather row
    per day) rows of ``left`` are never multiplied; duplicated right keys
    raise instead of silently multiplying rows.
    """
    return join_small(left, right, list(on), "left", unique_on=list(on) if unique_right else None, **kw)


def semi_in(df: DataFrame, keep: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``x %in% keep``: rows of ``df`` whose key occurs in ``keep``; never
    duplicates rows (left-semi join)."""
    return df.join(keep, on=on, how="left_semi")


def bind_rows_labelled(frames: dict[str, DataFrame], label: str = "Model") -> DataFrame:
    """Row-bind named frames, tagging each row with its frame's name."""
    from ..sources.csv import bind_rows

    return bind_rows(df.withColumn(label, F.lit(name)) for name, df in frames.items())


def row_index(df: DataFrame, order_cols: Sequence[str], name: str = "row_index") -> DataFrame:
    """1-based position of each row under ``order_cols``, ties broken by the
    remaining columns (equal positions could only go to identical rows,
    and those get consecutive ones). A row id is the last sort key, so that
    the range partitioning can cut a run of equal rows.

    One range shuffle: rows are range-partitioned and sorted inside each
    partition, each row's place inside its partition is read from
    ``monotonically_increasing_id`` (partition id in the high bits), and
    the copy is written once so those ids are fixed. Partition offsets come
    from a table with one row per partition. No global window and no
    single task sees more than one partition.
    """
    keys = list(order_cols) + [c for c in df.columns if c not in order_cols]
    keys = [F.col(f"`{c}`") for c in keys] + [F.col("_row")]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    tagged = materialize(ranged.drop("_row").withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright("_mid", 33)
    counts = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_c"))
    # one row per partition: the ordered window runs over the partition count only
    offsets = counts.select("_pid", F.coalesce(F.sum("_c").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = join_small(tagged.withColumn("_pid", pid), offsets, on="_pid", bounded=True)  # a row for each shuffle partition
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return out.select(*df.columns, (F.col("_off") + local + 1).alias(name))


def bind_cols(a: DataFrame, b: DataFrame, order_a: Sequence[str], order_b: Sequence[str]) -> DataFrame:
    """Column bind: n-th row of ``a`` beside the n-th row of ``b`` under an
    explicit order for each side (a full join on the row position)."""
    ia = row_index(a, order_a, "_pos")
    ib = row_index(b, order_b, "_pos")
    return ia.join(ib, on="_pos", how="full")
