"""Ordered series: regular time index, line and path point order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_small, row_index


def ts_index(df: DataFrame, period: str, freq: int = 12, idx: str = "idx", time: str = "time") -> DataFrame:
    """Index of a regular series with ``freq`` periods a year, 12 or a divisor of it (``time(x)``): ``idx`` = periods
    since the first one, ``time = start + idx / freq`` with start = year + (month-1)/12 of the first period.
    Arithmetic on the date itself — no window over the series."""
    if freq < 1 or 12 % freq:
        raise ValueError("freq is 12 or a divisor of it")
    start = df.agg(F.min(period).alias("_p0"))
    months = (F.year(period) - F.year("_p0")) * 12 + F.month(period) - F.month("_p0")
    i = F.floor(months / (12 // freq)).cast("long")
    t = F.year("_p0") + (F.month("_p0") - 1) / 12.0 + i / float(freq)
    return join_small(df, start, how="cross", on=None, bounded=True).select(
        *df.columns, i.alias(idx), t.alias(time))


def stat_line(df: DataFrame, x: str, y: str, pos: str = "pos") -> DataFrame:
    """``geom_line``: points connected in x order (position by x, then y)."""
    return row_index(df.select(x, y), [x, y], pos)


def stat_path(df: DataFrame, order: str, x: str, y: str, pos: str = "pos") -> DataFrame:
    """``geom_path``: points connected in data order given by ``order``."""
    cols = list(dict.fromkeys([order, x, y]))
    return row_index(df.select(*cols), [order], pos)
