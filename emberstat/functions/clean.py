"""Column functions for dirty values, labels, dates and rounding.

All are built-in Spark expressions (codegen, no Python per row). Spark runs
with ANSI mode on, so numeric casts of text use ``try_cast``: a bad token
becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_num(x: ColumnOrName) -> Column:
    """``as.numeric``: text → double; anything unparsable → NULL."""
    return _c(x).try_cast("double")


def to_str(x: ColumnOrName) -> Column:
    """``as.character``."""
    return _c(x).cast("string")


def if_else(cond: Column, yes, no) -> Column:
    """``ifelse`` as SQL ``CASE``: a NULL condition takes the ``no`` branch."""
    return F.when(cond, yes).otherwise(no)


def clean_trace(x: ColumnOrName, tokens=("T",), missing_value: float = 0.0) -> Column:
    """NULL or a trace token (``"T"``) → ``missing_value``; else the number.
    Other bad tokens (e.g. ``"M"``) become NULL."""
    c = _c(x)
    return if_else(c.isNull() | c.isin(*tokens), F.lit(missing_value), to_num(c))


def na_to_zero(x: ColumnOrName, na_token: str = "NA") -> Column:
    """``ifelse(x != "NA", as.numeric(x), 0)``."""
    c = _c(x)
    return if_else(c != F.lit(na_token), to_num(c), F.lit(0.0))


def binary_label(x: ColumnOrName, threshold: float = 0.0) -> Column:
    """``ifelse(x > threshold, 1, 0)`` as double."""
    return if_else(_c(x) > F.lit(threshold), F.lit(1.0), F.lit(0.0))


def delay_label(x: ColumnOrName, na_token: str = "NA") -> Column:
    """``"NA"`` → 0, then 1 if the delay is positive, else 0."""
    return binary_label(na_to_zero(x, na_token))


def yes_label(x: ColumnOrName, yes: str = "YES") -> Column:
    """1 if the text equals ``yes``, otherwise 0 (NULL included)."""
    return if_else(_c(x) == F.lit(yes), F.lit(1.0), F.lit(0.0))


def parse_date_us(x: ColumnOrName) -> Column:
    """``as.Date(x, "%m/%d/%Y")``: one- or two-digit month and day; an invalid
    date (``2/30/1973``) becomes NULL."""
    return F.try_to_date(_c(x), "M/d/yyyy")


def date_parts(x: ColumnOrName, prefix: str = "") -> list[Column]:
    """Year, Month, DayofMonth of a date as integer columns."""
    d = _c(x)
    return [F.year(d).alias(f"{prefix}Year"), F.month(d).alias(f"{prefix}Month"),
            F.dayofmonth(d).alias(f"{prefix}DayofMonth")]


def make_date_from_parts(month: ColumnOrName, day: ColumnOrName, year: ColumnOrName) -> Column:
    """``as.Date(paste(Month, Day, Year, sep="/"), "%m/%d/%Y")``."""
    return parse_date_us(F.concat_ws("/", _c(month).cast("string"), _c(day).cast("string"),
                                     _c(year).cast("string")))


def round_r(x: ColumnOrName, digits: int = 1) -> Column:
    """R's ``round``: half to even."""
    return F.bround(_c(x), digits)


def knuth_hash32(key: ColumnOrName) -> Column:
    """``(key * 2654435761) mod 2^32`` without 64-bit overflow.

    The key is split into 16-bit halves so every product stays below 2^48;
    the same integer arithmetic runs in any SQL engine, which makes hash
    splits and hash samples checkable outside Spark.
    """
    k = F.pmod(_c(key).cast("long"), F.lit(1 << 32))
    hi = F.floor(k / F.lit(1 << 16)).cast("long")
    lo = F.pmod(k, F.lit(1 << 16))
    a = F.lit(2654435761)
    return F.pmod(F.pmod(hi * a, F.lit(1 << 16)) * F.lit(1 << 16) + lo * a, F.lit(1 << 32))
