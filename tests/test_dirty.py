"""Literal mini-fixtures for the dirty-value rules."""

import datetime as dt

from pyspark.sql import functions as F

from emberstat.functions.clean import (binary_label, clean_trace, if_else, na_to_zero, parse_date_us,
                                       yes_label)
from emberstat.operators.prep import mutate
from emberstat.session import scratch_path
from emberstat.sources.csv import read_csv_many


def test_us_dates(spark):
    df = spark.createDataFrame([("5/1/1973",), ("05/01/1973",), ("2/30/1973",), (None,)], "d string")
    got = [r.x for r in df.select(parse_date_us("d").alias("x")).collect()]
    assert got == [dt.date(1973, 5, 1), dt.date(1973, 5, 1), None, None]


def test_trace_tokens(spark):
    df = spark.createDataFrame([(None,), ("T",), ("0.12",), ("M",)], "p string")
    got = [r.x for r in df.select(clean_trace("p").alias("x")).collect()]
    assert got == [0.0, 0.0, 0.12, None]


def test_na_delay_and_label_read_new_value(spark):
    df = spark.createDataFrame([("5",), ("-5",), ("NA",), (None,)], "DepDelay string")
    out = mutate(df, ("DepDelay", na_to_zero("DepDelay")), ("IsDepDelayed", binary_label("DepDelay")))
    got = [(r.DepDelay, r.IsDepDelayed) for r in out.collect()]
    assert got == [(5.0, 1.0), (-5.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_single_withcolumns_would_read_old_value(spark):
    """Why mutate chains: a one-shot projection reads the input column."""
    df = spark.createDataFrame([("-5",)], "DepDelay string")
    wrong = df.withColumns({"DepDelay": F.lit(7.0), "IsDepDelayed": binary_label(F.col("DepDelay").try_cast("double"))})
    assert wrong.first().IsDepDelayed == 0.0


def test_if_else_null_condition_takes_else(spark):
    df = spark.createDataFrame([(None,), (3.0,)], "x double")
    got = [r.y for r in df.select(if_else(F.col("x") > 1, F.lit("a"), F.lit("b")).alias("y")).collect()]
    assert got == ["b", "a"]


def test_yes_label(spark):
    df = spark.createDataFrame([("YES",), ("NO",), (None,)], "s string")
    assert [r.y for r in df.select(yes_label("s").alias("y")).collect()] == [1.0, 0.0, 0.0]


def test_mixed_type_year_files_union(spark):
    """One year holds "NA" in DepDelay, the other only numbers: with one
    all-text schema both read and bind; cleaning happens afterwards."""
    base = scratch_path(spark, "years")
    a, b = f"{base}/2007", f"{base}/2008"
    spark.createDataFrame([(2007, "NA"), (2007, "3")], "Year int, DepDelay string").write.option(
        "header", True).csv(a)
    spark.createDataFrame([(2008, 4), (2008, -1)], "Year int, DepDelay int").write.option("header", True).csv(b)
    u = read_csv_many(spark, [a, b], schema="Year int, DepDelay string")
    got = sorted((r.Year, r.d) for r in u.select("Year", na_to_zero("DepDelay").alias("d")).collect())
    assert got == [(2007, 0.0), (2007, 3.0), (2008, -1.0), (2008, 4.0)]


def test_read_docs_one_per_file(spark):
    import os

    from emberstat.sources.frames import read_docs

    base = scratch_path(spark, "docs")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local)
    texts = {"a.txt": "First review.\nTwo lines.", "b.txt": "Second", "c.txt": "Third one"}
    for name, t in texts.items():
        with open(os.path.join(local, name), "w") as fh:
            fh.write(t)
    got = sorted((r.doc_id, r.text) for r in read_docs(spark, base).collect())
    assert got == [(1, texts["a.txt"]), (2, "Second"), (3, "Third one")]


def test_left_join_rejects_duplicate_lookup_keys(spark):
    import pytest

    from emberstat.operators.joins import left_join

    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, w double")
    with pytest.raises(ValueError):
        left_join(a, b, ["k"])
    ok = left_join(a, spark.createDataFrame([(1, 1.0)], "k int, w double"), ["k"])
    assert sorted((r.k, r.w) for r in ok.collect()) == [(1, 1.0), (2, None)]
