"""Unit checks of single operators on literal frames."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from emberstat.operators import charts, prep, reshape
from emberstat.sources.frames import literal, seq_frame


def test_literal_recycles_and_rejects_uneven(spark):
    df = literal(spark, {"Shop": ["north", "north", "south", "south"], "Item": ["sales"], "Value": [1.5, 2.25, 7.0, 0.5]})
    assert [r.Item for r in df.collect()] == ["sales"] * 4
    with pytest.raises(ValueError):
        literal(spark, {"a": [1, 2, 3], "b": [1, 2]})


def test_seq_frame_inclusive(spark):
    assert [r.value for r in seq_frame(spark, 100, 500, 100).collect()] == [100, 200, 300, 400, 500]


def test_separate_vector_column(spark):
    df = spark.createDataFrame([(1, Vectors.dense([0.3, 0.7])), (2, Vectors.sparse(2, [1], [0.9]))],
                               ["id", "probability"])
    got = {r.id: r.P_YES for r in prep.separate(df, "probability", {"P_YES": 2}).collect()}
    assert got == {1: 0.7, 2: 0.9}


def test_stack_and_dodge_positions(spark):
    counts = spark.createDataFrame([("a", "x", 2), ("a", "y", 3), ("b", "x", 5)], "cut string, fill string, count long")
    st = {(r.cut, r.fill): (r.ymin, r.ymax) for r in charts.stat_stack(counts, "cut", "fill").collect()}
    assert st == {("a", "y"): (0, 3), ("a", "x"): (3, 5), ("b", "x"): (0, 5)}
    dg = {(r.cut, r.fill): r.xpos for r in reshape.dodge(counts, "cut", "fill", 0.9).collect()}
    assert dg[("a", "x")] == pytest.approx(1 - 0.225) and dg[("a", "y")] == pytest.approx(1 + 0.225)
    assert dg[("b", "x")] == pytest.approx(2.0)


def test_gather_and_reorder(spark):
    wide = spark.createDataFrame([("m1", 80.0, 60.0), ("m2", 70.0, 65.0)], "model string, AUC double, Accuracy double")
    long = reshape.gather(wide, ["model"], ["AUC", "Accuracy"], "metric", "value")
    assert long.count() == 4
    lv = {r.model: r.level for r in reshape.reorder_levels(long, "model", "value").collect()}
    assert lv == {"m2": 1, "m1": 2}  # mean 67.5 < 70


def test_filter_drops_null_on_not_equal(spark):
    df = spark.createDataFrame([("NA",), ("5",), (None,)], "DepTime string")
    assert prep.filter_rows(df, F.col("DepTime") != "NA").count() == 1


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (29.0,)], "x double")
    h = charts.stat_bin(df, "x", 30).orderBy("bin").collect()
    assert len(h) == 30 and h[0]["count"] == 2 and h[-1]["count"] == 1
    assert sum(r["count"] for r in h) == 3 and h[0].xmin == pytest.approx(-0.5)
