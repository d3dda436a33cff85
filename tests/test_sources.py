"""Sources and sinks."""

import datetime as dt

from pyspark.ml.linalg import Vectors

from emberstat.session import scratch_path
from emberstat.sources.csv import drop_vectors, read_csv, write_csv, write_json_doc
from emberstat.sources.frames import date_spine, describe_schema, from_sql, register


def test_csv_single_file_without_vectors(spark):
    df = spark.createDataFrame([(1, 0.5, Vectors.dense([0.5, 0.5])), (2, 0.9, Vectors.dense([0.1, 0.9]))],
                               ["id", "p", "probability"])
    assert drop_vectors(df).columns == ["id", "p"]
    path = write_csv(df, scratch_path(spark, "csv1"), single_file=True)
    back = read_csv(spark, path, schema="id int, p double")
    assert sorted(map(tuple, back.collect())) == [(1, 0.5), (2, 0.9)]
    assert back.rdd.getNumPartitions() == 1


def test_inferred_csv_and_null_token(spark):
    path = scratch_path(spark, "csv2")
    spark.createDataFrame([("a", "NA"), ("b", "3")], "k string, v string").coalesce(1).write.option(
        "header", True).csv(path)
    df = read_csv(spark, path, null_token="NA")
    assert sorted((r.k, r.v) for r in df.collect()) == [("a", None), ("b", 3)]


def test_describe_schema_and_sql(spark):
    df = register(spark.createDataFrame([(1, "x")], "a long, b string"), "tiny_view")
    assert [tuple(r) for r in describe_schema(df).collect()] == [(1, "a", "bigint"), (2, "b", "string")]
    assert from_sql(spark, "SELECT count(*) AS n FROM tiny_view").first().n == 1


def test_date_spine(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 20),)], "ts timestamp")
    days = [r.day for r in date_spine(df, "ts", 7).collect()]
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 15)]


def test_json_doc_sink(spark):
    import json

    doc = spark.createDataFrame([('{"a": 1}',)], "json string")
    path = write_json_doc(doc, scratch_path(spark, "json"))
    assert json.loads(spark.read.text(path).first().value) == {"a": 1}


def test_scratch_folders_go_at_the_end_of_their_block(spark):
    import os

    from emberstat.operators.checkpoint import materialize
    from emberstat.session import scratch

    def files(df):
        return [f.removeprefix("file://") for f in df.inputFiles()]

    outside = materialize(spark.range(5))
    with scratch(spark):
        inside = materialize(spark.range(7))
        with scratch(spark):
            nested = files(materialize(spark.range(3)))
        assert not any(os.path.exists(f) for f in nested) and inside.count() == 7
        written = files(inside)
    assert not any(os.path.exists(f) for f in written) and outside.count() == 5
