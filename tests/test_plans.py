"""Plan-shape checks: the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

Q = entry.queries()


def plan(df) -> str:
    jvm = df.sparkSession._jvm
    return df._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_flagship_pushes_filter_and_prunes_columns(spark):
    p = plan(entry.entry(spark))
    assert "EqualTo(l_returnflag,R)" in p
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = [s for s in schemas if "l_orderkey" in s][0]
    assert set(re.findall(r"(\w+):", lineitem)) == {"l_orderkey", "l_linenumber", "l_extendedprice",
                                                     "l_returnflag", "l_shipdate"}


def test_top_n_limits_before_the_shuffle(spark):
    p = plan(Q["topn_per_group"](spark, SMALL))
    body = p.split("\n\n(")[0]
    # a partial WindowGroupLimit sits below the exchange
    assert body.index("Exchange") < body.rindex("WindowGroupLimit")


@pytest.mark.parametrize("key", ["sample_exact", "scatter_points", "ordered_head"])
def test_limits_plan_as_top_k(spark, key):
    assert "TakeOrderedAndProject" in plan(Q[key](spark, SMALL))


#: Queries of numbered operators that are DataFrame functions only; the others may use Python workers.
NATIVE = ["op3_mixing", "op5_quality", "op8_sharding", "op9_url_rules"]


def test_no_python_in_native_keys(spark):
    keys = [k for k in sorted(entry.oracle_sql()) if not re.match(r"op\d", k)] + [k for k in NATIVE if k in Q]
    python = r"ArrowEvalPython|BatchEvalPython|MapIn(Pandas|Arrow)|FlatMap(Co)?GroupsIn(Pandas|Arrow)|PythonMapIn"
    assert [k for k in keys if re.search(python, plan(Q[k](spark, SMALL)))] == []


def test_join_small_falls_back_to_shuffle_join(spark):
    from emberstat.operators.joins import join_small

    big = spark.range(1000).selectExpr("id % 50 AS k", "id")
    small = spark.range(50).selectExpr("id AS k", "id * 2 AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        guarded = join_small(big, small, "k", max_bytes=10)
        assert "BroadcastExchange" not in plan(guarded)
        allowed = join_small(big, small, "k")
        assert "BroadcastExchange" in plan(allowed)
        assert sorted(map(tuple, guarded.collect())) == sorted(map(tuple, allowed.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
