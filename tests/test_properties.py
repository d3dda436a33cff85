"""Property checks for the keys without an exact oracle, and for the
distributed primitives under skew."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emberstat.operators import classify as cl
from emberstat.operators.joins import row_index
from emberstat.operators.ranks import exact_quantiles, rank_keys
from emberstat.operators.sampling import hash_split, sample_n
from tests.conftest import SMALL

Q = entry.queries()


def test_quantiles_hot_group(spark):
    """One group holds most rows; quantiles equal numpy's linear ones."""
    rng = np.random.default_rng(7)
    hot = rng.exponential(3.0, 20000).round(3)
    cold = rng.normal(0, 1, 300).round(3)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {(r.g, r.p): r.q for r in exact_quantiles(df, "v", [0.1, 0.25, 0.5, 0.9], ["g"], blocks=16).collect()}
    for g, vals in (("hot", hot), ("cold", cold)):
        for p in (0.1, 0.25, 0.5, 0.9):
            assert got[(g, p)] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


def test_row_index_consecutive_with_duplicates(spark):
    df = spark.createDataFrame([(k % 50, k % 3) for k in range(1000)], "a long, b long")
    idx = row_index(df, ["a", "b"], "pos").select("pos").collect()
    assert sorted(r.pos for r in idx) == list(range(1, 1001))


def test_dense_rank(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, 3, 9, 1, 5]], "x long")
    got = {r.x: r.rank for r in rank_keys(df, ["x"]).collect()}
    assert got == {1: 1, 3: 2, 5: 3, 9: 4}


def test_auc_matches_evaluator(spark):
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        (F.pmod(F.col("l_orderkey") * 7919, F.lit(100)) / 100.0).alias("p_yes"))
    mine = cl.auc(df).first().auc
    from pyspark.ml.functions import array_to_vector

    ev = cl.auc_evaluator(df.withColumn("probability", array_to_vector(F.array(1 - F.col("p_yes"), "p_yes"))))
    assert mine == pytest.approx(ev, abs=1e-12)


def test_hash_split_disjoint_and_complete(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    parts = hash_split(df, {"training": 0.7, "test": 0.2, "validation": 0.1}, "o_orderkey")
    keys = [set(r.o_orderkey for r in p.select("o_orderkey").collect()) for p in parts.values()]
    assert sum(len(k) for k in keys) == df.count()
    assert not (keys[0] & keys[1]) and not (keys[0] & keys[2]) and not (keys[1] & keys[2])


def test_sample_exact_size_and_reproducible(spark):
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    a = sample_n(df.repartition(3), 100, seed=5, key=["l_orderkey", "l_linenumber"]).collect()
    b = sample_n(df.repartition(11), 100, seed=5, key=["l_orderkey", "l_linenumber"]).collect()
    assert len(a) == 100 and sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_lda_tables_are_distributions(spark):
    theta = Q["lda_theta"](spark, SMALL)
    s = theta.groupBy("doc_id").agg(F.sum("theta").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert s[0] == pytest.approx(1.0, abs=1e-6) and s[1] == pytest.approx(1.0, abs=1e-6)
    phi = Q["lda_phi"](spark, SMALL)
    s = phi.groupBy("topic").agg(F.sum("phi").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert s[0] == pytest.approx(1.0, abs=1e-6) and s[1] == pytest.approx(1.0, abs=1e-6)
    top = Q["lda_top_terms"](spark, SMALL)
    assert top.count() == 20 * 5


def test_lda_trace_and_json(spark):
    tr = Q["lda_trace"](spark, SMALL).orderBy("iteration").collect()
    assert [r.iteration for r in tr] == [2, 4, 6, 8, 10, 12]
    assert all(np.isfinite(r.log_lik) for r in tr)
    js = Q["ldavis_json"](spark, SMALL).first().json
    import json

    doc = json.loads(js)
    assert len(doc["mdsDat"]) == 20 and doc["R"] == 30


def test_models_and_metrics(spark):
    m = Q["metrics_long"](spark, SMALL).collect()
    assert {r.model for r in m} == {"Logistic", "Decision Tree", "Random Forest"}
    assert all(0 <= r.value <= 100 for r in m)
    imp = Q["feature_importance"](spark, SMALL)
    sums = imp.groupBy("Model").agg(F.sum("importance").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0, abs=1e-9) for r in sums)
    sv = Q["score_validation"](spark, SMALL)
    assert sv.columns[-1] == "P_Delayed" and len(sv.columns) == 16


def test_poly_smooth_band_contains_fit(spark):
    rows = Q["poly_smooth"](spark, SMALL).collect()
    assert len(rows) == 2 * 80
    assert all(r.ymin <= r.y <= r.ymax for r in rows)


def test_binned_density_close_to_exact(spark):
    from emberstat.operators.charts import stat_density

    d = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(F.col("l_extendedprice").alias("x"))
    e = {r.i: r.density for r in stat_density(d, "x", n=64, method="exact").collect()}
    b = {r.i: r.density for r in stat_density(d, "x", n=64, method="binned", bin_count=4096).collect()}
    peak = max(e.values())
    assert max(abs(e[i] - b[i]) for i in e) < 1e-3 * peak


def test_hot_group_split_into_blocks_under_aqe(spark):
    """With adaptive block sizing (no fixed block count) a hot group spans
    several blocks and the running counts across blocks stay exact."""
    from pyspark.sql import Window

    from emberstat.operators.ranks import cumulative_counts

    df = spark.range(2_400_000).select(
        F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
        (F.col("id") * 7919 % 1000003).alias("v"))
    cc = cumulative_counts(df, ["v"], ["g"])
    assert cc.filter("g = 'hot'").select("_blk").distinct().count() >= 2
    w = Window.partitionBy("g").orderBy("v")
    ref = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")).withColumn(
        "ref", F.coalesce(F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bad = cc.join(ref, ["g", "v"]).filter(F.col("_before") != F.col("ref")).count()
    assert bad == 0 and cc.count() == ref.count()


def test_pairs_diag_densities_integrate_to_one(spark):
    rows = Q["pairs_diag"](spark, SMALL).collect()
    for v in ("carat", "depth"):
        pts = sorted((r.i, r.x, r.value) for r in rows if r.var == v)
        assert len(pts) == 512
        area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(pts, pts[1:]))
        assert 0.8 < area <= 1.01
    n = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    for c in ("cut", "color", "clarity"):
        assert sum(r.value for r in rows if r.var == c) == n


def test_dtm_summary_arithmetic(spark):
    """Non-zero plus zero cells fill the docs × terms matrix (the recorded
    summary's identity), and the sparse cut keeps terms in > 3 % of docs."""
    s = Q["dtm_summary"](spark, SMALL).first()
    assert s.non_zero + s.zero == s.docs * s.terms
    assert 0 <= s.sparsity_pct <= 100 and s.max_term_length >= 3
    n_docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("lang = 'en'").count()
    dfs = Q["sparse_terms"](spark, SMALL).collect()
    assert dfs and all(r.df > n_docs * 0.03 for r in dfs)


def test_concurrent_fits_equal_sequential_fits(spark):
    from emberstat.operators.checkpoint import materialize
    from emberstat.plans import flights as fl

    p = materialize(fl.prepared(spark, SMALL, keep_key=True))
    train = hash_split(p, {"training": 0.7, "rest": 0.3}, "FlightNum")["training"]
    together = cl.fit_all(train, "IsDepDelayed", fl.FEATURES, num_trees=10)
    fm = together["Logistic"].stages[0]
    x = fm.transform(train).select("features", "label")
    alone = {name: est.fit(x) for name, est in cl.classifiers(10).items()}
    assert list(together["Random Forest"].stages[-1].featureImportances.toArray()) == pytest.approx(
        list(alone["Random Forest"].featureImportances.toArray()), abs=1e-12)
    assert list(together["Logistic"].stages[-1].coefficients) == pytest.approx(
        list(alone["Logistic"].coefficients), abs=1e-9)
