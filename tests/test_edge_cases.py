"""Inputs that the test tables lack: NULL groups, offsets, odd text, equal rows, small samples."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emberstat.functions.stem import stem
from emberstat.operators import charts, classify as cl, prep, reshape, series, text as tx
from emberstat.operators.joins import join_small, row_index
from emberstat.operators.ranks import rank_keys
from emberstat.operators.sampling import sample_n
from emberstat.sources import csv as csvio
from emberstat.sources.frames import read_docs, seq_frame
from tests.conftest import SMALL

Q = entry.queries()


@pytest.fixture(scope="module")
def grouped(spark):
    """(g, x, y) with a NULL group of its own and NULL values."""
    rng = np.random.default_rng(3)
    rows = [(g, float(x), float(2 + 3 * x - x * x + e)) for g in ("a", "b", None) for x, e in zip(rng.uniform(0, 4, 60), rng.normal(0, 0.1, 60))]
    return spark.createDataFrame([*rows, ("a", None, 1.0), (None, 1.0, None)], "g string, x double, y double").cache()


def test_null_group_in_histogram_and_box(grouped):
    h = charts.stat_bin(grouped, "x", 10, by=["g"]).groupBy("g").agg(F.sum("count").alias("n")).collect()
    assert {r.g: r.n for r in h} == {"a": 60, "b": 60, None: 61}
    pdf = grouped.dropna(subset=["y"]).collect()
    for r in charts.box_stats(grouped, "g", "y").collect():
        assert r.middle == pytest.approx(float(np.median([p.y for p in pdf if p.g == r.g]))) and r.n == (61 if r.g == "a" else 60)
    assert {r.g for r in charts.box_outliers(grouped.unionByName(grouped.select(F.lit(None).cast("string").alias("g"), "x", F.lit(1e6).alias("y")).limit(1)), "g", "y").collect()} >= {None}


def test_null_group_in_density_and_regression(grouped):
    d = charts.stat_density(grouped, "x", by=["g"], n=64).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in d} == {"a": 64, "b": 64, None: 64}
    fit = {r.g: r for r in charts.poly_fit(grouped, "x", "y", ["g"]).collect()}
    assert set(fit) == {"a", "b", None}
    assert all(r.b0 == pytest.approx(2, abs=0.2) and r.b2 == pytest.approx(-1, abs=0.1) for r in fit.values())
    assert charts.poly_smooth(grouped, "x", "y", ["g"]).filter("g IS NULL AND ymin <= y").count() == 80


def test_null_level_in_dodge_reorder_and_facets(spark):
    counts = spark.createDataFrame([("a", "x", 2), (None, "x", 3), ("b", "x", 5)], "cut string, fill string, count long")
    assert {r.cut: r.x_level for r in reshape.dodge(counts, "cut", "fill").collect()} == {"a": 1, "b": 2, None: 3}
    assert {r.cut: r.level for r in reshape.reorder_levels(counts, "cut", "count").collect()} == {"a": 1, None: 2, "b": 3}
    assert {r.cut: r.panel for r in charts.facet_panels(counts, "cut").collect()} == {"a": 1, "b": 2, None: 3}


@pytest.mark.parametrize("n,rows,cols", [(1, 1, 1), (3, 1, 3), (4, 2, 2), (5, 2, 3), (6, 2, 3), (7, 3, 3), (10, 3, 4), (12, 3, 4), (13, 4, 4)])
def test_facet_layout(spark, n, rows, cols):
    got = charts.facet_panels(spark.range(n), "id").agg(F.max("row"), F.max("col")).first()
    assert tuple(got) == (rows, cols)


def test_regression_with_a_large_offset(spark):
    rng = np.random.default_rng(1)
    x, e = rng.uniform(0, 10, 200), rng.normal(0, 1, 200)
    df = spark.createDataFrame([(float(a), float(1e9 + b)) for a, b in zip(x, e)], "x double, y double")
    want = np.polyfit(x, e, 2, full=True)[1][0] / 197
    assert charts.poly_fit(df, "x", "y").first().sigma2 == pytest.approx(want, rel=1e-4)
    assert charts.poly_smooth(df, "x", "y").filter("ymin < y AND y < ymax").count() == 80


def test_t_quantile_published_values(spark):
    want = {1: 12.7062, 2: 4.3027, 3: 3.1824, 5: 2.5706, 10: 2.2281, 30: 2.0423, 40: 2.0211, 60: 2.0003, 120: 1.9799, 1000: 1.9623}
    got = spark.createDataFrame([(k,) for k in [0, *want]], "v long").select("v", charts.t_quantile_975(F.col("v")).alias("t")).collect()
    assert {r.v: r.t and round(r.t, 4) for r in got} == {0: None} | want


def test_density_binned_stays_within_its_stated_bound(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v),) for v in rng.exponential(1000, 3000)], "x double")
    exact = {r.i: r for r in charts.stat_density(df, "x", n=64, method="exact").collect()}
    bw = charts.bandwidth_nrd0(df, "x").first().bw
    lo, hi = df.agg(F.min("x"), F.max("x")).first()
    bound = ((hi - lo) / 2047) ** 2 / (8 * np.sqrt(2 * np.pi) * bw ** 3)
    assert max(abs(r.density - exact[r.i].density) for r in charts.stat_density(df, "x", n=64).collect()) <= bound


def test_bandwidth_of_constant_groups(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", 0.0), ("b", 0.0)], "g string, x double")
    got = {r.g: r.bw for r in charts.bandwidth_nrd0(df, "x", ["g"]).collect()}
    assert got == {"a": pytest.approx(0.9 * 5 * 2 ** -0.2), "b": pytest.approx(0.9 * 2 ** -0.2)}


def test_models_come_back_as_they_were(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from emberstat.sources.models import load_model, save_model

    df = spark.createDataFrame([(float(i % 3 > 0), float(i % 7), "ab"[i % 2]) for i in range(60)], "y double, x double, c string")
    model = cl.fit_all(df, "y", ["x", "c"], only=["Logistic"])["Logistic"]
    back = load_model(PipelineModel, save_model(model, str(tmp_path / "m")))
    assert cl.score(back, df, ["x"]).drop("probability").collect() == cl.score(model, df, ["x"]).drop("probability").collect()


def test_database_and_schema(spark):
    from emberstat.sources.frames import describe_schema, use_database

    use_database(spark, "default")
    assert spark.catalog.currentDatabase() == "default"
    got = describe_schema(spark.createDataFrame([(1, "x")], "a long, b string")).collect()
    assert [tuple(r) for r in got] == [(1, "a", "bigint"), (2, "b", "string")]


def test_quarterly_series_and_sequences(spark):
    df = spark.createDataFrame([(f"200{y}-{m:02d}-01",) for y in (0, 1) for m in (1, 4, 7, 10)], "d string").select(F.to_date("d").alias("d"))
    got = series.ts_index(df, "d", freq=4).orderBy("d").collect()
    assert [r.idx for r in got] == list(range(8)) and [r.time for r in got] == [2000 + k / 4 for k in range(8)]
    with pytest.raises(ValueError):
        series.ts_index(df, "d", freq=5)
    assert [r.value for r in seq_frame(spark, 10, 1, -3).collect()] == [10, 7, 4, 1]


def test_samples_follow_the_seed_and_split_equal_rows(spark):
    df = spark.range(10_000).select((F.col("id") % 10).alias("v"), "id")
    one, two = ({r.id for r in sample_n(df, 1000, seed=s, key=["id"]).collect()} for s in (1, 2))
    assert len(one) == len(two) == 1000 and len(one & two) < 200 and len({i + 1 for i in one} & two) < 200
    values = Counter(r.v for r in sample_n(df.select("v"), 500, seed=3).collect())
    assert sum(values.values()) == 500 and len(values) == 10


def test_sort_keeps_equal_rows_and_ranks_refuse_them(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k long, v string")
    assert [r.k for r in prep.arrange(df, F.desc("k"), "v").collect()] == [2, 1, 1]
    assert sorted(r.pos for r in row_index(df, ["k"], "pos").collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        rank_keys(df, ["k", "v"], method="row_number")


def test_a_run_of_equal_rows_is_split(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(F.lit(7)).alias("k")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = row_index(df, ["k"], "pos")
        assert ranged.agg(F.countDistinct("pos"), F.max("pos")).first()[:] == (40_000, 40_000)
        keys = ["k", "_row"]
        parts = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(16, *keys).groupBy(F.spark_partition_id()).count().collect()
        assert max(p["count"] for p in parts) <= 2 * 40_000 / len(parts)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dummy_names_do_not_collide(spark):
    df = spark.createDataFrame([("A-B", "x"), ("A B", "y"), ("C", "z")], "c string, d string")
    out = cl.dummy_encode(df, ["c", "d"])
    assert out.columns == ["c", "d", "c_A_B", "c_A_B_2", "d_x", "d_y"]
    assert {r.c: (r.c_A_B, r.c_A_B_2, r.d_x) for r in out.collect()} == {"A B": (1, 0, 0), "A-B": (0, 1, 1), "C": (0, 0, 0)}


def test_csv_keeps_text(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([" lead", "trail ", "", None, "a\nb", 'say "hi"', "x,y\\", " "])]
    df = spark.createDataFrame(rows, "id long, t string")
    path = csvio.write_csv(df, str(tmp_path / "t"), single_file=True)
    back = csvio.read_csv(spark, path, schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows
    with pytest.raises(ValueError):
        csvio.drop_vectors(df.withColumn("a", F.array("t")))


def test_docs_without_ids_get_some(spark, tmp_path):
    spark.createDataFrame([("b",), ("a",), ("b",)], "text string").write.parquet(str(tmp_path / "d"))
    assert sorted((r.doc_id, r.text) for r in read_docs(spark, str(tmp_path / "d"), "parquet").collect()) == [(1, "a"), (2, "b"), (3, "b")]


def test_wide_text_lookup_is_not_broadcast(spark):
    wide = spark.range(200).select("id", F.repeat(F.lit("x"), 2000).alias("text"))
    plan = lambda limit: join_small(spark.range(1000), wide, "id", max_bytes=limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(1 << 20) and "broadcast" not in plan(200 * 2000)


@pytest.fixture(scope="module")
def stems(spark):
    """Stemmed term counts of the English documents, recounted in plain Python."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").filter("lang = 'en'").collect()}
    out, stop = {}, set(tx.STOPWORDS)
    for d, t in docs.items():
        clean = re.sub("[0-9]", "", re.sub(r"[!-/:-@\[-`{-~]", "", t.lower()))
        words = Counter(stem(w) for w in clean.split() if w not in stop)
        out[d] = {w: n for w, n in words.items() if len(w) >= 3}
    df = Counter(w for ws in out.values() for w in ws)
    kept = {w for w, n in df.items() if n > len(docs) * (1 - 0.97)}
    return out, df, kept, {d: {w: n for w, n in ws.items() if w in kept} for d, ws in out.items()}


def test_stemmed_matrix_and_totals(spark, stems):
    dtm, df, kept, cut = stems
    cut = {d: ws for d, ws in cut.items() if ws}
    freq = Counter()
    for ws in cut.values():
        freq.update(ws)
    get = lambda key: [tuple(r) for r in Q[key](spark, SMALL).collect()]
    assert sorted(get("stemmed_document_term_matrix")) == sorted((d, w, n) for d, ws in dtm.items() for w, n in ws.items())
    assert sorted(get("stemmed_sparse_terms")) == sorted((w, df[w]) for w in kept)
    assert sorted(get("stemmed_vocabulary")) == [(i + 1, w) for i, w in enumerate(sorted(kept))]
    assert sorted(get("stemmed_nonempty_docs")) == sorted((d, len(ws)) for d, ws in cut.items())
    assert sorted(get("stemmed_doc_lengths")) == sorted((d, sum(ws.values())) for d, ws in cut.items())
    assert dict(get("stemmed_term_frequency")) == dict(freq)
    top = sorted(freq.items(), key=lambda x: (-x[1], x[0]))[:30]
    assert sorted(get("stemmed_top_words"), key=lambda r: r[2]) == [(w, n, i + 1) for i, (w, n) in enumerate(top)]
    cells = sum(map(len, cut.values()))
    assert get("stemmed_summary")[0][:4] == (len(cut), len(kept), cells, len(cut) * len(kept) - cells)


def test_keys_without_oracle_run_and_mean_something(spark):
    n = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert abs(Q["sample_fraction"](spark, SMALL).count() - 0.1 * n) < 0.03 * n
    sizes = {r.part: r.n for r in Q["random_split"](spark, SMALL).collect()}
    total = sum(sizes.values())
    assert all(abs(sizes[k] / total - w) < 0.08 for k, w in {"training": 0.7, "test": 0.2, "validation": 0.1}.items())
    for key in ("fit_logistic", "fit_tree", "fit_forest"):
        r = Q[key](spark, SMALL).first()
        assert r.used_rows == r.train_rows - r.dropped_rows > 0 and 0.5 < r.train_auc <= 1 and 0 < r.used_features <= r.n_features
        assert key != "fit_logistic" or r.mean_p == pytest.approx(r.mean_label, abs=0.01)
        assert key == "fit_logistic" or r.nodes > 1
    scored = Q["score_all_models"](spark, SMALL)
    assert scored.select("model").distinct().count() == 3 and scored.filter("p_yes < 0 OR p_yes > 1").count() == 0
    assert Q["model_save_load"](spark, SMALL).filter("p_yes BETWEEN 0 AND 1").count() > 0
    assert {r.term for r in Q["coefficients"](spark, SMALL).collect()} >= {"(Intercept)"}


def test_topic_keys_run_and_the_bound_rises(spark):
    trace = [r.log_lik for r in Q["lda_trace"](spark, SMALL).orderBy("iteration").collect()]
    assert len(trace) == 6 and trace[-1] > trace[0] and sum(b >= a - abs(a) * 1e-3 for a, b in zip(trace, trace[1:])) == 5
    fit = Q["lda_fit"](spark, SMALL).first()
    assert fit.k == 20 and fit.docs > 0 and fit.log_lik < 0 < fit.log_perplexity
    sweep = Q["lda_sweep_k"](spark, SMALL).collect()
    assert [r.k for r in sweep] == [5, 10, 20] and all(np.isfinite(r.log_lik) for r in sweep)
    docs = Q["docs_for_topic"](spark, SMALL).groupBy("topic").agg(F.count("*").alias("n"), F.min("theta").alias("t")).collect()
    assert len(docs) == 20 and all(r.n == 5 and r.t > 0 for r in docs)
    points = Q["topic_map"](spark, SMALL).collect()
    assert len(points) == 20 and sum(p.proportion for p in points) == pytest.approx(1)
    assert Q["model_round_trip"](spark, SMALL).count() == 100


def test_one_large_row_group_is_tokenised_by_all_tasks(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    monkeypatch.setattr(tx, "TASK_DOCS", 500)
    ids = [None, None, 7, 7, *range(10, 2006)]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": [f"apple pear{i % 3} plum" for i in range(2000)]}), str(tmp_path / "one.parquet"))
    corpus = spark.read.parquet(str(tmp_path / "one.parquet"))
    spread, n = tx.dealt(corpus)
    held = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert n == 2000 == sum(held) and len(held) == 4 and max(held) <= 600
    assert sorted(map(str, spread.collect())) == sorted(map(str, corpus.collect()))
    got = tx.sparse_document_term_matrix(corpus, 0.97, stemming=False)
    want = tx.document_term_matrix(corpus, stemming=False)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    few = corpus.limit(300)
    assert tx.dealt(few) == (few, 300) and tx.dealt(corpus.filter("doc_id < 0"))[1] == 0


@pytest.mark.parametrize("key", ["lda_theta", "docs_for_topic", "topic_map"])
def test_reading_a_topic_table_again_infers_nothing_again(spark, key):
    assert "UDF" not in Q[key](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_explorer_document_is_whole(spark):
    import json

    doc = json.loads(Q["ldavis_json"](spark, SMALL).first().json)
    assert {"mdsDat", "topic_order", "tinfo", "default_terms", "token_table", "top_terms", "R", "lambda_step"} <= set(doc)
    share = {d["topic"]: d["proportion"] for d in doc["mdsDat"]}
    assert [share[t] for t in doc["topic_order"]] == sorted(share.values(), reverse=True)
    assert len(doc["default_terms"]) == 30 and doc["default_terms"][0]["saliency"] >= doc["default_terms"][-1]["saliency"]
    spread = Counter()
    for t in doc["token_table"]:
        spread[t["term"]] += t["freq"]
    assert all(v == pytest.approx(1, abs=1e-6) for v in spread.values())
    assert all(np.isfinite(t["logprob"]) and np.isfinite(t["loglift"]) for t in doc["tinfo"])
