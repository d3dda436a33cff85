"""Inference, orthogonal polynomials and the topic map against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emberstat.operators import inference as inf
from emberstat.operators import polynomials as poly
from emberstat.operators import topics as tp
from emberstat.operators.charts import T_975, stat_density_2d
from tests.conftest import SMALL

Q = entry.queries()


def test_distributions_against_known_values():
    # published quantiles of Student's t
    assert all(inf.t_quantile(0.975, k + 1) == pytest.approx(t, abs=1e-7) for k, t in enumerate(T_975))
    assert inf.t_quantile(0.5, 3) == 0 and inf.t_quantile(0.025, 9) == pytest.approx(-2.2621572, abs=1e-6)
    assert inf.t_tail(1.0, 1) == pytest.approx(0.5) and inf.t_tail(0.0, 5) == pytest.approx(1.0)
    assert inf.f_tail(4.0, 1, 7) == pytest.approx(inf.t_tail(2.0, 7))  # F(1, v) is t(v) squared
    assert inf.incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248)
    assert inf.t_tail(1.96, 1e7) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-5)


def linear_rows(n=400, seed=2):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3)) * [1, 10, 0.1] + [1e5, 3, 0]
    return x, 2 + x @ [0.5, -1, 4] + r.normal(size=n)


def test_linear_model_equals_plain_least_squares(spark):
    x, y = linear_rows()
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)], "a double, b double, c double, y double")
    fit = inf.linear_model(df, "y", ["a", "b", "c"])
    m = np.c_[np.ones(len(y)), x - x.mean(axis=0)]
    slope = np.linalg.solve(m.T @ m, m.T @ y)
    resid = y - m @ slope
    sigma2 = resid @ resid / (len(y) - 4)
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(m.T @ m)))[1:]
    rows = {r.term: r for r in inf.tidy(spark, fit).collect()}
    assert [rows[t].estimate for t in "abc"] == pytest.approx(slope[1:]) and [rows[t].std_error for t in "abc"] == pytest.approx(se)
    raw = np.c_[np.ones(len(y)), x]
    assert rows["(Intercept)"].std_error == pytest.approx(math.sqrt(sigma2 * np.linalg.inv(raw.T @ raw)[0, 0]), rel=1e-4)
    assert all(rows[t].p_value == pytest.approx(inf.t_tail(rows[t].statistic, len(y) - 4)) for t in "abc")
    g = inf.glance(spark, fit).first()
    r2 = 1 - resid @ resid / ((y - y.mean()) ** 2).sum()
    assert (g.n, g.df_residual) == (400, 396) and g.r_squared == pytest.approx(r2) and g.sigma == pytest.approx(math.sqrt(sigma2))
    assert g.log_lik == pytest.approx(-200 * (math.log(2 * math.pi * (resid @ resid) / 400) + 1)) and g.aic == pytest.approx(-2 * g.log_lik + 10)
    assert g.statistic == pytest.approx(r2 / 3 / ((1 - r2) / 396))
    out = inf.augment(df, "y", fit).filter("resid IS NOT NULL").collect()
    hat = np.einsum("ij,jk,ik->i", m, np.linalg.inv(m.T @ m), m)
    assert [r.resid for r in out] == pytest.approx(resid, abs=1e-6) and [r.hat for r in out] == pytest.approx(hat)
    assert [r.std_resid for r in out] == pytest.approx(resid / np.sqrt(sigma2 * (1 - hat)), abs=1e-6)


def test_odd_linear_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0), (2.0, 4.0, 3.0), (3.0, 6.0, 5.0), (4.0, 8.0, 6.0)], "a double, b double, y double")
    fit = inf.linear_model(df, "y", ["a", "b"])  # b = 2 a: the smallest coefficients that fit
    assert fit.estimate[1] + 2 * fit.estimate[2] == pytest.approx(1.4)
    empty = inf.linear_model(df.limit(0), "y", ["a"])
    assert empty.n == 0 and inf.glance(spark, empty).first().r_squared is None
    two = inf.linear_model(df.limit(2), "y", ["a"])
    assert all(math.isnan(r.std_error) for r in inf.tidy(spark, two).collect())


def test_logistic_inference_equals_newtons(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    r = np.random.default_rng(4)
    x = r.normal(size=(800, 2))
    y = (r.random(800) < 1 / (1 + np.exp(-(0.3 + x @ [1.0, -2.0])))).astype(float)
    df = spark.createDataFrame([([float(v) for v in a], float(b)) for a, b in zip(x, y)], "x array<double>, label double").repartition(5)
    rows = df.select(array_to_vector("x").alias("features"), "label")
    lr = LogisticRegression(tol=1e-12, maxIter=200).fit(rows)
    fit = inf.logistic_model(lr.coefficients, lr.intercept, ["a", "b"], rows)
    m, beta = np.c_[np.ones(800), x], np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-m @ beta))
        info = m.T @ (m * (p * (1 - p))[:, None])
        beta = beta + np.linalg.solve(info, m.T @ (y - p))
    t = inf.tidy(spark, fit).collect()
    assert [v.term for v in t] == ["(Intercept)", "a", "b"] and [v.estimate for v in t] == pytest.approx(beta, rel=1e-5)
    assert [v.std_error for v in t] == pytest.approx(np.sqrt(np.diag(np.linalg.inv(info))), rel=1e-5)
    assert all(v.p_value == pytest.approx(math.erfc(abs(v.statistic) / math.sqrt(2))) for v in t)
    g = inf.glance(spark, fit).first()
    ll = (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    assert g.log_lik == pytest.approx(ll, rel=1e-6) and g.aic == pytest.approx(-2 * ll + 6, rel=1e-6) and g.n == 800 and g.r_squared is None
    q = y.mean()
    assert g.null_deviance == pytest.approx(-2 * 800 * (q * math.log(q) + (1 - q) * math.log(1 - q)))


def test_study_coefficients_have_errors(spark):
    plain = {r.term: r.estimate for r in Q["coefficients"](spark, SMALL).collect()}
    rows = Q["logistic_tidy"](spark, SMALL).collect()
    assert {r.term: r.estimate for r in rows} == plain and all(r.std_error > 0 and 0 <= r.p_value <= 1 for r in rows)


# polynomials
@pytest.mark.parametrize("degree", [1, 2, 3, 4, 6])
def test_basis_is_orthonormal_and_spans_the_powers(spark, degree):
    r = np.random.default_rng(degree)
    groups = {"a": r.normal(size=300) * 5 + 1e4, "b": r.integers(0, 40, 500).astype(float), None: r.random(60)}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("a", None)]
    got = poly.poly_basis(spark.createDataFrame(rows, "g string, x double"), "x", degree, ["g"]).collect()
    for g, x in groups.items():
        q = np.array([[v[f"poly{k}"] for k in range(1, degree + 1)] for v in got if v.g == g and v.x is not None])
        xs = np.array([v.x for v in got if v.g == g and v.x is not None])
        assert q.sum(axis=0) == pytest.approx(np.zeros(degree), abs=1e-9) and q.T @ q == pytest.approx(np.eye(degree), abs=1e-7)
        u = (xs - xs.mean()) / xs.std()
        plain, _ = np.linalg.qr(np.vander(u, degree + 1, increasing=True))
        plain = plain * np.sign((plain * np.vander(u, degree + 1, increasing=True)).sum(axis=0))
        assert q == pytest.approx(plain[:, 1:], abs=1e-7)
    assert [v.poly1 for v in got if v.x is None] == [None]


def test_curve_and_band_equal_numpy(spark):
    r = np.random.default_rng(1)
    x = r.random(50) * 4 + 100
    y = np.sin(x) * 10 + r.normal(size=50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    for degree, level in ((1, 0.9), (3, 0.95), (4, 0.99)):
        rows = poly.poly_curve(df, "x", "y", degree, n=9, level=level).orderBy("i").collect()
        u = x - 102
        m = np.vander(u, degree + 1, increasing=True)
        inverse = np.linalg.inv(m.T @ m)
        beta = inverse @ m.T @ y
        rss = ((y - m @ beta) ** 2).sum()
        at = np.vander(np.array([v.x for v in rows]) - 102, degree + 1, increasing=True)
        se = np.sqrt(rss / (50 - degree - 1) * np.einsum("ij,jk,ik->i", at, inverse, at))
        t = inf.t_quantile((1 + level) / 2, 50 - degree - 1)
        assert [v.y for v in rows] == pytest.approx(at @ beta, rel=1e-7) and [v.se for v in rows] == pytest.approx(se, rel=1e-6)
        assert [v.ymax - v.y for v in rows] == pytest.approx(t * se, rel=1e-6)


def test_polynomials_of_few_values(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 3.0), ("b", 5.0, 1.0), ("b", 5.0, 2.0)], "g string, x double, y double")
    got = poly.poly_coefficients(df, "x", 3, ["g"], "y").collect()
    by = {r.g: r for r in got}
    assert by["a"].c1_1 is not None and by["a"].c2_2 is None and by["a"].beta3 is None and by["b"].c1_1 is None
    assert poly.poly_basis(df.limit(0), "x", 2, ["g"]).count() == 0
    assert all(r.ymin is None for r in poly.poly_curve(df, "x", "y", 1, ["g"], n=3).collect())
    with pytest.raises(ValueError):
        poly.poly_basis(df, "x", 0)


def test_t_column_beyond_the_table(spark):
    df = spark.range(1).select(*[poly.t_column(F.lit(v), 0.9).alias(f"v{v}") for v in (0, 1, 200, 201, 5000)]).first()
    assert df.v0 is None and all(df[f"v{v}"] == pytest.approx(inf.t_quantile(0.95, v), abs=1e-9) for v in (1, 200, 201, 5000))


# topic map and densities
def test_topic_map_equals_numpy(spark):
    r = np.random.default_rng(7)
    p = r.dirichlet(np.ones(30) * 0.3, 9)
    k = len(p)
    m = (p[:, None] + p[None]) / 2
    d = 0.5 * ((p[:, None] * np.log(p[:, None] / m)).sum(axis=2) + (p[None] * np.log(p[None] / m)).sum(axis=2))
    rows = [(i, j, float(d[i, j])) for i in range(k) for j in range(i + 1, k)]
    shares = spark.createDataFrame([(i, 1 / k) for i in range(k)], "topic int, proportion double")
    got = {v.topic: v for v in tp.topic_map(spark.createDataFrame(rows, "topic_a int, topic_b int, jsd double"), shares).collect()}
    j = np.eye(k) - 1 / k
    values, vectors = np.linalg.eigh(-0.5 * j @ (d ** 2) @ j)
    order = np.argsort(values)[::-1][:2]
    for at, name in zip(order, ("x", "y")):
        want = vectors[:, at] * math.sqrt(values[at])
        want *= np.sign(want[np.argmax(np.abs(want))])
        assert [got[i][name] for i in range(k)] == pytest.approx(want, abs=1e-8)


def test_density_2d_is_the_plain_double_sum(spark):
    r = np.random.default_rng(3)
    x, y = np.round(r.normal(size=80), 2), np.round(r.exponential(size=80), 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    rows = stat_density_2d(df, "x", "y", n=7, method="exact").collect()

    def h(v):
        q1, q3 = np.percentile(v, [25, 75])
        return 4 * 1.06 * min(v.std(ddof=1), (q3 - q1) / 1.34) * len(v) ** -0.2

    hx, hy = h(x) / 4, h(y) / 4
    assert len(rows) == 49
    for v in rows:
        want = np.exp(-0.5 * (((v.x - x) / hx) ** 2 + ((v.y - y) / hy) ** 2)).sum() / (80 * hx * hy * 2 * math.pi)
        assert v.density == pytest.approx(want, rel=1e-9, abs=1e-16)
