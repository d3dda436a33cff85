"""What a fitted linear or logistic model says about its coefficients.

The data are read in one pass that sums weighted cross products of the
predictors (p x p numbers, p the number of coefficients); standard errors come
from inverting that matrix on the driver. ``tidy`` has a row for each
coefficient, ``glance`` one for the model, ``augment`` one for each data row.
"""

from __future__ import annotations

import math
from typing import Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checkpoint import materialize

INTERCEPT = "(Intercept)"


class Inference(NamedTuple):
    """Coefficients (intercept first) with their covariance, and what the model's summary needs."""

    terms: list[str]
    estimate: np.ndarray
    covariance: np.ndarray
    n: int
    log_lik: float
    deviance: float
    null_deviance: float
    family: str
    sigma2: float | None = None
    centre: np.ndarray | None = None
    inverse: np.ndarray | None = None


# ----------------------------------------------------------------- distributions
def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (Lentz)."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    tiny, c = 1e-300, 1.0
    d = 1.0 / (1.0 - (a + b) * x / (a + 1) or tiny)
    out = d
    for m in range(1, 10_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + step * d or tiny)
            c = 1.0 + step / c or tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * out


def t_tail(t: float, df: float) -> float:
    """P(|T| > |t|) for Student's t."""
    return incomplete_beta(df / 2, 0.5, df / (df + t * t)) if math.isfinite(t) else 0.0


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    return incomplete_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f)) if math.isfinite(f) else 0.0


def t_quantile(p: float, df: float) -> float:
    """The value that Student's t stays below with probability ``p``, by bisection of the tail."""
    if p == 0.5:
        return 0.0
    if p < 0.5:
        return -t_quantile(1 - p, df)
    low, high = 0.0, 1.0
    while t_tail(high, df) > 2 * (1 - p):
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if t_tail(mid, df) > 2 * (1 - p) else (low, mid)
    return (low + high) / 2


# ------------------------------------------------------------------------- linear
def linear_model(df: DataFrame, y: str, xs: Sequence[str]) -> Inference:
    """Least squares ``y ~ xs`` of numeric columns; rows with a NULL in any of them are left out.

    Means first, then one pass of centred cross products, so large offsets cost no digits. A predictor that others determine
    gets the smallest coefficients that fit (pseudo-inverse)."""
    cols = [y, *xs]
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(cols)]).dropna()
    p = len(cols)
    first = data.agg(F.count("*"), *[F.avg(f"v{i}") for i in range(p)]).first()
    n, mean = first[0], np.array([first[i + 1] or 0.0 for i in range(p)])
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    off = [F.col(f"v{i}") - F.lit(float(mean[i])) for i in range(p)]
    sums = data.agg(*[F.sum(off[i] * off[j]) for i, j in pairs]).first()
    s = np.zeros((p, p))
    for (i, j), v in zip(pairs, sums):
        s[i, j] = s[j, i] = v or 0.0
    inverse = np.linalg.pinv(s[1:, 1:], hermitian=True)
    slope = inverse @ s[1:, 0]
    rss = max(float(s[0, 0] - slope @ s[1:, 0]), 0.0)
    rest = n - p
    sigma2 = rss / rest if rest > 0 else math.nan
    centre = mean[1:]
    cov = np.zeros((p, p))
    cov[1:, 1:] = sigma2 * inverse
    cov[0, 1:] = cov[1:, 0] = -sigma2 * inverse @ centre
    cov[0, 0] = sigma2 * (1 / max(n, 1) + centre @ inverse @ centre)
    log_lik = -n / 2 * (math.log(2 * math.pi * rss / n) + 1) if n and rss > 0 else math.nan
    return Inference([INTERCEPT, *xs], np.array([mean[0] - slope @ centre, *slope]), cov, n, log_lik, rss, float(s[0, 0]), "gaussian", sigma2, centre, inverse)


# ----------------------------------------------------------------------- logistic
def _information(weights: list[float]):
    """Feature rows (x, label) to one task's sums: the upper triangle of X'WX, and at (-1, 0 .. 2) rows, log-likelihood, ones."""
    beta = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(beta)
        total, n, log_lik, ones = np.zeros((p, p)), 0, 0.0, 0.0
        for batch in batches:
            rows = batch.num_rows
            for at in range(0, rows, 1000):
                part = batch.slice(at, 1000)
                x = np.concatenate([np.ones((part.num_rows, 1)), part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)], axis=1)
                y = part.column(1).to_numpy()
                eta = x @ beta
                prob = 1 / (1 + np.exp(-eta))
                total += x.T @ (x * (prob * (1 - prob))[:, None])
                log_lik += float((y * eta - np.logaddexp(0, eta)).sum())
                n, ones = n + part.num_rows, ones + float(y.sum())
        i, j = np.triu_indices(p)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -1, -1], i]).astype(np.int32)), pa.array(np.concatenate([[0, 1, 2], j]).astype(np.int32)),
                                          pa.array(np.concatenate([[n, log_lik, ones], total[i, j]]))], ["i", "j", "v"])

    return run


def logistic_model(coefficients: Sequence[float], intercept: float, terms: Sequence[str], rows: DataFrame, features: str = "features", label: str = "label") -> Inference:
    """Inference for a fitted logistic regression (without penalty) on the ``rows`` (feature vector, 0/1 label) it was fitted
    on: the Fisher information X'WX is summed in one pass and inverted."""
    beta = [float(intercept), *map(float, coefficients)]
    p = len(beta)
    data = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    sums = data.mapInArrow(_information(beta), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect()  # p x p
    info, beside = np.zeros((p, p)), {}
    for i, j, v in sums:
        if i < 0:
            beside[j] = v
        else:
            info[i, j] = info[j, i] = v
    n, ones = int(beside.get(0, 0)), beside.get(2, 0.0)
    share = ones / n if n else 0.0
    null = n * (share * math.log(share) + (1 - share) * math.log1p(-share)) if 0 < share < 1 else 0.0
    return Inference([INTERCEPT, *terms], np.array(beta), np.linalg.pinv(info, hermitian=True), n, beside.get(1, 0.0), -2 * beside.get(1, 0.0), -2 * null, "binomial")


# ------------------------------------------------------------------------- tables
def tidy(spark: SparkSession, fit: Inference) -> DataFrame:
    """(term, estimate, std_error, statistic, p_value): t tests of a linear, z tests of a logistic model."""
    out = []
    for k, term in enumerate(fit.terms):
        se = math.sqrt(max(fit.covariance[k, k], 0.0)) if math.isfinite(fit.covariance[k, k]) else math.nan
        stat = float(fit.estimate[k]) / se if se > 0 else math.nan
        rest = fit.n - len(fit.terms)
        tail = math.nan if math.isnan(stat) else t_tail(stat, rest) if fit.family == "gaussian" else math.erfc(abs(stat) / math.sqrt(2))
        out.append((term, float(fit.estimate[k]), se, stat, tail))
    return spark.createDataFrame(out, "term string, estimate double, std_error double, statistic double, p_value double")


def glance(spark: SparkSession, fit: Inference) -> DataFrame:
    """One row about the model: n, log-likelihood, AIC, BIC, deviances; of a linear one R squared, sigma and the F test too."""
    p, n = len(fit.terms), fit.n
    free = p + (fit.family == "gaussian")
    row = [fit.family, n, n - p, fit.log_lik, -2 * fit.log_lik + 2 * free, -2 * fit.log_lik + math.log(max(n, 1)) * free, fit.deviance, fit.null_deviance]
    more: list[float | None] = [None] * 5
    if fit.family == "gaussian" and fit.null_deviance > 0 and n > p > 1:
        r2 = 1 - fit.deviance / fit.null_deviance
        f = (fit.null_deviance - fit.deviance) / (p - 1) / fit.sigma2 if fit.sigma2 else math.inf
        more = [r2, 1 - (1 - r2) * (n - 1) / (n - p), math.sqrt(fit.sigma2), f, f_tail(f, p - 1, n - p)]
    return spark.createDataFrame([tuple(row + more)], "family string, n long, df_residual long, log_lik double, aic double, bic double, deviance double, "
                                 "null_deviance double, r_squared double, adj_r_squared double, sigma double, statistic double, p_value double")


def augment(df: DataFrame, y: str, fit: Inference) -> DataFrame:
    """Rows of ``df`` with ``fitted``, ``resid``, ``hat`` (leverage) and ``std_resid`` of a linear model, as column expressions;
    null where a value is missing."""
    xs = [F.col(f"`{c}`").cast("double") for c in fit.terms[1:]]
    fitted = sum((F.lit(float(b)) * x for b, x in zip(fit.estimate[1:], xs)), F.lit(float(fit.estimate[0])))
    off = [x - F.lit(float(c)) for x, c in zip(xs, fit.centre)]
    hat = sum((F.lit(float(fit.inverse[i, j]) * (1 if i == j else 2)) * off[i] * off[j] for i in range(len(off)) for j in range(i, len(off))), F.lit(1.0 / max(fit.n, 1)))
    out = df.withColumn("fitted", fitted).withColumn("resid", F.col(f"`{y}`").cast("double") - F.col("fitted")).withColumn("hat", hat)
    return out.withColumn("std_resid", F.try_divide(F.col("resid"), F.lit(math.sqrt(fit.sigma2)) * F.sqrt(1 - F.col("hat"))))


def training_matrix(model, train: DataFrame) -> DataFrame:
    """The (features, label) rows that a formula pipeline fitted its last stage on, written once."""
    return materialize(model.stages[0].transform(train).select("features", "label"))
