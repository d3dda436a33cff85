"""Orthogonal polynomials of any degree per group, and fits on them.

The basis of a group follows from the moments of its x by the three-term
recurrence: one pass for centre and spread, one for the sums of powers (and of
y times powers), whatever the degree. Everything behind is arithmetic on one row
a group. Basis columns are orthonormal over the group's rows, so a fit needs no
matrix: its coefficients are sums, its variance adds up squares.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .inference import t_quantile
from .joins import join_small


def _dot(a: list[Column], b: list[Column], moment: str, shift: int = 0) -> Column:
    """Sum over the rows of the product of two polynomials (coefficients of rising powers), times u^shift."""
    terms = [x * y * F.col(f"{moment}{i + j + shift}") for i, x in enumerate(a) for j, y in enumerate(b)]
    return sum(terms[1:], terms[0])


def poly_coefficients(df: DataFrame, x: str, degree: int, by: Sequence[str] = (), y: str | None = None) -> DataFrame:
    """One row per group: by..., ``n``, ``centre``, ``spread``, ``xmin``, ``xmax``, and for k = 1 .. ``degree`` the coefficients
    ``c<k>_<j>`` of u^j, u = (x - centre) / spread, of the k-th orthonormal polynomial; its leading one is positive. With ``y``
    also ``ybar``, ``syy`` and ``beta<k>``, the coefficients of the fit y ~ poly(x, degree).

    NULL x (and y) are left out. A group with no more distinct x than ``degree`` has NULL where a polynomial doesn't exist."""
    if degree < 1:
        raise ValueError("degree must be at least 1")
    by, used = list(by), [x] + ([y] if y else [])
    data = df.select(*[F.col(f"`{b}`").alias(b) for b in by], *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(used, ("_x", "_y"))]).dropna(subset=["_x", "_y"][: len(used)])
    first = [F.avg("_x").alias("centre"), F.min("_x").alias("xmin"), F.max("_x").alias("xmax"), *([F.avg("_y").alias("ybar")] if y else [])]
    means = data.groupBy(*by).agg(*first)
    spread = F.greatest(F.col("xmax") - F.col("centre"), F.col("centre") - F.col("xmin"))
    means = means.withColumn("spread", F.when(spread > 0, spread).otherwise(F.lit(1.0)))
    d = join_small(data, means, on=by, null_safe=True) if by else join_small(data, means, how="cross", on=None, bounded=True)
    d = d.withColumn("_u", (F.col("_x") - F.col("centre")) / F.col("spread"))
    power = [F.lit(1.0)]
    for _ in range(2 * degree + 1):
        power.append(power[-1] * F.col("_u"))
    sums = [F.sum(p).alias(f"m{k}") for k, p in enumerate(power)]
    if y:
        off = F.col("_y") - F.col("ybar")
        sums += [F.sum(power[k] * off).alias(f"t{k}") for k in range(degree + 1)] + [F.sum(off * off).alias("syy")]
    kept = ["centre", "spread", "xmin", "xmax", *(["ybar"] if y else [])]
    s = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in kept], *sums)
    # p(k+1) = (u - a) p(k) - (|p(k)|^2 / |p(k-1)|^2) p(k-1); each step's numbers become columns for the next
    polys, s = [[F.lit(1.0)]], s.withColumn("w0", F.col("m0"))
    exists = F.lit(True)
    for k in range(degree):
        now = polys[k]
        s = s.withColumn("_a", F.try_divide(_dot(now, now, "m", 1), F.col(f"w{k}")))
        new = [F.lit(0.0), *now]
        new = [c - F.col("_a") * now[j] if j < len(now) else c for j, c in enumerate(new)]
        if k:
            ratio = F.try_divide(F.col(f"w{k}"), F.col(f"w{k - 1}"))
            new = [c - ratio * polys[k - 1][j] if j < len(polys[k - 1]) else c for j, c in enumerate(new)]
        s = s.withColumns({f"p{k + 1}_{j}": c for j, c in enumerate(new)}).drop("_a")
        polys.append([F.col(f"p{k + 1}_{j}") for j in range(k + 2)])
        s = s.withColumn(f"w{k + 1}", _dot(polys[-1], polys[-1], "m"))
        # a vanishing square, next to what rounding leaves, is no polynomial
        exists = exists & (F.col(f"w{k + 1}") > F.col("m0") * 1e-13)
        s = s.withColumn(f"e{k + 1}", exists)
        exists = F.col(f"e{k + 1}")
    out = [*by, "n", *kept]
    for k in range(1, degree + 1):
        norm = F.when(F.col(f"e{k}"), F.sqrt(f"w{k}"))
        out += [(c / norm).alias(f"c{k}_{j}") for j, c in enumerate(polys[k])]
        if y:
            out.append((sum((c * F.col(f"t{j}") for j, c in enumerate(polys[k])), F.lit(0.0)) / norm).alias(f"beta{k}"))
    return s.select(*out, *(["syy"] if y else []))


def _values(u: Column, degree: int) -> list[Column]:
    """The polynomials 1 .. degree at u (Horner)."""
    out = []
    for k in range(1, degree + 1):
        v = F.col(f"c{k}_{k}")
        for j in range(k - 1, -1, -1):
            v = v * u + F.col(f"c{k}_{j}")
        out.append(v)
    return out


def poly_basis(df: DataFrame, x: str, degree: int, by: Sequence[str] = (), prefix: str = "poly") -> DataFrame:
    """``df`` with the columns ``<prefix>1`` ... of the orthogonal basis of x in its group: each sums to 0, its squares to 1, the
    products of two to 0. NULL for a NULL x."""
    by = list(by)
    c = poly_coefficients(df, x, degree, by)
    c = c.select(*by, F.col("centre").alias("_c"), F.col("spread").alias("_s"), *[f"c{k}_{j}" for k in range(1, degree + 1) for j in range(k + 1)])
    d = join_small(df, c, on=by, how="left", null_safe=True) if by else join_small(df, c, how="cross", on=None, bounded=True)
    u = (F.col(f"`{x}`").cast("double") - F.col("_c")) / F.col("_s")
    return d.select(*[F.col(f"`{n}`") for n in df.columns], *[v.alias(f"{prefix}{k + 1}") for k, v in enumerate(_values(u, degree))])


def poly_curve(df: DataFrame, x: str, y: str, degree: int = 2, by: Sequence[str] = (), n: int = 80, level: float = 0.95) -> DataFrame:
    """Fitted curve of y ~ poly(x, degree) with a confidence band at ``level`` on ``n`` points across each group's x range.
    Columns: by..., i, x, y, ymin, ymax, se. NULL where the group can't carry the degree; no band without a degree of freedom."""
    by = list(by)
    fit = poly_coefficients(df, x, degree, by, y)
    fit = fit.withColumn("_df", F.col("n") - degree - 1)
    rss = F.greatest(F.col("syy") - sum((F.col(f"beta{k}") * F.col(f"beta{k}") for k in range(1, degree + 1)), F.lit(0.0)), F.lit(0.0))
    fit = fit.withColumn("_sigma2", F.when(F.col("_df") > 0, rss / F.col("_df")))
    grid = join_small(fit, df.sparkSession.range(n).withColumnRenamed("id", "i"), how="cross", on=None, bounded=True)
    grid = grid.withColumn("_at", F.col("xmin") + F.col("i") * (F.col("xmax") - F.col("xmin")) / (n - 1))
    values = _values((F.col("_at") - F.col("centre")) / F.col("spread"), degree)
    yhat = sum((F.col(f"beta{k + 1}") * v for k, v in enumerate(values)), F.col("ybar"))
    se = F.sqrt(F.col("_sigma2") * (1 / F.col("n") + sum((v * v for v in values), F.lit(0.0))))
    t = t_column(F.col("_df"), level)
    return grid.select(*by, "i", F.col("_at").alias("x"), yhat.alias("y"), (yhat - t * se).alias("ymin"), (yhat + t * se).alias("ymax"), se.alias("se"))


def t_column(df: Column, level: float) -> Column:
    """Two-sided quantile of Student's t at ``level`` for a column of degrees of freedom: exact up to 200, beyond that the
    expansion around the normal quantile (error below 1e-9); NULL below 1."""
    from statistics import NormalDist

    p = (1 + level) / 2
    z, v = NormalDist().inv_cdf(p), df.cast("double")
    far = (F.lit(z) + (z ** 3 + z) / (4 * v) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * v * v) + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / (384 * v * v * v)
           + (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / (92160 * v * v * v * v))
    near = F.element_at(F.array(*[F.lit(t_quantile(p, k)) for k in range(1, 201)]), F.least(df, F.lit(200)).cast("int"))
    return F.when(df > 200, far).when(df >= 1, near)
