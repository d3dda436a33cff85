"""Statistics behind charts, computed on the cluster (the numbers, not pixels).

Every statistic reduces the data with a distributed aggregation before any
per-group or per-grid work. Grids (histogram bins, density evaluation points)
have a size fixed by a parameter, so they are the only broadcast sides.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checkpoint import materialize
from .joins import join_null_safe, join_small
from .ranks import quantile_columns, rank_keys

SQRT_2PI = math.sqrt(2 * math.pi)
#: Standard deviations beyond which a normal kernel adds nothing to a double (its value is 3e-18 there).
REACH = 9.0


# --------------------------------------------------------------------- bars
def stat_count(df: DataFrame, x: str, fill: str | None = None) -> DataFrame:
    """Bar heights: rows per x (and per fill level)."""
    keys = [x] + ([fill] if fill else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def stat_stack(counts: DataFrame, x: str, fill: str, y: str = "count") -> DataFrame:
    """Stacked segments: the first fill level on top, the last at the bottom
    (``position_stack``); ``ymin``/``ymax`` are running totals inside each x.
    The input has one row per (x, fill), so each window is one bar."""
    w = Window.partitionBy(x).orderBy(F.desc(fill)).rowsBetween(Window.unboundedPreceding, 0)
    out = counts.withColumn("ymax", F.sum(y).over(w))
    return out.withColumn("ymin", F.col("ymax") - F.col(y))


# ---------------------------------------------------------------- histogram
def bin_edges(df: DataFrame, x: str, bins: int = 30) -> tuple[float, float]:
    """(origin, width) of ``bins`` equal bins whose centres start at the
    minimum and end at the maximum (width = range / (bins-1)). One pass;
    two scalars come back."""
    mn, mx = df.agg(F.min(x), F.max(x)).first()
    if mn is None:
        return 0.0, 1.0
    width = 0.1 if mx == mn else (mx - mn) / (bins - 1)
    return mn - width / 2, width


def stat_bin(df: DataFrame, x: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Histogram: right-closed bins (the first also closed on the left), the
    same edges in every panel ``by``, empty bins kept with count 0.

    Two passes over the data: the range, then the bin counts (partial
    aggregation; the counts — panels × bins rows — are written once and
    also give the panel list). Columns: by…, bin, xmin, xmax, x, count,
    density, ncount.
    """
    by = list(by)
    spark = df.sparkSession
    origin, width = bin_edges(df, x, bins)
    o, w = F.lit(origin), F.lit(width)
    data = df.filter(F.col(x).isNotNull()).select(*by, x)
    k = F.least(F.greatest(F.ceil((F.col(x) - o) / w), F.lit(1)), F.lit(bins))
    counts = materialize(data.groupBy(*by, k.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = spark.range(1, bins + 1).withColumnRenamed("id", "bin")
    if by:
        # every panel with a value has at least one bin count: no extra scan
        panels = counts.select(*by).distinct()
        grid = join_small(panels, grid, how="cross", on=None, bounded=True)
    full = join_null_safe(grid, counts, [*by, "bin"], "left")
    full = full.withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long"))
    pw = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    xmin = o + (F.col("bin") - 1) * w
    return full.select(
        *by, "bin", xmin.alias("xmin"), (xmin + w).alias("xmax"), (xmin + w / 2).alias("x"), "count",
        (F.col("count") / w / F.sum("count").over(pw)).alias("density"),
        (F.col("count") / F.max("count").over(pw)).alias("ncount"))


# ------------------------------------------------------------------ boxplot
def weighted_keys(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct (group, values) with their row count ``_w``, written once to
    the checkpoint folder: the one scan of the data every later statistic
    (quantiles, spread, range, kernel sums, whiskers) reads from."""
    data = df.select(*by, *cols).dropna(subset=list(cols))
    return materialize(data.groupBy(*by, *cols).agg(F.count(F.lit(1)).alias("_w")))


def box_stats(df: DataFrame, x: Sequence[str] | str, y: str, coef: float = 1.5) -> DataFrame:
    """Box-plot statistics per x: exact quartiles (type 7), whiskers at the
    most extreme values inside ``coef``·IQR of the hinges, notches
    ±1.58·IQR/√n, and the outlier count. The data are scanned once (into
    weighted distinct values); everything else reads that reduced table.
    """
    xs = [x] if isinstance(x, str) else list(x)
    keys = weighted_keys(df, [y], xs)
    q = quantile_columns(keys, y, {"lower": 0.25, "middle": 0.5, "upper": 0.75}, xs, weight_col="_w")
    q = q.withColumn("_iqr", F.col("upper") - F.col("lower"))
    fences = q.select(*xs, (F.col("lower") - coef * F.col("_iqr")).alias("_lo"),
                      (F.col("upper") + coef * F.col("_iqr")).alias("_hi"))
    inside = F.col(y).between(F.col("_lo"), F.col("_hi"))
    w = join_small(keys, fences, on=xs, null_safe=True).groupBy(*xs).agg(
        F.min(F.when(inside, F.col(y))).alias("_wlo"), F.max(F.when(inside, F.col(y))).alias("_whi"),
        F.sum(F.when(~inside, F.col("_w")).otherwise(0)).cast("long").alias("outliers"))
    out = join_null_safe(q, w, xs)
    notch = 1.58 * F.col("_iqr") / F.sqrt("n")
    return out.select(
        *xs, "n", F.least("lower", "_wlo").alias("ymin"), "lower", "middle", "upper",
        F.greatest("upper", "_whi").alias("ymax"), (F.col("middle") - notch).alias("notchlower"),
        (F.col("middle") + notch).alias("notchupper"), "outliers")


def box_outliers(df: DataFrame, x: Sequence[str] | str, y: str, coef: float = 1.5,
                 keep: Sequence[str] = ()) -> DataFrame:
    """The outlying rows (drawn as points): y beyond the whisker fences."""
    xs = [x] if isinstance(x, str) else list(x)
    q = quantile_columns(df, y, {"lower": 0.25, "upper": 0.75}, xs)
    fences = q.select(*xs, (F.col("lower") - coef * (F.col("upper") - F.col("lower"))).alias("_lo"),
                      (F.col("upper") + coef * (F.col("upper") - F.col("lower"))).alias("_hi"))
    data = df.filter(F.col(y).isNotNull()).select(*xs, y, *keep)
    return join_small(data, fences, on=xs, null_safe=True).filter((F.col(y) < F.col("_lo")) | (F.col(y) > F.col("_hi"))).drop(
        "_lo", "_hi")


# ------------------------------------------------------------------ density
def _spread(keys: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
    """Per group: n, sample sd, and the quartiles of ``x`` from weighted keys."""
    by = list(by)
    q = quantile_columns(keys, x, {"_q1": 0.25, "_q3": 0.75}, by, weight_col="_w")
    m = keys.groupBy(*by).agg((F.sum(F.col("_w") * F.col(x)) / F.sum("_w")).alias("_mean"))
    c = join_small(keys, m, on=by, null_safe=True) if by else join_small(keys, m, how="cross", on=None, bounded=True)
    dev = F.col(x) - F.col("_mean")
    v = c.groupBy(*by).agg(F.sqrt(F.try_divide(F.sum(F.col("_w") * dev * dev), F.sum("_w") - 1)).alias("_sd"),
                           F.abs(F.min(x)).alias("_abs"))
    return join_null_safe(q, v, by) if by else q.crossJoin(v)


def bandwidth_nrd0(df: DataFrame, x: str, by: Sequence[str] = (), keys: DataFrame | None = None) -> DataFrame:
    """Silverman's rule per group: 0.9·min(sd, IQR/1.34)·n^(-1/5). When the
    spread is 0 it falls back to the sd, then to the absolute value of the
    (constant) group, then to 1. Columns by…, n, bw."""
    by = list(by)
    s = _spread(keys if keys is not None else weighted_keys(df, [x], by), x, by)
    lo = F.least(F.col("_sd"), (F.col("_q3") - F.col("_q1")) / 1.34)
    lo = F.when(lo > 0, lo).when(F.col("_sd") > 0, F.col("_sd")).when(F.col("_abs") > 0, F.col("_abs")).otherwise(F.lit(1.0))
    return s.select(*by, "n", (0.9 * lo * F.pow(F.col("n").cast("double"), -0.2)).alias("bw"))


def _reduce_points(keys: DataFrame, cols: Sequence[str], by: Sequence[str], method: str,
                   bin_count: int, common_range: bool = True) -> DataFrame:
    """Weighted points standing for the data (from weighted distinct keys):
    the exact distinct values with their counts, or linear binning onto
    ``bin_count`` nodes per axis over the full range (each value splits its
    weight between its two nodes)."""
    by = list(by)
    if method == "exact":
        return keys.select(*by, *cols, F.col("_w").cast("double").alias("_w"))
    ends = [F.min(c).alias(f"_mn_{c}") for c in cols] + [F.max(c).alias(f"_mx_{c}") for c in cols]
    if common_range or not by:
        d = join_small(keys, keys.agg(*ends), how="cross", on=None, bounded=True)
    else:
        d = join_small(keys, keys.groupBy(*by).agg(*ends), on=by, null_safe=True)
    for c in cols:
        step = (F.col(f"_mx_{c}") - F.col(f"_mn_{c}")) / (bin_count - 1)
        step = F.when(step > 0, step).otherwise(F.lit(1.0))
        pos = (F.col(c) - F.col(f"_mn_{c}")) / step
        i0 = F.least(F.floor(pos), F.lit(bin_count - 2))
        frac = pos - i0
        d = d.withColumn(f"_s_{c}", F.explode(F.array(
            F.struct((F.col(f"_mn_{c}") + i0 * step).alias("v"), (1 - frac).alias("w")),
            F.struct((F.col(f"_mn_{c}") + (i0 + 1) * step).alias("v"), frac.alias("w")))))
    weight = F.col("_w").cast("double")
    for c in cols:
        weight = weight * F.col(f"_s_{c}.w")
    return d.select(*by, *[F.col(f"_s_{c}.v").alias(c) for c in cols], weight.alias("_w")).groupBy(
        *by, *cols).agg(F.sum("_w").alias("_w"))


def stat_density(df: DataFrame, x: str, by: Sequence[str] = (), n: int = 512, method: str = "binned",
                 bin_count: int = 2048, common_range: bool = True) -> DataFrame:
    """Gaussian kernel density per group on ``n`` points over the full range.

    ``method="binned"`` first bins linearly onto ``bin_count`` nodes, so the
    kernel sums don't grow with the data. With nodes ``h`` apart a value's
    kernel changes by at most h²/8 times the largest second derivative, so
    the density is off by at most h² / (8·√(2π)·bw³). ``method="exact"``
    crosses every distinct value with the grid: only for few values.
    ``common_range=False`` gives each group its own evaluation range (e.g.
    several variables stacked in one frame).
    Columns: by…, i, x, density, count, scaled, n.
    """
    by = list(by)
    spark = df.sparkSession
    keys = weighted_keys(df, [x], by)
    bw = materialize(bandwidth_nrd0(df, x, by, keys=keys))  # a row for each group, read by the points and by the grid
    pts = _reduce_points(keys, [x], by, method, bin_count, common_range)
    p = join_null_safe(pts, bw, by) if by else pts.crossJoin(bw)
    ends = [F.min(x).alias("_lo"), F.max(x).alias("_hi")]
    if common_range or not by:
        rng = keys.agg(*ends)
        p = join_small(p, rng, how="cross", on=None, bounded=True)
        every = join_small(bw, rng, how="cross", on=None, bounded=True)
    else:
        rng = keys.groupBy(*by).agg(*ends)
        p, every = join_null_safe(p, rng, by), join_null_safe(bw, rng, by)
    # a point meets the part of the grid that its kernel reaches; the grid itself stands beside them without weight
    step = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / (n - 1)).otherwise(F.lit(1.0))
    near = [F.least(F.greatest(F.col(x) + side * REACH * F.col("bw") - F.col("_lo"), F.lit(0.0)) / step, F.lit(float(n - 1))) for side in (-1, 1)]
    p = p.select(*by, "_lo", "_hi", "n", "bw", F.col(x).alias("_at"), "_w", F.explode(F.sequence(F.floor(near[0]), F.ceil(near[1]))).alias("i"))
    every = join_small(every, spark.range(n).withColumnRenamed("id", "i"), how="cross", on=None, bounded=True)
    pg = p.unionByName(every.select(*by, "_lo", "_hi", "n", "bw", F.col("_lo").alias("_at"), F.lit(0.0).alias("_w"), "i"))
    pg = pg.withColumn("gx", F.col("_lo") + F.col("i") * (F.col("_hi") - F.col("_lo")) / (n - 1))
    z = (F.col("gx") - F.col("_at")) / F.col("bw")
    k = pg.groupBy(*by, "i", "gx").agg(
        (F.sum(F.col("_w") * F.exp(-0.5 * z * z)) / (F.first("n") * F.first("bw") * SQRT_2PI)).alias("density"),
        F.first("n").alias("n"))
    pw = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return k.select(*by, "i", F.col("gx").alias("x"), "density", (F.col("density") * F.col("n")).alias("count"),
                    F.try_divide(F.col("density"), F.max("density").over(pw)).alias("scaled"), "n")


def bandwidth_nrd(df: DataFrame, x: str, keys: DataFrame | None = None) -> DataFrame:
    """Scott-type rule used by 2-D densities: 4·1.06·min(sd, IQR/1.34)·n^(-1/5)."""
    s = _spread(keys if keys is not None else weighted_keys(df, [x]), x, ())
    return s.select((4 * 1.06 * F.least(F.col("_sd"), (F.col("_q3") - F.col("_q1")) / 1.34)
                     * F.pow(F.col("n").cast("double"), -0.2)).alias(f"h_{x}"))


def stat_density_2d(df: DataFrame, x: str, y: str, n: int = 25, method: str = "binned",
                    bin_count: int = 256) -> DataFrame:
    """2-D Gaussian kernel density on an ``n``×``n`` grid over the data range
    (bivariate normal kernel, sd = bandwidth/4 per axis). The data are
    scanned once into weighted distinct (x, y) pairs; the marginal spreads,
    the range and the kernel sums all read that table. The axes are summed up
    one after the other, so a node meets 2 ``n`` grid values at most, those
    its kernel reaches. Columns: ix, iy, x, y, density.
    """
    spark = df.sparkSession
    keys = weighted_keys(df, [x, y])
    h = bandwidth_nrd(df, x, keys).crossJoin(bandwidth_nrd(df, y, keys))
    pts = _reduce_points(keys, [x, y], (), method, bin_count)
    rng = keys.agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1"),
                   F.sum("_w").alias("_n"))
    scale = materialize(rng.crossJoin(h))  # one row that both axes and the grid read
    # the kernel is a product, so one axis is summed up after the other: a node meets n points, not n x n
    out = pts.withColumnRenamed("_w", "_mass")
    for axis, i, g, lo, hi, rest in ((x, "ix", "gx", "_x0", "_x1", [y]), (y, "iy", "gy", "_y0", "_y1", ["ix"])):
        line = join_small(spark.range(n).withColumnRenamed("id", i), scale, how="cross", on=None, bounded=True)
        line = line.select(i, (F.col(lo) + F.col(i) * (F.col(hi) - F.col(lo)) / (n - 1)).alias(g), (F.col(f"h_{axis}") / 4).alias("_sd"))
        z = (F.col(g) - F.col(axis)) / F.col("_sd")
        met = join_small(out, line, how="cross", on=None, bounded=True).filter(F.abs(z) <= REACH)
        out = met.groupBy(*rest, i).agg(F.sum(F.col("_mass") * F.exp(-0.5 * z * z)).alias("_mass"))
    grid = join_small(join_small(spark.range(n).withColumnRenamed("id", "ix"), spark.range(n).withColumnRenamed("id", "iy"), how="cross", on=None, bounded=True),
                      scale, how="cross", on=None, bounded=True)
    k = grid.join(out, ["ix", "iy"], "left")
    norm = F.col("_n") * (F.col(f"h_{x}") / 4) * (F.col(f"h_{y}") / 4) * 2 * math.pi
    return k.select("ix", "iy", (F.col("_x0") + F.col("ix") * (F.col("_x1") - F.col("_x0")) / (n - 1)).alias("x"),
                    (F.col("_y0") + F.col("iy") * (F.col("_y1") - F.col("_y0")) / (n - 1)).alias("y"),
                    (F.coalesce("_mass", F.lit(0.0)) / norm).alias("density"))


# ------------------------------------------------------------- regression
def _det3(a, b, c, d, e, f, g, h, i):
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def poly_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares ``y ~ poly(x, 2)`` per group from one pass of sums of
    centred powers (centring x and y at the group means keeps the 3×3 system
    well conditioned and the residual sum free of the offset of y); solved with Cramer's rule as column expressions.

    Columns: by…, n, xbar, a0..a2 (centred basis), b0..b2 (raw x), sigma2,
    xmin, xmax and the sums needed for confidence bands (s0..s4).
    """
    by = list(by)
    data = df.select(*by, x, y).dropna(subset=[x, y])
    centres = [F.avg(x).alias("xbar"), F.avg(y).alias("ybar")]
    means = data.groupBy(*by).agg(*centres) if by else data.agg(*centres)
    c = join_small(data, means, on=by, null_safe=True) if by else join_small(data, means, how="cross", on=None, bounded=True)
    u, v = F.col(x) - F.col("xbar"), F.col(y) - F.col("ybar")
    s = c.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.first("xbar").alias("xbar"), F.first("ybar").alias("ybar"), F.sum(u).alias("s1"),
        F.sum(u * u).alias("s2"), F.sum(u * u * u).alias("s3"), F.sum(u * u * u * u).alias("s4"),
        F.sum(v).alias("t0"), F.sum(u * v).alias("t1"), F.sum(u * u * v).alias("t2"), F.sum(v * v).alias("syy"), F.min(x).alias("xmin"), F.max(x).alias("xmax"))
    n, s1, s2, s3, s4 = (F.col(k) for k in ("n", "s1", "s2", "s3", "s4"))
    t0, t1, t2 = F.col("t0"), F.col("t1"), F.col("t2")
    det = _det3(n, s1, s2, s1, s2, s3, s2, s3, s4)
    # try_divide: a degenerate group (fewer than 3 distinct x) gives NULLs, not an ANSI error
    a0 = F.try_divide(_det3(t0, s1, s2, t1, s2, s3, t2, s3, s4), det)
    a1 = F.try_divide(_det3(n, t0, s2, s1, t1, s3, s2, t2, s4), det)
    a2 = F.try_divide(_det3(n, s1, t0, s1, s2, t1, s2, s3, t2), det)
    s = s.withColumns({"a0": a0, "a1": a1, "a2": a2, "s0": n.cast("double")})
    rss = F.col("syy") - F.col("a0") * t0 - F.col("a1") * t1 - F.col("a2") * t2  # of the centred y
    s = s.withColumn("sigma2", F.greatest(F.try_divide(rss, n - 3), F.lit(0.0)))
    s = s.withColumn("a0", F.col("a0") + F.col("ybar"))
    xb = F.col("xbar")
    return s.select(
        *by, "n", "xbar", "a0", "a1", "a2",
        (F.col("a0") - F.col("a1") * xb + F.col("a2") * xb * xb).alias("b0"),
        (F.col("a1") - 2 * F.col("a2") * xb).alias("b1"), F.col("a2").alias("b2"),
        "sigma2", "xmin", "xmax", "s0", "s1", "s2", "s3", "s4")


# fixed values: published 0.975 quantiles of Student's t for 1 to 30 degrees of freedom
T_975 = [12.7062047, 4.3026527, 3.1824463, 2.7764451, 2.5705818, 2.4469119, 2.3646243, 2.3060041, 2.2621572, 2.2281389,
         2.2009852, 2.1788128, 2.1603687, 2.1447867, 2.1314495, 2.1199053, 2.1098156, 2.1009220, 2.0930241, 2.0859634,
         2.0796138, 2.0738731, 2.0686576, 2.0638986, 2.0595386, 2.0555294, 2.0518305, 2.0484071, 2.0452296, 2.0422725]


def t_quantile_975(df_col: Column) -> Column:
    """0.975 quantile of Student's t with ``df_col`` degrees of freedom: published values up to 30, beyond that the
    expansion around the normal quantile (error below 1e-6); NULL below 1."""
    z = 1.959963984540054
    v = df_col.cast("double")
    far = (F.lit(z) + (z ** 3 + z) / (4 * v) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * v * v)
           + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / (384 * v * v * v)
           + (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / (92160 * v * v * v * v))
    near = F.element_at(F.array(*[F.lit(t) for t in T_975]), F.least(df_col, F.lit(30)).cast("int"))
    return F.when(df_col > 30, far).when(df_col >= 1, near)


def poly_smooth(df: DataFrame, x: str, y: str, by: Sequence[str] = (), n: int = 80) -> DataFrame:
    """Fitted curve and 95 % confidence band on ``n`` points across each
    group's own x range (``geom_smooth(method="lm", formula=y~poly(x,2))``).
    Columns: by…, i, x, y, ymin, ymax, se."""
    by = list(by)
    fit = poly_fit(df, x, y, by)
    spark = df.sparkSession
    grid = spark.range(n).withColumnRenamed("id", "i")
    g = join_small(fit, grid, how="cross", on=None, bounded=True)
    gx = F.col("xmin") + F.col("i") * (F.col("xmax") - F.col("xmin")) / (n - 1)
    g = g.withColumn("gx", gx).withColumn("u", F.col("gx") - F.col("xbar"))
    # inverse of the symmetric moment matrix M = [[s0,s1,s2],[s1,s2,s3],[s2,s3,s4]] via cofactors
    s0, s1, s2, s3, s4 = (F.col(k) for k in ("s0", "s1", "s2", "s3", "s4"))
    det = _det3(s0, s1, s2, s1, s2, s3, s2, s3, s4)
    c00, c01, c02 = s2 * s4 - s3 * s3, -(s1 * s4 - s3 * s2), s1 * s3 - s2 * s2
    c11, c12, c22 = s0 * s4 - s2 * s2, -(s0 * s3 - s1 * s2), s0 * s2 - s1 * s1
    u = F.col("u")
    quad = F.try_divide(c00 + 2 * c01 * u + (2 * c02 + c11) * u * u + 2 * c12 * u * u * u + c22 * u * u * u * u, det)
    yhat = F.col("a0") + F.col("a1") * u + F.col("a2") * u * u
    se = F.sqrt(F.col("sigma2") * quad)
    t = t_quantile_975(F.col("n") - 3)
    return g.select(*by, "i", F.col("gx").alias("x"), yhat.alias("y"), (yhat - t * se).alias("ymin"),
                    (yhat + t * se).alias("ymax"), se.alias("se"))


# ------------------------------------------------------------ panels, lines
def facet_panels(df: DataFrame, facet: str, ncol: int | None = None) -> DataFrame:
    """Panel number (dense rank of the facet value, NULL last) and its wrap position. Without ``ncol`` the layout is
    R's for n panels: one row up to 3, two rows up to 6, three up to 12, else ceil(sqrt(n)) columns."""
    levels = df.select(facet, F.col(facet).isNull().alias("_none")).distinct()
    lv = rank_keys(levels, ["_none", facet], method="dense", name="panel")
    n = F.col("panel_n")
    rows = F.when(n <= 3, 1).when(n <= 6, 2).when(n <= 12, 3)
    cols = F.lit(ncol) if ncol else F.when(n <= 12, F.ceil(n / rows)).otherwise(F.ceil(F.sqrt(n.cast("double"))))
    return lv.select(facet, F.col("panel").cast("long").alias("panel"),
                     (F.floor((F.col("panel") - 1) / cols) + 1).cast("long").alias("row"),
                     (F.pmod(F.col("panel") - 1, cols) + 1).cast("long").alias("col"))


def pair_long(df: DataFrame, value_cols: Sequence[str], cat_cols: Sequence[str]) -> DataFrame:
    """(num_var, cat_var, level, value) for every continuous × categorical pair."""
    pairs = [F.struct(F.lit(v).alias("num_var"), F.lit(c).alias("cat_var"), F.col(c).cast("string").alias("level"),
                      F.col(v).cast("double").alias("value")) for v in value_cols for c in cat_cols]
    return df.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def pairs_box(df: DataFrame, value_cols: Sequence[str], cat_cols: Sequence[str]) -> DataFrame:
    """Box statistics of every continuous column by every categorical one
    (mixed panels of a pair matrix), computed in one distributed pass."""
    return box_stats(pair_long(df, value_cols, cat_cols), ["num_var", "cat_var", "level"], "value")


def pairs_crosstab(df: DataFrame, cat_cols: Sequence[str]) -> DataFrame:
    """Counts of every pair of categorical columns (a < b in column order)."""
    pairs = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(a).cast("string").alias("level_a"),
                      F.col(b).cast("string").alias("level_b"))
             for i, a in enumerate(cat_cols) for b in cat_cols[i + 1:]]
    long = df.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")
    return long.groupBy("var_a", "var_b", "level_a", "level_b").agg(F.count(F.lit(1)).alias("n"))


def pairs_diag(df: DataFrame, value_cols: Sequence[str], cat_cols: Sequence[str], n: int = 512) -> DataFrame:
    """Diagonal panels of a pair matrix in one long frame
    (var, kind, level, i, x, value): a kernel density per continuous column
    (kind ``density``, ``n`` points over that column's range) and bar
    counts per categorical column (kind ``count``). All columns of a kind
    are stacked and done in one pass."""
    parts = []
    if value_cols:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(v).alias("var"), F.col(v).cast("double").alias("_x"))
                                             for v in value_cols])).alias("_p")).select("_p.*")
        d = stat_density(long, "_x", by=["var"], n=n, common_range=False)
        parts.append(d.select("var", F.lit("density").alias("kind"), F.lit(None).cast("string").alias("level"),
                              "i", "x", F.col("density").alias("value")))
    if cat_cols:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("var"), F.col(c).cast("string").alias("level"))
                                             for c in cat_cols])).alias("_p")).select("_p.*")
        k = stat_count(long, "var", "level")
        parts.append(k.select("var", F.lit("count").alias("kind"), "level", F.lit(None).cast("long").alias("i"),
                              F.lit(None).cast("double").alias("x"), F.col("count").cast("double").alias("value")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def pairs_points(df: DataFrame, value_cols: Sequence[str], cat_cols: Sequence[str], colour: str, key: Sequence[str],
                 n: int = 1000, seed: int = 0) -> DataFrame:
    """Lower panels of a pair matrix for ``n`` sampled rows: points of each pair of continuous columns (kind
    ``points``) and dots of each continuous column by each categorical one (kind ``dot``), coloured by ``colour``.
    Columns: row, col, kind, group, level, x, y."""
    from .sampling import sample_n

    def panel(row: str, col: str, kind: str, level, x, y) -> Column:
        return F.struct(F.lit(row).alias("row"), F.lit(col).alias("col"), F.lit(kind).alias("kind"),
                        F.col(colour).cast("string").alias("group"), level.cast("string").alias("level"),
                        x.cast("double").alias("x"), y.cast("double").alias("y"))

    none = F.lit(None)
    points = [panel(b, a, "points", none, F.col(a), F.col(b)) for i, a in enumerate(value_cols) for b in value_cols[i + 1:]]
    dots = [panel(v, c, "dot", F.col(c), none, F.col(v)) for v in value_cols for c in cat_cols]
    return sample_n(df, n, seed, key).select(F.explode(F.array(*points, *dots)).alias("_p")).select("_p.*")


def pairs_matrix(df: DataFrame, value_cols: Sequence[str], cat_cols: Sequence[str], colour: str, key: Sequence[str],
                 points: int = 1000, seed: int = 0) -> DataFrame:
    """All panels of a pair matrix in one long frame (row, col, kind, group, level, x, y, value).

    Above the diagonal: 2-D densities of continuous pairs (kind ``density2d``: x, y, value), box statistics of mixed
    pairs (kind ``box``: the statistic's name in ``group``), counts of categorical pairs (kind ``count``: levels in
    ``level`` and ``group``). On it: densities and bar counts (``density``, ``bar``). Below it: ``points`` and ``dot`` of
    a sample, coloured by ``colour``.
    """
    text, num = F.lit(None).cast("string"), F.lit(None).cast("double")
    parts = []
    for i, a in enumerate(value_cols):
        for b in value_cols[i + 1:]:
            d = stat_density_2d(df, a, b)
            parts.append(d.select(F.lit(a).alias("row"), F.lit(b).alias("col"), F.lit("density2d").alias("kind"), text.alias("group"),
                                  text.alias("level"), "x", "y", F.col("density").alias("value")))
    if value_cols and cat_cols:
        box = pairs_box(df, value_cols, cat_cols).unpivot(["num_var", "cat_var", "level"], ["ymin", "lower", "middle", "upper", "ymax"], "group", "value")
        parts.append(box.select(F.col("num_var").alias("row"), F.col("cat_var").alias("col"), F.lit("box").alias("kind"), "group", "level",
                                num.alias("x"), num.alias("y"), "value"))
    if len(cat_cols) > 1:
        c = pairs_crosstab(df, cat_cols)
        parts.append(c.select(F.col("var_a").alias("row"), F.col("var_b").alias("col"), F.lit("count").alias("kind"), F.col("level_b").alias("group"),
                              F.col("level_a").alias("level"), num.alias("x"), num.alias("y"), F.col("n").cast("double").alias("value")))
    d = pairs_diag(df, value_cols, cat_cols)
    parts.append(d.select(F.col("var").alias("row"), F.col("var").alias("col"), F.when(F.col("kind") == "count", "bar").otherwise(F.col("kind")).alias("kind"),
                          text.alias("group"), "level", "x", num.alias("y"), "value"))
    low = pairs_points(df, value_cols, cat_cols, colour, key, points, seed)
    parts.append(low.select("row", "col", "kind", "group", "level", "x", "y", num.alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
