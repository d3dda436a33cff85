"""Group D queries: the statistics behind the charts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.clean import round_r
from ..operators import charts, reshape, series
from ..operators import polynomials as poly
from ..operators.joins import join_null_safe
from ..operators.sampling import sample_n
from ..sources.tables import table
from . import standins as si
from .registry import query
from .sqlparts import AIR, DIAMONDS, MONTHLY, with_

SQRT_2PI = repr(math.sqrt(2 * math.pi))
R6 = lambda c: F.round(c, 6)
R10 = lambda c: F.round(c, 10)


@query("bar_count", with_(DIAMONDS) + "SELECT cut, count(*) AS count FROM diamonds GROUP BY 1")
def bar_count(spark, sf):
    return charts.stat_count(si.diamonds(spark, sf), "cut")


@query("bar_stacked", with_(DIAMONDS) + """
SELECT cut, clarity, count,
       CAST(sum(count) OVER (PARTITION BY cut ORDER BY clarity DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ymax,
       CAST(sum(count) OVER (PARTITION BY cut ORDER BY clarity DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) - count AS ymin
FROM (SELECT cut, clarity, count(*) AS count FROM diamonds GROUP BY 1, 2)""")
def bar_stacked(spark, sf):
    return charts.stat_stack(charts.stat_count(si.diamonds(spark, sf), "cut", "clarity"), "cut", "clarity")


ORDER_TOTALS = """
totals AS (SELECT o_orderpriority AS x, o_orderstatus AS fill, round(sum(o_totalprice) / 1000000, 3) AS value
           FROM orders GROUP BY 1, 2)"""


def _order_totals(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("x"), F.col("o_orderstatus").alias(
        "fill")).agg(F.round(F.sum("o_totalprice") / 1000000, 3).alias("value"))


@query("bar_identity", with_(ORDER_TOTALS) + """
SELECT x, fill, value,
       round(sum(value) OVER (PARTITION BY x ORDER BY fill DESC ROWS UNBOUNDED PRECEDING), 6) AS ymax,
       round(sum(value) OVER (PARTITION BY x ORDER BY fill DESC ROWS UNBOUNDED PRECEDING) - value, 6) AS ymin
FROM totals""")
def bar_identity(spark, sf):
    """Pre-aggregated values drawn as given (no counting), stacked."""
    s = charts.stat_stack(_order_totals(spark, sf), "x", "fill", "value")
    return s.select("x", "fill", "value", R6("ymax").alias("ymax"), R6("ymin").alias("ymin"))


@query("bar_dodge", with_(ORDER_TOTALS) + """
SELECT x, fill, value, x_level, bar_index, bars,
       round(x_level + (bar_index - (bars + 1) / 2) * 0.9 / bars, 6) AS xpos, round_even(value, 1) AS label
FROM (SELECT *, dense_rank() OVER (ORDER BY x) AS x_level, dense_rank() OVER (PARTITION BY x ORDER BY fill) AS bar_index,
             count(*) OVER (PARTITION BY x) AS bars FROM totals)""")
def bar_dodge(spark, sf):
    d = reshape.dodge(_order_totals(spark, sf), "x", "fill", 0.9)
    return d.select("x", "fill", "value", "x_level", F.col("bar_index").cast("long").alias("bar_index"), "bars",
                    R6("xpos").alias("xpos"), round_r("value", 1).alias("label"))


def _hist_sql(by: str | None) -> str:
    part = f"PARTITION BY {by}" if by else ""
    sel = f"{by}, " if by else ""
    grid = (f"(SELECT * FROM (SELECT DISTINCT {by} FROM diamonds) p, (SELECT range + 1 AS bin FROM range(30)) g) pg"
            if by else "(SELECT range + 1 AS bin FROM range(30)) g")
    return with_(DIAMONDS) + f""", e AS (SELECT (max(price) - min(price)) / 29 AS width, min(price) AS mn FROM diamonds),
e2 AS (SELECT mn - width / 2 AS origin, width FROM e),
c AS (SELECT {sel}CAST(least(greatest(ceil((price - origin) / width), 1), 30) AS BIGINT) AS bin, count(*) AS count
      FROM diamonds, e2 GROUP BY ALL),
f AS (SELECT {sel}bin, CAST(coalesce(count, 0) AS BIGINT) AS count FROM {grid} LEFT JOIN c USING ({sel}bin))
SELECT {sel}bin, round(origin + (bin - 1) * width, 6) AS xmin, round(origin + (bin - 1) * width + width, 6) AS xmax,
       round(origin + (bin - 1) * width + width / 2, 6) AS x, count,
       round(count / width / sum(count) OVER ({part}), 12) AS density,
       round(count / max(count) OVER ({part}), 12) AS ncount
FROM f, e2"""


def _hist_out(h, by=()):
    return h.select(*by, "bin", R6("xmin").alias("xmin"), R6("xmax").alias("xmax"), R6("x").alias("x"), "count",
                    F.round("density", 12).alias("density"), F.round("ncount", 12).alias("ncount"))


@query("histogram", _hist_sql(None))
def histogram(spark, sf):
    return _hist_out(charts.stat_bin(si.diamonds(spark, sf), "price", 30))


@query("histogram_facet", _hist_sql("cut"))
def histogram_facet(spark, sf):
    return _hist_out(charts.stat_bin(si.diamonds(spark, sf), "price", 30, by=["cut"]), ["cut"])


BOX_SQL = """
WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS lower, quantile_cont(value, 0.5) AS middle,
                  quantile_cont(value, 0.75) AS upper FROM events WHERE value IS NOT NULL GROUP BY 1),
f AS (SELECT *, lower - 1.5 * (upper - lower) AS lo, upper + 1.5 * (upper - lower) AS hi FROM q)"""


@query("box_stats", BOX_SQL + """
SELECT event_type, n, round(least(lower, min(value) FILTER (WHERE value BETWEEN lo AND hi)), 6) AS ymin,
       round(lower, 6) AS lower, round(middle, 6) AS middle, round(upper, 6) AS upper,
       round(greatest(upper, max(value) FILTER (WHERE value BETWEEN lo AND hi)), 6) AS ymax,
       round(middle - 1.58 * (upper - lower) / sqrt(n), 6) AS notchlower,
       round(middle + 1.58 * (upper - lower) / sqrt(n), 6) AS notchupper,
       count(*) FILTER (WHERE NOT (value BETWEEN lo AND hi)) AS outliers
FROM events JOIN f USING (event_type) WHERE value IS NOT NULL
GROUP BY event_type, n, lower, middle, upper""")
def box_stats(spark, sf):
    b = charts.box_stats(table(spark, sf, "events"), "event_type", "value")
    return b.select("event_type", "n", *[R6(c).alias(c) for c in
                                         ("ymin", "lower", "middle", "upper", "ymax", "notchlower", "notchupper")],
                    "outliers")


@query("box_outliers", BOX_SQL + """
SELECT event_id, event_type, value FROM events JOIN f USING (event_type) WHERE value < lo OR value > hi""")
def box_outliers(spark, sf):
    return charts.box_outliers(table(spark, sf, "events"), "event_type", "value", keep=["event_id"]).select(
        "event_id", "event_type", "value")


def _binned_sql(name: str, source: str, by: str, v: str, lo: str, hi: str, nodes: int) -> str:
    """``name``: weights of linear binning of ``v`` onto ``nodes`` points from lo to hi (columns of ``source``)."""
    step = f"(CASE WHEN {hi} > {lo} THEN ({hi} - {lo}) / {nodes - 1} ELSE 1 END)"
    at = f"least(floor(({v} - {lo}) / {step}), {nodes - 2})"
    return f"""{name} AS (SELECT {by}, v, sum(w) AS w FROM (
  SELECT {by}, {lo} + {at} * {step} AS v, 1 - (({v} - {lo}) / {step} - {at}) AS w FROM {source}
  UNION ALL SELECT {by}, {lo} + ({at} + 1) * {step} AS v, ({v} - {lo}) / {step} - {at} AS w FROM {source}) GROUP BY ALL)"""


def _density_sql(by: str) -> str:
    return with_(DIAMONDS) + f""",
q AS (SELECT {by}, count(*) AS n, stddev_samp(price) AS sd, quantile_cont(price, 0.25) AS q1,
             quantile_cont(price, 0.75) AS q3 FROM diamonds GROUP BY 1),
b AS (SELECT {by}, n, 0.9 * (CASE WHEN least(sd, (q3 - q1) / 1.34) > 0 THEN least(sd, (q3 - q1) / 1.34)
                                 WHEN sd > 0 THEN sd ELSE 1 END) * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM q),
r AS (SELECT min(price) AS lo, max(price) AS hi FROM diamonds),
g AS (SELECT range AS i, lo + range * (hi - lo) / 511 AS gx FROM range(512), r),
raw AS (SELECT {by}, price, lo, hi FROM diamonds, r),
{_binned_sql("p", "raw", by, "price", "lo", "hi", 2048)},
k AS (SELECT {by}, i, gx, sum(w * exp(-0.5 * ((gx - v) / bw) * ((gx - v) / bw))) / (n * bw * {SQRT_2PI}) AS density, n
      FROM p JOIN b USING ({by}), g GROUP BY {by}, i, gx, n, bw)
SELECT {by}, i, round(gx, 6) AS x, round(density, 10) AS density, round(density * n, 6) AS count,
       round(density / max(density) OVER (PARTITION BY {by}), 8) AS scaled, n FROM k"""


def _density(spark, sf, by: str):
    d = charts.stat_density(si.diamonds(spark, sf), "price", by=[by], n=512)
    return d.select(by, "i", R6("x").alias("x"), R10("density").alias("density"), R6("count").alias("count"),
                    F.round("scaled", 8).alias("scaled"), "n")


@query("density_1d", _density_sql("cut"))
def density_1d(spark, sf):
    """Density of the continuous price by cut."""
    return _density(spark, sf, "cut")


@query("density_1d_color", _density_sql("color"))
def density_1d_color(spark, sf):
    """Density of price by colour."""
    return _density(spark, sf, "color")


DENSITY2_SQL = with_(DIAMONDS) + f""",
hx AS (SELECT 4 * 1.06 * least(stddev_samp(carat), (quantile_cont(carat, 0.75) - quantile_cont(carat, 0.25)) / 1.34)
              * pow(CAST(count(*) AS DOUBLE), -0.2) / 4 AS h FROM diamonds),
hy AS (SELECT 4 * 1.06 * least(stddev_samp(depth), (quantile_cont(depth, 0.75) - quantile_cont(depth, 0.25)) / 1.34)
              * pow(CAST(count(*) AS DOUBLE), -0.2) / 4 AS h FROM diamonds),
r AS (SELECT min(carat) AS x0, max(carat) AS x1, min(depth) AS y0, max(depth) AS y1, count(*) AS n FROM diamonds),
g AS (SELECT a.range AS ix, b.range AS iy, x0 + a.range * (x1 - x0) / 24 AS gx, y0 + b.range * (y1 - y0) / 24 AS gy
      FROM range(25) a, range(25) b, r),
raw AS (SELECT row_number() OVER () AS id, carat, depth, x0, x1, y0, y1 FROM diamonds, r),
{_binned_sql("px", "raw", "id", "carat", "x0", "x1", 256)},
{_binned_sql("py", "raw", "id", "depth", "y0", "y1", 256)},
p AS (SELECT px.v AS vx, py.v AS vy, sum(px.w * py.w) AS w FROM px JOIN py USING (id) GROUP BY 1, 2)
SELECT ix, iy, round(gx, 10) AS x, round(gy, 10) AS y,
       round(sum(w * exp(-0.5 * (((gx - vx) / hx.h) * ((gx - vx) / hx.h) + ((gy - vy) / hy.h) * ((gy - vy) / hy.h))))
             / (max(n) * max(hx.h) * max(hy.h) * 2 * pi()), 10) AS density
FROM p, g, hx, hy, r GROUP BY ix, iy, gx, gy"""


@query("density_2d", DENSITY2_SQL)
def density_2d(spark, sf):
    d = charts.stat_density_2d(si.diamonds(spark, sf), "carat", "depth", n=25)
    return d.select("ix", "iy", R10("x").alias("x"), R10("y").alias("y"), R10("density").alias("density"))


POLY_CTES = with_(DIAMONDS) + """,
m AS (SELECT clarity, avg(carat) AS xbar, avg(price) AS ybar FROM diamonds GROUP BY 1),
s AS (SELECT clarity, count(*) AS n, any_value(xbar) AS xbar, any_value(ybar) AS ybar, sum(carat - xbar) AS s1, sum((carat - xbar) * (carat - xbar)) AS s2,
             sum((carat - xbar) * (carat - xbar) * (carat - xbar)) AS s3,
             sum((carat - xbar) * (carat - xbar) * (carat - xbar) * (carat - xbar)) AS s4,
             sum(price - ybar) AS t0, sum((carat - xbar) * (price - ybar)) AS t1,
             sum((carat - xbar) * (carat - xbar) * (price - ybar)) AS t2, sum((price - ybar) * (price - ybar)) AS syy, min(carat) AS xmin, max(carat) AS xmax
      FROM diamonds JOIN m USING (clarity) GROUP BY 1),
d AS (SELECT *, n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS det FROM s),
c AS (SELECT *, (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / det AS a0,
                (n * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / det AS a1,
                (n * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)) / det AS a2 FROM d),
a AS (SELECT * REPLACE (a0 + ybar AS a0), (syy - a0 * t0 - a1 * t1 - a2 * t2) / (n - 3) AS sigma2 FROM c)
"""

POLY_SQL = POLY_CTES + """
SELECT clarity, n, round(xbar, 9) AS xbar, round(a0, 4) AS a0, round(a1, 4) AS a1, round(a2, 6) AS a2,
       round(a0 - a1 * xbar + a2 * xbar * xbar, 4) AS b0, round(a1 - 2 * a2 * xbar, 4) AS b1, round(a2, 6) AS b2,
       round(sigma2 / 1000000, 3) AS sigma2_m, xmin, xmax FROM a"""


@query("poly_fit", POLY_SQL)
def poly_fit(spark, sf):
    """price ~ poly(carat, 2) per clarity."""
    p = charts.poly_fit(si.diamonds(spark, sf), "carat", "price", ["clarity"])
    return p.select("clarity", "n", F.round("xbar", 9).alias("xbar"), F.round("a0", 4).alias("a0"),
                    F.round("a1", 4).alias("a1"), F.round("a2", 6).alias("a2"), F.round("b0", 4).alias("b0"),
                    F.round("b1", 4).alias("b1"), F.round("b2", 6).alias("b2"),
                    F.round(F.col("sigma2") / 1000000, 3).alias("sigma2_m"), "xmin", "xmax")


_Z = 1.959963984540054
_T = [repr(_Z ** 3 + _Z), repr(5 * _Z ** 5 + 16 * _Z ** 3 + 3 * _Z), repr(3 * _Z ** 7 + 19 * _Z ** 5 + 17 * _Z ** 3 - 15 * _Z),
      repr(79 * _Z ** 9 + 776 * _Z ** 7 + 1482 * _Z ** 5 - 1920 * _Z ** 3 - 945 * _Z)]

POLY_SMOOTH_SQL = POLY_CTES + f""",
f AS (SELECT *, CAST(n AS DOUBLE) AS s0, CAST(n - 3 AS DOUBLE) AS v FROM a),
g AS (SELECT f.*, r.range AS i, xmin + r.range * (xmax - xmin) / 79 AS gx FROM f, range(80) r),
h AS (SELECT *, gx - xbar AS u,
             s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS det0,
             {_Z!r} + {_T[0]} / (4 * v) + {_T[1]} / (96 * v * v) + {_T[2]} / (384 * v * v * v)
               + {_T[3]} / (92160 * v * v * v * v) AS tq FROM g),
k AS (SELECT clarity, i, gx, a0 + a1 * u + a2 * u * u AS yhat, tq,
             sqrt(sigma2 * ((s2 * s4 - s3 * s3) + 2 * (-(s1 * s4 - s3 * s2)) * u
                            + (2 * (s1 * s3 - s2 * s2) + (s0 * s4 - s2 * s2)) * u * u
                            + 2 * (-(s0 * s3 - s1 * s2)) * u * u * u + (s0 * s2 - s1 * s1) * u * u * u * u) / det0) AS se
      FROM h)
SELECT clarity, i, round(gx, 8) AS x, round(yhat, 2) AS y, round(yhat - tq * se, 2) AS ymin,
       round(yhat + tq * se, 2) AS ymax, round(se, 2) AS se FROM k"""


@query("poly_smooth", POLY_SMOOTH_SQL)
def poly_smooth(spark, sf):
    """Fitted curve with a 95 % band, 80 points per clarity."""
    p = charts.poly_smooth(si.diamonds(spark, sf), "carat", "price", ["clarity"], n=80)
    return p.select("clarity", "i", F.round("x", 8).alias("x"), *[F.round(c, 2).alias(c) for c in ("y", "ymin", "ymax", "se")])


def _basis_sql(degree: int) -> str:
    """Gram-Schmidt on the rows themselves: each power loses its projections on the columns before it."""
    out = with_(DIAMONDS) + """, x AS (SELECT row_key, clarity, price, carat - avg(carat) OVER (PARTITION BY clarity) AS u FROM diamonds),
b0 AS (SELECT *, 1 / sqrt(count(*) OVER (PARTITION BY clarity)) AS q0 FROM x)"""
    for k in range(1, degree + 1):
        before = [f"q{j}" for j in range(k)]
        for again, (power, to) in enumerate(((f"q{k - 1} * u", "v"), ("v", "w"))):  # twice, so that rounding does not add up
            lost = " - ".join(f"{q} * sum(({power}) * {q}) OVER (PARTITION BY clarity)" for q in before)
            out += f",\ng{k}{again} AS (SELECT *, {power} - {lost} AS {to} FROM {f'b{k - 1}' if not again else f'g{k}0'})"
        out += f",\nb{k} AS (SELECT * EXCLUDE (v, w), w / sqrt(sum(w * w) OVER (PARTITION BY clarity)) AS q{k} FROM g{k}1)"
    return out


BASIS_DEGREE = 4


@query("poly_basis", _basis_sql(BASIS_DEGREE) + "\nSELECT row_key, clarity, " + ", ".join(
    f"round(q{k}, 9) + 0.0 AS poly{k}" for k in range(1, BASIS_DEGREE + 1)) + f" FROM b{BASIS_DEGREE}")
def poly_basis(spark, sf):
    """The orthogonal basis of carat up to degree 4 in each clarity."""
    d = si.diamonds(spark, sf).select("row_key", "clarity", "carat")
    out = poly.poly_basis(d, "carat", BASIS_DEGREE, ["clarity"])
    return out.select("row_key", "clarity", *[(F.round(f"poly{k}", 9) + 0.0).alias(f"poly{k}") for k in range(1, BASIS_DEGREE + 1)])


@query("poly_cubic", _basis_sql(3) + """,
c AS (SELECT clarity, count(*) AS n, avg(price) AS b0, sum(price * q1) AS b1, sum(price * q2) AS b2, sum(price * q3) AS b3 FROM b3 GROUP BY 1)
SELECT clarity, n, round(b0, 4) AS b0, round(b1, 3) AS b1, round(b2, 3) AS b2, round(b3, 3) AS b3 FROM c""")
def poly_cubic(spark, sf):
    """price ~ poly(carat, 3) per clarity, on the orthonormal basis."""
    c = poly.poly_coefficients(si.diamonds(spark, sf), "carat", 3, ["clarity"], "price")
    return c.select("clarity", "n", F.round("ybar", 4).alias("b0"), *[F.round(f"beta{k}", 3).alias(f"b{k}") for k in (1, 2, 3)])


@query("scatter_points", with_(DIAMONDS) + """
SELECT carat, price, clarity FROM diamonds
ORDER BY md5(concat_ws('|', '12345', CAST(row_key AS VARCHAR))), row_key LIMIT 1000""")
def scatter_points(spark, sf):
    """A reproducible 1000-row sample (hash of the row key with seed 12345)."""
    return sample_n(si.diamonds(spark, sf), 1000, seed=12345, key=["row_key"]).select("carat", "price", "clarity")


@query("sample_exact", """
SELECT * FROM lineitem
ORDER BY md5(concat_ws('|', '12345', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) LIMIT 1000""")
def sample_exact(spark, sf):
    """Exactly 1000 lineitems, reproducible for a seed whatever the
    partitioning: smallest hashes of seed 12345 and the row's key."""
    return sample_n(table(spark, sf, "lineitem"), 1000, seed=12345, key=["l_orderkey", "l_linenumber"])


@query("facet_counts", with_(DIAMONDS) + """,
p AS (SELECT cut, CAST(dense_rank() OVER (ORDER BY cut) AS BIGINT) AS panel, count(*) OVER () AS np
      FROM (SELECT DISTINCT cut FROM diamonds))
SELECT cut, clarity, count(*) AS count, panel, CAST(1 AS BIGINT) AS "row", panel AS col  -- the published layout of three panels: one row
FROM diamonds JOIN p USING (cut) GROUP BY cut, clarity, panel, np HAVING np = 3""")
def facet_counts(spark, sf):
    d = si.diamonds(spark, sf)
    counts = charts.stat_count(d, "clarity", "cut")
    return join_null_safe(counts, charts.facet_panels(d, "cut"), ["cut"]).select("cut", "clarity", "count", "panel", "row", "col")


@query("line_series", with_(AIR) + """
SELECT NewDate, Ozone, row_number() OVER (ORDER BY NewDate, Ozone) AS pos
FROM (SELECT CAST(try_strptime(concat_ws('/', Month, Day, '2024'), '%m/%d/%Y') AS DATE) AS NewDate, Ozone
      FROM air WHERE Ozone IS NOT NULL)""")
def line_series(spark, sf):
    """Ozone over time: points in x order (``geom_line``)."""
    from ..functions.clean import make_date_from_parts

    a = si.air_quality(spark, sf).filter(F.col("Ozone").isNotNull())
    pts = a.select(make_date_from_parts("Month", "Day", F.lit(2024)).alias("NewDate"), "Ozone")
    return series.stat_line(pts, "NewDate", "Ozone")


@query("path_series", with_(MONTHLY) + """
SELECT month, value, row_number() OVER (ORDER BY month) AS pos FROM monthly""")
def path_series(spark, sf):
    """Monthly totals in data (time) order (``geom_path``)."""
    return series.stat_path(si.monthly_totals(spark, sf), "month", "month", "value")


PAIR_NUM, PAIR_CAT = ["carat", "depth"], ["cut", "color", "clarity"]


@query("pairs_box", with_(DIAMONDS) + """,
long AS (""" + " UNION ALL ".join(
    f"SELECT '{v}' AS num_var, '{c}' AS cat_var, CAST({c} AS VARCHAR) AS level, CAST({v} AS DOUBLE) AS value FROM diamonds"
    for v in PAIR_NUM for c in PAIR_CAT) + """),
q AS (SELECT num_var, cat_var, level, count(*) AS n, quantile_cont(value, 0.25) AS lower,
             quantile_cont(value, 0.5) AS middle, quantile_cont(value, 0.75) AS upper
      FROM long GROUP BY 1, 2, 3),
f AS (SELECT *, lower - 1.5 * (upper - lower) AS lo, upper + 1.5 * (upper - lower) AS hi FROM q)
SELECT num_var, cat_var, level, n, round(least(lower, min(value) FILTER (WHERE value BETWEEN lo AND hi)), 6) AS ymin,
       round(lower, 6) AS lower, round(middle, 6) AS middle, round(upper, 6) AS upper,
       round(greatest(upper, max(value) FILTER (WHERE value BETWEEN lo AND hi)), 6) AS ymax,
       count(*) FILTER (WHERE NOT (value BETWEEN lo AND hi)) AS outliers
FROM long JOIN f USING (num_var, cat_var, level) GROUP BY num_var, cat_var, level, n, lower, middle, upper""")
def pairs_box(spark, sf):
    """Mixed (continuous × categorical) panels of the pair matrix over the
    first five diamond columns."""
    d = si.diamonds(spark, sf)
    b = charts.pairs_box(d, PAIR_NUM, PAIR_CAT)
    return b.select("num_var", "cat_var", "level", "n",
                    *[R6(c).alias(c) for c in ("ymin", "lower", "middle", "upper", "ymax")], "outliers")


@query("pairs_crosstab", with_(DIAMONDS) + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, CAST({a} AS VARCHAR) AS level_a, CAST({b} AS VARCHAR) AS level_b, "
    f"count(*) AS n FROM diamonds GROUP BY 1, 2, 3, 4"
    for i, a in enumerate(PAIR_CAT) for b in PAIR_CAT[i + 1:]))
def pairs_crosstab(spark, sf):
    return charts.pairs_crosstab(si.diamonds(spark, sf), PAIR_CAT)


@query("reorder_levels", """
SELECT o_orderpriority, round(avg_o_totalprice, 6) AS avg_o_totalprice,
       dense_rank() OVER (ORDER BY avg_o_totalprice, o_orderpriority) AS level
FROM (SELECT o_orderpriority, avg(o_totalprice) AS avg_o_totalprice FROM orders GROUP BY 1)""")
def reorder_levels(spark, sf):
    """Levels of the priority ordered by mean order value."""
    r = reshape.reorder_levels(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return r.select("o_orderpriority", R6("avg_o_totalprice").alias("avg_o_totalprice"), "level")


@query("sample_fraction")
def sample_fraction(spark, sf):
    """About 10 % of the lineitems (Bernoulli, seed 12345)."""
    from ..operators.sampling import sample_frac

    return sample_frac(table(spark, sf, "lineitem"), 0.1, False, 12345)


def _diag_density_sql(v: str) -> str:
    return f"""
q_{v} AS (SELECT count(*) AS n, stddev_samp({v}) AS sd, quantile_cont({v}, 0.25) AS q1,
                 quantile_cont({v}, 0.75) AS q3 FROM diamonds),
b_{v} AS (SELECT n, 0.9 * (CASE WHEN least(sd, (q3 - q1) / 1.34) > 0 THEN least(sd, (q3 - q1) / 1.34)
                                WHEN sd > 0 THEN sd ELSE 1 END) * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM q_{v}),
g_{v} AS (SELECT range AS i, lo + range * (hi - lo) / 511 AS gx
          FROM range(512), (SELECT min({v}) AS lo, max({v}) AS hi FROM diamonds)),
raw_{v} AS (SELECT 1 AS one, {v}, lo, hi FROM diamonds, (SELECT min({v}) AS lo, max({v}) AS hi FROM diamonds)),
{_binned_sql("p_" + v, "raw_" + v, "one", v, "lo", "hi", 2048)},
k_{v} AS (SELECT i, gx, sum(w * exp(-0.5 * ((gx - v) / bw) * ((gx - v) / bw))) / (n * bw * {SQRT_2PI}) AS density
          FROM p_{v}, b_{v}, g_{v} GROUP BY i, gx, n, bw)"""


PAIRS_DIAG_SQL = with_(DIAMONDS) + "," + ",".join(_diag_density_sql(v) for v in PAIR_NUM) + "\n" + " UNION ALL ".join(
    [f"SELECT '{v}' AS var, 'density' AS kind, CAST(NULL AS VARCHAR) AS level, i, round(gx, 10) AS x, "
     f"round(density, 10) AS value FROM k_{v}" for v in PAIR_NUM]
    + [f"SELECT '{c}' AS var, 'count' AS kind, CAST({c} AS VARCHAR) AS level, CAST(NULL AS BIGINT) AS i, "
       f"CAST(NULL AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS value FROM diamonds GROUP BY {c}" for c in PAIR_CAT])


@query("pairs_diag", PAIRS_DIAG_SQL)
def pairs_diag(spark, sf):
    """Diagonal panels of the pair matrix: densities of carat and depth,
    bar counts of cut, color and clarity."""
    d = charts.pairs_diag(si.diamonds(spark, sf), PAIR_NUM, PAIR_CAT, n=512)
    return d.select("var", "kind", "level", "i", R10("x").alias("x"), R10("value").alias("value"))


PAIRS_PANELS_SQL = with_(DIAMONDS) + """,
lv AS (SELECT 'cut' AS var, count(DISTINCT cut) AS n FROM diamonds UNION ALL SELECT 'color', count(DISTINCT color) FROM diamonds
       UNION ALL SELECT 'clarity', count(DISTINCT clarity) FROM diamonds),
s AS (SELECT least(1000, count(*)) AS n FROM diamonds), v AS (SELECT unnest(['carat', 'depth']) AS var)
SELECT 'carat' AS "row", 'depth' AS col, 'density2d' AS kind, CAST(625 AS BIGINT) AS n
UNION ALL SELECT v.var, lv.var, 'box', 5 * lv.n FROM v, lv
UNION ALL SELECT 'cut', 'color', 'count', count(*) FROM (SELECT DISTINCT cut, color FROM diamonds)
UNION ALL SELECT 'cut', 'clarity', 'count', count(*) FROM (SELECT DISTINCT cut, clarity FROM diamonds)
UNION ALL SELECT 'color', 'clarity', 'count', count(*) FROM (SELECT DISTINCT color, clarity FROM diamonds)
UNION ALL SELECT var, var, 'density', 512 FROM v
UNION ALL SELECT var, var, 'bar', n FROM lv
UNION ALL SELECT 'depth', 'carat', 'points', n FROM s
UNION ALL SELECT v.var, lv.var, 'dot', s.n FROM v, lv, s"""


@query("pairs_panels", PAIRS_PANELS_SQL)
def pairs_panels(spark, sf):
    """Panels of the whole pair matrix, coloured by cut, and the marks in each."""
    m = charts.pairs_matrix(si.diamonds(spark, sf), PAIR_NUM, PAIR_CAT, "cut", ["row_key"], seed=12345)
    return m.groupBy("row", "col", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("pairs_points", with_(DIAMONDS) + """,
s AS (SELECT * FROM diamonds ORDER BY md5(concat_ws('|', '12345', CAST(row_key AS VARCHAR))), row_key LIMIT 1000)
SELECT 'depth' AS "row", 'carat' AS col, 'points' AS kind, cut AS "group", CAST(NULL AS VARCHAR) AS level,
       CAST(carat AS DOUBLE) AS x, CAST(depth AS DOUBLE) AS y FROM s""" + "".join(
    f" UNION ALL SELECT '{v}', '{c}', 'dot', cut, CAST({c} AS VARCHAR), NULL, CAST({v} AS DOUBLE) FROM s" for v in PAIR_NUM for c in PAIR_CAT))
def pairs_points(spark, sf):
    """Lower panels of the pair matrix: points and dots of 1000 sampled rows by cut."""
    return charts.pairs_points(si.diamonds(spark, sf), PAIR_NUM, PAIR_CAT, "cut", ["row_key"], 1000, 12345)
