"""Group B queries: the flight-delay classification study."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..operators import classify as cl
from ..operators import inference as inf
from ..operators.checkpoint import materialize
from ..operators.prep import separate
from ..operators.sampling import hash_part, hash_split, random_split
from ..session import scratch_path
from ..sources.csv import read_csv, write_csv
from ..sources.models import load_model, save_model
from ..sources.tables import table
from . import flights as fl
from . import standins as si
from .registry import query
from .sqlparts import DIAMONDS, PREPARED, SCORED, with_

SPLIT = {"training": 0.7, "test": 0.2, "validation": 0.1}
SPLIT_SEED, FOREST_SEED, TREES = 101917, 10432, 100

def study(spark, sf, only: list[str] | None = None, trees: int = TREES):
    """Key-hash split of the prepared table (written once: the fits read it), the fitted models (``only`` some) and
    the feature names."""
    parts = hash_split(materialize(fl.prepared(spark, sf, keep_key=True)), SPLIT, "FlightNum")
    models = cl.fit_all(parts["training"], "IsDepDelayed", fl.FEATURES, trees, FOREST_SEED, only)
    names = cl.feature_names(next(iter(models.values())).stages[0].transform(parts["training"]))
    return parts, models, names


HASH_SQL = """((((FlightNum % 4294967296) // 65536 * 2654435761) % 65536 * 65536
   + ((FlightNum % 4294967296) % 65536) * 2654435761) % 4294967296)"""


@query("hash_split", PREPARED + f"""
SELECT CASE WHEN h < {int(0.7 * 2 ** 32)} THEN 'training' WHEN h < {int(0.9 * 2 ** 32)} THEN 'test' ELSE 'validation' END AS part,
       count(*) AS n, CAST(sum(IsDepDelayed) AS DOUBLE) AS n_delayed
FROM (SELECT *, {HASH_SQL} AS h FROM prepared) GROUP BY 1""")
def hash_split_q(spark, sf):
    """training / test / validation = 0.7 / 0.2 / 0.1 by flight-key hash."""
    p = fl.prepared(spark, sf, keep_key=True)
    return p.groupBy(hash_part(F.col("FlightNum"), SPLIT).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("IsDepDelayed").alias("n_delayed"))


@query("random_split")
def random_split_q(spark, sf):
    """Spark's ``randomSplit`` (seed 101917): sizes per part."""
    p = fl.prepared(spark, sf, keep_key=True)
    parts = random_split(p, SPLIT, SPLIT_SEED)
    from ..operators.joins import bind_rows_labelled

    return bind_rows_labelled(parts, "part").groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# Oracle side only: levels of each categorical predictor in alphabetical
# order, last one dropped (the formula's encoding), valid while every level
# occurs in the training part (true for the test tables); numbers pass
# through in formula order. The Spark side learns the levels from the data.
_LEVELS = {
    "Dest": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"],
    "DayOfWeek": ["1", "2", "3", "4", "5", "6"],
    "Month": ["1", "10", "11", "12", "2", "3", "4", "5", "6", "7", "8"],
    "UniqueCarrier": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"],
}


@query("dummy_encode", PREPARED + "SELECT FlightNum, " + ", ".join(_LEVELS) + ", " + ", ".join(
    f"CASE WHEN {c} = '{lv}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS \"{c}_{cl._safe(lv)}\""
    for c, levels in _LEVELS.items() for lv in levels) + " FROM prepared")
def dummy_encode(spark, sf):
    """Indicator columns of the four categorical predictors (last level of each dropped), in one call."""
    return cl.dummy_encode(fl.prepared(spark, sf, keep_key=True), list(_LEVELS), keep=["FlightNum"])


def _feature_sql() -> str:
    parts = []
    for f in fl.FEATURES:
        if f in _LEVELS:
            parts += [f"CASE WHEN {f} = '{lv}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END" for lv in _LEVELS[f]]
        else:
            parts.append(f"CAST({f} AS DOUBLE)")
    return "[" + ", ".join(parts) + "]"


@query("feature_matrix", PREPARED + f"""
SELECT FlightNum, IsDepDelayed AS label, {_feature_sql()} AS features
FROM (SELECT *, {HASH_SQL} AS h FROM prepared)
WHERE h < {int(0.7 * 2 ** 32)} AND {' AND '.join(c + ' IS NOT NULL' for c in fl.FEATURES)}""")
def feature_matrix(spark, sf):
    """Assembled training matrix: label and the feature vector as an array,
    NULL-feature rows skipped."""
    train = hash_split(materialize(fl.prepared(spark, sf, keep_key=True)), SPLIT, "FlightNum")["training"]
    x = cl.feature_pipeline("IsDepDelayed", fl.FEATURES).fit(train).transform(train)
    return x.select("FlightNum", "label", vector_to_array_col(x))


def vector_to_array_col(df):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array("features").alias("features")


def _model_summary(spark, sf, name):
    """One row about a fit: what it read, its size, and how well it ranks the rows it was fitted on."""
    parts, models, names = study(spark, sf, [name])
    m = models[name]
    est = m.stages[-1]
    nodes = est.numNodes if name == "Decision Tree" else est.totalNumNodes if name == "Random Forest" else None
    strength = est.coefficients.toArray() if name == "Logistic" else est.featureImportances.toArray()
    scored = materialize(cl.score(m, parts["training"]).drop("probability"))
    rows = parts["training"].agg(F.count(F.lit(1)).alias("train_rows")).crossJoin(
        scored.agg(F.count(F.lit(1)).alias("used_rows"), F.avg("label").alias("mean_label"), F.avg("p_yes").alias("mean_p")))
    return rows.crossJoin(cl.auc(scored).select(F.col("auc").alias("train_auc"))).select(
        F.lit(name).alias("model"), F.lit(len(names)).alias("n_features"), "train_rows",
        "used_rows", (F.col("train_rows") - F.col("used_rows")).alias("dropped_rows"),
        F.lit(est.depth if name == "Decision Tree" else None).cast("int").alias("depth"),
        F.lit(est.getNumTrees if name == "Random Forest" else None).cast("int").alias("trees"),
        F.lit(nodes).cast("long").alias("nodes"), F.lit(int((strength != 0).sum())).alias("used_features"),
        "mean_label", "mean_p", "train_auc")


@query("fit_logistic")
def fit_logistic(spark, sf):
    return _model_summary(spark, sf, "Logistic")


@query("fit_tree")
def fit_tree(spark, sf):
    return _model_summary(spark, sf, "Decision Tree")


@query("fit_forest")
def fit_forest(spark, sf):
    return _model_summary(spark, sf, "Random Forest")


@query("score_all_models")
def score_all_models(spark, sf):
    """Test rows scored by all three models, labelled by model."""
    parts, models, _ = study(spark, sf)
    return cl.score_all(models, parts["test"])


@query("score_validation")
def score_validation(spark, sf):
    """Validation rows scored by the forest: the 15 model columns plus
    ``P_Delayed`` (element 2 of the probability vector), written as one CSV
    file and read back (vectors cannot go to CSV)."""
    parts, models, _ = study(spark, sf, ["Random Forest"])
    s = separate(models["Random Forest"].transform(parts["validation"]), "probability", {"P_Delayed": 2})
    out = s.select(*fl.MODEL_COLUMNS, "P_Delayed")
    path = write_csv(out, scratch_path(spark, "scored-validation"), single_file=True)
    return read_csv(spark, path, schema=out.schema)


@query("metrics_long")
def metrics_long(spark, sf):
    """AUC and accuracy (×100) of each model on the test part, long form."""
    parts, models, _ = study(spark, sf)
    return cl.performance(models, parts["test"])


@query("feature_importance")
def feature_importance(spark, sf):
    _, models, names = study(spark, sf, ["Decision Tree", "Random Forest"])
    return spark.createDataFrame(cl.importances(models, names), "feature string, importance double, Model string")


@query("coefficients")
def coefficients(spark, sf):
    _, models, names = study(spark, sf, ["Logistic"])
    return spark.createDataFrame(cl.coefficients(models["Logistic"], names), "term string, estimate double")


_LINE = with_(DIAMONDS) + """, r AS (SELECT count(*) AS n, regr_slope(price, carat) AS b, regr_intercept(price, carat) AS a, regr_r2(price, carat) AS r2,
  regr_sxx(price, carat) AS sxx, regr_syy(price, carat) AS syy, avg(carat) AS xbar FROM diamonds),
s AS (SELECT *, syy * (1 - r2) / (n - 2) AS sigma2 FROM r)
"""


def line(spark, sf):
    return inf.linear_model(si.diamonds(spark, sf), "price", ["carat"])


@query("linear_tidy", _LINE + """, t AS (SELECT '(Intercept)' AS term, a AS estimate, sqrt(sigma2 * (1 / n + xbar * xbar / sxx)) AS se FROM s
UNION ALL SELECT 'carat' AS term, b AS estimate, sqrt(sigma2 / sxx) AS se FROM s)
SELECT term, round(estimate, 5) AS estimate, round(se, 7) AS std_error, round(estimate / se, 5) AS statistic FROM t""")
def linear_tidy(spark, sf):
    """Coefficients of price ~ carat with standard errors and t values."""
    t = inf.tidy(spark, line(spark, sf))
    return t.select("term", F.round("estimate", 5).alias("estimate"), F.round("std_error", 7).alias("std_error"), F.round("statistic", 5).alias("statistic"))


@query("linear_glance", _LINE + """SELECT n AS n, n - 2 AS df_residual, round(r2, 10) AS r_squared, round(1 - (1 - r2) * (n - 1) / (n - 2), 10) AS adj_r_squared,
  round(sqrt(sigma2), 5) AS sigma, round(b * b * sxx / sigma2, 3) AS statistic, round(-n / 2 * (ln(2 * pi() * sigma2 * (n - 2) / n) + 1), 3) AS log_lik FROM s""")
def linear_glance(spark, sf):
    """One row about price ~ carat."""
    g = inf.glance(spark, line(spark, sf))
    return g.select("n", "df_residual", F.round("r_squared", 10).alias("r_squared"), F.round("adj_r_squared", 10).alias("adj_r_squared"),
                    F.round("sigma", 5).alias("sigma"), F.round("statistic", 3).alias("statistic"), F.round("log_lik", 3).alias("log_lik"))


@query("linear_augment", _LINE + """SELECT row_key, round(a + b * carat, 4) AS fitted, round(price - a - b * carat, 4) AS resid,
  round(1 / n + (carat - xbar) * (carat - xbar) / sxx, 12) AS hat,
  round((price - a - b * carat) / (sqrt(sigma2) * sqrt(1 - (1 / n + (carat - xbar) * (carat - xbar) / sxx))), 8) AS std_resid FROM diamonds, s""")
def linear_augment(spark, sf):
    """Every row with its fitted value, residual, leverage and standardised residual."""
    out = inf.augment(si.diamonds(spark, sf), "price", line(spark, sf))
    return out.select("row_key", F.round("fitted", 4).alias("fitted"), F.round("resid", 4).alias("resid"), F.round("hat", 12).alias("hat"),
                      F.round("std_resid", 8).alias("std_resid"))


def logistic(spark, sf):
    parts, models, names = study(spark, sf, ["Logistic"])
    m = models["Logistic"]
    lr = m.stages[-1]
    return inf.logistic_model(lr.coefficients, lr.intercept, names, inf.training_matrix(m, parts["training"]))


@query("logistic_tidy")
def logistic_tidy(spark, sf):
    """Coefficients of the delay model with standard errors, z and p values."""
    return inf.tidy(spark, logistic(spark, sf))


@query("logistic_glance")
def logistic_glance(spark, sf):
    """One row about the delay model: log-likelihood, AIC, BIC, deviances."""
    return inf.glance(spark, logistic(spark, sf))


@query("model_save_load")
def model_save_load(spark, sf):
    """Save the forest pipeline, load it, and score the validation part."""
    parts, models, _ = study(spark, sf, ["Random Forest"])
    path = save_model(models["Random Forest"], scratch_path(spark, "forest"))
    return cl.score(load_model(PipelineModel, path), parts["validation"], keep=["FlightNum"]).drop("probability")


@query("auc_rank", with_(SCORED) + """,
s AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM scored GROUP BY 1),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
SELECT round(sum(pos * (before + neg / 2.0)) / (sum(pos) * sum(neg)), 12) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c""")
def auc_rank(spark, sf):
    """AUC of a tied score against the return flag, by ranks."""
    a = cl.auc(si.scored_lines(spark, sf), "label", "score")
    return a.select(F.round("auc", 12).alias("auc"), "n_pos", "n_neg")


@query("accuracy_cutpoint", with_(SCORED) + """
SELECT CAST(sum(CASE WHEN (CASE WHEN score > 0.5 THEN 1 ELSE 0 END) = (CASE WHEN label = 1 THEN 1 ELSE 0 END) THEN 1 ELSE 0 END) AS DOUBLE)
       / count(*) AS accuracy FROM scored""")
def accuracy_cutpoint(spark, sf):
    return cl.accuracy(si.scored_lines(spark, sf), "label", "score", 0.5)


IMP_SQL = """
imp AS (SELECT l_linestatus AS Model, p_brand AS feature,
               round(sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (PARTITION BY l_linestatus), 12) AS importance
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def _importance_standin(spark, sf):
    """(feature, importance, Model): brand shares of revenue per line status."""
    li, pa = table(spark, sf, "lineitem"), table(spark, sf, "part")
    s = li.join(pa, li.l_partkey == pa.p_partkey).groupBy(
        F.col("l_linestatus").alias("Model"), F.col("p_brand").alias("feature")).agg(
        F.sum("l_extendedprice").alias("_v"))
    tot = s.groupBy("Model").agg(F.sum("_v").alias("_t"))
    return s.join(tot, "Model").select("feature", F.round(F.col("_v") / F.col("_t"), 12).alias("importance"),
                                       "Model")


@query("top_features", with_(IMP_SQL) + """,
top AS (SELECT feature FROM (SELECT *, row_number() OVER (PARTITION BY Model ORDER BY importance DESC, feature) AS rn FROM imp)
        WHERE rn <= 10)
SELECT feature, importance, Model FROM imp WHERE feature IN (SELECT feature FROM top)""")
def top_features(spark, sf):
    return cl.top_features(_importance_standin(spark, sf), 10)
