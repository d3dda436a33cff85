"""Supervised classification workflow on Spark ML: features, three
classifiers, scoring, evaluation, importances."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, RFormula, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checkpoint import materialize
from .joins import semi_in
from .ranks import cumulative_counts
from .reshape import gather, top_n_by


def _safe(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_")


def dummy_names(col: str, levels: Sequence[str]) -> list[str]:
    """``<col>_<level>`` with safe characters; levels whose safe names collide get a number."""
    names, seen = [], {}
    for level in levels:
        name = f"{col}_{_safe(level)}"
        seen[name.lower()] = n = seen.get(name.lower(), 0) + 1
        names.append(name if n == 1 else f"{name}_{n}")
    return names


def dummy_encode(df: DataFrame, cols: str | Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One 0/1 column per level of each of ``cols`` except its last (alphabetical) level, named ``<col>_<level>``:
    one StringIndexer + OneHotEncoder for all columns (one pass). The level lists live in the fitted indexer (their
    size is the number of levels)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    mid, vec = [f"_{c}_idx" for c in cols], [f"_{c}_vec" for c in cols]
    idx = StringIndexer(inputCols=cols, outputCols=mid, stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    coded = idx.transform(df)
    out = OneHotEncoder(inputCols=mid, outputCols=vec, dropLast=True, handleInvalid="keep").fit(coded).transform(coded)
    dummies = [vector_to_array(F.col(v))[i].alias(name) for c, v, levels in zip(cols, vec, idx.labelsArray)
               for i, name in enumerate(dummy_names(c, levels[:-1]))]
    return out.select(*keep, *[c for c in cols if c not in keep], *dummies)


def formula(label: str, features: Sequence[str]) -> str:
    return f"{label} ~ " + " + ".join(features)


def feature_pipeline(label: str, features: Sequence[str]) -> RFormula:
    """``label ~ a + b + …``: strings become dummy columns (last level
    dropped, alphabetical order), numbers pass through; rows with a NULL
    in any used column are skipped (the R model-frame rule)."""
    return RFormula(formula=formula(label, features), featuresCol="features", labelCol="label",
                    handleInvalid="skip", stringIndexerOrderType="alphabetAsc")


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the vector slots from the column's ML attribute metadata."""
    attrs = df.schema[col].metadata["ml_attr"]["attrs"]
    pairs = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return [n for _, n in sorted(pairs)]


def classifiers(num_trees: int = 100, seed: int = 10432) -> dict:
    """The three models of the study: logistic regression, a gini decision
    tree and a gini random forest."""
    return {
        "Logistic": LogisticRegression(featuresCol="features", labelCol="label"),
        "Decision Tree": DecisionTreeClassifier(featuresCol="features", labelCol="label", impurity="gini",
                                                seed=seed),
        "Random Forest": RandomForestClassifier(featuresCol="features", labelCol="label", impurity="gini",
                                                numTrees=num_trees, seed=seed),
    }


def fit_all(train: DataFrame, label: str, features: Sequence[str], num_trees: int = 100,
            seed: int = 10432, only: Sequence[str] | None = None) -> dict[str, PipelineModel]:
    """Fit every classifier (or ``only`` some) behind one shared formula stage.

    The formula (string indexers, encoders, assembler) is fitted once and
    the assembled training matrix is written once to the checkpoint folder;
    the three estimators all read that copy. Each result is a two-stage
    ``PipelineModel`` that scores raw rows."""
    fm = feature_pipeline(label, features).fit(train)
    x = materialize(fm.transform(train).select("features", "label"))
    # independent fits on the same written matrix: submitted together, as
    # Spark ML's own tuning does with ``parallelism``; seeds fix the results
    from concurrent.futures import ThreadPoolExecutor

    ests = {n: e for n, e in classifiers(num_trees, seed).items() if only is None or n in only}
    with ThreadPoolExecutor(max_workers=len(ests)) as pool:
        fitted = {name: pool.submit(est.fit, x) for name, est in ests.items()}
        return {name: PipelineModel(stages=[fm, f.result()]) for name, f in fitted.items()}


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Predictions: kept columns + label, prediction and P(class 1)."""
    out = model.transform(df)
    return out.select(*keep, "label", "prediction", vector_to_array("probability")[1].alias("p_yes"),
                      "probability")


def score_all(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Scores of every model, row-bound and labelled with the model name. Models behind one formula stage share the
    feature matrix of ``df``, which is made and written once."""
    from .joins import bind_rows_labelled

    shared = {id(m.stages[0]) for m in models.values()}
    if len(shared) == 1 and all(len(m.stages) == 2 for m in models.values()):
        x = materialize(next(iter(models.values())).stages[0].transform(df).select("features", "label"))
        last = {n: PipelineModel(stages=m.stages[1:]) for n, m in models.items()}
        return bind_rows_labelled({n: score(m, x).drop("probability") for n, m in last.items()}, "model")
    return bind_rows_labelled({n: score(m, df).drop("probability") for n, m in models.items()}, "model")


def auc(scored: DataFrame, label: str = "label", score_col: str = "p_yes", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by ranks, ties counted half (Mann-Whitney):
    Σ_s pos(s)·(neg_before(s) + neg(s)/2) / (P·N) over distinct scores s.

    Rows collapse to one per (group, score); the negatives before each score
    come from the distributed block counts (no global ordered window), so a
    single score holding many rows costs nothing extra.
    """
    g = list(by)
    d = scored.select(*g, F.col(score_col).alias("_s"),
                      F.when(F.col(label) == 1, 1).otherwise(0).cast("long").alias("_pos"),
                      F.when(F.col(label) == 1, 0).otherwise(1).cast("long").alias("_neg"))
    cc = cumulative_counts(d, ["_s"], g, weight_col="_neg", sums=["_pos"])
    agg = cc.groupBy(*g).agg(
        F.sum(F.col("_pos") * (F.col("_before") + F.col("_w") / 2.0)).alias("_num"),
        F.sum("_pos").alias("n_pos"), F.max("_n").alias("n_neg"))
    auc_v = F.try_divide(F.col("_num"), F.col("n_pos") * F.col("n_neg"))  # NULL when a class is absent
    return agg.select(*g, auc_v.alias("auc"), "n_pos", "n_neg")


def auc_evaluator(scored: DataFrame, label: str = "label", raw: str = "probability") -> float:
    """Spark's evaluator with the full curve (``numBins=0``)."""
    return BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol=label, metricName="areaUnderROC",
                                         numBins=0).evaluate(scored)


def accuracy(scored: DataFrame, label: str = "label", score_col: str = "p_yes", cutpoint: float = 0.5,
             by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose class (1 iff score > cutpoint, strictly) equals
    the label (any label other than 1 counts as 0)."""
    pred = F.when(F.col(score_col) > cutpoint, 1.0).otherwise(0.0)
    tgt = F.when(F.col(label) == 1, 1.0).otherwise(0.0)
    hit = F.when(pred == tgt, 1).otherwise(0)
    return scored.groupBy(*by).agg((F.sum(hit) / F.count(F.lit(1))).alias("accuracy"))


def performance(models: dict[str, PipelineModel], data: DataFrame, digits: int = 1) -> DataFrame:
    """model × {AUC, Accuracy} (×100), long, with a rounded display value.
    The scores are computed once and written once; both metrics read them."""
    s = materialize(score_all(models, data))
    a = auc(s, by=["model"]).select("model", (F.col("auc") * 100).alias("AUC"))
    c = accuracy(s, by=["model"]).select("model", (F.col("accuracy") * 100).alias("Accuracy"))
    long = gather(a.join(c, "model"), ["model"], ["AUC", "Accuracy"], "metric", "value")
    return long.withColumn("val2", F.bround("value", digits))


def importances(models: dict[str, PipelineModel], names: list[str]) -> list[tuple[str, float, str]]:
    """(feature, importance, Model) for every tree-based model."""
    rows = []
    for name, m in models.items():
        est = m.stages[-1]
        if hasattr(est, "featureImportances"):
            imp = est.featureImportances.toArray()
            rows += [(names[i], float(imp[i]), name) for i in range(len(names))]
    return rows


def top_features(imp: DataFrame, n: int = 10, model: str = "Model") -> DataFrame:
    """Top ``n`` features of each model, then every model's row for any
    feature that made a top list (group → arrange → slice → %in%). The
    importance table is read twice, so it is written once first."""
    imp = materialize(imp)
    top = top_n_by(imp, [model], [F.desc("importance"), F.asc("feature")], n)
    keep = top.select("feature").distinct()
    return semi_in(imp, keep, "feature")


def coefficients(model: PipelineModel, names: list[str]) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return [("(Intercept)", float(lr.intercept))] + [(n, float(c)) for n, c in zip(names, lr.coefficients)]
