"""Queries: chi-square, classifiers, ALS, model persistence (step 7).

Fitted models are not SQL-checkable; their queries return the model outputs
as DataFrames (rows-only check) and pytest checks invariants.  The feature
table feeding them is written once to the shared checkpoint folder so fit
and transform do not recompute it.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from feedlab.operators.features import VECTOR_ORDER, assemble
from feedlab.operators.models import (als_estimator, als_input, chi2_select, chi2_stats, fit_als, fit_forest,
                                      fit_gbt, fit_lr, fit_tree, fit_trees, load_model, prediction_report,
                                      recommend_items, recommend_users, save_model, tree_report, user_factors,
                                      with_ids)
from feedlab.operators.relational import random_split
from feedlab.plans.feed import checkpoint_stage, feed_feature_groups, feed_train_feature
from feedlab.plans.q_features import _feature_table_sql
from feedlab.plans.registry import query
from feedlab.session import scratch_path
from feedlab.sources.tables import ratings

from feedlab import constants as C

SEED = 42
CLS_SPLIT = list(C.TRAIN_SPLIT_CLASSIFIER)


def _ml_input(spark, sf_dir):
    return checkpoint_stage(spark, assemble(feed_train_feature(spark, sf_dir), VECTOR_ORDER), "ml_input")


def _chi2_sql() -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST(label AS DOUBLE) AS y FROM train_feature"
        for c in VECTOR_ORDER)
    return _feature_table_sql().rstrip("\n") + f""",
stacked AS ({parts}),
cells AS (SELECT feature, value, y, count(*) AS o FROM stacked GROUP BY feature, value, y),
r AS (SELECT feature, value, sum(o) AS r FROM cells GROUP BY feature, value),
c AS (SELECT feature, y, sum(o) AS c FROM cells GROUP BY feature, y),
t AS (SELECT feature, sum(o) AS t, count(DISTINCT value) AS nv, count(DISTINCT y) AS ny FROM cells GROUP BY feature)
SELECT cells.feature,
       round(sum(CAST(o AS DOUBLE) * o * t.t / (CAST(r.r AS DOUBLE) * c.c)) - max(t.t), 6) AS statistic,
       CAST((max(t.nv) - 1) * (max(t.ny) - 1) AS BIGINT) AS dof
FROM cells JOIN r ON cells.feature = r.feature AND cells.value = r.value
           JOIN c ON cells.feature = c.feature AND cells.y = c.y
           JOIN t ON cells.feature = t.feature
GROUP BY cells.feature
"""


@query("chi2_stats", _chi2_sql())
def q_chi2_stats(spark, sf_dir):
    # counted from the reduced (uid, urlid, label) groups, not from their expansion
    return chi2_stats(feed_feature_groups(spark, sf_dir), VECTOR_ORDER, "label", count="cnt")


def _chi2_select_sql() -> str:
    """The upper tail of the chi-square distribution as two recursions over the
    seven features: the series of the lower tail below the mean, a continued
    fraction above it."""
    *ctes, last = _chi2_sql().rpartition("SELECT cells.feature")
    names = ", ".join(f"('{f}', {i})" for i, f in enumerate(VECTOR_ORDER))
    return ctes[0].replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
stats AS (SELECT cells.feature{last}),
arg AS (SELECT n.feature, n.i, stats.dof / 2.0::DOUBLE AS a, stats.statistic / 2.0::DOUBLE AS x, stats.dof
        FROM stats JOIN (VALUES {names}) n(feature, i) ON n.feature = stats.feature),
ser AS (
  SELECT feature, x, a AS n, 1 / a AS term, 1 / a AS total FROM arg WHERE dof > 0 AND x > 0 AND x < a + 1
  UNION ALL
  SELECT feature, x, n + 1, term * x / (n + 1), total + term * x / (n + 1) FROM ser WHERE term > total * 1e-16),
frac AS (
  SELECT feature, a, 0::BIGINT AS k, x + 1 - a AS b, 1e300::DOUBLE AS c, 1 / (x + 1 - a) AS d, 1 / (x + 1 - a) AS h,
         false AS done
  FROM arg WHERE dof > 0 AND x >= a + 1
  UNION ALL
  SELECT feature, a, k, b, c, d, h * d * c, abs(d * c - 1) < 1e-15 OR k >= 99999
  FROM (SELECT feature, a, k + 1 AS k, b + 2 AS b, b + 2 - (k + 1) * (k + 1 - a) / c AS c,
               1 / (b + 2 - (k + 1) * (k + 1 - a) * d) AS d, h FROM frac WHERE NOT done)),
p AS (
  SELECT arg.feature, arg.i, CASE
    WHEN arg.dof <= 0 OR arg.x <= 0 THEN 1.0::DOUBLE
    WHEN s.total IS NOT NULL
      THEN 1 - least(exp(ln(s.total) - arg.x + arg.a * ln(arg.x) - lgamma(arg.a)), 1 - 1e-16::DOUBLE)
    ELSE exp(ln(f.h) - arg.x + arg.a * ln(arg.x) - lgamma(arg.a)) END AS p
  FROM arg LEFT JOIN (SELECT feature, max(total) AS total FROM ser GROUP BY feature) s ON s.feature = arg.feature
           LEFT JOIN (SELECT feature, h FROM frac WHERE done) f ON f.feature = arg.feature),
best AS (SELECT feature, i FROM p ORDER BY p, i LIMIT {C.CHI2_TOP_FEATURES})
SELECT CAST(row_number() OVER (ORDER BY i) - 1 AS INTEGER) AS rank, CAST(i AS INTEGER) AS feature_index, feature FROM best
"""


@query("chi2_select", _chi2_select_sql())
def q_chi2_select(spark, sf_dir):
    stats = chi2_stats(feed_feature_groups(spark, sf_dir), VECTOR_ORDER, "label", count="cnt")
    rows = [(rank, i, name) for rank, (i, name) in enumerate(chi2_select(stats, VECTOR_ORDER))]
    return spark.createDataFrame(rows, "rank int, feature_index int, feature string")


@query("lr_coefficients")
def q_lr_coefficients(spark, sf_dir):
    train, _ = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    m = fit_lr(train)
    rows = [(name, float(v)) for name, v in zip(VECTOR_ORDER, m.coefficients.toArray())]
    rows.append(("intercept", float(m.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


@query("lr_objective")
def q_lr_objective(spark, sf_dir):
    train, _ = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    m = fit_lr(train)
    hist = m.summary.objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, objective double")


def _report(model, test):
    return prediction_report(model.transform(test))


@query("dt_predictions")
def q_dt_predictions(spark, sf_dir):
    train, test = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    return _report(fit_tree(train), test)


@query("rf_predictions")
def q_rf_predictions(spark, sf_dir):
    train, test = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    return _report(fit_forest(train), test)


@query("gbt_predictions")
def q_gbt_predictions(spark, sf_dir):
    train, test = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    return _report(fit_gbt(train), test)


def _als(spark, sf_dir):
    """(model, held-out ratings, user map, item map)"""
    r, users, items = als_input(ratings(spark, sf_dir))
    r = checkpoint_stage(spark, r, "ratings")
    train, test = random_split(r, list(C.TRAIN_SPLIT_ALS), SEED)
    return fit_als(train), test, users, items


@query("als_predictions")
def q_als_predictions(spark, sf_dir):
    model, test, users, items = _als(spark, sf_dir)
    pred = model.transform(test).select("uid", "urlid", "label", "prediction")
    return with_ids(with_ids(pred, users, "uid"), items, "urlid")


@query("als_user_factors")
def q_als_user_factors(spark, sf_dir):
    model, _, users, _ = _als(spark, sf_dir)
    return user_factors(model, users).select(
        "id", F.array_join(F.transform("features", lambda x: x.cast("string")), ",").alias("features"))


@query("als_user_recs")
def q_als_user_recs(spark, sf_dir):
    model, _, users, items = _als(spark, sf_dir)
    return recommend_items(model, user_map=users, item_map=items)


@query("als_item_recs")
def q_als_item_recs(spark, sf_dir):
    model, _, users, items = _als(spark, sf_dir)
    return recommend_users(model, user_map=users, item_map=items)


@query("als_estimator_roundtrip")
def q_als_estimator_roundtrip(spark, sf_dir):
    """The estimator saved, loaded and fitted again (K8), next to the first one's predictions."""
    r, users, items = als_input(ratings(spark, sf_dir))
    train, test = random_split(checkpoint_stage(spark, r, "ratings"), list(C.TRAIN_SPLIT_ALS), SEED)
    est = als_estimator()
    path = scratch_path(spark, "als_estimator")
    save_model(est, path)
    before = est.fit(train).transform(test).withColumnRenamed("prediction", "pred_before")
    both = load_model(ALS, path).fit(train).transform(before).withColumnRenamed("prediction", "pred_after")
    out = both.select("uid", "urlid", "label", "pred_before", "pred_after")
    return with_ids(with_ids(out, users, "uid"), items, "urlid")


@query("ml_model_roundtrip")
def q_ml_model_roundtrip(spark, sf_dir):
    data = _ml_input(spark, sf_dir)
    train, test = random_split(data, CLS_SPLIT, SEED)
    m = fit_lr(train)
    path = scratch_path(spark, "lr_model")
    save_model(m, path)
    back = load_model(LogisticRegressionModel, path)
    # one table scored by both models, so rows pair by construction
    keep = ("rawPrediction", "probability", "prediction")
    before = m.transform(test).withColumnRenamed("prediction", "pred_before").drop(*keep)
    both = back.transform(before).withColumnRenamed("prediction", "pred_after").drop(*keep)
    return both.select("label", "pred_before", "pred_after", (F.col("pred_before") == F.col("pred_after")).alias("same"))


def _lr_and_test(spark, sf_dir):
    train, test = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    return fit_lr(train), test


@query("lr_threshold_predictions")
def q_lr_threshold_predictions(spark, sf_dir):
    """Best-F threshold from the training curve, set on the fitted model (M13),
    then the held-out set scored with it."""
    from feedlab.operators.evaluate import best_threshold
    model, test = _lr_and_test(spark, sf_dir)
    curve = model.summary.fMeasureByThreshold.withColumnRenamed("F-Measure", "f_measure")
    t = best_threshold(curve, "f_measure").first()["threshold"]
    model.setThreshold(float(t))
    return prediction_report(model.transform(test)).withColumn("threshold", F.lit(float(t)))


@query("lr_eval")
def q_lr_eval(spark, sf_dir):
    """Native AUC ROC / PR of held-out LR scores (probability of class 1),
    next to MLlib's evaluator on the same scores."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import vector_to_array
    from feedlab.operators.evaluate import auc_pr, auc_roc
    model, test = _lr_and_test(spark, sf_dir)
    pred = model.transform(test).select("label", vector_to_array("probability")[1].alias("score"))
    pred = checkpoint_stage(spark, pred, "lr_scores")
    roc = auc_roc(pred).first()["auc_roc"]
    pr = auc_pr(pred).first()["auc_pr"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    rows = [("auc_roc", float(roc), float(ev.evaluate(pred))),
            ("auc_pr", float(pr), float(ev.setMetricName("areaUnderPR").evaluate(pred)))]
    return spark.createDataFrame(rows, "metric string, native double, mllib double")


@query("lr_json_coefficients")
def q_lr_json_coefficients(spark, sf_dir):
    """LR on the JSON-table 6-vector: 500 iterations, reg 0.2, elastic net 0.8 (M3 + M5)."""
    from feedlab.operators.features import JSON_VECTOR_ORDER
    from feedlab.plans.q_features import json_ml_input
    data = checkpoint_stage(spark, json_ml_input(spark, sf_dir), "json_ml_input")
    m = fit_lr(data, C.LR_TABLE_MAX_ITER, C.LR_TABLE_REG, C.LR_TABLE_ENET)
    rows = [(n, float(v)) for n, v in zip(JSON_VECTOR_ORDER, m.coefficients.toArray())]
    rows += [("intercept", float(m.intercept)), ("train_auc_roc", float(m.summary.areaUnderROC))]
    return spark.createDataFrame(rows, "feature string, value double")


@query("tree_eval")
def q_tree_eval(spark, sf_dir):
    """Accuracy, test error and weighted F1 of the three tree models on the held-out set."""
    from feedlab.operators.evaluate import accuracy, weighted_f1
    train, test = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    # scored once for each measure of each model, so written once
    test = checkpoint_stage(spark, test, "ml_test")
    out = None
    for name, model in fit_trees(train):
        pred = model.transform(test).select("label", "prediction")
        acc = accuracy(pred)
        f1 = weighted_f1(pred)
        m = spark.range(1).select(F.lit(name).alias("model"), acc.select("accuracy").scalar().alias("accuracy"),
                                  acc.select("test_error").scalar().alias("test_error"),
                                  f1.select("weighted_f1").scalar().alias("weighted_f1"),
                                  f1.select("f1_error").scalar().alias("f1_error"))
        out = m if out is None else out.unionByName(m)
    return out


def _tree_report(spark, sf_dir, fit):
    train, _ = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    rep = tree_report(fit(train))
    return spark.createDataFrame([(k, str(v)) for k, v in sorted(rep.items())], "name string, value string")


@query("dt_report")
def q_dt_report(spark, sf_dir):
    """Tree statistics: node count, depth, classes, features, importances, rules (M7)."""
    return _tree_report(spark, sf_dir, fit_tree)


@query("rf_report")
def q_rf_report(spark, sf_dir):
    """Forest statistics: total nodes, tree weights, importances, rules, tree list (M8)."""
    return _tree_report(spark, sf_dir, fit_forest)


@query("gbt_report")
def q_gbt_report(spark, sf_dir):
    """The same of the boosted trees (M9)."""
    return _tree_report(spark, sf_dir, fit_gbt)


@query("als_rmse")
def q_als_rmse(spark, sf_dir):
    """RMSE of ALS predictions on the held-out ratings (E1 on M10)."""
    from feedlab.operators.evaluate import rmse
    model, test, _, _ = _als(spark, sf_dir)
    return rmse(model.transform(test), "prediction", "label")
