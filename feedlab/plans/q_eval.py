"""Queries: evaluation metrics and threshold search on the scored impressions (step 6)."""

from __future__ import annotations

from feedlab.operators.evaluate import (accuracy, apply_threshold, auc_pr, auc_roc, auc_roc_hard, best_threshold,
                                        f_by_threshold, precision_by_threshold, rmse, roc_curve, weighted_f1)
from feedlab.plans import sql as S
from feedlab.plans.registry import query
from feedlab.sources.tables import scores

CURVE = S.with_(S.IMPRESSIONS, S.URL_STATS, S.SCORES) + """, curve AS (
  SELECT score, pos, neg,
         sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         sum(pos) OVER () AS P, sum(neg) OVER () AS N
  FROM (SELECT CAST(score AS DOUBLE) AS score,
               CAST(sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
               CAST(sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS BIGINT) AS neg
        FROM scores WHERE score IS NOT NULL GROUP BY score)),
pr AS (
  SELECT score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / P AS recall
  FROM curve),
fm AS (
  SELECT threshold, CASE WHEN precision + recall = 0 THEN 0.0
                         ELSE 2.0 * precision * recall / (1.0 * precision + recall) END AS f_measure
  FROM pr)
"""
CURVE = CURVE.replace("WITH ", "WITH ", 1).replace(")\n, curve AS", "),\ncurve AS")


def _best_sql(table: str, metric: str) -> str:
    return f"""SELECT max(threshold) AS threshold, arg_max({metric}, threshold) AS {metric}
FROM {table} WHERE (SELECT max({metric}) FROM {table}) - {metric} < 0.00001"""


@query("eval_rmse", S.with_(S.IMPRESSIONS, S.URL_STATS, S.SCORES) + """
SELECT round(sqrt(avg((score - label) * (score - label))), 9) AS rmse FROM scores
""")
def q_eval_rmse(spark, sf_dir):
    return rmse(scores(spark, sf_dir), "score", "label")


@query("eval_auc_roc", CURVE + """
SELECT CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / (2.0 * max(P) * max(N)) AS auc_roc FROM curve
""")
def q_eval_auc_roc(spark, sf_dir):
    return auc_roc(scores(spark, sf_dir))


@query("eval_auc_roc_hard", S.with_(S.IMPRESSIONS, S.URL_STATS, S.SCORES) + """, n AS (
  SELECT CAST(sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS p,
         CAST(sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS BIGINT) AS n,
         CAST(sum(CASE WHEN label > 0.5 AND prediction > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN label <= 0.5 AND prediction <= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM scores WHERE prediction IS NOT NULL)
SELECT CAST(tp * n + tn * p AS DOUBLE) / (2.0 * p * n) AS auc_roc FROM n
""".replace("\n, n AS", ",\nn AS"))
def q_eval_auc_roc_hard(spark, sf_dir):
    return auc_roc_hard(scores(spark, sf_dir))


@query("eval_auc_pr", CURVE + """
SELECT round(sum(CAST(pos AS DOUBLE) / P * (CAST(tp AS DOUBLE) / (tp + fp) +
             CASE WHEN tp - pos + fp - neg = 0 THEN CAST(tp AS DOUBLE) / (tp + fp)
                  ELSE CAST(tp - pos AS DOUBLE) / (tp - pos + fp - neg) END) / 2.0), 9) AS auc_pr
FROM curve
""")
def q_eval_auc_pr(spark, sf_dir):
    return auc_pr(scores(spark, sf_dir))


@query("eval_roc_curve", CURVE + """
SELECT score AS threshold, CAST(fp AS DOUBLE) / N AS fpr, CAST(tp AS DOUBLE) / P AS tpr FROM curve
""")
def q_eval_roc_curve(spark, sf_dir):
    return roc_curve(scores(spark, sf_dir))


@query("eval_precision_by_threshold", CURVE + "SELECT threshold, precision FROM pr")
def q_eval_precision_by_threshold(spark, sf_dir):
    return precision_by_threshold(scores(spark, sf_dir))


@query("eval_f_by_threshold", CURVE + "SELECT threshold, f_measure FROM fm")
def q_eval_f_by_threshold(spark, sf_dir):
    return f_by_threshold(scores(spark, sf_dir))


@query("threshold_best_f", CURVE + _best_sql("fm", "f_measure"))
def q_threshold_best_f(spark, sf_dir):
    return best_threshold(f_by_threshold(scores(spark, sf_dir)), "f_measure")


@query("threshold_best_precision", CURVE + _best_sql("pr", "precision"))
def q_threshold_best_precision(spark, sf_dir):
    return best_threshold(precision_by_threshold(scores(spark, sf_dir)), "precision")


@query("apply_threshold", CURVE + f""", best AS ({_best_sql("fm", "f_measure")})
SELECT s.event_id, s.score, s.label,
       CASE WHEN s.score > b.threshold THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction
FROM scores s CROSS JOIN best b
""".replace("\n, best AS", ",\nbest AS"))
def q_apply_threshold(spark, sf_dir):
    s = scores(spark, sf_dir).drop("prediction")
    best = best_threshold(f_by_threshold(s), "f_measure").select("threshold").scalar()
    out = apply_threshold(s, "score", best)
    return out.select("event_id", "score", "label", "prediction")


@query("eval_accuracy", S.with_(S.IMPRESSIONS, S.URL_STATS, S.SCORES) + """
SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
       round(1.0 - avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 9) AS test_error
FROM scores
""")
def q_eval_accuracy(spark, sf_dir):
    return accuracy(scores(spark, sf_dir), "prediction", "label")


@query("eval_weighted_f1", S.with_(S.IMPRESSIONS, S.URL_STATS, S.SCORES) + """, pairs AS (
  SELECT CAST(label AS DOUBLE) AS y, prediction AS p, count(*) AS n FROM scores GROUP BY 1, 2),
per AS (
  SELECT s.c, s.support, coalesce(pr.predicted, 0) AS predicted, coalesce(t.tp, 0) AS tp
  FROM (SELECT y AS c, sum(n) AS support FROM pairs GROUP BY y) s
  LEFT JOIN (SELECT p AS c, sum(n) AS predicted FROM pairs GROUP BY p) pr ON s.c = pr.c
  LEFT JOIN (SELECT y AS c, n AS tp FROM pairs WHERE y = p) t ON s.c = t.c),
f AS (
  SELECT support,
         CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / predicted END AS prec,
         CAST(tp AS DOUBLE) / support AS rec FROM per)
SELECT round(sum(support * CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2.0 * prec * rec / (prec + rec) END)
             / sum(support), 9) AS weighted_f1,
       round(1.0 - sum(support * CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2.0 * prec * rec / (prec + rec) END)
             / sum(support), 9) AS f1_error
FROM f
""".replace("\n, pairs AS", ",\npairs AS"))
def q_eval_weighted_f1(spark, sf_dir):
    return weighted_f1(scores(spark, sf_dir), "prediction", "label")
