"""Distributed evaluation metrics and threshold search.

Binary curves (ROC, PR, precision/F by threshold) need, per distinct score
``s`` in descending order, the cumulative positives ``tp(s)`` and negatives
``fp(s)``.  A plain ``Window.orderBy(score)`` would pull every row into one
task, so the cumulative counts are computed in two levels:

1. rows are reduced to one row per distinct score (partial + final agg);
2. distinct scores are cut into score ranges of about half a million rows
   (approximate quantiles, one aggregate pass); range totals (one row each)
   are prefix-summed in one small task;
3. inside each bucket a window partitioned by bucket adds the local
   running sum to the bucket's offset.

Every area is then a plain aggregate over the curve rows.  Results are exact
(no down-sampling of the curve).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlab.constants import THRESHOLD_TOLERANCE
from feedlab.operators.relational import range_buckets, within_of_max
from feedlab.session import materialize

METRIC_DIGITS = 9


def _m(c: Column) -> Column:
    return F.round(c, METRIC_DIGITS)


def score_counts(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score: ``(score, pos, neg)`` (label > 0.5 is positive)."""
    pos = (F.col(label).cast("double") > F.lit(0.5)).cast("long")
    return (df.where(F.col(score).isNotNull())
              .groupBy(F.col(score).cast("double").alias("score"))
              .agg(F.sum(pos).alias("pos"), F.sum(F.lit(1) - pos).alias("neg")))


def cumulative_counts(df: DataFrame, score: str = "score", label: str = "label",
                      n_buckets: int | None = None) -> DataFrame:
    """``(score, pos, neg, tp, fp, P, N)``: tp/fp are counts at score >= s."""
    # read by the bounds, the range totals and the curve: written once
    counts = materialize(score_counts(df, score, label), "score_counts")
    # bucket 0 holds the highest scores
    b = range_buckets(counts, "score", n_buckets, out="bucket", descending=True)
    tot = b.groupBy("bucket").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(
        "bucket",
        F.coalesce(F.sum("bp").over(before), F.lit(0)).alias("off_p"),
        F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("off_n"),
    )
    totals = tot.agg(F.struct(F.sum("bp").alias("P"), F.sum("bn").alias("N"))).scalar()
    inside = Window.partitionBy("bucket").orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cum = (b.join(off, "bucket")
            .select("score", "pos", "neg",
                    (F.col("off_p") + F.sum("pos").over(inside)).alias("tp"),
                    (F.col("off_n") + F.sum("neg").over(inside)).alias("fp"),
                    totals["P"].alias("P"), totals["N"].alias("N")))
    return cum


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``(threshold, fpr, tpr)`` per distinct score."""
    c = cumulative_counts(df, score, label)
    return c.select(F.col("score").alias("threshold"), (F.col("fp") / F.col("N")).alias("fpr"),
                    (F.col("tp") / F.col("P")).alias("tpr"))


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return F.col("tp") / F.col("P")


def precision_by_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``(threshold, precision)`` (E5)."""
    c = cumulative_counts(df, score, label)
    return c.select(F.col("score").alias("threshold"), _precision().alias("precision"))


def f_measure(p: Column, r: Column, beta: float = 1.0) -> Column:
    b2 = beta * beta
    return F.when(p + r == 0, F.lit(0.0)).otherwise((1.0 + b2) * p * r / (F.lit(b2) * p + r))


def f_by_threshold(df: DataFrame, score: str = "score", label: str = "label", beta: float = 1.0) -> DataFrame:
    """``(threshold, f_measure)``."""
    c = cumulative_counts(df, score, label)
    return c.select(F.col("score").alias("threshold"), f_measure(_precision(), _recall(), beta).alias("f_measure"))


def auc_roc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under ROC by the trapezoid rule over distinct scores.

    Each distinct score adds ``neg·(2·tp − pos) / (2·P·N)``; the numerator is
    an exact integer sum.
    """
    c = cumulative_counts(df, score, label)
    num = F.sum(F.col("neg") * (F.lit(2) * F.col("tp") - F.col("pos")))
    return c.agg((num.cast("double") / (F.lit(2.0) * F.max("P") * F.max("N"))).alias("auc_roc"))


def auc_roc_hard(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Area under ROC of hard predictions (E2): the curve has one inner point, so the
    area is ``(tp·N + tn·P) / (2·P·N)``, from one aggregate; null without both classes.
    Rows without a prediction are left out."""
    p, y = F.col(pred).cast("double") > 0.5, F.col(label).cast("double") > 0.5
    n = df.where(F.col(pred).isNotNull()).agg(
        F.count_if(y).alias("P"), F.count_if(~y).alias("N"), F.count_if(y & p).alias("tp"), F.count_if(~y & ~p).alias("tn"))
    area = (F.col("tp") * F.col("N") + F.col("tn") * F.col("P")).cast("double") / (F.lit(2.0) * F.col("P") * F.col("N"))
    return n.select(F.when((F.col("P") > 0) & (F.col("N") > 0), area).alias("auc_roc"))


def auc_pr(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the PR curve, trapezoid rule, first point (0, first precision)."""
    c = cumulative_counts(df, score, label)
    prev_tp = F.col("tp") - F.col("pos")
    prev_all = prev_tp + F.col("fp") - F.col("neg")
    p = _precision()
    p_prev = F.when(prev_all == 0, p).otherwise(prev_tp / prev_all)
    area = F.col("pos") / F.col("P") * (p + p_prev) / 2.0
    return c.agg(_m(F.sum(area)).alias("auc_pr"))


def best_threshold(curve: DataFrame, metric: str, tol: float = THRESHOLD_TOLERANCE,
                   threshold: str = "threshold") -> DataFrame:
    """Highest threshold whose metric is within ``tol`` of the maximum.

    The curve is ordered by threshold descending, so "first row within
    tolerance" is the largest such threshold.  One row: ``(threshold, metric)``.
    """
    near = within_of_max(curve, metric, tol)
    best = near.agg(F.max(F.struct(threshold, metric)).alias("_b"))
    return best.select(F.col("_b")[threshold].alias(threshold), F.col("_b")[metric].alias(metric))


def apply_threshold(df: DataFrame, score: str, t: Column | float, out: str = "prediction") -> DataFrame:
    """Hard prediction ``score > t``."""
    tc = t if isinstance(t, Column) else F.lit(t)
    return df.withColumn(out, F.when(F.col(score) > tc, F.lit(1.0)).otherwise(F.lit(0.0)))


def rmse(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Root mean squared error."""
    d = F.col(pred).cast("double") - F.col(label).cast("double")
    return df.agg(_m(F.sqrt(F.avg(d * d))).alias("rmse"))


def accuracy(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Accuracy and test error ``1 - accuracy``."""
    hit = (F.col(pred).cast("double") == F.col(label).cast("double")).cast("double")
    a = F.avg(hit)
    return df.agg(_m(a).alias("accuracy"), _m(F.lit(1.0) - a).alias("test_error"))


def weighted_f1(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Support-weighted F1 over the label classes (E8), as MLlib's default
    multiclass metric; ``f1_error = 1 - f1``.  Classes are few, so the
    per-class table is tiny; all counts come from one grouped pass."""
    p = F.col(pred).cast("double")
    y = F.col(label).cast("double")
    pairs = df.groupBy(y.alias("y"), p.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # each (label, prediction) count adds to its label class (support, true
    # positives) and to its predicted class (predicted): one more aggregate,
    # no joins; classes seen only as predictions carry no weight
    zero = F.lit(0).cast("long")
    roles = pairs.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("predicted")),
        F.struct(F.col("p").alias("c"), zero.alias("support"), zero.alias("tp"),
                 F.col("n").alias("predicted")))).alias("r")).select("r.*")
    per = (roles.groupBy("c").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                  F.sum("predicted").alias("predicted"))
                .where(F.col("support") > 0))
    prec = F.when(F.col("predicted") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("predicted"))
    rec = F.col("tp") / F.col("support")
    f1 = F.when(prec + rec == 0, F.lit(0.0)).otherwise(2.0 * prec * rec / (prec + rec))
    per = per.select("support", f1.alias("f1"))
    total = F.sum("support")
    w = F.sum(F.col("support") * F.col("f1")) / total
    return per.agg(_m(w).alias("weighted_f1"), _m(F.lit(1.0) - w).alias("f1_error"))
