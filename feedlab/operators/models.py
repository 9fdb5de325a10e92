"""Models on the feature table and the rating log.

Model fitting is MLlib (distributed gradient/tree aggregation, block ALS);
this module fixes the source jobs' hyper-parameters as defaults, adds seeds,
and turns model outputs into plain DataFrames.  Chi-square statistics are
also computed natively from contingency counts so they can be checked in SQL.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Sequence
from functools import partial

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab import constants as C
from feedlab.session import materialize, together

SEED = 42
STAT_DIGITS = 6


# --------------------------------------------------------------- chi-square

def chi2_stats(df: DataFrame, features: Sequence[str], label: str = "label", count: str | None = None) -> DataFrame:
    """Pearson chi-square of each (categorical) feature against the label (M4).

    ``(feature, statistic, dof)``.  With O the observed count of a
    (value, label) cell, r and c its row/column totals and T the total,
    statistic = Σ_nonzero O²·T/(r·c) − T, equal to Σ (O−E)²/E over all
    cells.  All counts are grouped aggregates over the stacked
    ``(feature, value, label)`` rows.  ``count`` names a column of
    multiplicities, for rows that are already reduced to groups.
    """
    stacked = df.select(
        F.col(label).cast("double").alias("_y"), (F.col(count) if count else F.lit(1)).cast("long").alias("_c"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                            for f in features])).alias("_s"))
    # the cell table (features x values x labels) feeds four branches: write it once
    cells = materialize(stacked.select("_s.feature", "_s.value", "_y", "_c")
                               .groupBy("feature", "value", "_y").agg(F.sum("_c").alias("o")),
                        "chi2_cells")
    rows = cells.groupBy("feature", "value").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("feature", "_y").agg(F.sum("o").alias("c"))
    # null is a value of the tables above but not a distinct one
    tot = (rows.groupBy("feature").agg(F.sum("r").alias("t"), F.count("value").alias("nv"))
           .join(cols.groupBy("feature").agg(F.count("_y").alias("ny")), "feature"))
    j = cells.join(rows, ["feature", "value"]).join(cols, ["feature", "_y"]).join(tot, "feature")
    term = F.col("o").cast("double") * F.col("o") * F.col("t") / (F.col("r").cast("double") * F.col("c"))
    agg = j.groupBy("feature").agg(F.sum(term).alias("s"), F.max("t").alias("t"), F.max("nv").alias("nv"),
                                   F.max("ny").alias("ny"))
    return agg.select("feature", F.round(F.col("s") - F.col("t"), STAT_DIGITS).alias("statistic"),
                      ((F.col("nv") - 1) * (F.col("ny") - 1)).cast("long").alias("dof"))


def _log_gamma_q(a: float, x: float) -> float:
    """ln of the upper regularised incomplete gamma function Q(a, x): the series
    of its complement below the mean, Lentz's continued fraction above."""
    if x <= 0:
        return 0.0
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        return math.log1p(-min(math.exp(math.log(total) - x + a * math.log(x) - math.lgamma(a)), 1 - 1e-16))
    b, c = x + 1 - a, 1e300
    d = h = 1.0 / b
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.log(h) - x + a * math.log(x) - math.lgamma(a)


def chi2_p_value(statistic: float, dof: int) -> float:
    """Probability of a chi-square statistic at least this large."""
    return 1.0 if dof <= 0 else math.exp(_log_gamma_q(dof / 2, statistic / 2))


def chi2_select(stats: DataFrame, features: Sequence[str], k: int = C.CHI2_TOP_FEATURES) -> list[tuple[int, str]]:
    """The ``k`` features of smallest chi-square p-value, as (index, name) in
    index order (M4); equal p-values keep the features' order, as MLlib's
    selector does.  ``stats`` is ``chi2_stats`` of the same features: one row
    each, from the exact cells, so columns of any number of values work.
    """
    p = {r["feature"]: chi2_p_value(r["statistic"], r["dof"]) for r in stats.collect()}
    best = sorted(range(len(features)), key=lambda i: (p[features[i]], i))[:k]
    return [(i, features[i]) for i in sorted(best)]


# ------------------------------------------------------------ classifiers

def fit_lr(df: DataFrame, max_iter: int = C.LR_MAX_ITER, reg: float = C.LR_REG, enet: float = C.LR_ENET,
           label: str = "label", features: str = "features"):
    """Logistic regression (M5); the training summary carries M6 and the curves."""
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=enet, labelCol=label,
                              featuresCol=features).fit(df)


@contextlib.contextmanager
def _kept(df: DataFrame):
    """``df`` on the executors' disks while a tree model is fitted: a fit reads it four
    times, and a part of a random split sorts its whole input each time.  Rows keep
    their tasks, on which the models' samples depend."""
    ours = df.storageLevel == StorageLevel.NONE
    if ours:
        df.persist(StorageLevel.DISK_ONLY)
    try:
        yield df
    finally:
        if ours:
            df.unpersist()


def fit_tree(df: DataFrame, depth: int = C.TREE_DEPTH, label: str = "label", features: str = "features"):
    """Decision tree, depth 5 (M7)."""
    with _kept(df):
        return DecisionTreeClassifier(maxDepth=depth, labelCol=label, featuresCol=features, seed=SEED).fit(df)


def fit_forest(df: DataFrame, trees: int = C.FOREST_TREES, subsample: float = C.SUBSAMPLE, label: str = "label",
               features: str = "features"):
    """Random forest, 10 trees, subsample 0.7 (M8)."""
    with _kept(df):
        return RandomForestClassifier(numTrees=trees, subsamplingRate=subsample, labelCol=label,
                                      featuresCol=features, seed=SEED).fit(df)


def fit_gbt(df: DataFrame, subsample: float = C.SUBSAMPLE, label: str = "label", features: str = "features",
            max_iter: int = 20):
    """Gradient-boosted trees, subsample 0.7 (M9)."""
    with _kept(df):
        return GBTClassifier(subsamplingRate=subsample, labelCol=label, featuresCol=features, seed=SEED,
                             maxIter=max_iter).fit(df)


# The three tree models (M7-M9) by name.
TREE_FITS = (("decision_tree", fit_tree), ("random_forest", fit_forest), ("gbt", fit_gbt))


def fit_trees(df: DataFrame) -> list[tuple[str, object]]:
    """The three tree models of ``df``, fitted side by side: a fit is a row of short
    jobs, one level of trees each, which leave the cluster idle between them."""
    with _kept(df):
        models = together(df.sparkSession, *[partial(fit, df) for _, fit in TREE_FITS])
    return [(name, model) for (name, _), model in zip(TREE_FITS, models)]


def prediction_report(pred: DataFrame, label: str = "label") -> DataFrame:
    """label, prediction, probability, raw score and features as arrays."""
    cols = [F.col(label), F.col("prediction")]
    for c in ("probability", "rawPrediction", "features"):
        if c in pred.columns:
            cols.append(vector_to_array(c).alias(c))
    return pred.select(*cols)


def tree_report(model) -> dict:
    """Tree statistics printed by the source jobs (node count, depth,
    importances, class/feature counts, rule text)."""
    rep = {"num_features": model.numFeatures, "feature_importances": model.featureImportances.toArray().tolist(),
           "debug_string": model.toDebugString}
    for attr in ("numNodes", "depth", "numClasses", "totalNumNodes", "treeWeights", "getNumTrees"):
        if hasattr(model, attr):
            v = getattr(model, attr)
            rep[attr] = list(v) if isinstance(v, (list, tuple)) else v
    if hasattr(model, "trees"):
        rep["trees"] = [f"depth {t.depth}, {t.numNodes} nodes" for t in model.trees]
    return rep


# --------------------------------------------------------------------- ALS

def fit_als(df: DataFrame, iters: int = C.ALS_MAX_ITER, reg: float = C.ALS_REG,
            user_blocks: int = C.ALS_USER_BLOCKS, item_blocks: int = C.ALS_ITEM_BLOCKS,
            user: str = "uid", item: str = "urlid", rating: str = "label", rank: int = 10, seed: int = SEED):
    """Explicit-feedback ALS (M10) with the source jobs' block counts.

    Ids must be 32-bit: pass what ``als_input`` returns.
    """
    return als_estimator(iters, reg, user_blocks, item_blocks, user, item, rating, rank, seed).fit(df)


def als_estimator(iters: int = C.ALS_MAX_ITER, reg: float = C.ALS_REG, user_blocks: int = C.ALS_USER_BLOCKS,
                  item_blocks: int = C.ALS_ITEM_BLOCKS, user: str = "uid", item: str = "urlid", rating: str = "label",
                  rank: int = 10, seed: int = SEED) -> ALS:
    """The unfitted estimator, which can be saved (K8)."""
    return ALS(maxIter=iters, regParam=reg, numUserBlocks=user_blocks, numItemBlocks=item_blocks,
               userCol=user, itemCol=item, ratingCol=rating, rank=rank, seed=seed, coldStartStrategy="drop")


def als_input(df: DataFrame, user: str = "uid", item: str = "urlid", rating: str = "label"):
    """Ratings ready for ALS: ``(df, user_map, item_map)``.

    ALS takes 32-bit ids, so both id columns are always replaced by dense
    indices (computed distributed, no id list on the driver); the maps
    ``(original, index)`` lead back (``with_ids``).  Ratings without a user or
    an item are dropped: ALS cannot place them.
    """
    from feedlab.operators.relational import dense_index
    out = df.where(F.col(user).isNotNull() & F.col(item).isNotNull()).withColumn(rating, F.col(rating).cast("float"))
    maps = []
    for c in (user, item):
        index = dense_index(out, c, INDEX)
        maps.append(materialize(index.select(c, F.col(INDEX).cast("int").alias(INDEX)), f"als_{c}"))
        out = out.join(maps[-1], c).drop(c).withColumnRenamed(INDEX, c)
    return out, maps[0], maps[1]


INDEX = "_als_index"


def with_ids(df: DataFrame, id_map: DataFrame, col: str) -> DataFrame:
    """Replace the ALS indices in ``col`` by the original ids."""
    original = id_map.columns[0]
    m = id_map.select(F.col(original).alias("_original"), F.col(INDEX).alias(col))
    out = df.join(m, col)
    return out.select(*[F.col("_original").alias(c) if c == col else F.col(c) for c in df.columns])


def user_factors(model, user_map: DataFrame | None = None) -> DataFrame:
    """``(id, features)`` ordered by id."""
    f = model.userFactors
    return (with_ids(f, user_map, "id") if user_map is not None else f).orderBy("id")


def _recommended(recs: DataFrame, key: str, other: str, maps) -> DataFrame:
    rows = recs.select(key, F.inline("recommendations")).select(key, other, "rating")
    for col, id_map in maps:
        if id_map is not None:
            rows = with_ids(rows, id_map, col)
    return rows


def recommend_items(model, k: int = C.ALS_TOP_K, user: str = "uid", item: str = "urlid",
                    user_map: DataFrame | None = None, item_map: DataFrame | None = None) -> DataFrame:
    """Top-``k`` items per user, exploded to rows ``(uid, urlid, rating)``."""
    return _recommended(model.recommendForAllUsers(k), user, item, ((user, user_map), (item, item_map)))


def recommend_users(model, k: int = C.ALS_TOP_K, user: str = "uid", item: str = "urlid",
                    user_map: DataFrame | None = None, item_map: DataFrame | None = None) -> DataFrame:
    """Top-``k`` users per item, exploded."""
    return _recommended(model.recommendForAllItems(k), item, user, ((user, user_map), (item, item_map)))


# ------------------------------------------------------------ persistence

def save_model(model, path: str) -> None:
    """Model / estimator save (K8/K9)."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    return cls.load(path)
