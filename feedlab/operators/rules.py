"""Fitted trees as rows (M7-M9): node tables, scoring by a native walk, rules.

A saved tree model is read back as one row per node.  ``score_nodes`` walks the
nodes with built-in array functions, so a table is scored without the model
object; ``leaf_rules`` gives one row per leaf with the conditions on its path.

The nodes travel to the rows as one value of proven size: a tree of depth d has
fewer than 2^(d+1) nodes, and depth and number of trees are model parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab.operators.models import save_model
from feedlab.session import scratch_path

CLASSES, MARGIN = "classes", "margin"


def node_table(spark: SparkSession, model) -> DataFrame:
    """One row per node: ``tree, weight, id, feature, threshold, left_values, left,
    right, prediction, stats, rows, gain``.

    A leaf has ``feature`` -1.  ``left_values`` holds the values that go left at a
    categorical split and is null at a numeric one, which has a ``threshold``
    (values up to it go left).
    """
    path = scratch_path(spark, "tree_model")
    save_model(model, path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        # boosted trees are weighted; a forest's trees count the same
        weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
        data = data.join(weights, "treeID").select(F.col("treeID").alias("tree"), "weight", "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0)).withColumn("weight", F.lit(1.0))
    numeric = F.col("split.numCategories") == -1
    values = F.col("split.leftCategoriesOrThreshold")
    return data.select(
        "tree", "weight", "id", F.col("split.featureIndex").alias("feature"),
        F.when(numeric, F.get(values, F.lit(0))).alias("threshold"), F.when(~numeric, values).alias("left_values"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), "prediction",
        F.col("impurityStats").alias("stats"), F.col("rawCount").alias("rows"), "gain")


def model_kind(model) -> str:
    """How leaves combine: boosted trees add predictions, the others class shares."""
    return MARGIN if type(model).__name__.startswith("GBT") else CLASSES


def _trees(nodes: DataFrame) -> Column:
    """All trees as one value: per tree its nodes, at the position of their id."""
    node = F.struct("id", "feature", "threshold", "left_values", "left", "right", "prediction", "stats")
    per_tree = nodes.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    return per_tree.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar()


def _leaf(nodes: Column, x: Column, depth: int) -> Column:
    """The leaf that ``x`` reaches: one step down per level, a leaf stays."""
    def step(at, _):
        value = F.get(x, at["feature"])
        goes_left = F.when(at["left_values"].isNull(), value <= at["threshold"]).otherwise(
            F.array_contains(at["left_values"], value))
        return F.when(at["feature"] < 0, at).otherwise(F.get(nodes, F.when(goes_left, at["left"]).otherwise(at["right"])))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.get(nodes, F.lit(0)), step)


def score_nodes(df: DataFrame, nodes: DataFrame, kind: str, depth: int, features: str = "features",
                out: str = "prediction") -> DataFrame:
    """``df`` plus ``out``, the prediction of the trees in ``nodes`` for the array column ``features``.

    ``kind`` is ``model_kind``; ``depth`` is at least the deepest tree's depth.
    Class shares are added tree by tree and the first largest class wins;
    margins are added and the sign decides.
    """
    # (a subquery may not sit inside a lambda: project it as a column first)
    with_trees = df.withColumn("_trees", _trees(nodes))
    leaf = lambda t: _leaf(t["nodes"], F.col(features), depth)
    if kind == MARGIN:
        margin = F.aggregate("_trees", F.lit(0.0), lambda acc, t: acc + t["weight"] * leaf(t)["prediction"])
        return with_trees.withColumn(out, F.when(margin > 0, F.lit(1.0)).otherwise(F.lit(0.0))).drop("_trees")
    reached = with_trees.withColumn("_stats", F.transform("_trees", lambda t: leaf(t)["stats"]))

    def add(acc, stats):
        total = F.aggregate(stats, F.lit(0.0), lambda a, s: a + s)
        return F.when(total == 0, acc).otherwise(F.zip_with(acc, stats, lambda a, s: a + s / total))
    votes = F.aggregate("_stats", F.transform(F.get("_stats", F.lit(0)), lambda _: F.lit(0.0)), add)
    voted = reached.withColumn("_votes", votes)
    winner = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
    return voted.withColumn(out, winner).drop("_trees", "_stats", "_votes")


def leaf_rules(nodes: DataFrame, names: Sequence[str], depth: int) -> DataFrame:
    """One row per leaf: ``tree, leaf, weight, level, rule, prediction, rows, share``.

    ``rule`` joins the conditions from the root down with `` and ``, features by
    their ``names`` (empty for a tree of one leaf); ``share`` is the leaf's part of
    its tree's training rows.
    """
    name = F.array(*[F.lit(n) for n in names])
    one = F.struct("id", "feature", "threshold", "left_values", "left", "right", "prediction", "rows")
    trees = (nodes.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(one)).alias("nodes"))
             .withColumn("names", name))
    leaves = trees.select("*", F.explode(F.filter("nodes", lambda n: n["feature"] < 0)).alias("at"))

    def condition(parent, child):
        feature = F.get("names", parent["feature"])
        goes_left = parent["left"] == child
        numeric = F.concat(feature, F.when(goes_left, F.lit(" <= ")).otherwise(F.lit(" > ")),
                           parent["threshold"].cast("string"))
        listed = F.concat(feature, F.when(goes_left, F.lit(" in ")).otherwise(F.lit(" not in ")), F.lit("{"),
                          F.array_join(F.transform(parent["left_values"], lambda v: v.cast("string")), ", "), F.lit("}"))
        return F.when(parent["left_values"].isNull(), numeric).otherwise(listed)

    def climb(acc, _):
        parent = F.get(F.filter("nodes", lambda n: (n["left"] == acc["at"]) | (n["right"] == acc["at"])), F.lit(0))
        up = F.struct(parent["id"].alias("at"),
                      F.concat(F.array(condition(parent, acc["at"])), acc["path"]).alias("path"))
        return F.when(acc["at"] == 0, acc).otherwise(up)
    start = F.struct(F.col("at.id").alias("at"), F.array().cast("array<string>").alias("path"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), start, climb)["path"]
    out = leaves.withColumn("path", path)
    return out.select("tree", F.col("at.id").alias("leaf"), "weight", F.size("path").alias("level"),
                      F.array_join("path", " and ").alias("rule"), F.col("at.prediction").alias("prediction"),
                      F.col("at.rows").alias("rows"),
                      (F.col("at.rows") / F.get("nodes", F.lit(0))["rows"]).alias("share"))


def tree_depth(model) -> int:
    """Depth of the deepest tree."""
    return max(t.depth for t in model.trees) if hasattr(model, "trees") else model.depth
