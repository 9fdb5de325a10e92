"""Queries: trees as rows, profiles merged by batches, the page vector from text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from feedlab.operators.features import VECTOR_ORDER
from feedlab.operators.incremental import ProfileStore, profile_delta
from feedlab.operators.models import fit_trees
from feedlab.operators.relational import random_split
from feedlab.operators.rules import leaf_rules, model_kind, node_table, score_nodes, tree_depth
from feedlab.operators.terms import page_vector_from_text, terms_to_text
from feedlab.plans import sql as S
from feedlab.plans.feed import feed_page_vector, title_keywords
from feedlab.plans.q_models import CLS_SPLIT, SEED, _ml_input
from feedlab.plans.registry import query
from feedlab.session import materialize, scratch_path
from feedlab.sources.tables import impressions, pages_info

@query("tree_rules")
def q_tree_rules(spark, sf_dir):
    """The rules of the three tree models, one row per leaf (M7-M9)."""
    train, _ = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    rules = []
    for name, model in fit_trees(train):
        rules.append(leaf_rules(node_table(spark, model), VECTOR_ORDER, tree_depth(model))
                     .select(F.lit(name).alias("model"), "*"))
    return reduce(lambda a, b: a.unionByName(b), rules)


@query("tree_node_scores")
def q_tree_node_scores(spark, sf_dir):
    """Held-out rows scored by the walk over the node tables, beside the models' own predictions."""
    train, test = random_split(_ml_input(spark, sf_dir), CLS_SPLIT, SEED)
    out = test
    for name, model in fit_trees(train):
        own = model.transform(out).withColumnRenamed("prediction", f"{name}_model").drop("rawPrediction", "probability")
        own = own.withColumn("_x", vector_to_array("features"))
        out = score_nodes(own, node_table(spark, model), model_kind(model), tree_depth(model), "_x", f"{name}_nodes").drop("_x")
    return out.drop("features")


@query("user_profile_incremental", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR, S.SIGNED_TERMS, S.USER_PROFILE,
                                           S.USER_PROFILE_TOP) + "SELECT uid, term, weight FROM user_profile_top")
def q_user_profile_incremental(spark, sf_dir):
    """The top-21 profiles after three merges, the impressions cut by time."""
    imp = impressions(spark, sf_dir).select("uid", "urlid", "label", F.col("ts").cast("timestamp").cast("double").alias("t"))
    pv = materialize(feed_page_vector(pages_info(spark, sf_dir)), "page_vector")
    span = imp.agg(F.struct(F.min("t").alias("a"), F.max("t").alias("b"))).scalar()
    part = F.coalesce(F.floor((F.col("t") - span["a"]) * 3 / F.nullif(span["b"] - span["a"], F.lit(0.0))), F.lit(0))
    parts = materialize(imp.withColumn("part", F.least(part, F.lit(2))), "impression_parts")
    store = ProfileStore(spark, scratch_path(spark, "profiles"))
    for k in range(3):
        store.merge(profile_delta(parts.where(F.col("part") == k), pv))
    return store.profile()


@query("page_vector_text", S.with_(S.PAGES_INFO, S.PAGE_VECTOR) + "SELECT urlid, term, weight FROM page_vector")
def q_page_vector_text(spark, sf_dir):
    """The page vector read from the text columns of a page row: keywords, points, tags (T4)."""
    pages = pages_info(spark, sf_dir)
    titles = terms_to_text(title_keywords(pages), "urlid", out="s_title")
    rows = pages.select("urlid", F.col("points").alias("ppoint"), F.col("tags").alias("tpoint"))
    rows = rows.join(titles, "urlid", "left").withColumn("s_title", F.coalesce("s_title", F.lit("-")))
    return page_vector_from_text(rows).select("urlid", "term", "weight")
