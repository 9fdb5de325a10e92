"""Feature table and vector assembly (M1-M3).

``train_feature`` builds the nine-column training row for every impression:

    uid, label, sumclick, sumshow, ctr, pnum, pdef, pbeau, s_term_score

Plan at scale
-------------
Impressions are read once and reduced by a partial + final aggregate to one
row per ``(uid, urlid, label)`` with its multiplicity.  Every feature is a
function of that triple, so all joins (url statistics, page attributes,
page vectors, user profiles) run on the reduced table.  The multiplicity is
restored at the end by ``expand_counts``, which splits a group into chunks of
bounded size and spreads the chunks over tasks: a group holding a third of
all impressions is emitted by many tasks, never one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlab import constants as C
from feedlab.operators.stats import ctr
from feedlab.operators.terms import (map_scores, merge_terms, no_neg_zero, page_maps, pair_scores, rounded,
                                     top_n_per_key)
from feedlab.functions.terms import sign_weight
from feedlab.session import join_dealt, materialize, spread_like, together

FEATURE_COLUMNS = ["uid", "label", "sumclick", "sumshow", "ctr", "pnum", "pdef", "pbeau", "s_term_score"]
VECTOR_ORDER = list(C.VECTOR_ORDER)
JSON_VECTOR_ORDER = list(C.JSON_VECTOR_ORDER)

# Rows emitted per task for one chunk of a repeated group.
EXPAND_CHUNK = 10_000


def expand_counts(df: DataFrame, count: str = "cnt", chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Emit each row ``count`` times (the inverse of ``groupBy(...).count()``).

    A row is first split into ``ceil(count/chunk)`` chunk rows, the chunk rows
    are redistributed round-robin, then each chunk expands to at most
    ``chunk`` rows.  Memory and work per task stay bounded however large one
    group is.
    """
    n_chunks = F.ceil(F.col(count) / F.lit(chunk)).cast("int")
    chunks = df.select("*", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("_chunk"))
    size = F.least(F.lit(chunk), F.col(count) - F.col("_chunk") * F.lit(chunk)).cast("int")
    # Hash on every column (chunk index included): deterministic on retry, and
    # the chunks of one group land in different partitions.
    spread = chunks.repartition(*[F.col(c) for c in chunks.columns])
    out = spread.select("*", F.explode(F.array_repeat(F.lit(0), size)).alias("_rep"))
    return out.drop("_chunk", "_rep", count)


def page_defaults(df: DataFrame) -> DataFrame:
    """Impressions without a page get ``pnum = pdef = pbeau = -1``."""
    d = C.MISSING_NUMBER
    return (df.withColumn("pnum", F.coalesce(F.col("pnum").cast("int"), F.lit(d)))
              .withColumn("pdef", F.coalesce(F.col("pdef").cast("double"), F.lit(float(d))))
              .withColumn("pbeau", F.coalesce(F.col("pbeau").cast("double"), F.lit(float(d)))))


def train_feature(log: DataFrame, page_attrs: DataFrame, page_vec: DataFrame,
                  top_n: int | None = C.PROFILE_TOP_N, with_click_stats: bool = True) -> DataFrame:
    """Feature rows for every impression (M1): ``feature_groups``, each row as
    often as its impressions."""
    return expand_counts(feature_groups(log, page_attrs, page_vec, top_n, with_click_stats))


def feature_groups(log: DataFrame, page_attrs: DataFrame, page_vec: DataFrame,
                   top_n: int | None = C.PROFILE_TOP_N, with_click_stats: bool = True) -> DataFrame:
    """Feature row and ``cnt`` per ``(uid, urlid, label)`` group of impressions.

    ``log``: ``(uid, urlid, label)``; ``page_attrs``: ``(urlid, pnum, pdef,
    pbeau)``; ``page_vec``: ``(urlid, term, weight)``.  The user profile sums
    each user's signed page vectors over all impressions (the row's own label
    included, as in the source pipeline) and keeps the ``top_n`` strongest
    terms (``None`` keeps all).  ``page_vec`` may be a function that builds the
    table, which then runs beside the reduction of the log.
    """
    # Impressions reduced to (uid, urlid, label, cnt) once; the reduced table
    # feeds the url statistics, the profile pairs and the final rows, so it is
    # written once instead of rescanning the log per branch.  The page vector
    # feeds both the profile and the scores; a page travels as one map.
    groups, pages = together(
        log.sparkSession,
        lambda: materialize(log.select("uid", "urlid", "label")
                               .groupBy("uid", "urlid", "label").agg(F.count(F.lit(1)).alias("cnt")),
                            "impression_groups"),
        lambda: materialize(page_maps(page_vec() if callable(page_vec) else page_vec), "page_vector"))

    # url statistics, from the reduced groups
    stats = groups.groupBy("urlid").agg(
        F.sum(F.col("label").cast("long") * F.col("cnt")).alias("sumclick"),
        F.sum("cnt").alias("sumshow"))

    # user profile: page vectors scaled by the net signed count of each pair
    sgn = F.when(F.col("label") != F.lit(0), F.col("cnt")).otherwise(-F.col("cnt"))
    pairs = (groups.where(F.col("uid").isNotNull())
                   .groupBy("uid", "urlid").agg(F.sum(sgn).cast("double").alias("net")))
    prof_rows = (join_dealt(log, pairs, pages, "urlid", "uid").select("uid", "net", F.explode("_page").alias("term", "_w"))
                      .select("uid", "term", (F.col("net") * F.col("_w")).alias("weight")))
    profile = merge_terms(spread_like(log, prof_rows, "uid", "term"), "uid")
    if top_n is not None:
        profile = top_n_per_key(spread_like(log, profile, "uid"), "uid", [F.col("weight").desc(), F.col("term").asc()], top_n)
    if top_n is None:
        dots = pair_scores(pairs, pages.select("urlid", F.explode("_page").alias("term", "weight")), profile, log=log)
    else:
        dots = map_scores(pairs, pages, profile, log=log)

    url_side = page_attrs.select("urlid", "pnum", "pdef", "pbeau")
    if with_click_stats:
        url_side = stats.join(url_side, "urlid", "left")
    # One row per url, written once: the join below then has a plain shuffle on
    # both sides, so AQE can split the partition of a url that a third of all
    # users saw.
    url_side = materialize(url_side, "url_features")
    feat = (groups.join(url_side, "urlid", "left")
                  .join(dots, ["uid", "urlid"], "left"))
    feat = page_defaults(feat)
    score = rounded(sign_weight("label", F.coalesce(F.col("dot"), F.lit(0.0))))
    cols = [F.col("uid"), F.col("label")]
    if with_click_stats:
        cols += [F.col("sumclick"), F.col("sumshow"), ctr(F.col("sumclick"), F.col("sumshow")).alias("ctr")]
    cols += [F.col("pnum"), F.col("pdef"), F.col("pbeau"), score.alias("s_term_score"), F.col("cnt")]
    return feat.select(*cols)


def feature_groups_loo(log: DataFrame, page_attrs: DataFrame, page_vec: DataFrame,
                       top_n: int = C.PROFILE_TOP_N) -> DataFrame:
    """``feature_groups`` without leakage: every feature of an impression is taken
    over all impressions but itself.

    Click and show counts are the url's less the row's own.  The profile is the
    user's less the row's own signed page vector, cut to its ``top_n`` terms after
    that.  The cut is exact: removing a page changes the weights of that page's
    terms only, so the new list consists of the page's terms (whose sums and
    numbers of rows are looked up per pair) and of the user's best other terms,
    all of which are among the first ``top_n`` + (most terms of a page) of the
    full profile.  A term that only the row itself brought is gone.

    Scale: a user travels as one array of that depth, a pair as one array of its
    page's terms; the (uid, term) rows meet once, where both sums are formed beside
    the pairs' own weights, and are dealt by the log's bytes.
    """
    page_vec = materialize(page_vec, "page_vector")
    groups = materialize(log.select("uid", "urlid", "label")
                            .groupBy("uid", "urlid", "label").agg(F.count(F.lit(1)).alias("cnt")),
                         "impression_groups")
    stats = groups.groupBy("urlid").agg(
        F.sum(F.col("label").cast("long") * F.col("cnt")).alias("sumclick"), F.sum("cnt").alias("sumshow"))
    url_side = materialize(stats.join(page_attrs.select("urlid", "pnum", "pdef", "pbeau"), "urlid", "left"),
                           "url_features")

    sgn = F.when(F.col("label") != F.lit(0), F.col("cnt")).otherwise(-F.col("cnt"))
    pairs = (groups.where(F.col("uid").isNotNull()).groupBy("uid", "urlid")
             .agg(F.sum(sgn).cast("double").alias("net"), F.sum("cnt").alias("rows")))
    # each (uid, term) is summed where its pairs stand, so no join brings the sums back
    terms = spread_like(log, join_dealt(log, pairs, page_vec, "urlid", "uid"), "uid", "term")
    order = Window.partitionBy("uid", "term").orderBy("urlid")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    terms = materialize(
        terms.select("uid", "urlid", "term", F.col("weight").alias("pv"),
                     F.sum(F.col("net") * F.col("weight")).over(every).alias("w"),
                     F.sum("rows").over(every).alias("rows"),
                     (F.row_number().over(order) == 1).alias("first")), "pair_terms")
    most = page_vec.groupBy("urlid").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    full = terms.where("first").select("uid", "term", rounded(F.col("w")).alias("w"))
    ranked = top_n_per_key(spread_like(log, full, "uid"), "uid", [F.col("w").desc(), F.col("term").asc()], top_n + most)
    down = no_neg_zero(-F.col("w"))
    # ascending order of these structs is descending weight, then term
    best = F.sort_array(F.collect_list(F.struct(down.alias("down"), "term")))
    deep = materialize(ranked.groupBy("uid").agg(best.alias("_deep")), "deep_profile")
    own = (spread_like(log, terms.select("uid", "urlid", "term", "pv", "w", "rows"), "uid", "urlid")
           .groupBy("uid", "urlid").agg(F.collect_list(F.struct("term", "pv", "w", "rows")).alias("_own")))

    sign = F.when(F.col("label") != F.lit(0), F.lit(1.0)).otherwise(F.lit(-1.0))

    def entry(down, term, pv):
        return F.struct(down.alias("down"), term.alias("term"), pv.alias("pv"))

    feat = groups.join(url_side, "urlid", "left").join(own, ["uid", "urlid"], "left").join(deep, "uid", "left")
    left = F.transform(F.filter("_own", lambda t: t["rows"] > 1),
                       lambda t: entry(no_neg_zero(-rounded(t["w"] - F.col("_sign") * t["pv"])), t["term"], t["pv"]))
    # the page's terms take no more than their number from the first of the user's
    near = F.slice("_deep", 1, F.lit(top_n) + F.size("_own"))
    rest = F.transform(F.slice(F.filter(near, lambda t: ~F.array_contains(F.col("_terms"), t["term"])), 1, top_n),
                       lambda t: entry(t["down"], t["term"], F.lit(0.0)))
    top = F.slice(F.sort_array(F.concat("_left", "_rest")), 1, top_n)
    dot = F.aggregate("_top", F.lit(0.0), lambda acc, t: acc - t["down"] * t["pv"])
    feat = (page_defaults(feat).withColumn("_sign", sign)
            .withColumn("_terms", F.transform("_own", lambda t: t["term"]))
            .withColumn("_left", left).withColumn("_rest", rest).withColumn("_top", top))
    clicks, shows = F.col("sumclick") - F.col("label"), F.col("sumshow") - 1
    return feat.select("uid", "label", clicks.alias("sumclick"), shows.alias("sumshow"),
                       ctr(clicks, F.when(shows > 0, shows)).alias("ctr"), "pnum", "pdef", "pbeau",
                       rounded(F.coalesce(F.col("_sign") * dot, F.lit(0.0))).alias("s_term_score"), "cnt")


def train_feature_loo(log: DataFrame, page_attrs: DataFrame, page_vec: DataFrame,
                      top_n: int = C.PROFILE_TOP_N) -> DataFrame:
    """Leave-one-out feature rows for every impression: ``feature_groups_loo``
    expanded (impressions of one group have equal features)."""
    return expand_counts(feature_groups_loo(log, page_attrs, page_vec, top_n))


def assemble(df: DataFrame, cols: list[str], label: str = "label", out: str = "features",
             handle_invalid: str = "skip") -> DataFrame:
    """Dense feature vector in a fixed column order (M2/M3); rows with nulls
    are skipped, as the source jobs' tuple-building map would fail on them."""
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid)
    casted = df.select(F.col(label).cast("double").alias(label),
                       *[F.col(c).cast("double").alias(c) for c in cols])
    return va.transform(casted).select(label, out)
