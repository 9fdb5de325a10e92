"""End-to-end feed plans on the canonical views.

Nothing is collected.  Stage outputs that several branches read are written
under ``spark.checkpoint.dir`` while the DataFrame is being built, so building
one runs jobs; the result itself is lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab import constants as C
from feedlab.operators.features import feature_groups, train_feature, train_feature_loo
from feedlab.operators.terms import page_vector
from feedlab.operators.text import keywords
from feedlab.session import materialize
from feedlab.sources.tables import impressions, pages_info, table

TITLE_K = C.TITLE_KEYWORDS
CONTENT_K = C.CONTENT_KEYWORDS
PROFILE_N = C.PROFILE_TOP_N


def title_keywords(pages: DataFrame, k: int = TITLE_K) -> DataFrame:
    return keywords(pages.select("urlid", "title"), "urlid", "title", k)


def content_keywords(pages: DataFrame, k: int = CONTENT_K) -> DataFrame:
    return keywords(pages.select("urlid", "content"), "urlid", "content", k)


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page columns of the feature table, joined and written once: the keywords,
    the point and tag terms and the page attributes all read it, none the content."""
    return materialize(pages_info(spark, sf_dir).select("urlid", "title", "points", "tags", "pnum", "pdef", "pbeau"),
                       "pages")


def feed_page_vector(pages: DataFrame) -> DataFrame:
    """Page vector: title keywords ⊕ points ⊕ tags (T4)."""
    kw = title_keywords(pages).select("urlid", "term", "weight")
    return page_vector(kw, pages.select("urlid", "points", "tags"))


def feed_train_feature(spark: SparkSession, sf_dir: str, top_n: int | None = PROFILE_N,
                       with_click_stats: bool = True) -> DataFrame:
    imp = impressions(spark, sf_dir)
    pages = page_table(spark, sf_dir)
    attrs = pages.select("urlid", "pnum", "pdef", "pbeau")
    return train_feature(imp, attrs, lambda: feed_page_vector(pages), top_n, with_click_stats)


def feed_train_feature_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with every feature taken over the other impressions."""
    pages = pages_info(spark, sf_dir)
    return train_feature_loo(impressions(spark, sf_dir), pages.select("urlid", "pnum", "pdef", "pbeau"),
                             feed_page_vector(pages))


def feed_feature_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature rows with their counts, before they are expanded."""
    pages = page_table(spark, sf_dir)
    return feature_groups(impressions(spark, sf_dir), pages.select("urlid", "pnum", "pdef", "pbeau"),
                          lambda: feed_page_vector(pages), PROFILE_N)


def checkpoint_stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Stage output written to the shared checkpoint folder (see ``materialize``)."""
    return materialize(df, name)


def feed_json_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse-style training table (one JSON object per row):
    ``userid, label, ts_interval, p_num, p_defination, p_beauty,
    title_term_score, url_whole_term_score``.

    * ``ts_interval``: seconds since the url's first impression;
    * ``title_term_score``: title keywords of the page · the user's profile of
      clicked-page title keywords (unsigned);
    * ``url_whole_term_score``: the signed whole-page score of the feature table.
    ``p_defination`` / ``p_beauty`` are null for pages without labels, as in
    a warehouse export with missing values (dropped before training, F7).
    """
    from feedlab.operators.stats import lookup_join
    from feedlab.operators.terms import clicked_profile, pair_scores, rounded, term_score, user_profile_topn
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "ts", "label")
    pages = pages_info(spark, sf_dir)
    pv = materialize(feed_page_vector(pages), "page_vector")
    prof = user_profile_topn(imp, pv, n=PROFILE_N)
    scored = term_score(imp, pv, prof, topn_profile=True)
    kw = title_keywords(pages).select("urlid", "term", "weight")
    cprof = clicked_profile(imp, kw)
    pairs = imp.select("uid", "urlid").where(F.col("uid").isNotNull()).distinct()
    tdot = pair_scores(pairs, kw, cprof)
    # microseconds since the epoch of the wall-clock timestamp, independent of
    # the session time zone
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    first = imp.groupBy("urlid").agg(F.min(us).alias("_t0"))
    j = lookup_join(scored, first, "urlid", "inner")
    # definition / beauty as exported: null for pages without labels
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("urlid"),
                                                   F.col("quality").cast("double").alias("pdef"),
                                                   F.col("toxic").cast("double").alias("pbeau"))
    j = lookup_join(j, pages.select("urlid", "pnum"), "urlid").join(labels, "urlid", "left")
    j = lookup_join(j, tdot, ["uid", "urlid"], "left")
    return j.select(
        F.col("uid").alias("userid"), "label",
        ((us - F.col("_t0")) / F.lit(1e6)).alias("ts_interval"),
        F.col("pnum").alias("p_num"), F.col("pdef").alias("p_defination"), F.col("pbeau").alias("p_beauty"),
        rounded(F.coalesce(F.col("dot"), F.lit(0.0))).alias("title_term_score"),
        F.col("s_term_score").alias("url_whole_term_score"))
