"""Canonical views over the driver's test tables.

The operators take any DataFrame with the right columns; these functions map
the provided Parquet tables onto the shapes the feed pipeline uses:

* ``impressions(event_id, uid, urlid, ts, label)`` from ``events``
* ``pages_info(urlid, utype, url, title, content, pnum, pdef, pbeau, points, tags)``
  from ``documents`` ⟕ ``labels`` ⟕ ``pages``
* ``ratings(uid, urlid, label)``
* ``scores(score, label, prediction)`` — a click score per impression
* ``vectors(id, vec)`` from ``embeddings``

Every read selects only the columns used, so Parquet scans prune columns and
push filters down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab.operators.stats import click_show, ctr, lookup_join

# Event types counted as a click (label 1); every other event is a show only.
CLICK_EVENTS = ("click", "purchase")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("urlid"),
        F.col("ts"),
        F.when(F.col("event_type").isin(*CLICK_EVENTS), F.lit(1)).otherwise(F.lit(0)).alias("label"),
    )


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


def pages_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables are all as large as the corpus, so they meet in shuffled
    joins whatever their size; what is derived from the text comes before the
    joins, so a consumer of titles shuffles titles only."""
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", first_line(text).alias("title"), text.alias("content"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    j = docs.join(labels.hint("merge"), "doc_id", "left").join(pages.hint("merge"), "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("urlid"),
        F.col("source").alias("utype"),
        F.col("url"),
        F.col("title"),
        F.col("content"),
        F.col("n_chars").cast("int").alias("pnum"),
        F.coalesce(F.col("quality"), F.lit(-1)).cast("double").alias("pdef"),
        F.coalesce(F.col("toxic"), F.lit(-1)).cast("double").alias("pbeau"),
        F.concat(F.col("lang"), F.lit(":"), F.coalesce(F.col("quality"), F.lit(0)).cast("string"),
                 F.lit(";"), F.col("source"), F.lit(":1")).alias("points"),
        F.concat_ws(",", F.col("lang"), F.col("source")).alias("tags"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedlab.operators.relational import select_cols
    return select_cols(impressions(spark, sf_dir), ["uid", "urlid", "label"])


def scores(spark: SparkSession, sf_dir: str, cutoff: float = 0.4) -> DataFrame:
    """A scored label set: score = CTR of the impression's url (4 decimals)."""
    imp = impressions(spark, sf_dir).select("event_id", "urlid", "label")
    stats = click_show(imp, "urlid", "label").select(
        "urlid", F.round(ctr(F.col("sumclick"), F.col("sumshow")), 4).alias("score"))
    j = lookup_join(imp, stats, "urlid", "left")
    return j.select(
        "event_id",
        F.col("score"),
        F.col("label"),
        F.when(F.col("score") > F.lit(cutoff), F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
