"""Queries: click statistics, joins, filters, splits (steps 0-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlab.operators.relational import (drop_incomplete, hash_bucket, join_keep_left, positives, preview,
                                          rename_all, run_sql, true_positives)
from feedlab.operators.stats import click_show, ctr_by_key, join_page
from feedlab.plans import sql as S
from feedlab.session import materialize
from feedlab.plans.registry import query
from feedlab.sources.tables import impressions, pages_info, ratings, scores, table

# Largest page table, in bytes, that the map-side lookup (J4) will broadcast.
PAGE_BROADCAST_MAX_BYTES = 64 << 20


@query("ctr_by_url", S.with_(S.IMPRESSIONS) + """
SELECT urlid, CAST(sum(label) AS BIGINT) AS sumclick, count(*) AS sumshow,
       CAST(sum(label) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS ctr
FROM impressions GROUP BY urlid
""")
def q_ctr_by_url(spark, sf_dir):
    stats = ctr_by_key(impressions(spark, sf_dir).select("urlid", "label"), "urlid", "label")
    return rename_all(stats, ["urlid", "sumclick", "sumshow", "ctr"])


@query("ratings", S.with_(S.IMPRESSIONS) + "SELECT uid, urlid, label FROM impressions")
def q_ratings(spark, sf_dir):
    return ratings(spark, sf_dir)


_JOIN_PAGE_SQL = S.with_(S.IMPRESSIONS, S.PAGES_INFO) + """
SELECT i.event_id, i.uid, i.urlid, i.label, p.utype, p.url, p.title, p.pnum, p.pdef, p.pbeau, p.points, p.tags
FROM impressions i LEFT JOIN pages_info p ON i.urlid = p.urlid
"""
_PAGE_COLS = ["urlid", "utype", "url", "title", "pnum", "pdef", "pbeau", "points", "tags"]


@query("join_page", _JOIN_PAGE_SQL)
def q_join_page(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label")
    return join_page(imp, pages_info(spark, sf_dir).select(*_PAGE_COLS))


@query("join_page_broadcast", _JOIN_PAGE_SQL)
def q_join_page_broadcast(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label")
    return join_page(imp, pages_info(spark, sf_dir).select(*_PAGE_COLS),
                     broadcast_max_bytes=PAGE_BROADCAST_MAX_BYTES)


@query("join_labelled_page", S.with_(S.IMPRESSIONS) + """
SELECT i.event_id, i.urlid, coalesce(CAST(l.quality AS INTEGER), -1) AS pnum,
       coalesce(CAST(l.quality AS DOUBLE), -1.0) AS pdef, coalesce(CAST(l.toxic AS DOUBLE), -1.0) AS pbeau
FROM impressions i LEFT JOIN labels l ON i.urlid = l.doc_id
""")
def q_join_labelled_page(spark, sf_dir):
    # only labelled pages on the page side: the unmatched urls get the defaults
    from feedlab.operators.features import page_defaults
    page = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("urlid"), F.col("quality").alias("pnum"),
                                                 F.col("quality").alias("pdef"), F.col("toxic").alias("pbeau"))
    imp = impressions(spark, sf_dir).select("event_id", "urlid")
    return page_defaults(join_page(imp, page)).select("event_id", "urlid", "pnum", "pdef", "pbeau")


@query("join_url_stats", S.with_(S.IMPRESSIONS, S.URL_STATS) + """
SELECT i.event_id, i.uid, i.urlid, i.label, s.sumclick, s.sumshow
FROM impressions i LEFT JOIN url_stats s ON i.urlid = s.urlid
""")
def q_join_url_stats(spark, sf_dir):
    # all log columns plus the two statistics columns (F2 over J2)
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label")
    stats = materialize(click_show(imp, "urlid", "label"), "url_stats")
    return join_keep_left(imp, stats, "urlid", ["sumclick", "sumshow"])


@query("preview_topn", S.with_(S.IMPRESSIONS) + """
SELECT event_id, uid, urlid, label FROM impressions ORDER BY event_id LIMIT 20
""")
def q_preview_topn(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label")
    return preview(imp, 20, ["event_id"])


@query("split_hash", S.with_(S.IMPRESSIONS) + """
SELECT event_id, CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100 AS BIGINT) AS bucket,
       CASE WHEN ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80
            THEN 'train' ELSE 'test' END AS part
FROM impressions
""")
def q_split_hash(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("event_id")
    b = hash_bucket("event_id")
    return imp.select("event_id", b.alias("bucket"),
                      F.when(b < 80, F.lit("train")).otherwise(F.lit("test")).alias("part"))


@query("flt_positives", S.with_(S.IMPRESSIONS) + """
SELECT event_id, uid, urlid, label FROM impressions WHERE label > 0
""")
def q_flt_positives(spark, sf_dir):
    return positives(impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label"))


@query("flt_true_positives", S.with_(S.IMPRESSIONS, S.URL_STATS, S.SCORES) + """
SELECT event_id, score, label, prediction FROM scores WHERE label = 1 AND prediction > 0
""")
def q_flt_true_positives(spark, sf_dir):
    return true_positives(scores(spark, sf_dir), "label", "prediction")


@query("flt_complete_rows", S.with_(S.IMPRESSIONS, S.PAGES_INFO) + """
SELECT i.event_id, i.uid, i.urlid, p.url, l.quality, l.toxic
FROM impressions i LEFT JOIN pages_info p ON i.urlid = p.urlid
LEFT JOIN labels l ON i.urlid = l.doc_id
WHERE p.url IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL
""")
def q_flt_complete_rows(spark, sf_dir):
    # quality / toxic are null for pages without labels: rows with a missing
    # feature are dropped
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("urlid"), "quality", "toxic")
    j = join_page(imp, pages_info(spark, sf_dir).select("urlid", "url")).join(labels, "urlid", "left")
    return drop_incomplete(j, ["url", "quality", "toxic"])


@query("sql_view_query", S.with_(S.IMPRESSIONS, S.PAGES_INFO) + """
SELECT i.uid, count(*) AS shows, CAST(sum(i.label) AS BIGINT) AS clicks, count(p.urlid) AS shows_with_page
FROM impressions i LEFT JOIN pages_info p ON i.urlid = p.urlid
GROUP BY i.uid
""")
def q_sql_view_query(spark, sf_dir):
    return run_sql(spark, """
        SELECT i.uid, count(*) AS shows, CAST(sum(i.label) AS BIGINT) AS clicks,
               count(p.urlid) AS shows_with_page
        FROM {imp} i LEFT JOIN {pages} p ON i.urlid = p.urlid
        GROUP BY i.uid""",
        imp=impressions(spark, sf_dir), pages=materialize(pages_info(spark, sf_dir).select("urlid"), "page_ids"))


@query("ctr_by_url_stream", S.with_(S.IMPRESSIONS) + """
SELECT urlid, CAST(sum(label) AS BIGINT) AS sumclick, count(*) AS sumshow,
       CAST(sum(label) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS ctr
FROM impressions GROUP BY urlid
""")
def q_ctr_by_url_stream(spark, sf_dir):
    # the same A1 aggregate, maintained incrementally by Structured Streaming
    from feedlab.session import scratch_path
    from feedlab.streaming.clicks import ctr_stream, impression_stream, run_available_now
    sink = scratch_path(spark, "ctr-stream-sink")
    run_available_now(ctr_stream(impression_stream(spark, sf_dir, file_glob="events.parquet")), sink)
    return spark.read.parquet(sink)
