"""Queries: term vectors, profiles and the feature table (steps 4-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlab import constants as C
from feedlab.functions.terms import parse_terms, tag_terms
from feedlab.operators.features import JSON_VECTOR_ORDER, VECTOR_ORDER, assemble, page_defaults
from feedlab.operators.stats import join_profile, lookup_join
from feedlab.operators.terms import (explode_terms, merge_terms, signed_terms,
                                     term_score, terms_to_text, user_profile, user_profile_topn)
from feedlab.plans import sql as S
from feedlab.plans.feed import feed_page_vector, feed_train_feature
from feedlab.plans.registry import query
from feedlab.sources.tables import impressions, pages_info

FEATURE_SQL = S.with_(*S.FEATURE_BASE) + """
SELECT i.uid, i.label, s.sumclick, s.sumshow,
       CAST(s.sumclick AS DOUBLE) / CAST(s.sumshow AS DOUBLE) AS ctr,
       coalesce(p.pnum, -1) AS pnum, coalesce(p.pdef, -1.0) AS pdef, coalesce(p.pbeau, -1.0) AS pbeau,
       __SCORE__ AS s_term_score
FROM impressions i
LEFT JOIN url_stats s ON i.urlid = s.urlid
LEFT JOIN pages_info p ON i.urlid = p.urlid
JOIN term_score ts ON ts.event_id = i.event_id
"""


@query("train_feature", FEATURE_SQL.replace("__SCORE__", "ts.s_term_score"))
def q_train_feature(spark, sf_dir):
    return feed_train_feature(spark, sf_dir)


@query("train_feature_basic", S.with_(*S.FEATURE_BASE) + """
SELECT i.uid, i.label, coalesce(p.pnum, -1) AS pnum, coalesce(p.pdef, -1.0) AS pdef,
       coalesce(p.pbeau, -1.0) AS pbeau, ts.s_term_score
FROM impressions i
LEFT JOIN pages_info p ON i.urlid = p.urlid
JOIN term_score ts ON ts.event_id = i.event_id
""")
def q_train_feature_basic(spark, sf_dir):
    return feed_train_feature(spark, sf_dir, with_click_stats=False)


# ------------------------------------------------------------ term parsing

# Page rows rebuilt in the text form of the source pipeline: title keywords
# as "k:v,k:v", points "k:v;k:v", tags "k,k".
@query("terms_parse", S.with_(S.PAGES_INFO) + """
SELECT urlid, term, round(sum(weight), 6) AS weight FROM (
  SELECT urlid, kv[1] AS term, TRY_CAST(kv[2] AS DOUBLE) AS weight
  FROM (SELECT urlid, string_split(item, ':') AS kv
        FROM (SELECT urlid, unnest(string_split(points || ',' || tags || ':2,bad,x:y:z', ',')) AS item
              FROM pages_info))
  WHERE len(kv) = 2 AND TRY_CAST(kv[2] AS DOUBLE) IS NOT NULL)
GROUP BY urlid, term
""")
def q_terms_parse(spark, sf_dir):
    # "k:v,k:v" items built from the page table, with malformed items mixed in
    p = pages_info(spark, sf_dir)
    text = F.concat(F.col("points"), F.lit(","), F.col("tags"), F.lit(":2,bad,x:y:z"))
    rows = explode_terms(p.select("urlid", text.alias("s")), "urlid", parse_terms("s", ",", ":"))
    return merge_terms(rows, "urlid")


@query("terms_parse_points", S.with_(S.PAGES_INFO) + """
SELECT urlid, kv[1] AS term, TRY_CAST(kv[2] AS DOUBLE) AS weight
FROM (SELECT urlid, string_split(item, ':') AS kv
      FROM (SELECT urlid, unnest(string_split(points, ';')) AS item FROM pages_info))
WHERE len(kv) = 2 AND TRY_CAST(kv[2] AS DOUBLE) IS NOT NULL
""")
def q_terms_parse_points(spark, sf_dir):
    p = pages_info(spark, sf_dir)
    return explode_terms(p, "urlid", parse_terms("points", C.POINT_ITEM_SEP, C.TERM_KV_SEP))


@query("terms_tags", S.with_(S.PAGES_INFO) + """
SELECT urlid, term, CAST(count(*) AS DOUBLE) AS weight
FROM (SELECT urlid, unnest(string_split(tags || ',' || lang_tag, ',')) AS term
      FROM (SELECT urlid, tags, split_part(tags, ',', 1) AS lang_tag FROM pages_info WHERE tags <> '-'))
GROUP BY urlid, term
""")
def q_terms_tags(spark, sf_dir):
    # tags with a repeated first tag, so one tag counts twice
    p = pages_info(spark, sf_dir)
    t = F.concat(F.col("tags"), F.lit(","), F.split(F.col("tags"), ",")[0])
    return merge_terms(explode_terms(p.select("urlid", t.alias("t")), "urlid", tag_terms("t")), "urlid")


@query("page_vector", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR) + """
SELECT urlid, term, weight FROM page_vector
""")
def q_page_vector(spark, sf_dir):
    return feed_page_vector(pages_info(spark, sf_dir))


@query("page_vector_defaults", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR) + """
SELECT i.event_id, i.urlid, coalesce(p.pnum, -1) AS pnum, coalesce(p.pdef, -1.0) AS pdef,
       coalesce(p.pbeau, -1.0) AS pbeau, coalesce(v.n_terms, 0) AS n_terms
FROM impressions i
LEFT JOIN pages_info p ON i.urlid = p.urlid
LEFT JOIN (SELECT urlid, count(*) AS n_terms FROM page_vector GROUP BY urlid) v ON i.urlid = v.urlid
""")
def q_page_vector_defaults(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("event_id", "urlid")
    pages = pages_info(spark, sf_dir)
    nterms = feed_page_vector(pages).groupBy("urlid").agg(F.count(F.lit(1)).alias("n_terms"))
    j = lookup_join(imp, pages.select("urlid", "pnum", "pdef", "pbeau"), "urlid", "left", "pages")
    j = lookup_join(j, nterms, "urlid", "left")
    j = page_defaults(j).withColumn("n_terms", F.coalesce("n_terms", F.lit(0)).cast("long"))
    return j.select("event_id", "urlid", "pnum", "pdef", "pbeau", "n_terms")


@query("signed_terms", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR, S.SIGNED_TERMS) + """
SELECT event_id, uid, urlid, term, weight FROM signed_terms
""")
def q_signed_terms(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label")
    st = signed_terms(imp, feed_page_vector(pages_info(spark, sf_dir)))
    return st.select("event_id", "uid", "urlid", "term", "weight")


@query("terms_serialize", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR) + """
SELECT urlid, string_agg(term || ':' || CAST(CAST(weight AS DECIMAL(18,6)) AS VARCHAR), ',' ORDER BY term) AS s_term
FROM page_vector GROUP BY urlid
""")
def q_terms_serialize(spark, sf_dir):
    return terms_to_text(feed_page_vector(pages_info(spark, sf_dir)), "urlid")


@query("user_profile", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR, S.SIGNED_TERMS, S.USER_PROFILE) + """
SELECT uid, term, weight FROM user_profile
""")
def q_user_profile(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    return user_profile(imp, feed_page_vector(pages_info(spark, sf_dir)))


@query("user_profile_topn", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR, S.SIGNED_TERMS,
                                    S.USER_PROFILE, S.USER_PROFILE_TOP) + """
SELECT uid, term, weight FROM user_profile_top
""")
def q_user_profile_topn(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    return user_profile_topn(imp, feed_page_vector(pages_info(spark, sf_dir)), n=21)


@query("clicked_title_profile", S.with_(S.IMPRESSIONS, S.PAGES_INFO,
                                        S.keywords_cte("kw_title", "pages_info", "title", 20)) + """
SELECT i.uid, k.term, round(sum(k.weight), 6) AS weight
FROM impressions i JOIN kw_title k ON i.urlid = k.urlid
WHERE i.label > 0 AND i.uid IS NOT NULL
GROUP BY i.uid, k.term
""")
def q_clicked_title_profile(spark, sf_dir):
    from feedlab.operators.terms import clicked_profile
    from feedlab.plans.feed import title_keywords
    kw = title_keywords(pages_info(spark, sf_dir)).select("urlid", "term", "weight")
    return clicked_profile(impressions(spark, sf_dir), kw)


@query("join_user_profile", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR, S.SIGNED_TERMS,
                                    S.USER_PROFILE, S.USER_PROFILE_TOP) + """
SELECT i.event_id, i.uid, i.urlid, p.user_s_term
FROM impressions i LEFT JOIN (
  SELECT uid, string_agg(term || ':' || CAST(CAST(weight AS DECIMAL(18,6)) AS VARCHAR), ',' ORDER BY term) AS user_s_term
  FROM user_profile_top GROUP BY uid) p ON i.uid = p.uid
""")
def q_join_user_profile(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    prof = user_profile_topn(imp, feed_page_vector(pages_info(spark, sf_dir)), n=21)
    text = terms_to_text(prof, "uid", out="user_s_term")
    return join_profile(imp.select("event_id", "uid", "urlid"), text, "uid").select(
        "event_id", "uid", "urlid", "user_s_term")


@query("term_score", S.with_(*S.FEATURE_BASE) + """
SELECT event_id, s_term_score FROM term_score
""")
def q_term_score(spark, sf_dir):
    from feedlab.session import materialize
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label")
    # the page vector feeds the profile and the scores: written once
    pv = materialize(feed_page_vector(pages_info(spark, sf_dir)), "page_vector")
    prof = user_profile_topn(imp, pv, n=21)
    return term_score(imp, pv, prof, topn_profile=True).select("event_id", "s_term_score")


# ----------------------------------------------------------- feature vectors

def _feature_table_sql() -> str:
    body = FEATURE_SQL.replace("__SCORE__", "ts.s_term_score")
    head = S.with_(*S.FEATURE_BASE)
    return head.rstrip("\n") + ",\ntrain_feature AS (" + body[len(head):] + ")\n"


_VEC_COLS = ", ".join(f"CAST({c} AS DOUBLE) AS f_{c}" for c in VECTOR_ORDER)
_VEC_NOTNULL = " AND ".join(f"{c} IS NOT NULL" for c in VECTOR_ORDER)


@query("feature_vector", _feature_table_sql() + f"""
SELECT CAST(label AS DOUBLE) AS label, {_VEC_COLS}
FROM train_feature WHERE {_VEC_NOTNULL}
""")
def q_feature_vector(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    v = assemble(feed_train_feature(spark, sf_dir), VECTOR_ORDER)
    arr = vector_to_array("features")
    return v.select(F.col("label"), *[arr[i].alias(f"f_{c}") for i, c in enumerate(VECTOR_ORDER)])


def _json_table_sql() -> str:
    head = S.with_(*S.FEATURE_BASE).rstrip("\n")
    return head + """,
cprof AS (
  SELECT i.uid, k.term, round(sum(k.weight), 6) AS weight
  FROM impressions i JOIN kw_title k ON i.urlid = k.urlid
  WHERE i.label > 0 AND i.uid IS NOT NULL GROUP BY i.uid, k.term),
tscore AS (
  SELECT i.event_id, sum(k.weight * c.weight) AS dot
  FROM impressions i JOIN kw_title k ON i.urlid = k.urlid JOIN cprof c ON c.uid = i.uid AND c.term = k.term
  GROUP BY i.event_id),
first_ts AS (SELECT urlid, min(epoch_us(ts)) AS t0 FROM impressions GROUP BY urlid),
json_table AS (
  SELECT i.uid AS userid, i.label, (epoch_us(i.ts) - f.t0) / 1e6 AS ts_interval,
         p.pnum AS p_num, CAST(l.quality AS DOUBLE) AS p_defination, CAST(l.toxic AS DOUBLE) AS p_beauty,
         """ + S.nz("round(coalesce(t.dot, 0.0), 6)") + """ AS title_term_score,
         ts.s_term_score AS url_whole_term_score
  FROM impressions i JOIN first_ts f ON i.urlid = f.urlid
  LEFT JOIN pages_info p ON i.urlid = p.urlid
  LEFT JOIN labels l ON i.urlid = l.doc_id
  LEFT JOIN tscore t ON t.event_id = i.event_id
  JOIN term_score ts ON ts.event_id = i.event_id)
"""


_JVEC_COLS = ", ".join(f"CAST({c} AS DOUBLE) AS f_{c}" for c in JSON_VECTOR_ORDER)
_JVEC_NOTNULL = " AND ".join(f"{c} IS NOT NULL" for c in ["userid", *JSON_VECTOR_ORDER])


def json_ml_input(spark, sf_dir):
    """JSON export of the training table read back, rows with a missing user or
    feature dropped (F7), assembled into the 6-vector (M3)."""
    from feedlab.operators.relational import drop_incomplete
    from feedlab.plans.feed import feed_json_table
    from feedlab.session import scratch_path
    from feedlab.sources.readers import read_json
    path = scratch_path(spark, "json_table")
    table_ = feed_json_table(spark, sf_dir)
    table_.write.json(path)
    t = drop_incomplete(read_json(spark, path, table_.schema), ["userid", *JSON_VECTOR_ORDER])
    return assemble(t, JSON_VECTOR_ORDER)


@query("feature_vector_json", _json_table_sql() + f"""
SELECT CAST(label AS DOUBLE) AS label, {_JVEC_COLS}
FROM json_table WHERE {_JVEC_NOTNULL}
""")
def q_feature_vector_json(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    v = json_ml_input(spark, sf_dir)
    arr = vector_to_array("features")
    return v.select(F.col("label"), *[arr[i].alias(f"f_{c}") for i, c in enumerate(JSON_VECTOR_ORDER)])


@query("io_nested_json", S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.PAGE_VECTOR, S.SIGNED_TERMS,
                                 S.USER_PROFILE, S.USER_PROFILE_TOP) + """
SELECT uid, term, weight FROM user_profile_top
""")
def q_io_nested_json(spark, sf_dir):
    # profiles as nested rows (uid, array<struct<term, weight>>) -> JSON lines -> back
    from feedlab.session import scratch_path
    from feedlab.sources.readers import read_json
    from feedlab.sources.sinks import write_nested
    imp = impressions(spark, sf_dir)
    prof = user_profile_topn(imp, feed_page_vector(pages_info(spark, sf_dir)), n=21)
    nested = prof.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    path = scratch_path(spark, "nested")
    write_nested(nested, path)
    back = read_json(spark, path, "uid bigint, terms array<struct<term:string,weight:double>>")
    return back.select("uid", F.inline("terms"))
