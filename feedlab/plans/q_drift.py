"""Queries: segmentation of unspaced text, drifting JSON, leave-one-out features."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlab.plans import sql as S
from feedlab.plans.feed import feed_train_feature_loo
from feedlab.plans.registry import query
from feedlab.session import scratch_path
from feedlab.sources.tables import impressions, table

# The texts' letters without their spaces: what a script without spaces looks like.
RUN = r"[a-zà-ÿ]+"


def _runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.regexp_replace(F.lower("text"), r"[\x20\x09-\x0D]+", "")
    return docs.select("doc_id", F.coalesce(F.regexp_extract_all(text, F.lit(RUN), 0),
                                            F.array().cast("array<string>")).alias("runs"))


_LEXICON_SQL = rf"""WITH
runs AS (SELECT run, count(*) AS n FROM (
           SELECT unnest(regexp_extract_all(regexp_replace(lower(text), '[\x20\x09-\x0D]+', '', 'g'), '{RUN}')) AS run
           FROM documents) GROUP BY run),
pos AS (SELECT run, n, unnest(range(1, length(run) + 1)) AS s FROM runs),
grams AS (SELECT gram, CAST(sum(n) AS BIGINT) AS count FROM (
            SELECT n, unnest(list_transform(range(1, least(5, length(run) - s + 1) + 1), lambda k: substring(run, s, k))) AS gram
            FROM pos) GROUP BY gram),
total AS (SELECT CAST(sum(count) AS DOUBLE) AS t FROM grams WHERE length(gram) = 1),
splits AS (SELECT gram, count, unnest(range(1, length(gram))) AS k FROM grams
           WHERE length(gram) BETWEEN 2 AND 4 AND count >= 5),
weak AS (SELECT s.gram, s.count, round(min(ln(s.count * t / (CAST(a.count AS DOUBLE) * b.count))), 6) AS pmi
         FROM splits s JOIN grams a ON a.gram = substring(s.gram, 1, s.k)
         JOIN grams b ON b.gram = substring(s.gram, s.k + 1) CROSS JOIN total GROUP BY s.gram, s.count),
aft AS (SELECT substring(gram, 1, length(gram) - 1) AS gram,
               round(ln(sum(CAST(count AS DOUBLE))) - sum(count * ln(CAST(count AS DOUBLE))) / sum(CAST(count AS DOUBLE)), 6) AS h
        FROM grams WHERE length(gram) > 1 GROUP BY 1),
bef AS (SELECT substring(gram, 2) AS gram,
               round(ln(sum(CAST(count AS DOUBLE))) - sum(count * ln(CAST(count AS DOUBLE))) / sum(CAST(count AS DOUBLE)), 6) AS h
        FROM grams WHERE length(gram) > 1 GROUP BY 1),
words AS (SELECT w.gram, w.count, pmi, least(coalesce(aft.h, 0.0), coalesce(bef.h, 0.0)) AS entropy
          FROM weak w LEFT JOIN aft ON aft.gram = w.gram LEFT JOIN bef ON bef.gram = w.gram
          WHERE pmi >= 1.0 AND least(coalesce(aft.h, 0.0), coalesce(bef.h, 0.0)) >= 0.5
          UNION ALL SELECT gram, count, NULL, NULL FROM grams WHERE length(gram) = 1),
mass AS (SELECT CAST(sum(count) AS DOUBLE) AS m FROM words)
SELECT gram AS term, count, pmi, entropy, round(ln(count / m), 6) AS logp FROM words CROSS JOIN mass
"""


@query("lexicon_unspaced", _LEXICON_SQL)
def q_lexicon_unspaced(spark, sf_dir):
    from feedlab.operators.segment import lexicon, run_counts
    from feedlab.session import materialize
    return lexicon(materialize(run_counts(_runs(spark, sf_dir)), "runs"))


@query("tokenize_unspaced")
def q_tokenize_unspaced(spark, sf_dir):
    # brute-force test of the path: tests/test_drift.py
    from feedlab.operators.segment import lexicon, run_counts, segment
    from feedlab.session import materialize
    counted = materialize(run_counts(_runs(spark, sf_dir)), "runs")
    return segment(counted, lexicon(counted))


# ------------------------------------------------------------ drifting JSON

def _drifting_lines(spark, sf_dir):
    """Impressions as JSON lines of several versions: ids turn into text, a field
    comes late, numbers change width, and some lines are broken."""
    imp = impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label")
    e = F.col("event_id")
    plain = F.struct("event_id", "uid", "urlid", "label", (e / 4).alias("score"))
    text_id = F.struct("event_id", "uid", F.concat(F.lit("u-"), F.col("urlid")).alias("urlid"), "label", e.alias("score"))
    late = F.struct("event_id", "uid", "urlid", "label", e.alias("score"),
                    F.struct(F.concat(F.lit("v"), (e % 3).cast("string")).alias("name"), (e % 5).alias("rank")).alias("page info"))
    line = (F.when(e % 11 == 3, F.to_json(text_id)).when(e % 7 == 2, F.to_json(late)).otherwise(F.to_json(plain)))
    return imp.select(F.when(e % 97 == 5, F.concat(F.lit("#"), line)).otherwise(line).alias("value"))


def _inferred(spark, sf_dir):
    from feedlab.sources.drift import read_json_inferred
    from feedlab.sources.sinks import write_lines
    path = scratch_path(spark, "drift")
    write_lines(_drifting_lines(spark, sf_dir), path)
    return read_json_inferred(spark, path)


@query("src_json_inferred", S.with_(S.IMPRESSIONS) + """
SELECT event_id, uid, CASE WHEN event_id % 11 = 3 THEN NULL ELSE urlid END AS urlid, CAST(label AS BIGINT) AS label,
       CASE WHEN event_id % 11 <> 3 AND event_id % 7 <> 2 THEN event_id / 4.0 ELSE CAST(event_id AS DOUBLE) END AS score,
       CASE WHEN event_id % 11 <> 3 AND event_id % 7 = 2 THEN 'v' || (event_id % 3) END AS name,
       CASE WHEN event_id % 11 <> 3 AND event_id % 7 = 2 THEN event_id % 5 END AS rank
FROM impressions WHERE event_id % 97 <> 5
""")
def q_src_json_inferred(spark, sf_dir):
    got, _ = _inferred(spark, sf_dir)
    return got.select("event_id", "uid", "urlid", "label", "score", F.col("`page info`.name").alias("name"),
                      F.col("`page info`.rank").alias("rank"))


@query("src_json_quarantine", S.with_(S.IMPRESSIONS) + """
SELECT CASE WHEN event_id % 97 <> 5 THEN 'urlid' END AS field,
       CASE WHEN event_id % 97 <> 5 THEN 'u-' || urlid END AS found,
       CASE WHEN event_id % 97 <> 5 THEN 'STRING' END AS type
FROM impressions WHERE event_id % 97 = 5 OR (event_id % 11 = 3 AND urlid IS NOT NULL)
""")
def q_src_json_quarantine(spark, sf_dir):
    return _inferred(spark, sf_dir)[1].select("field", "found", "type")


# ------------------------------------------------------------ leave-one-out features

LOO_SQL = S.with_(S.IMPRESSIONS, S.PAGES_INFO, S.URL_STATS, S.PAGE_VECTOR, S.SIGNED_TERMS) + f""",
others AS (
  SELECT i.event_id, o.term, {S.nz("round(sum(o.weight), 6)")} AS weight
  FROM impressions i JOIN signed_terms o ON o.uid = i.uid AND o.event_id <> i.event_id GROUP BY i.event_id, o.term),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY weight DESC, term) AS rn FROM others)
        WHERE rn <= 21),
score AS (SELECT s.event_id, sum(s.weight * t.weight) AS dot
          FROM signed_terms s JOIN top t ON t.event_id = s.event_id AND t.term = s.term GROUP BY s.event_id)
SELECT i.uid, i.label, s.sumclick - i.label AS sumclick, s.sumshow - 1 AS sumshow,
       CAST(s.sumclick - i.label AS DOUBLE) / nullif(s.sumshow - 1, 0) AS ctr,
       coalesce(p.pnum, -1) AS pnum, coalesce(p.pdef, -1.0) AS pdef, coalesce(p.pbeau, -1.0) AS pbeau,
       {S.nz("round(coalesce(c.dot, 0.0), 6)")} AS s_term_score
FROM impressions i LEFT JOIN url_stats s ON s.urlid = i.urlid LEFT JOIN pages_info p ON p.urlid = i.urlid
LEFT JOIN score c ON c.event_id = i.event_id
""".replace(")\n,", "),", 1)


@query("train_feature_loo", LOO_SQL)
def q_train_feature_loo(spark, sf_dir):
    return feed_train_feature_loo(spark, sf_dir)


# ------------------------------------------------------------ recommendations

@query("recommend_pruned", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS f, 1 + label AS scale FROM embeddings),
r AS (SELECT u.vec_id AS uid, i.vec_id AS urlid, list_inner_product(u.f, i.f) * i.scale AS rating
      FROM v u, v i WHERE u.vec_id % 2 = 0 AND i.vec_id % 2 = 1)
SELECT uid, urlid, CAST(rank AS INTEGER) AS rank, round(rating, 6) AS rating
FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY rating DESC, urlid) AS rank FROM r) WHERE rank <= 10
""")
def q_recommend_pruned(spark, sf_dir):
    from feedlab.operators.recommend import recommend_pruned
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"),
                                                  F.col("embedding").cast("array<double>").alias("features"), "label")
    items = v.filter("id % 2 = 1").select("id", F.transform("features", lambda x: x * (1 + F.col("label"))).alias("features"))
    return recommend_pruned(v.filter("id % 2 = 0"), items, 10).withColumn("rating", F.round("rating", 6))
