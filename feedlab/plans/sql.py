"""DuckDB oracle building blocks: the canonical views as SQL CTEs.

These mirror ``feedlab.sources.tables`` and the core algebra; each oracle
query is ``WITH <ctes> SELECT ...`` over the driver's pre-registered views.
"""

from __future__ import annotations

IMPRESSIONS = """impressions AS (
  SELECT event_id, user_id AS uid,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS urlid, ts,
         CAST(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM events)"""

PAGES_INFO = """pages_info AS (
  SELECT d.doc_id AS urlid, d.source AS utype, p.url,
         split_part(d.text, chr(10), 1) AS title, d.text AS content,
         CAST(d.n_chars AS INTEGER) AS pnum,
         CAST(coalesce(l.quality, -1) AS DOUBLE) AS pdef,
         CAST(coalesce(l.toxic, -1) AS DOUBLE) AS pbeau,
         d.lang || ':' || CAST(coalesce(l.quality, 0) AS VARCHAR) || ';' || d.source || ':1' AS points,
         concat_ws(',', d.lang, d.source) AS tags
  FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN pages p ON p.page_id = d.doc_id)"""

URL_STATS = """url_stats AS (
  SELECT urlid, CAST(sum(label) AS BIGINT) AS sumclick, count(*) AS sumshow
  FROM impressions GROUP BY urlid)"""

SCORES = """scores AS (
  SELECT i.event_id, round(CAST(s.sumclick AS DOUBLE) / s.sumshow, 4) AS score, i.label,
         CASE WHEN round(CAST(s.sumclick AS DOUBLE) / s.sumshow, 4) > 0.4 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction
  FROM impressions i LEFT JOIN url_stats s ON i.urlid = s.urlid)"""

TOKEN_RE = r"([a-zà-ÿ]+|\p{Han})"


def nz(x: str) -> str:
    """-0.0 -> 0.0 (as ``no_neg_zero``)."""
    return f"(CASE WHEN ({x}) = 0 THEN CAST(0 AS DOUBLE) ELSE ({x}) END)"


def keywords_cte(name: str, src: str, text_col: str, k: int | None) -> str:
    """TF-IDF keyword rows ``(urlid, term, weight, rank)`` of ``src.text_col``."""
    lim = f"WHERE rank <= {k}" if k is not None else ""
    return f"""{name}_tok AS (
  SELECT urlid, regexp_extract_all(lower({text_col}), '{TOKEN_RE}', 1) AS toks FROM {src}),
{name}_tf AS (
  SELECT urlid, term, count(*) AS tf, max(n) AS n
  FROM (SELECT urlid, len(toks) AS n, unnest(toks) AS term FROM {name}_tok)
  GROUP BY urlid, term),
{name}_df AS (SELECT term, count(*) AS df FROM {name}_tf GROUP BY term),
{name}_n AS (SELECT count(*) AS n_docs FROM {name}_tok WHERE len(toks) > 0),
{name}_all AS (
  SELECT t.urlid, t.term,
         {nz(f"round(CAST(t.tf AS DOUBLE) / CAST(t.n AS DOUBLE) * ln((n.n_docs + 1.0) / (d.df + 1.0)), 6)")} AS weight
  FROM {name}_tf t JOIN {name}_df d ON t.term = d.term CROSS JOIN {name}_n n),
{name} AS (
  SELECT * FROM (SELECT urlid, term, weight,
                        row_number() OVER (PARTITION BY urlid ORDER BY weight DESC, term ASC) AS rank
                 FROM {name}_all) {lim})"""


PAGE_VECTOR = f"""{keywords_cte('kw_title', 'pages_info', 'title', 20)},
pv_points AS (
  SELECT urlid, kv[1] AS term, TRY_CAST(kv[2] AS DOUBLE) AS weight
  FROM (SELECT urlid, string_split(item, ':') AS kv
        FROM (SELECT urlid, unnest(string_split(points, ';')) AS item FROM pages_info))
  WHERE len(kv) = 2 AND TRY_CAST(kv[2] AS DOUBLE) IS NOT NULL),
pv_tags AS (
  SELECT urlid, unnest(string_split(tags, ',')) AS term, CAST(1.0 AS DOUBLE) AS weight
  FROM pages_info WHERE tags <> '-'),
page_vector AS (
  SELECT urlid, term, {nz("round(sum(weight), 6)")} AS weight
  FROM (SELECT urlid, term, weight FROM kw_title
        UNION ALL SELECT urlid, term, weight FROM pv_points
        UNION ALL SELECT urlid, term, weight FROM pv_tags)
  GROUP BY urlid, term)"""

SIGNED_TERMS = f"""signed_terms AS (
  SELECT i.event_id, i.uid, i.urlid, i.label, pv.term,
         {nz("CASE WHEN i.label <> 0 THEN pv.weight ELSE -pv.weight END")} AS weight
  FROM impressions i JOIN page_vector pv ON i.urlid = pv.urlid)"""

USER_PROFILE = f"""user_profile AS (
  SELECT uid, term, {nz("round(sum(weight), 6)")} AS weight
  FROM signed_terms WHERE uid IS NOT NULL GROUP BY uid, term)"""

USER_PROFILE_TOP = """user_profile_top AS (
  SELECT uid, term, weight FROM (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY weight DESC, term ASC) AS rn
    FROM user_profile) WHERE rn <= 21)"""

TERM_SCORE = f"""term_score AS (
  SELECT i.event_id, {nz("round(coalesce(s.dot, 0.0), 6)")} AS s_term_score
  FROM impressions i LEFT JOIN (
    SELECT st.event_id, sum(st.weight * p.weight) AS dot
    FROM signed_terms st JOIN user_profile_top p ON st.uid = p.uid AND st.term = p.term
    GROUP BY st.event_id) s ON i.event_id = s.event_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FEATURE_BASE = (IMPRESSIONS, PAGES_INFO, URL_STATS, PAGE_VECTOR, SIGNED_TERMS, USER_PROFILE,
                USER_PROFILE_TOP, TERM_SCORE)
