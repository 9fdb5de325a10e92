"""Queries: text/CSV/JSON sources and sinks, cleaning (step 2).

Text-file operators are checked by a round trip: lines are rebuilt from the
tables with ``concat_ws``, written to a fresh folder under the shared
checkpoint folder, read back with the operator and parsed.  The oracle is
plain SQL on the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlab.functions.strings import unquote
from feedlab.functions.terms import tokens_to_text
from feedlab.functions.tokens import tokenize
from feedlab.operators.clean import (clean_fields, guard_width, page_fields_with_defaults, quote_fields,
                                     strip_id_prefixes)
from feedlab.operators.relational import cast_cols
from feedlab.operators.stats import join_page
from feedlab.plans import sql as S
from feedlab.plans.registry import query
from feedlab.session import charset_codecs, materialize, scratch_path
from feedlab.sources.readers import (parse_impressions, parse_key_rest, parse_tsv, read_csv, read_csv_named,
                                     read_json, read_lines)
from feedlab.sources.sinks import compact, copy_dataset, write_csv, write_lines
from feedlab.sources.tables import impressions, pages_info, table

TAB = "\t"


def _roundtrip_lines(spark, df, name, cols=None):
    path = scratch_path(spark, name)
    write_lines(df, path, cols)
    return path


@query("src_lines", """
SELECT 'u:' || CAST(c_custkey AS VARCHAR) || chr(9) || c_name || chr(9) || c_mktsegment AS value FROM customer
""")
def q_src_lines(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    src = c.select(F.concat(F.lit("u:"), F.col("c_custkey").cast("string")).alias("k"), "c_name", "c_mktsegment")
    return read_lines(spark, _roundtrip_lines(spark, src, "src_lines"))


@query("src_impression_parse", S.with_(S.IMPRESSIONS, S.PAGES_INFO) + """
SELECT i.label, CAST(i.event_id AS VARCHAR) AS ts, i.uid, i.urlid,
       concat_ws(chr(9), p.utype, p.url, p.title) AS urlinfo
FROM impressions i LEFT JOIN pages_info p ON i.urlid = p.urlid
""")
def q_src_impression_parse(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    pages = pages_info(spark, sf_dir).select("urlid", "utype", "url", "title")
    j = join_page(imp, pages)
    # label,ts,uid,urlid,urlinfo where urlinfo holds tabs and commas (titles)
    line = F.concat_ws(",", F.col("label").cast("string"), F.col("event_id").cast("string"),
                       F.col("uid").cast("string"), F.col("urlid").cast("string"),
                       F.concat_ws(TAB, "utype", "url", "title"))
    path = scratch_path(spark, "impr")
    j.select(line.alias("value")).write.text(path)
    return parse_impressions(read_lines(spark, path))


@query("src_tsv_parse", S.with_(S.IMPRESSIONS) + """
SELECT uid, urlid, CAST(event_id AS VARCHAR) AS ts, label FROM impressions
""")
def q_src_tsv_parse(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("uid", "urlid", F.col("event_id").cast("string").alias("ts"), "label")
    lines = read_lines(spark, _roundtrip_lines(spark, imp, "tsv"))
    fields = parse_tsv(lines, ["uid", "urlid", "ts", "label"])
    return cast_cols(fields, {"uid": "bigint", "urlid": "bigint", "label": "int"})


@query("src_short_lines", S.with_(S.IMPRESSIONS) + """
SELECT CAST(label AS INTEGER) AS label, CAST(event_id AS VARCHAR) AS ts,
       CASE WHEN label = 1 THEN uid END AS uid, CASE WHEN label = 1 THEN urlid END AS urlid,
       CAST(NULL AS VARCHAR) AS urlinfo
FROM impressions
""")
def q_src_short_lines(spark, sf_dir):
    # two fields of five on lines without a click, four on the others
    imp = impressions(spark, sf_dir)
    short = F.concat_ws(",", F.col("label").cast("string"), F.col("event_id").cast("string"))
    line = F.when(F.col("label") == 1, F.concat_ws(",", short, F.col("uid").cast("string"),
                                                   F.col("urlid").cast("string"))).otherwise(short)
    path = scratch_path(spark, "short")
    imp.select(line.alias("value")).write.text(path)
    return parse_impressions(read_lines(spark, path))


@query("src_tsv_short", """
SELECT CAST(c_custkey AS VARCHAR) AS k, CASE WHEN c_acctbal > 0 THEN c_name END AS name,
       CAST(NULL AS INTEGER) AS nation
FROM customer
""")
def q_src_tsv_short(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    line = F.when(F.col("c_acctbal") > 0, F.concat_ws(TAB, F.col("c_custkey").cast("string"), "c_name")).otherwise(
        F.col("c_custkey").cast("string"))
    path = scratch_path(spark, "short_tsv")
    c.select(line.alias("value")).write.text(path)
    return parse_tsv(read_lines(spark, path), ["k", "name", "nation"], types={"nation": "int"})


@query("io_null_fields", """
SELECT coalesce(CAST(l.quality AS VARCHAR), '') || chr(9) || CAST(d.doc_id AS VARCHAR) || chr(9)
       || coalesce(CAST(l.toxic AS VARCHAR), '') || chr(9) || d.source AS value
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_io_null_fields(spark, sf_dir):
    # documents without labels have null fields, which keep their places
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    j = d.join(table(spark, sf_dir, "labels"), "doc_id", "left").select("quality", "doc_id", "toxic", "source")
    return read_lines(spark, _roundtrip_lines(spark, j, "null_fields"))


@query("src_key_rest", S.with_(S.PAGES_INFO) + """
SELECT CAST(urlid AS VARCHAR) AS urlid, coalesce(url || chr(9) || utype, '') AS urlinfo FROM pages_info
""")
def q_src_key_rest(spark, sf_dir):
    # pages without a url give a line holding the key only
    p = pages_info(spark, sf_dir)
    rest = F.concat(F.col("url"), F.lit(TAB), F.col("utype"))
    lines = read_lines(spark, _roundtrip_lines(spark, p.select("urlid", rest.alias("rest")), "keyrest"))
    return parse_key_rest(lines, "urlid", "urlinfo")


_JSON_SCHEMA = "event_id bigint, uid bigint, urlid bigint, label int"


@query("src_json_table", S.with_(S.IMPRESSIONS) + """
SELECT event_id, uid, urlid, label FROM impressions
""")
def q_src_json_table(spark, sf_dir):
    path = scratch_path(spark, "json")
    impressions(spark, sf_dir).select("event_id", "uid", "urlid", "label").write.json(path)
    return read_json(spark, path, _JSON_SCHEMA)


@query("src_gbk_decode", """
SELECT p_partkey, p_name || ' 中文页面' AS p_name FROM part
""")
def q_src_gbk_decode(spark, sf_dir):
    # the GBK codec needs spark.sql.legacy.javaCharsets (session.RECOMMENDED_CONF)
    with charset_codecs(spark):
        return _gbk_lines(spark, sf_dir)


def _gbk_lines(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    line = F.concat_ws(TAB, F.col("p_partkey").cast("string"), F.concat(F.col("p_name"), F.lit(" 中文页面")))
    path = scratch_path(spark, "gbk")
    (p.select(line.alias("value")).write
      .options(encoding="GBK", quote="", escape="", header="false",
               ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
      .csv(path))
    lines = read_lines(spark, path, charset="GBK")
    return materialize(parse_tsv(lines, ["p_partkey", "p_name"], types={"p_partkey": "bigint"}), "gbk")


@query("clean_fields", """
SELECT c_custkey,
       c_name || chr(9) || CASE WHEN c_nationkey % 4 = 0 THEN '-' ELSE c_mktsegment END || chr(9) || '-' AS value
FROM customer
""")
def q_clean_fields(spark, sf_dir):
    # padded fields, whitespace-only fields (incl. U+3000) and an empty last field
    c = table(spark, sf_dir, "customer")
    f2 = F.when(F.col("c_nationkey") % 4 == 0, F.lit(" 　 ")).otherwise(
        F.concat(F.lit("　"), F.col("c_mktsegment"), F.lit("  ")))
    raw = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "), F.lit(TAB), f2, F.lit(TAB))
    return clean_fields(c.select("c_custkey", raw.alias("value")))


@query("clean_quote", """
SELECT c_custkey, '"' || c_name || '"' || chr(9) || '"' || c_mktsegment || '"' AS value FROM customer
""")
def q_clean_quote(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return quote_fields(c.select("c_custkey", F.concat_ws(TAB, "c_name", "c_mktsegment").alias("value")))


@query("clean_strip_prefix", """
SELECT CAST(c_custkey AS VARCHAR) || chr(9) || c_name || chr(9) || CAST(c_nationkey AS VARCHAR) AS value
FROM customer
""")
def q_clean_strip_prefix(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    src = c.select(F.concat(F.lit("u:"), F.col("c_custkey").cast("string")).alias("k"), "c_name",
                   F.concat(F.lit("n:"), F.col("c_nationkey").cast("string")).alias("n"))
    lines = read_lines(spark, _roundtrip_lines(spark, src, "prefix"))
    return strip_id_prefixes(lines, [0, 2])


@query("clean_unquote", """
SELECT c_custkey, c_name AS name_csv, c_name AS name_raw, c_mktsegment AS seg_raw FROM customer
""")
def q_clean_unquote(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = scratch_path(spark, "quoted")
    write_csv(c, path, quoteAll="true")
    typed = read_csv(spark, path, "c_custkey bigint, name_csv string, seg string")
    raw = read_lines(spark, path).select(F.split("value", ",", -1).alias("f"))
    raw = raw.select(unquote(F.col("f")[0]).cast("bigint").alias("c_custkey"),
                     unquote(F.col("f")[1]).alias("name_raw"), unquote(F.col("f")[2]).alias("seg_raw"))
    return typed.select("c_custkey", "name_csv").join(raw, "c_custkey")


@query("clean_split_urlinfo", S.with_(S.PAGES_INFO) + """
SELECT urlid, utype, url, title, s_title,
       CASE WHEN url IS NULL THEN -1 ELSE pnum END AS pnum,
       CASE WHEN url IS NULL THEN -1.0 ELSE pdef END AS pdef,
       CASE WHEN url IS NULL THEN -1.0 ELSE pbeau END AS pbeau,
       ppoint, tpoint, s_content, url IS NOT NULL AS _valid
FROM (SELECT urlid, CASE WHEN url IS NULL THEN NULL ELSE utype END AS utype, url,
             CASE WHEN url IS NULL THEN NULL ELSE title END AS title,
             CASE WHEN url IS NULL THEN NULL ELSE '-' END AS s_title, pnum, pdef, pbeau,
             CASE WHEN url IS NULL THEN NULL ELSE points END AS ppoint,
             CASE WHEN url IS NULL THEN NULL ELSE tags END AS tpoint,
             CASE WHEN url IS NULL THEN NULL ELSE replace(content, chr(10), ' ') END AS s_content
      FROM pages_info)
""")
def q_clean_split_urlinfo(spark, sf_dir):
    # 10-field urlinfo; pages without a url lose that field (9 fields -> defaults)
    p = pages_info(spark, sf_dir)
    urlinfo = F.concat_ws(TAB, "utype", "url", "title", F.lit("-"), F.col("pnum").cast("string"),
                          F.col("pdef").cast("string"), F.col("pbeau").cast("string"), "points", "tags",
                          F.regexp_replace("content", "\n", " "))
    return page_fields_with_defaults(p.select("urlid", urlinfo.alias("urlinfo")), "urlinfo", keep=["urlid"])


@query("clean_guard_quarantine", S.with_(S.IMPRESSIONS) + """
SELECT value, len(string_split(value, chr(9))) = 4 AS good FROM (
  SELECT CASE WHEN event_type = 'error' THEN concat_ws(chr(9), uid, urlid, event_id)
              WHEN event_type = 'signup' THEN concat_ws(chr(9), uid, urlid, event_id, label, 'x')
              ELSE concat_ws(chr(9), uid, urlid, event_id, label) END AS value
  FROM impressions JOIN events USING (event_id))
""")
def q_clean_guard_quarantine(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    imp = impressions(spark, sf_dir).join(ev, "event_id")
    cols = [F.col(c).cast("string") for c in ("uid", "urlid", "event_id")]
    line = (F.when(F.col("event_type") == "error", F.concat_ws(TAB, *cols))
             .when(F.col("event_type") == "signup", F.concat_ws(TAB, *cols, F.col("label").cast("string"),
                                                                 F.lit("x")))
             .otherwise(F.concat_ws(TAB, *cols, F.col("label").cast("string"))))
    lines = imp.select(line.alias("value"))
    good, bad = guard_width(lines, 4)
    return good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))


_ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


@query("io_csv_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def q_io_csv_roundtrip(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderpriority")
    path = scratch_path(spark, "csv")
    write_csv(o, path)
    return read_csv(spark, path, _ORDERS_SCHEMA)


@query("io_csv_untyped", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, o_orderpriority FROM orders
""")
def q_io_csv_untyped(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "csv_untyped")
    write_csv(o, path)
    return read_csv_named(spark, path, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("io_text_roundtrip", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
""")
def q_io_text_roundtrip(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    lines = read_lines(spark, _roundtrip_lines(spark, o, "text"))
    return parse_tsv(lines, ["o_orderkey", "o_orderstatus", "o_orderpriority"], types={"o_orderkey": "bigint"})


@query("io_compact", """
SELECT CAST(l_orderkey AS VARCHAR) || chr(9) || CAST(l_linenumber AS VARCHAR) || chr(9) || l_returnflag AS value
FROM lineitem
""")
def q_io_compact(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    src = scratch_path(spark, "many")
    write_lines(li.repartition(16), src)
    dst = scratch_path(spark, "compact")
    compact(spark, src, dst, n=2)
    return read_lines(spark, dst)


@query("io_copy", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def q_io_copy(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderpriority")
    src = scratch_path(spark, "copy_src")
    write_csv(o, src)
    dst = scratch_path(spark, "copy_dst")
    copy_dataset(spark, src, dst, "csv", schema=_ORDERS_SCHEMA, header="false")
    return read_csv(spark, dst, _ORDERS_SCHEMA)


@query("ser_tokens", S.with_(S.PAGES_INFO) + f"""
SELECT urlid, array_to_string(regexp_extract_all(lower(title), '{S.TOKEN_RE}', 1), ',') AS s_title
FROM pages_info
""")
def q_ser_tokens(spark, sf_dir):
    p = pages_info(spark, sf_dir)
    return p.select("urlid", tokens_to_text(tokenize(F.col("title"))).alias("s_title"))
