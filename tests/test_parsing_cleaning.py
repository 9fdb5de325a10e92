"""Edge rows for sources and cleaning (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from feedlab.functions.strings import clean_field, strip_prefix, unquote
from feedlab.operators.clean import guard_width, page_fields_with_defaults
from feedlab.sources.readers import parse_impressions, parse_key_rest, parse_tsv, read_lines, read_stopwords
from feedlab.sources.sinks import compact, write_csv, write_lines
from feedlab.session import scratch_path


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_impression_line_keeps_remainder(spark):
    r = parse_impressions(lines(spark, '1,1500,7,9,"a\tb,c"')).collect()[0]
    assert (r.label, r.ts, r.uid, r.urlid) == (1, "1500", 7, 9)
    assert r.urlinfo == '"a\tb,c"'


def test_impression_bad_number_becomes_null(spark):
    r = parse_impressions(lines(spark, "x,1,2,3,rest")).collect()[0]
    assert r.label is None and r.uid == 2


def test_tsv_keeps_trailing_empty_fields(spark):
    r = parse_tsv(lines(spark, "a\tb\t\t"), ["w", "x", "y", "z"]).collect()[0]
    assert (r.w, r.x, r.y, r.z) == ("a", "b", "", "")


def test_guard_quarantines_wrong_width(spark):
    good, bad = guard_width(lines(spark, "1\t2\t3\t4", "1\t2\t3", "1\t2\t3\t4\t5"), 4)
    assert [r.value for r in good.collect()] == ["1\t2\t3\t4"]
    assert sorted(r.value for r in bad.collect()) == ["1\t2\t3", "1\t2\t3\t4\t5"]


def test_whitespace_only_field_becomes_dash(spark):
    df = spark.createDataFrame([(" \t ",), ("　",), ("  x ",), ("",)], "v string")
    got = [r[0] for r in df.select(clean_field("v")).collect()]
    assert got == ["-", "-", "x", "-"]


def test_strip_prefix(spark):
    df = spark.createDataFrame([("u:123",), ("u",)], "v string")
    assert [r[0] for r in df.select(strip_prefix("v")).collect()] == ["123", ""]


def test_key_only_line_gives_empty_rest(spark):
    rows = parse_key_rest(lines(spark, "42", "7\ta\tb")).orderBy("urlid").collect()
    assert [(r.urlid, r.urlinfo) for r in rows] == [("42", ""), ("7", "a\tb")]


def test_unquote_only_enclosing_quotes(spark):
    df = spark.createDataFrame([('"ab"',), ("ab",), ('"a',), (None,)], "v string")
    assert [r[0] for r in df.select(unquote("v")).collect()] == ["ab", "ab", '"a', None]


def test_malformed_urlinfo_gets_defaults(spark):
    good = "\t".join(["t", "u", "title", "a:1", "5", "0.5", "0.7", "p:1", "x,y", "body"])
    df = spark.createDataFrame([(1, None), (2, ""), (3, "\t".join(["f"] * 9)), (4, good)],
                               "urlid long, urlinfo string")
    rows = {r.urlid: r for r in page_fields_with_defaults(df, "urlinfo", keep=["urlid"]).collect()}
    for k in (1, 2, 3):
        assert (rows[k].pnum, rows[k].pdef, rows[k].pbeau, rows[k]._valid) == (-1, -1.0, -1.0, False)
    assert (rows[4].pnum, rows[4].pdef, rows[4].pbeau, rows[4].s_title) == (5, 0.5, 0.7, "a:1")


def test_text_roundtrip_and_compaction(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    src = scratch_path(spark, "t-src")
    write_lines(df.repartition(10), src)
    dst = scratch_path(spark, "t-dst")
    compact(spark, src, dst, n=2)
    import glob
    assert len(glob.glob(dst + "/part-*")) == 2
    back = read_lines(spark, dst)
    assert back.count() == 1000
    assert back.where(F.col("value") == "999\tx").count() == 1


def test_csv_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "k int, s string")
    p = scratch_path(spark, "csv")
    write_csv(df, p)
    raw = sorted(r.value for r in read_lines(spark, p).collect())
    assert raw == ["1,", '2,""']


def test_stopword_file_reader(spark):
    p = scratch_path(spark, "sw")
    lines(spark, "the", " a ", "", "the").write.text(p)
    assert sorted(r.word for r in read_stopwords(spark, p).collect()) == ["a", "the"]


def test_gbk_decode(spark):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    p = scratch_path(spark, "gbk")
    (lines(spark, "1\t中文 abc").write
     .options(encoding="GBK", quote="", escape="", ignoreLeadingWhiteSpace="false",
              ignoreTrailingWhiteSpace="false").csv(p))
    raw = open([f for f in __import__("glob").glob(p + "/part-*") if __import__("os").path.getsize(f)][0], "rb").read()
    assert raw == "1\t中文 abc\n".encode("gbk")
    assert read_lines(spark, p, charset="GBK").collect()[0].value == "1\t中文 abc"


def test_compact_without_count_packs_small_files(spark):
    import glob
    df = spark.range(2000).select(F.col("id").cast("string").alias("v"))
    src = scratch_path(spark, "many-small")
    write_lines(df.repartition(40), src)
    dst = scratch_path(spark, "packed")
    compact(spark, src, dst)
    parts = [f for f in glob.glob(dst + "/part-*")]
    assert len(parts) < 40
    assert read_lines(spark, dst).count() == 2000


def test_json_schema_inferred(spark):
    from feedlab.sources.readers import read_json
    p = scratch_path(spark, "json-infer")
    spark.createDataFrame([(1, "a", 0.5), (2, None, 1.5)], "k long, s string, x double").write.json(p)
    t = read_json(spark, p)
    assert dict(t.dtypes) == {"k": "bigint", "s": "string", "x": "double"}
    assert sorted(r.k for r in t.collect()) == [1, 2]
