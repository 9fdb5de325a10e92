"""End-to-end jobs on exports rebuilt from the test tables."""

from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from feedlab.plans.jobs import feature_job, model_job, text_job
from feedlab.session import scratch_path
from feedlab.sources.tables import impressions, pages_info


def _exports(spark):
    imp = impressions(spark, SF_SMALL)
    imp_lines = imp.select(F.concat_ws("\t", F.concat(F.lit("u:"), F.col("uid").cast("string")),
                                       F.concat(F.lit("p:"), F.col("urlid").cast("string")),
                                       F.col("event_id").cast("string"), F.col("label").cast("string")))
    bad = spark.createDataFrame([("u:1\tp:2\t3",), ("u:1\tp:2\t3\tx",)], "value string")  # quarantined
    imp_path = scratch_path(spark, "exp-imp")
    imp_lines.union(bad).write.text(imp_path)
    p = pages_info(spark, SF_SMALL)
    page_lines = p.select(F.concat_ws(
        "\t", F.concat(F.lit("p:"), F.col("urlid").cast("string")), "utype", F.coalesce("url", F.lit("")),
        F.concat(F.lit(" "), F.col("title"), F.lit("　")), F.col("pnum").cast("string"),
        F.col("pdef").cast("string"), F.col("pbeau").cast("string"), "points", "tags",
        F.regexp_replace("content", "\n", " ")))
    page_path = scratch_path(spark, "exp-pages")
    page_lines.write.text(page_path)
    return imp_path, page_path


def test_feature_job_matches_query(spark):
    imp_path, page_path = _exports(spark)
    out = scratch_path(spark, "features")
    got = feature_job(spark, imp_path, page_path, out, fmt="parquet")
    exp = E.queries()["train_feature"](spark, SF_SMALL)
    norm = lambda df: Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert norm(got) == norm(exp.select(*got.columns))
    assert spark.read.text(out + "_quarantine/impressions").count() == 2


def test_text_and_model_jobs(spark):
    _, page_path = _exports(spark)
    out = scratch_path(spark, "text")
    pages = text_job(spark, page_path, out, vector_size=8, min_count=2)
    assert pages.count() == pages_info(spark, SF_SMALL).count()
    assert spark.read.parquet(out + "/words").count() > 0
    feats = E.queries()["train_feature"](spark, SF_SMALL)
    m = {r.metric: r.value for r in model_job(spark, feats, scratch_path(spark, "model")).collect()}
    assert 0.0 <= m["auc_roc"] <= 1.0 and 0.0 <= m["best_threshold"] <= 1.0


def test_feature_job_command_line(spark):
    from feedlab.plans.jobs import main
    imp_path, page_path = _exports(spark)
    out = scratch_path(spark, "cli-features")
    main(["features", "--impressions", imp_path, "--pages", page_path, "--out", out, "--fmt", "parquet"])
    assert spark.read.parquet(out).count() == E.queries()["train_feature"](spark, SF_SMALL).count()
