"""Physical-plan invariants of the headline queries (read from ``explain``).

* no Python evaluation in any plan (everything stays in the JVM);
* no cartesian product or nested-loop join;
* scans read only the columns they need.
"""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

HEADLINE = ["train_feature", "ctr_by_url", "join_page", "page_vector", "user_profile_topn", "term_score",
            "keywords_content", "page_enriched", "term_doc_count", "txt_stopwords_default", "txt_stopwords_custom",
            "eval_auc_roc", "eval_f_by_threshold", "eval_weighted_f1", "chi2_stats", "vec_similar_topk",
            "seq_mean_vector", "feature_vector_json"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", HEADLINE)
def test_plan_stays_in_jvm_without_cartesian_joins(spark, name):
    plan = plan_text(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad} in plan"


def test_scan_prunes_columns(spark):
    plan = plan_text(E.queries()["ctr_by_url"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string,props:string>" in plan


def test_topn_uses_window_group_limit(spark):
    plan = plan_text(E.queries()["user_profile_topn"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_text_is_scanned_once_for_keywords(spark):
    """The eager stages are seen too: every job of the query, by its input scans."""
    from feedlab.plans.feed import content_keywords
    from feedlab.sources import tables
    scans = []
    real = tables.table
    try:
        tables.table = lambda s, d, n: scans.append(n) or real(s, d, n)
        content_keywords(tables.pages_info(spark, SF_SMALL)).count()
    finally:
        tables.table = real
    assert scans.count("documents") == 1
    plan = plan_text(E.queries()["keywords_content"](spark, SF_SMALL))
    assert "documents.parquet" not in plan          # what is left reads the written frequencies


def test_plan_does_not_depend_on_the_number_of_files(spark):
    from feedlab.session import scratch_path
    from feedlab.operators.text import keywords
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id urlid", "text")
    path = scratch_path(spark, "many")
    docs.repartition(12).write.parquet(path)
    many = {tuple(r) for r in keywords(spark.read.parquet(path), "urlid", "text", 5).collect()}
    assert many == {tuple(r) for r in keywords(docs, "urlid", "text", 5).collect()}
