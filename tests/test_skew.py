"""Hot keys: one url and one user each hold a third of the impressions.

Broadcasts are switched off so every join is a sort-merge join, and the
skew thresholds are lowered so AQE must split the hot partitions.  Results
must equal the brute-force computation.
"""

import contextlib
import io
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_MID
from feedlab.operators.features import train_feature
from feedlab.plans.feed import feed_page_vector
from feedlab.sources.tables import impressions, pages_info
from test_terms_profile import brute_force_features

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_url_and_user(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        imp = impressions(spark, SF_MID)
        # a third of the impressions go to url 1, each from a distinct user, so
        # the hot url survives the (uid, urlid, label) reduction; another third
        # come from user 7
        third = F.col("event_id") % 3
        hot = (imp.withColumn("urlid", F.when(third == 0, F.lit(1)).otherwise(F.col("urlid")))
                  .withColumn("uid", F.when(third == 0, F.col("event_id") + 1_000_000)
                                      .when(third == 1, F.lit(7)).otherwise(F.col("uid"))))
        pages = pages_info(spark, SF_MID)
        attrs = pages.select("urlid", "pnum", "pdef", "pbeau")
        pv = feed_page_vector(pages)
        out = train_feature(hot, attrs, pv)
        got = out.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        plan = buf.getvalue()
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan
        assert "skew=true" in plan, "AQE did not split the hot partitions"

        log = [(r.uid, r.urlid, r.label) for r in hot.select("uid", "urlid", "label").collect()]
        attr = {r.urlid: (r.pnum, r.pdef, r.pbeau) for r in attrs.collect()}
        pvr = [(r.urlid, r.term, r.weight) for r in pv.collect()]
        exp = brute_force_features(log, attr, pvr)
        norm = lambda rows: Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
        assert norm(tuple(r) for r in got) == norm(exp)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_lookup_join_splits_hot_url(spark):
    from feedlab.operators.stats import click_show, join_stats
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        imp = impressions(spark, SF_MID).select("event_id", "urlid", "label")
        hot = imp.withColumn("urlid", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("urlid")))
        # AQE splits a skewed partition along map-output blocks; the test file
        # is one row group (one mapper), so spread it over several map tasks
        hot = hot.repartition(8)
        out = join_stats(hot, click_show(hot))
        rows = out.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        assert "skew=true" in buf.getvalue()
        assert len(rows) == imp.count()
        shows = Counter(r.urlid for r in rows)
        assert all(r.sumshow == shows[r.urlid] for r in rows)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_join_is_dealt_by_the_log_and_a_hot_key_is_cut(spark, tmp_path):
    from feedlab.operators.terms import user_profile
    from feedlab.session import join_dealt
    # half of the rows have key 1, some have none; a key of the side may repeat or be missing
    log = spark.range(2_000).select(F.col("id").alias("uid"),
                                    F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 7 > 0, F.col("id") % 90)
                                    .cast("long").alias("urlid"), (F.col("id") % 3 > 0).cast("int").alias("label"))
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    side = spark.createDataFrame([(k, f"t{t}", 1.0 + t) for k in [*range(60), 1, None] for t in range(3)],
                                 "urlid long, term string, weight double")
    rows = log.select("uid", "urlid")
    dealt = join_dealt(log, rows, side, "urlid", "uid", bytes_a_task=512)
    key = ["uid", "urlid", "term", "weight"]
    assert Counter(dealt.select(key).collect()) == Counter(rows.join(side, "urlid").select(key).collect())
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 16 and max(sizes) < sum(sizes) / 4

    # the profile's join has a task for each SPREAD_BYTES of the log, whatever Spark would choose
    plan = user_profile(log, side)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [urlid" in plan and "_cut" in plan
