"""Incremental click/show statistics resume from their checkpoint."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from feedlab.operators.stats import ctr_by_key
from feedlab.session import scratch_path
from feedlab.sources.tables import impressions, table
from feedlab.streaming.clicks import ctr_stream, impression_stream, run_available_now


def test_stream_resumes_and_matches_batch(spark):
    ev = table(spark, SF_SMALL, "events")
    src = scratch_path(spark, "stream-src")
    ev.where(F.col("event_id") % 2 == 0).write.parquet(src + "/day1")
    sink = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-ckpt")
    stream = lambda: ctr_stream(impression_stream(spark, src + "/*"))
    run_available_now(stream(), sink, ckpt)
    first = spark.read.parquet(sink).agg(F.sum("sumshow")).collect()[0][0]
    assert first == ev.where(F.col("event_id") % 2 == 0).count()
    # a second day arrives; the same checkpoint continues from the first run's state
    ev.where(F.col("event_id") % 2 == 1).write.parquet(src + "/day2")
    run_available_now(stream(), sink, ckpt)
    got = sorted(tuple(r) for r in spark.read.parquet(sink).select("urlid", "sumclick", "sumshow").collect())
    exp = ctr_by_key(impressions(spark, SF_SMALL).select("urlid", "label"))
    assert got == sorted(tuple(r) for r in exp.select("urlid", "sumclick", "sumshow").collect())
