"""Click/show statistics and the left joins of the feed.

All aggregates are plain ``groupBy`` aggregates, so Spark plans a partial
(map-side) aggregate before the shuffle: a url holding a third of all rows
costs one partial row per input partition, never one hot task.  Joins are
left outer equi-joins on the key; AQE decides at runtime whether the small
side is broadcast and splits skewed partitions of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlab.session import materialize


def click_show(df: DataFrame, key: str = "urlid", label: str = "label",
               clicks: str = "sumclick", shows: str = "sumshow") -> DataFrame:
    """Per key: ``sum(label)`` as clicks and the row count as shows (A1)."""
    return df.groupBy(key).agg(
        F.sum(F.col(label).cast("long")).alias(clicks),
        F.count(F.lit(1)).alias(shows),
    )


def ctr(clicks: Column, shows: Column) -> Column:
    """clicks / shows as double; null when shows is 0 or null (A2)."""
    return F.try_divide(clicks.cast("double"), shows.cast("double"))


def ctr_by_key(df: DataFrame, key: str = "urlid", label: str = "label") -> DataFrame:
    return click_show(df, key, label).withColumn("ctr", ctr(F.col("sumclick"), F.col("sumshow")))


def lookup_join(log: DataFrame, side: DataFrame, key, how: str = "left", name: str = "lookup") -> DataFrame:
    """Join a large log to a keyed side (few rows per key) that is itself the
    result of an aggregate or a join on that key.

    The side is written once under the shared checkpoint folder, so the join
    sees a plain shuffle on both inputs: AQE broadcasts the side when its
    measured size is small, and otherwise splits the partition of a hot key on
    the log side.  Without the write the side would reuse its own partitioning,
    its last operator would stand between the shuffle and the join, and AQE
    (with or without ``forceOptimizeSkewedJoin``) splits only where the shuffle
    feeds the join directly.  A stored table needs no write: join it as it is.
    """
    return log.join(materialize(side, name), key, how)


def join_stats(log: DataFrame, stats: DataFrame, key: str = "urlid") -> DataFrame:
    """Every log row plus the key's statistics, null when missing."""
    return lookup_join(log, stats, key, "left")


def join_page(log: DataFrame, page: DataFrame, key: str = "urlid",
              broadcast_max_bytes: int | None = None) -> DataFrame:
    """LEFT OUTER log ⟕ page on ``key``.

    With ``broadcast_max_bytes`` set (J4, the map-side lookup) the page side is
    written once, its rows are measured, and it is broadcast only if they take
    at most that many bytes; a larger table goes through the shuffled join.
    """
    if broadcast_max_bytes is not None:
        page = materialize(page, "broadcast_side")
        if row_bytes(page) <= broadcast_max_bytes:
            return log.join(F.broadcast(page), key, "left")
    return lookup_join(log, page, key, "left")


def row_bytes(df: DataFrame) -> int:
    """Bytes of all values: 8 per column and row, and the length of each text."""
    text = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in df.schema.fields
            if f.dataType.simpleString() not in ("int", "bigint", "double", "float", "boolean", "timestamp")]
    per_row = F.lit(8 * len(df.columns)).cast("long")
    for t in text:
        per_row = per_row + t
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def join_profile(rows: DataFrame, profile: DataFrame, key: str = "uid") -> DataFrame:
    """LEFT OUTER sample ⟕ user profile on ``uid``."""
    return lookup_join(rows, profile, key, "left")
