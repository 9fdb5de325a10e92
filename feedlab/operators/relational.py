"""Projections, filters, splits and SQL over DataFrames.

Thin, named wrappers over DataFrame calls so that pipelines read like the
jobs they replace; Catalyst prunes columns and pushes every filter here into
the Parquet scan when the input is a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab.constants import THRESHOLD_TOLERANCE
from feedlab.session import materialize


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column subset (F1)."""
    return df.select(*cols)


def join_keep_left(left: DataFrame, right: DataFrame, on: str | list[str],
                   right_cols: Sequence[str], how: str = "left") -> DataFrame:
    """All columns of ``left`` plus chosen columns of ``right`` (F2)."""
    keys = [on] if isinstance(on, str) else list(on)
    r = right.select(*keys, *right_cols)
    return left.join(r, keys, how)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename."""
    return df.toDF(*names)


def cast_cols(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Typed cast projection (F4); unparsable values become null unless ``strict``."""
    out = df
    for c, t in types.items():
        out = out.withColumn(c, F.col(c).cast(t) if strict else F.col(c).try_cast(t))
    return out


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not null."""
    return df.where(F.col(key).isNotNull())


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with no null in ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Stable bucket of a key: first 32 bits of md5(key as text) mod ``buckets``."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(buckets))


def hash_split(df: DataFrame, key: str, train_pct: int) -> tuple[DataFrame, DataFrame]:
    """Reproducible train/test split by key hash (F8); independent of partitioning."""
    b = hash_bucket(key)
    return df.where(b < train_pct), df.where(b >= train_pct)


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Random split (F8) as in the source jobs; seeded."""
    return df.randomSplit(list(weights), seed)


def positives(df: DataFrame, label: str = "label") -> DataFrame:
    """``label > 0``."""
    return df.where(F.col(label) > F.lit(0))


def true_positives(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """``label == 1 and prediction > 0``."""
    return df.where((F.col(label) == F.lit(1)) & (F.col(pred) > F.lit(0)))


def within_of_max(df: DataFrame, col: str, tol: float = THRESHOLD_TOLERANCE) -> DataFrame:
    """Rows within ``tol`` of the column's global maximum.

    The maximum is a scalar subquery (partial max per partition, then one
    row), evaluated once: nothing grows with the data on one node.
    """
    mx = df.agg(F.max(col)).scalar()
    return df.where(mx - F.col(col) < F.lit(tol))


def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a total order (F13); planned as TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL over DataFrames passed by name (F15): ``run_sql(spark, "SELECT * FROM {t}", t=df)``.

    Uses parameterised ``spark.sql`` so no global temp view is left behind.
    """
    return spark.sql(query, **frames)


# Range buckets of any table, and rows for each further one.
LEAST_BUCKETS = 8
BUCKET_ROWS = 500_000


def _first_not(bounds: Column, passed, steps: int) -> Column:
    """How many leading elements of a sorted array fulfil ``passed``, by binary search in ``steps`` halvings."""
    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        inside = F.when(F.coalesce(passed(F.get(bounds, mid)), F.lit(False)),
                        F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(
                            F.struct(s["lo"].alias("lo"), mid.alias("hi")))
        return F.when(s["lo"] < s["hi"], inside).otherwise(s)
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(steps, 1))), start, halve)["lo"]


def range_buckets(df: DataFrame, col: str, n_buckets: int | None = None, out: str = "_bucket",
                  descending: bool = False) -> DataFrame:
    """Assign each row a bucket of ``col``'s value range (approximate quantiles,
    one aggregate pass).  Buckets are ordered: ascending values get ascending
    bucket numbers (or the reverse with ``descending``).  Equal values share a
    bucket, so per-bucket work can be finished with a window partitioned by
    bucket and stitched together with per-bucket offsets (one row a bucket).
    The number of buckets follows the number of rows (``BUCKET_ROWS`` each), and a
    row finds its bucket by binary search, so its cost grows with their logarithm.
    """
    n = n_buckets or LEAST_BUCKETS + df.count() // BUCKET_ROWS
    qs = [i / n for i in range(1, n)]
    bounds = df.agg(F.percentile_approx(col, qs, 10 * n)).scalar()
    # (a subquery may not sit inside a lambda: project it as a column first)
    # no bounds for one bucket or an empty table
    with_b = df.withColumn("_bounds", F.coalesce(bounds, F.array().cast(f"array<{df.schema[col].dataType.simpleString()}>")))
    # ascending: how many bounds lie below the value; descending: how many above it
    passed = (lambda bound: bound <= F.col(col)) if descending else (lambda bound: bound < F.col(col))
    at = _first_not(F.col("_bounds"), passed, (n - 1).bit_length())
    b = F.size("_bounds") - at if descending else at
    return with_b.withColumn(out, b).drop("_bounds")


def dense_index(df: DataFrame, col: str, out: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """``(col, out)``: a dense 0-based index of the distinct values of ``col``
    in ascending order, computed without collecting the values anywhere.

    Distinct values are cut into ordered range buckets; bucket sizes (one row
    per bucket) are prefix-summed into offsets, and a window partitioned by
    bucket numbers the values inside each bucket.
    """
    from pyspark.sql import Window
    out = out or f"{col}_idx"
    ids = materialize(df.select(col).where(F.col(col).isNotNull()).distinct(), "index_values")
    b = range_buckets(ids, col, n_buckets)
    sizes = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_bucket").orderBy(col)
    return b.join(offsets, "_bucket").select(col, (F.col("_off") + F.row_number().over(inside) - 1).alias(out))
