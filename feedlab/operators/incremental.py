"""Profiles kept up to date by batches of impressions.

``ProfileStore`` keeps, per batch, the full unrounded term sums and the cut
profile of every user that the batch touched; a user's valid rows are those of
the last batch that touched them.  A merge reads and writes touched users only,
and the cut is made from full sums, so any split into batches gives the profile
of one pass over all impressions.

Layout under the store's folder: ``sums/batch=k`` and ``top/batch=k``; the
success marker of ``top/batch=k``, written last, commits batch k.  A batch that
died before it is overwritten by the next merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab.constants import PROFILE_TOP_N
from feedlab.operators.terms import net_sign, rounded, top_n_per_key
from feedlab.session import materialize

SUMS_DDL = "uid bigint, term string, weight double"


def profile_delta(log: DataFrame, page_vec: DataFrame, user: str = "uid", item: str = "urlid",
                  label: str = "label") -> DataFrame:
    """What a batch of impressions adds: unrounded ``(uid, term, weight)`` sums."""
    rows = net_sign(log, user, item, label).join(page_vec, item)
    return (rows.groupBy(F.col(user).alias("uid"), "term")
            .agg(F.sum(F.col("net") * F.col("weight")).alias("weight")))


class ProfileStore:
    """Profiles of ``top_n`` terms per user in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, top_n: int = PROFILE_TOP_N):
        self.spark, self.path, self.top_n = spark, path.rstrip("/"), top_n

    def batches(self) -> int:
        """Number of committed batches."""
        n = 0
        while self._exists(f"{self.path}/top/batch={n}/_SUCCESS"):
            n += 1
        return n

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _rows(self, table: str) -> DataFrame:
        """Committed rows of a table with their batch; typed and empty before the first."""
        n = self.batches()
        if not n:
            return self.spark.createDataFrame([], f"{SUMS_DDL}, batch int")
        paths = [f"{self.path}/{table}/batch={k}" for k in range(n)]
        return (self.spark.read.option("basePath", f"{self.path}/{table}").schema(f"{SUMS_DDL}, batch int")
                .parquet(*paths))

    def _valid(self, table: str, users: DataFrame | None = None) -> DataFrame:
        rows = self._rows(table)
        if users is not None:
            rows = rows.join(users, "uid", "left_semi")
        # sums hold many rows per user: the batches come from the short table
        last = self._rows("top")
        if users is not None:
            last = last.join(users, "uid", "left_semi")
        last = last.groupBy("uid").agg(F.max("batch").alias("batch"))
        return rows.join(last, ["uid", "batch"]).select("uid", "term", "weight")

    def profile(self) -> DataFrame:
        """``(uid, term, weight)`` as ``user_profile_topn`` gives it for all batches."""
        return self._valid("top")

    def sums(self) -> DataFrame:
        """Full unrounded sums of all users."""
        return self._valid("sums")

    def merge(self, delta: DataFrame) -> int:
        """Add ``profile_delta`` of a batch; returns the number of users whose cut was redone.

        An empty delta commits an empty batch.  Null users or terms are dropped.
        """
        k = self.batches()
        delta = materialize(delta.where(F.col("uid").isNotNull() & F.col("term").isNotNull())
                            .select(F.col("uid").cast("bigint").alias("uid"), "term",
                                    F.col("weight").cast("double").alias("weight")), "profile_delta")
        touched = materialize(delta.select("uid").distinct(), "touched_users")
        full = (self._valid("sums", touched).unionByName(delta)
                .groupBy("uid", "term").agg(F.sum("weight").alias("weight")))
        self._write(full, "sums", k)
        written = self.spark.read.schema(SUMS_DDL).parquet(f"{self.path}/sums/batch={k}")
        self._write(self._cut(written), "top", k)
        return touched.count()

    def _cut(self, sums: DataFrame) -> DataFrame:
        return top_n_per_key(sums.select("uid", "term", rounded(F.col("weight")).alias("weight")), "uid",
                             [F.col("weight").desc(), F.col("term").asc()], self.top_n)

    def _write(self, rows: DataFrame, table: str, batch: int) -> None:
        rows.select("uid", "term", "weight").write.mode("overwrite").parquet(f"{self.path}/{table}/batch={batch}")

    def compacted(self, path: str) -> ProfileStore:
        """A new store whose only batch holds every user's valid rows."""
        new = ProfileStore(self.spark, path, self.top_n)
        new._write(self.sums(), "sums", 0)
        new._write(self.profile(), "top", 0)
        return new
