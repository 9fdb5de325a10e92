"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab.session import materialize  # noqa: F401  (used by the operators)

# The white space of every word rule here: space and U+0009 - U+000D.  It is
# also what ``bytes.split()`` splits at, so words of UTF-8 bytes need no regex.
SPACES = " \t\n\x0b\x0c\r"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


TASK_BYTES = 128 << 20


def tasks_for(df: DataFrame) -> int:
    """Tasks of a shuffle of ``df``: the session's shuffle partitions, or as many as
    hold ``TASK_BYTES`` each where that is more.  The plan's own size estimate is
    free; only where it says more are the rows measured, by strings' lengths."""
    least = shuffle_partitions(df.sparkSession)
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if estimate <= least * TASK_BYTES:
        return least
    sizes = [F.octet_length(f.name) if f.dataType.simpleString() in ("string", "binary") else F.lit(8)
             for f in df.schema.fields]
    total = df.agg(F.sum(sum((F.coalesce(s, F.lit(0)).cast("long") for s in sizes), F.lit(0).cast("long")))).first()[0]
    return max(least, -(-(total or 0) // TASK_BYTES))


_shipped: set[str] = set()


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors' path.

    The package is added to the job's Python files once per application, so the
    functions run whatever folder the executors' Python starts in.
    """
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        file = Path(tempfile.mkdtemp(prefix="feedlab-py-")) / "feedlab.zip"
        with zipfile.ZipFile(file, "w") as z:
            for p in sorted((root / "feedlab").rglob("*.py")):
                z.write(p, p.relative_to(root).as_posix())
        sc.addPyFile(str(file))
        _shipped.add(sc.applicationId)
    return df.mapInArrow(function, schema)
