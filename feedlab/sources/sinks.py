"""Sinks: text lines, headerless CSV, compaction, copy, nested dumps (K1-K7).

No sink funnels data through one task unless asked: ``compact`` picks the
file count from the data size, and arrays are exploded or serialised before
CSV (which cannot hold them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab.functions.strings import join_fields


def write_lines(df: DataFrame, path: str, cols: Sequence[str] | None = None, sep: str = "\t",
                mode: str = "errorifexists") -> None:
    """One text line per row, fields joined by ``sep`` (K1)."""
    cols = list(cols) if cols is not None else df.columns
    df.select(join_fields([F.col(c).cast("string") for c in cols], sep).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """Headerless CSV (K2): null -> empty field, ``""`` -> quoted empty."""
    df.write.mode(mode).options(header="false", **options).csv(path)


def compact(spark: SparkSession, path_in: str, path_out: str, n: int | None = None,
            fmt: str = "text", mode: str = "errorifexists") -> None:
    """Rewrite many small part files as fewer, larger files.

    With ``n`` the output has exactly ``n`` files (a round-robin shuffle).
    Without it, the scan itself packs small input files into read splits of
    up to ``spark.sql.files.maxPartitionBytes`` each and every split is
    written as one file: no shuffle and no single-task bottleneck.
    """
    df = spark.read.format(fmt).load(path_in)
    if n is not None:
        df = df.repartition(n)
    df.write.mode(mode).format(fmt).save(path_out)


def copy_dataset(spark: SparkSession, src: str, dst: str, fmt: str = "csv", schema=None,
                 mode: str = "errorifexists", **options) -> None:
    """Copy a dataset between stores with the same options on both sides (K4)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    r.load(src).write.mode(mode).format(fmt).options(**options).save(dst)


def write_nested(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows with nested columns as JSON lines (K7)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)
