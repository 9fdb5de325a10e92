"""Readers for delimited text, CSV, JSON and legacy-charset exports.

Every reader returns a DataFrame; parsing is native (``split`` +
``try_cast``), so the line scan, split and typed projection form one codegen
stage and malformed values become nulls instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlab.constants import IMPRESSION_FIELDS  # label first (see SURVEY §1.3)
from feedlab.functions.strings import split_all, split_limited

IMPRESSION_TYPES = {"label": "int", "ts": "string", "uid": "bigint", "urlid": "bigint", "urlinfo": "string"}

# Field separator used when a non-UTF-8 file is read through the CSV reader
# as whole lines: a control sequence that does not occur in text exports.
_WHOLE_LINE_SEP = "\u0000\u0001\u0000"


def read_lines(spark: SparkSession, path: str | Sequence[str], charset: str | None = None) -> DataFrame:
    """One row per line in column ``value``.

    ``path`` may be a file, directory, glob or list.  For a legacy charset
    (e.g. ``GBK``) the bytes are decoded by the CSV reader with quoting off,
    so each line stays one field; undecodable bytes (U+FFFD) are removed.
    Non-UTF-8 charsets need ``spark.sql.legacy.javaCharsets=true``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if charset is None or charset.replace("-", "").lower() == "utf8":
        return spark.read.text(paths)
    df = (spark.read.format("csv")
          .option("encoding", charset)
          .option("sep", _WHOLE_LINE_SEP)
          .option("quote", "")
          .option("escape", "")
          .option("comment", "")
          .option("header", "false")
          .option("ignoreLeadingWhiteSpace", "false")
          .option("ignoreTrailingWhiteSpace", "false")
          .option("nullValue", "\u0000\u0002")
          .schema("value string")
          .load(paths))
    return df.select(F.regexp_replace("value", "�", "").alias("value"))


def parse_impressions(df: DataFrame, col: str = "value") -> DataFrame:
    """``label,ts,uid,urlid,urlinfo`` lines: the first four commas split, the
    rest (which may hold commas and tabs) is ``urlinfo`` (S2); fields that a
    short line does not have are null."""
    f = split_limited(col, ",", len(IMPRESSION_FIELDS))
    return df.select(*[
        (F.get(f, F.lit(i)) if IMPRESSION_TYPES[n] == "string"
         else F.get(f, F.lit(i)).try_cast(IMPRESSION_TYPES[n])).alias(n)
        for i, n in enumerate(IMPRESSION_FIELDS)])


def parse_tsv(df: DataFrame, names: Sequence[str], col: str = "value",
              types: dict[str, str] | None = None) -> DataFrame:
    """Unbounded tab split into named fields (S3); missing fields are null."""
    f = split_all(col, "\t")
    types = types or {}
    out = []
    for i, n in enumerate(names):
        c = F.get(f, F.lit(i))
        out.append((c.try_cast(types[n]) if n in types else c).alias(n))
    return df.select(*out)


def parse_key_rest(df: DataFrame, key: str = "urlid", rest: str = "urlinfo", col: str = "value") -> DataFrame:
    """Split at the first tab only: key and remainder; no tab -> remainder ``""``."""
    f = split_limited(col, "\t", 2)
    return df.select(f[0].alias(key), F.coalesce(F.get(f, 1), F.lit("")).alias(rest))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
             **options) -> DataFrame:
    """Headerless CSV with a declared schema."""
    return spark.read.options(header="false", **options).schema(schema).csv(path)


def read_csv_named(spark: SparkSession, path: str | Sequence[str], names: Sequence[str],
                   **options) -> DataFrame:
    """Headerless CSV without a schema: all strings, named by position."""
    return spark.read.options(header="false", inferSchema="false", **options).csv(path).toDF(*names)


def read_json(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """One JSON object per line (warehouse table export).

    Without ``schema`` the schema is inferred (an extra pass over the data);
    pass one for large tables.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_stopwords(spark: SparkSession, path: str | Sequence[str], col: str = "word") -> DataFrame:
    """Dictionary file, one word per line, kept distributed."""
    from feedlab.functions.strings import trim_unicode
    lines = read_lines(spark, path)
    w = trim_unicode("value")
    return lines.select(w.alias(col)).where(F.col(col) != F.lit("")).distinct()
