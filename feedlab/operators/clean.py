"""Line cleaning, width guards and named field splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.constants import MISSING_NUMBER, URLINFO_FIELDS
from feedlab.functions.strings import clean_field, quote, split_all, strip_prefix


def clean_fields(df: DataFrame, col: str = "value", sep: str = "\t") -> DataFrame:
    """Split a line, trim each field (Unicode whitespace), empty -> ``"-"``,
    and re-join (C1 + C2 + C6).  The split comes first, so empty edge
    fields are kept (unlike a line-level strip)."""
    fields = F.transform(split_all(col, sep), lambda x: clean_field(x))
    return df.withColumn(col, F.array_join(fields, sep))


def quote_fields(df: DataFrame, col: str = "value", sep: str = "\t") -> DataFrame:
    """Wrap every field in double quotes."""
    return df.withColumn(col, F.array_join(F.transform(split_all(col, sep), lambda x: quote(x)), sep))


def strip_id_prefixes(df: DataFrame, positions: Sequence[int], col: str = "value", sep: str = "\t",
                      n: int = 2) -> DataFrame:
    """Drop the ``n``-character prefix of the fields at ``positions`` (C4 + C6)."""
    pos = set(positions)
    f = split_all(col, sep)
    width = F.size(f)
    fixed = F.transform(f, lambda x, i: F.when(i.isin(*pos), strip_prefix(x, n)).otherwise(x))
    return df.withColumn(col, F.when(width > 0, F.array_join(fixed, sep)))


def guard_width(df: DataFrame, n: int, col: str = "value", sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Split rows into those with exactly ``n`` fields and the rest.

    Bad rows are returned (quarantine), not silently dropped.
    """
    w = F.size(split_all(col, sep))
    return df.where(w == F.lit(n)), df.where((w != F.lit(n)) | w.isNull())


def split_named(df: DataFrame, col: str, names: Sequence[str] = URLINFO_FIELDS, sep: str = "\t",
                keep: Sequence[str] = ()) -> DataFrame:
    """Named fields of a delimited column (F14); rows with another field
    count get null fields and ``_valid = false``."""
    f = split_all(col, sep)
    ok = F.size(f) == F.lit(len(names))
    return df.select(*keep, *[F.when(ok, f[i]).alias(n) for i, n in enumerate(names)],
                     F.coalesce(ok, F.lit(False)).alias("_valid"))


def page_fields_with_defaults(df: DataFrame, col: str = "urlinfo", keep: Sequence[str] = ()) -> DataFrame:
    """``urlinfo`` -> typed page columns; malformed rows get ``s_term "-"``,
    ``pnum = pdef = pbeau = -1`` (C7)."""
    s = split_named(df, col, URLINFO_FIELDS, keep=keep)
    v = F.col("_valid")
    return s.select(
        *keep, *[F.col(c) for c in URLINFO_FIELDS if c not in ("pnum", "pdef", "pbeau")],
        F.when(v, F.col("pnum").try_cast("int")).otherwise(F.lit(MISSING_NUMBER)).alias("pnum"),
        F.when(v, F.col("pdef").try_cast("double")).otherwise(F.lit(float(MISSING_NUMBER))).alias("pdef"),
        F.when(v, F.col("pbeau").try_cast("double")).otherwise(F.lit(float(MISSING_NUMBER))).alias("pbeau"),
        v.alias("_valid"))
