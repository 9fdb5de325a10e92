"""Column -> Column functions over term lists and token arrays.

A term vector is ``array<struct<term:string, weight:double>>``; text forms
(``"k:v,k:v"``) appear only at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlab.constants import TAG_SEP, TERM_ITEM_SEP, TERM_KV_SEP, TOKEN_TRUNCATE
from feedlab.functions.strings import MISSING, col_of, lit_regex, split_all

TERM_STRUCT = "array<struct<term:string,weight:double>>"


def empty_terms() -> Column:
    return F.array().cast(TERM_STRUCT)


def parse_terms(c, item_sep: str = TERM_ITEM_SEP, kv_sep: str = TERM_KV_SEP) -> Column:
    """``"k:v,k:v"`` -> term vector.

    Items that do not split into exactly two parts, or whose value is not a
    number, are skipped; ``"-"``, ``""`` and null give an empty vector.
    Repeated keys stay repeated here and are summed by ``merge_terms``.
    """
    items = split_all(col_of(c), item_sep)
    pairs = F.filter(F.transform(items, lambda x: split_all(x, kv_sep)), lambda a: F.size(a) == 2)
    structs = F.transform(
        pairs, lambda a: F.struct(a[0].alias("term"), a[1].try_cast("double").alias("weight")))
    kept = F.filter(structs, lambda s: s["weight"].isNotNull())
    return F.coalesce(kept, empty_terms())


def tag_terms(c, sep: str = TAG_SEP) -> Column:
    """``"k,k"`` -> one (term, 1.0) per occurrence; ``"-"`` / null -> empty."""
    c = col_of(c)
    tags = F.transform(split_all(c, sep), lambda x: F.struct(x.alias("term"), F.lit(1.0).alias("weight")))
    return F.when(c.isNull() | (c == F.lit(MISSING)), empty_terms()).otherwise(tags)


def sign_weight(label, weight) -> Column:
    """+w when label != 0, else -w (T5)."""
    w = col_of(weight)
    return F.when(col_of(label) != F.lit(0), w).otherwise(-w)


def weight_text(weight) -> Column:
    """Weight as fixed 6-decimal text (identical in every SQL engine)."""
    return col_of(weight).cast("decimal(18,6)").cast("string")


def terms_text(terms) -> Column:
    """Term vector -> ``"k:v,k:v"`` in the vector's order."""
    return F.array_join(
        F.transform(col_of(terms), lambda s: F.concat(s["term"], F.lit(":"), weight_text(s["weight"]))), ",")


def text_to_tokens(c, sep: str = ",") -> Column:
    """Token text -> array; null -> ``[]``."""
    c = col_of(c)
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.split(c, lit_regex(sep), -1))


def truncate_tokens(c, n: int = TOKEN_TRUNCATE) -> Column:
    """First ``n`` tokens."""
    return F.slice(col_of(c), 1, n)


def tokens_to_text(c, sep: str = ",") -> Column:
    """Token array -> delimited text for CSV sinks (K5)."""
    return F.array_join(col_of(c), sep)


def vector_to_text(c, sep: str = ",") -> Column:
    """ML vector -> delimited text (K6)."""
    from pyspark.ml.functions import vector_to_array
    return F.array_join(F.transform(vector_to_array(col_of(c)), lambda x: x.cast("string")), sep)
