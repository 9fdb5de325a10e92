"""Tokenisation as a native regular-expression extraction.

The source jobs run a per-row segmenter library in Python workers; here the
tokenizer is a column expression: lower-cased Latin letter runs, and each Han
character as its own token.  Any other tokenizer that yields
``array<string>`` can be passed to the text operators instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlab.functions.strings import col_of

# Fixed token pattern: runs of a-z plus Latin-1 letters à..ÿ, or one Han character.
TOKEN_PATTERN = r"([a-zà-ÿ]+|\p{IsHan})"


def tokenize(c, pattern: str = TOKEN_PATTERN) -> Column:
    """Text -> ordered token array; null text -> ``[]``."""
    toks = F.regexp_extract_all(F.lower(col_of(c)), F.lit(pattern), 1)
    return F.coalesce(toks, F.array().cast("array<string>"))


# Character class of one token start, for "has at least one token" checks.
TOKEN_CHAR = r"[a-zà-ÿ]|\p{IsHan}"
