"""Column -> Column cleaning helpers.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Separators given to ``split`` are regular expressions in Spark; ``lit_regex``
quotes a literal separator.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlab.constants import ID_PREFIX_LEN, MISSING, SIMILARITY_DIGITS

# Unicode whitespace as Python's str.strip() sees it: Java's \s in UNICODE
# mode plus the four information separators U+001C..U+001F.
_WS = r"[\s\x{1c}-\x{1f}]"
_EDGE_WS = rf"(?U)^{_WS}+|{_WS}+$"


def lit_regex(sep: str) -> str:
    """A Java regex matching ``sep`` literally."""
    return "".join("\\" + ch if re.match(r"[\\^$.|?*+()\[\]{}]", ch) else ch for ch in sep)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_unicode(c) -> Column:
    """Strip leading/trailing Unicode whitespace (tab, U+3000 ...)."""
    return F.regexp_replace(col_of(c), _EDGE_WS, "")


def empty_to_dash(c) -> Column:
    """Empty string -> ``"-"``."""
    c = col_of(c)
    return F.when(c == F.lit(""), F.lit(MISSING)).otherwise(c)


def clean_field(c) -> Column:
    """C1 then C2: trimmed field, ``"-"`` when nothing is left."""
    return empty_to_dash(trim_unicode(c))


def quote(c) -> Column:
    """Wrap a field in double quotes."""
    return F.concat(F.lit('"'), col_of(c), F.lit('"'))


def strip_prefix(c, n: int = ID_PREFIX_LEN) -> Column:
    """Drop the first ``n`` characters (``s[n:]``); shorter values give ``""`` (C4)."""
    return F.substring(col_of(c), n + 1, 2147483647)


def unquote(c) -> Column:
    """Remove one pair of enclosing double quotes; other values unchanged."""
    return F.regexp_replace(col_of(c), r'(?s)^"(.*)"$', "$1")


def join_fields(cols, sep: str = "\t") -> Column:
    """Re-join fields with a separator (C6); a null field is an empty one, so
    later fields keep their places."""
    return F.concat_ws(sep, *[F.coalesce(col_of(c).cast("string"), F.lit("")) for c in cols])


def fmt_fixed(c, digits: int = SIMILARITY_DIGITS) -> Column:
    """Fixed-decimal text with grouping, e.g. ``1,234.50000``."""
    return F.format_number(col_of(c), digits)


def split_limited(c, sep: str, max_fields: int) -> Column:
    """Split into at most ``max_fields`` parts; the rest stays in the last one.

    Python's ``s.split(sep, k)`` equals ``split_limited(s, sep, k + 1)``.
    """
    return F.split(col_of(c), lit_regex(sep), max_fields)


def split_all(c, sep: str) -> Column:
    """Unbounded split keeping trailing empty fields, like Python ``str.split``."""
    return F.split(col_of(c), lit_regex(sep), -1)
