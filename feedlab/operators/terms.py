"""Term-vector operators in relational form.

A vector is held as rows ``(key, term, weight)``.  Merging is a two-level
hash aggregate (partial before the shuffle), top-N per key is a
``row_number`` filter that Spark plans as a ``WindowGroupLimit`` on both
sides of the exchange, and a dot product is an equi-join on the term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlab.constants import POINT_ITEM_SEP, TERM_KV_SEP
from feedlab.functions.terms import parse_terms, sign_weight, tag_terms, weight_text
from feedlab.session import join_dealt, spread_like

DIGITS = 6


def keys_of(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def no_neg_zero(c: Column) -> Column:
    """Map -0.0 to 0.0 so text and hash forms of a zero weight agree."""
    return F.when(c == F.lit(0.0), F.lit(0.0)).otherwise(c)


def rounded(c: Column, digits: int = DIGITS) -> Column:
    return no_neg_zero(F.round(c, digits))


def explode_terms(df: DataFrame, key: str | Sequence[str], terms: str | Column) -> DataFrame:
    """Term-vector column -> rows ``(*key, term, weight)``; empty vectors give no row."""
    tcol = F.col(terms) if isinstance(terms, str) else terms
    return df.select(*keys_of(key), F.inline(tcol))


def merge_terms(df: DataFrame, key: str | Sequence[str] = "uid", term: str = "term",
                weight: str = "weight", digits: int = DIGITS) -> DataFrame:
    """Sum weights per (key, term) (T7 / A8); result rounded to ``digits``."""
    ks = keys_of(key)
    return df.groupBy(*ks, term).agg(rounded(F.sum(weight), digits).alias(weight))


def top_n_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column], n: int,
                  rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per key in ``order`` (O2/O3).

    ``order`` must be a total order within a key (add a tie-breaker) so the
    result is deterministic.  Planned as ``WindowGroupLimit`` + ``Window``.
    """
    w = Window.partitionBy(*keys_of(key)).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def merge_terms_topn(df: DataFrame, key: str = "uid", term: str = "term", weight: str = "weight",
                     n: int = 21, rank_col: str | None = None) -> DataFrame:
    """Full merge, then the ``n`` largest weights per key, ties by term."""
    merged = merge_terms(df, key, term, weight)
    return top_n_per_key(merged, key, [F.col(weight).desc(), F.col(term).asc()], n, rank_col)


def page_vector_from_text(page: DataFrame, key: str = "urlid", title_terms: str = "s_title",
                          points: str = "ppoint", tags: str = "tpoint") -> DataFrame:
    """Page vector from the text form of a page row (T4):
    ``s_title`` ("k:v,k:v") ⊕ ``ppoint`` ("k:v;k:v") ⊕ ``tpoint`` ("k,k")."""
    parts = F.concat(parse_terms(title_terms), parse_terms(points, POINT_ITEM_SEP, TERM_KV_SEP), tag_terms(tags))
    return merge_terms(explode_terms(page, key, parts), key)


def page_vector(keyword_rows: DataFrame, page: DataFrame, key: str = "urlid",
                points: str = "points", tags: str = "tags") -> DataFrame:
    """Page vector = keyword rows ⊕ point terms ⊕ tag terms, summed per term (T4).

    ``keyword_rows`` is ``(key, term, weight)`` (e.g. title keywords).  Computed
    once per page, never per impression.
    """
    # both in one pass: the page side is often a join of its own
    own = explode_terms(page, key, F.concat(parse_terms(points, POINT_ITEM_SEP, TERM_KV_SEP), tag_terms(tags)))
    kw = keyword_rows.select(key, "term", F.col("weight").cast("double").alias("weight"))
    return merge_terms(kw.unionByName(own), key)


def sign_terms(df: DataFrame, label: str = "label", weight: str = "weight") -> DataFrame:
    """Negate weights of rows whose label is 0 (T5)."""
    return df.withColumn(weight, no_neg_zero(sign_weight(label, weight)))


def signed_terms(log: DataFrame, page_vec: DataFrame, key: str = "urlid", label: str = "label") -> DataFrame:
    """Per log row, its page's terms signed by the row's label (T5 on J1)."""
    return sign_terms(log.join(page_vec, key), label, "weight")


def terms_to_text(df: DataFrame, key: str | Sequence[str], term: str = "term", weight: str = "weight",
                  out: str = "s_term") -> DataFrame:
    """Rows -> ``"k:v,k:v"`` per key, sorted by term.

    Collects one key's terms into one row, so use it on bounded vectors
    (page vectors, top-N profiles), not on unbounded groups.
    """
    ks = keys_of(key)
    items = F.array_sort(F.collect_list(F.struct(F.col(term).alias("t"), F.col(weight).alias("w"))))
    text = F.array_join(F.transform(items, lambda s: F.concat(s["t"], F.lit(":"), weight_text(s["w"]))), ",")
    return df.groupBy(*ks).agg(text.alias(out))


def net_sign(df: DataFrame, user: str = "uid", item: str = "urlid", label: str = "label",
             count: str | None = None) -> DataFrame:
    """Per (user, item): number of positive minus non-positive rows.

    Signing and summing commute with the page vector, so the profile is the
    page vector scaled by this one integer per pair instead of one vector per
    impression.
    """
    from feedlab.operators.relational import drop_null_key
    one = F.col(count) if count else F.lit(1)
    s = F.when(F.col(label) != F.lit(0), one).otherwise(-one)
    return drop_null_key(df, user).groupBy(user, item).agg(F.sum(s).cast("double").alias("net"))


def user_profile(log: DataFrame, page_vec: DataFrame, user: str = "uid", item: str = "urlid",
                 label: str = "label", count: str | None = None) -> DataFrame:
    """Sum of signed page vectors per user (T7 over T5): ``(uid, term, weight)``.

    Impressions are first reduced to one signed count per (user, page)
    pair; only those pairs are joined to the page vectors.
    """
    pairs = net_sign(log, user, item, label, count)
    rows = (join_dealt(log, pairs, page_vec, item, user)
            .select(user, "term", (F.col("net") * F.col("weight")).alias("weight")))
    return merge_terms(spread_like(log, rows, user, "term"), user)


def user_profile_topn(log: DataFrame, page_vec: DataFrame, n: int = 21, **kw) -> DataFrame:
    """Profile cut to the ``n`` largest weights per user, ties by term."""
    user = kw.get("user", "uid")
    prof = spread_like(log, user_profile(log, page_vec, **kw), user)
    return top_n_per_key(prof, user, [F.col("weight").desc(), F.col("term").asc()], n)


def clicked_profile(log: DataFrame, term_rows: DataFrame, user: str = "uid", item: str = "urlid",
                    label: str = "label") -> DataFrame:
    """Per user, the summed term weights of the pages they clicked.

    Clicks are counted per (user, page) first, so each page's terms are
    joined once per pair and scaled by the click count.
    """
    from feedlab.operators.relational import drop_null_key, positives
    clicks = (drop_null_key(positives(log, label), user)
              .groupBy(user, item).agg(F.count(F.lit(1)).cast("double").alias("_c")))
    rows = (join_dealt(log, clicks, term_rows, item, user)
            .select(user, "term", (F.col("_c") * F.col("weight")).alias("weight")))
    return merge_terms(spread_like(log, rows, user, "term"), user)


def pair_scores(pairs: DataFrame, page_vec: DataFrame, profile: DataFrame, user: str = "uid",
                item: str = "urlid", log: DataFrame | None = None) -> DataFrame:
    """Unsigned dot product of page vector and user profile per (user, item).

    Inner joins drop pairs without a common term; callers left-join back and
    default to 0.  The terms of all pairs take many times the room of the pairs, so
    they are spread before they are sorted for the profile.
    """
    p = profile.select(user, "term", F.col("weight").alias("pw"))
    log = pairs if log is None else log
    terms = join_dealt(log, pairs.select(user, item), page_vec, item, user)
    rows = spread_like(log, terms, user, "term").join(p, [user, "term"])
    return rows.groupBy(user, item).agg(F.sum(F.col("weight") * F.col("pw")).alias("dot"))


def page_maps(page_vec: DataFrame, item: str = "urlid") -> DataFrame:
    """``(item, _page)``: a page's terms as one map (bounded by the page)."""
    return page_vec.groupBy(item).agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("_page"))


def pair_scores_topn(pairs: DataFrame, page_vec: DataFrame, profile: DataFrame, user: str = "uid",
                     item: str = "urlid") -> DataFrame:
    """``pair_scores`` for profiles of a bounded number of terms per user.

    A profile travels as one array and a page as one map, so a pair is one row
    in both joins instead of one row per term.  The dot product is a native
    fold over the user's terms.
    """
    return map_scores(pairs, page_maps(page_vec, item), profile, user, item)


def map_scores(pairs: DataFrame, pages: DataFrame, profile: DataFrame, user: str = "uid",
               item: str = "urlid", log: DataFrame | None = None) -> DataFrame:
    """``pair_scores_topn`` over ``page_maps``.  A pair that carries its page's map is a
    wide row; these are spread before they are sorted for the users (``log``: see ``spread_like``)."""
    terms = profile.groupBy(user).agg(
        F.sort_array(F.collect_list(F.struct("term", F.col("weight").alias("w")))).alias("_terms"))
    log = pairs if log is None else log
    wide = join_dealt(log, pairs.select(user, item), pages, item, user)
    j = spread_like(log, wide, user).join(terms, user)
    dot = F.aggregate("_terms", F.lit(0.0),
                      lambda acc, t: acc + t["w"] * F.coalesce(F.try_element_at("_page", t["term"]), F.lit(0.0)))
    return j.select(user, item, dot.alias("dot"))


def term_score(rows: DataFrame, page_vec: DataFrame, profile: DataFrame, user: str = "uid",
               item: str = "urlid", label: str = "label", out: str = "s_term_score",
               topn_profile: bool = False) -> DataFrame:
    """Every row plus Σ signed page weight × profile weight; 0 when nothing matches.
    ``topn_profile``: the profile holds a bounded number of terms per user."""
    from feedlab.operators.stats import lookup_join
    pairs = rows.select(user, item).where(F.col(user).isNotNull()).distinct()
    dots = (pair_scores_topn if topn_profile else pair_scores)(pairs, page_vec, profile, user, item)
    j = lookup_join(rows, dots, [user, item], "left")
    signed = sign_weight(label, F.coalesce(F.col("dot"), F.lit(0.0)))
    return j.withColumn(out, rounded(signed)).drop("dot")
