"""Text operators: keywords, term counts, stop words, token lists.

Every step is a native expression, ``explode`` or ``groupBy``.  Document
frequency is a per-term aggregate; the corpus size N is a one-row aggregate
joined as a scalar.  Top-k keywords per document are a ``row_number``
filter (``WindowGroupLimit``), bounded by the document's own length.
"""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.functions.strings import split_all, split_limited
from feedlab.functions.terms import text_to_tokens, weight_text
from feedlab.functions.tokens import tokenize
from feedlab.operators.stats import lookup_join
from feedlab.operators.terms import DIGITS, rounded, top_n_per_key
from feedlab.session import materialize, spread, together


def explode_values(df: DataFrame, keep, arr, alias: str, pos: str | None = None) -> DataFrame:
    """Rows of the array's elements (empty/null arrays give no row).

    Uses the *outer* generator and drops the null row: a plain ``explode``
    makes the optimizer infer ``size(arr) > 0`` and push it below the
    projection, which evaluates an expensive array expression (a tokenizer)
    twice per row.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    keep = [keep] if isinstance(keep, str) else list(keep)
    if pos:
        out = df.select(*keep, F.posexplode_outer(a).alias(pos, alias))
    else:
        out = df.select(*keep, F.explode_outer(a).alias(alias))
    return out.where(F.col(alias).isNotNull())


def term_frequencies(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """``(key, term, tf, n, leads)``: occurrences of each term, the document
    length, and whether the term is the document's first token."""
    ex = explode_values(df.select(key, tokens, F.size(tokens).alias("n")), [key, "n"], tokens, "term", pos="pos")
    return ex.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"), F.max("n").alias("n"),
                                       (F.min("pos") == 0).alias("leads"))


def tfidf(df: DataFrame, key: str, text: str, tokenizer=tokenize, idf: DataFrame | None = None) -> DataFrame:
    """``(key, term, weight)``, weight = round(tf/len · ln((N+1)/(df+1)), 6).

    N counts documents with at least one token.  A supplied ``idf`` table
    ``(term, idf)`` replaces the corpus statistics.
    """
    toks = spread(df.select(key, text), key).select(key, tokenizer(F.col(text)).alias("tokens"))
    tf = term_frequencies(toks, key, "tokens")
    if idf is None:
        # The text is read and tokenised once: document frequencies, N (every
        # document has one leading term) and the weights read the written table.
        tf = materialize(tf, "term_frequencies")
        dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        n_docs = tf.agg(F.count_if("leads")).scalar()
        idf = dfreq.select("term", F.log((n_docs + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    j = lookup_join(tf, idf, "term", "inner")
    w = F.col("tf").cast("double") / F.col("n").cast("double") * F.col("idf")
    return j.select(key, "term", rounded(w, DIGITS).alias("weight"))


def keywords(df: DataFrame, key: str, text: str, k: int, tokenizer=tokenize,
             idf: DataFrame | None = None) -> DataFrame:
    """Top-``k`` TF-IDF terms per document by weight desc, term asc (X2):
    ``(key, term, weight, rank)``."""
    scored = tfidf(df, key, text, tokenizer, idf)
    return top_n_per_key(scored, key, [F.col("weight").desc(), F.col("term").asc()], k, rank_col="rank")


def keywords_text(kw: DataFrame, key: str, out: str) -> DataFrame:
    """Keyword rows -> ``"term:weight,..."`` in rank order (bounded by k)."""
    items = F.array_sort(F.collect_list(F.struct("rank", "term", "weight")))
    text = F.array_join(
        F.transform(items, lambda s: F.concat(s["term"], F.lit(":"), weight_text(s["weight"]))), ",")
    return kw.groupBy(key).agg(text.alias(out))


def enrich_page(page: DataFrame, key: str = "urlid", title: str = "title", content: str = "content",
                k_title: int = 20, k_content: int = 40, tokenizer=tokenize) -> DataFrame:
    """Page row + ``s_title`` / ``s_content`` keyword text columns."""
    kt, kc = together(page.sparkSession,
                      lambda: keywords_text(keywords(page, key, title, k_title, tokenizer), key, "s_title"),
                      lambda: keywords_text(keywords(page, key, content, k_content, tokenizer), key, "s_content"))
    out = page.join(kt, key, "left").join(kc, key, "left")
    return (out.withColumn("s_title", F.coalesce("s_title", F.lit("-")))
               .withColumn("s_content", F.coalesce("s_content", F.lit("-"))))


def token_count(lines: DataFrame, col: str = "value", sep: str = "\t") -> DataFrame:
    """Occurrences of every field over all lines (A3): ``(token, count)``."""
    toks = lines.select(F.explode(split_all(col, sep)).alias("token"))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def term_doc_count(df: DataFrame, key: str, title: str, terms: str, sep: str = ",", keep_title: bool = True) -> DataFrame:
    """Term frequency per document (A4): ``(key, title, term, tf)``;
    a document without terms gives one row ``("-", 0)``.

    ``keep_title=False`` leaves the title out of the result.  The same documents are
    told apart, by the title's SHA-256: a title may be a whole text, which would be
    copied and hashed with every term.
    """
    if not keep_title:
        df, title = df.select(key, F.unhex(F.sha2(title, 256)).alias("_title"), terms), "_title"
    docs = spread(df.select(key, title, terms), key, title)
    ex = docs.select(key, title, F.explode_outer(F.when(F.col(terms).isNotNull(), split_all(terms, sep)))
                     .alias("term"))
    counted = ex.groupBy(key, title, "term").agg(F.count("term").alias("tf"))
    return counted.select(*([key, title] if keep_title else [key]), F.coalesce("term", F.lit("-")).alias("term"),
                          F.col("tf").cast("long"))


def term_total_count(tf: DataFrame, term: str = "term", count: str = "tf") -> DataFrame:
    """Corpus total per term (A5)."""
    return tf.groupBy(term).agg(F.sum(count).cast("long").alias("count"))


def term_share(tf: DataFrame, total: DataFrame, key: str, term: str = "term") -> DataFrame:
    """Per document term: its count, the corpus total and the share.

    A term whose total is 0 (the ``-`` of documents without terms) has the share NaN.
    A task's part of the totals is a hash table; the rows of ``tf`` are not sorted.
    """
    j = tf.join(materialize(total, "lookup").hint("shuffle_hash"), term)
    share = F.when(F.col("count") == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.col("tf"), F.col("count")))
    return j.select(key, term, "tf", F.col("count").alias("total"), rounded(share, DIGITS).alias("share"))


# ---------------------------------------------------------------- stop words

def english_stopwords() -> list[str]:
    """Spark's built-in English stop-word list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def remove_stopwords(df: DataFrame, col: str, out: str, words: list[str] | None = None,
                     case_sensitive: bool = False, locale: str = "en") -> DataFrame:
    """Drop stop words from a token array with MLlib's transformer.

    ``words`` defaults to the built-in English list; the list travels inside
    the transformer, so it must be small (a dictionary, not a table).
    """
    # the locale is pinned so case folding does not depend on the JVM default
    remover = StopWordsRemover(inputCol=col, outputCol=out, caseSensitive=case_sensitive, locale=locale,
                               stopWords=words if words is not None else english_stopwords())
    return remover.transform(df)


def remove_stopwords_table(df: DataFrame, key: str, col: str, out: str, stop: DataFrame,
                           word: str = "word") -> DataFrame:
    """Stop-word removal against a *table* of words (X5, large lists).

    Tokens are exploded with their position, removed by a left-anti join on
    the lower-cased word (AQE broadcasts the list when it is small), and
    re-collected in their original order per row.  ``key`` must identify the
    row.  Rows whose tokens are all removed keep an empty array.
    """
    stop_l = materialize(stop.select(F.lower(F.col(word)).alias("_sw")).distinct(), "stopwords")
    ex = explode_values(df, key, col, "_tok", pos="_pos").withColumn("_sw", F.lower(F.col("_tok")))
    kept = ex.join(stop_l, "_sw", "left_anti")
    regrouped = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_tok"))).alias("_s"))
    back = regrouped.select(key, F.transform("_s", lambda s: s["_tok"]).alias(out))
    res = df.join(back, key, "left")
    return res.withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>")))


# ------------------------------------------------------------- token lists

TOKEN_LINE_FIELDS = 4


def _token_lines(lines: DataFrame, col: str, s_term) -> tuple[DataFrame, DataFrame]:
    """Token rows of lines with at most four fields, and the wider lines as they are."""
    f = split_limited(col, "\t", TOKEN_LINE_FIELDS + 1)
    n = F.size(f)
    wide = F.coalesce(n > TOKEN_LINE_FIELDS, F.lit(False))
    field = lambda i: F.get(f, F.lit(i))
    urlid = F.when(n >= 2, field(0)).otherwise(F.col(col))
    title = F.when(n >= 2, field(1)).otherwise(F.lit("-"))
    good = lines.where(~wide).select(urlid.alias("urlid"), title.alias("title"), s_term(n, field).alias("s_term"))
    return good, lines.where(wide)


def combine_tokens(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``urlid \\t title \\t s_title \\t s_content`` lines -> ``(urlid, title, s_term)``.

    4 fields: title tokens followed by content tokens; 3 fields: title tokens;
    2 fields: the title as the only token; 1 field: whole line as id, title
    ``"-"``, no tokens.  Lines with more fields are returned whole on the
    second side (quarantine).
    """
    return _token_lines(lines, col, lambda n, field: (
        F.when(n >= 4, split_all(F.concat(field(2), F.lit(","), field(3)), ","))
         .when(n == 3, split_all(field(2), ","))
         .when(n == 2, F.array(field(1)))
         .otherwise(F.array().cast("array<string>"))))


def title_tokens(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Title-only variant of ``combine_tokens`` (T13); wider lines on the second side."""
    return _token_lines(lines, col, lambda n, field: (
        F.when(n >= 3, split_all(field(2), ","))
         .when(n == 2, F.array(field(1)))
         .otherwise(F.array().cast("array<string>"))))


def tokens_from_text(df: DataFrame, key: str, title: str, terms: str, sep: str = ",") -> DataFrame:
    """``(urlid, title, s_term_filtered text)`` -> token array; null -> ``[]`` and title ``"-"``."""
    return df.select(
        key,
        F.when(F.col(terms).isNull(), F.lit("-")).otherwise(F.col(title)).alias(title),
        text_to_tokens(terms, sep).alias("s_term"),
    )

