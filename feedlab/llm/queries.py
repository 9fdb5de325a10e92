"""The ``op<N>_<name>`` queries: each applies its operator, with production
parameters, to its whole table.  ``ORACLES`` holds DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlab.llm import quality_ledger
from feedlab.llm.common import read_table
from feedlab.llm.weak_quality import score_quality
from feedlab.session import scratch_path
from feedlab.llm.exact_dedup import exact_dedup
from feedlab.llm.html_style_tree import extract_main_text
from feedlab.llm.lexical_search import search
from feedlab.llm.lsh_search import nearest_neighbours
from feedlab.llm.packing import pack_documents
from feedlab.llm.pii import replace_pii
from feedlab.llm.prefix_trie import prefix_trie
from feedlab.llm.sentencepiece_stream import encode_pieces
from feedlab.llm.simhash import near_duplicates
from feedlab.llm.substring_dedup import substring_dedup
from feedlab.llm.token_files import token_index, write_token_files

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# SQL for the word rule and for the text without white space.
_CLASS = r"[\x20\x09-\x0D]"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op(name: str, sql: str | None = None):
    def enter(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return enter


@op("op1_exact_dedup", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '{_CLASS}+', '', 'g') AS c
           FROM documents),
r AS (SELECT doc_id, c, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY c) AS group_size,
             row_number() OVER w AS rn
      FROM d WINDOW w AS (PARTITION BY c ORDER BY length(t) DESC, doc_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(c) AS text_sha256 FROM r
""")
def op1(spark, sf_dir):
    return exact_dedup(read_table(spark, sf_dir, "documents"))


@op("op2_sentencepiece")
def op2(spark, sf_dir):
    return encode_pieces(read_table(spark, sf_dir, "documents"), decoded_sha256=True)


@op("op3_packing")
def op3(spark, sf_dir):
    return pack_documents(read_table(spark, sf_dir, "documents"))


_KEPT_SQL = "NOT (" + " OR ".join(f"({r.failed})" for r in quality_ledger.RULES
                                  if quality_ledger.POLICIES[quality_ledger.DEFAULT_POLICY] >> r.bit & 1) + ")"

QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, {_KEPT_SQL} AS kept
FROM m
"""


@op("op7_quality_rules", QUALITY_SQL)
def op7(spark, sf_dir):
    led = quality_ledger.ledger(read_table(spark, sf_dir, "documents"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~quality_ledger.passes(quality_ledger.BASE_MASK)).alias("base_failed"),
                      quality_ledger.passes(quality_ledger.DEFAULT_POLICY).alias("kept"))


@op("op8_simhash")
def op8(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def pii_key(spark) -> bytes:
    """The surrogates' key: the session's ``spark.feedlab.pii.key``.  Without one
    a fixed key is used, which is fit for tests only."""
    return spark.conf.get("spark.feedlab.pii.key", "feedlab-test-key").encode()


@op("op9_pii")
def op9(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_pii(docs, pii_key(spark))


@op("op10_token_files")
def op10(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path)
    return token_index(spark, path)


@op("op6_html_extraction")
def op6(spark, sf_dir):
    return extract_main_text(read_table(spark, sf_dir, "pages"))


@op("op4_quality_classifier")
def op4(spark, sf_dir):
    return score_quality(read_table(spark, sf_dir, "documents"))


SUBSTRING_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM g) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM r),
g2 AS (SELECT doc_id, list(p) AS ps, count(*) AS n_removed FROM gone GROUP BY doc_id),
k AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, w,
             coalesce(ps, []) AS ps FROM d LEFT JOIN g2 USING (doc_id)),
u AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM k)),
t AS (SELECT u.doc_id, string_agg(x, ' ' ORDER BY u.i) AS s
      FROM u LEFT JOIN gone ON u.doc_id = gone.doc_id AND u.i = gone.p WHERE gone.p IS NULL GROUP BY u.doc_id)
SELECT k.doc_id, n_words, n_removed, sha256(coalesce(t.s, '')) AS kept_sha256 FROM k LEFT JOIN t USING (doc_id)
"""


@op("op5_substring_dedup", SUBSTRING_SQL)
def op5(spark, sf_dir):
    return substring_dedup(read_table(spark, sf_dir, "documents"), with_text=False)


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEARCH_SQL = rf"""
WITH f AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}') AS ts,
                  row_number() OVER () AS r FROM documents),
g AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS terms FROM f WHERE len(ts) > 0),
t AS (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM f),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, g GROUP BY term),
q AS (SELECT row_number() OVER () AS i, item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}') AS ts FROM benchmark),
k AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(ts) AS term FROM q) GROUP BY ALL),
s AS (SELECT i, item_id, r, doc_id,
             CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
      FROM k JOIN w USING (term) JOIN p USING (term), g GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""


@op("op12_lexical_search", SEARCH_SQL)
def op12(spark, sf_dir):
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@op("op13_lsh_search")
def op13(spark, sf_dir):
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# crc32 of a conv_id's digits by a table of 256 remainders, eight shifts each.
_BIT = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
TRIE_SQL = rf"""
WITH RECURSIVE rem AS (SELECT i, 0 AS step, CAST(i AS BIGINT) AS c FROM range(256) t(i)
                       UNION ALL SELECT i, step + 1, {_BIT} FROM rem WHERE step < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM rem WHERE step = 8),
own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, turns,
                 CAST(xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                   list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                   lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 9 AS BIGINT) AS h
          FROM own, tab),
built AS (SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:h], a.turns[h + 1:]) AS turns
          FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
pre AS (SELECT conv_id, CAST(d AS BIGINT) AS depth, turns[1:d] AS p, turns[1:d - 1] AS up, len(turns) AS n
        FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)),
node AS (SELECT p, depth, min(conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs,
                CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(any_value(p)[depth].t)) END AS own,
                sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
         FROM pre GROUP BY p, depth),
kids AS (SELECT up AS p, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (p, depth)),
sub AS (SELECT a.conv_id, a.depth, CAST(sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
               CAST(sum(b.own) AS BIGINT) AS saved_tokens
        FROM full_node a JOIN full_node b ON b.depth >= a.depth AND b.p[1:a.depth] = a.p GROUP BY ALL)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM full_node f JOIN sub s ON s.conv_id = f.conv_id AND s.depth = f.depth
LEFT JOIN node u ON f.depth > 0 AND u.depth = f.depth - 1 AND u.p = f.up
"""


@op("op11_prefix_trie", TRIE_SQL)
def op11(spark, sf_dir):
    return prefix_trie(read_table(spark, sf_dir, "conversations"))
