"""Property tests: string operators against plain-Python models of their semantics.

Each hypothesis example is a batch of generated strings evaluated in one
Spark job, so the number of Spark jobs stays small.
"""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedlab.functions.strings import clean_field, split_limited
from feedlab.functions.terms import parse_terms, tag_terms
from feedlab.operators.terms import explode_terms, merge_terms

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

term_text = st.text(alphabet="abc12.-:,;", max_size=30)
batches = st.lists(term_text, min_size=1, max_size=40)


def py_float(v):
    try:
        return float(v)
    except ValueError:
        return None


def model_parse(s, item_sep, kv_sep):
    out = defaultdict(float)
    if s is None:
        return {}
    for item in s.split(item_sep):
        kv = item.split(kv_sep)
        if len(kv) != 2:
            continue
        w = py_float(kv[1])
        if w is None:
            continue
        out[kv[0]] += w
    return {k: round(v, 6) + 0.0 for k, v in out.items()}


@SETTINGS
@given(batches, st.sampled_from([(",", ":"), (";", ":")]))
def test_parse_terms_matches_model(spark, texts, seps):
    item_sep, kv_sep = seps
    df = spark.createDataFrame(list(enumerate(texts)), "k long, s string")
    rows = merge_terms(explode_terms(df, "k", parse_terms("s", item_sep, kv_sep)), "k").collect()
    got = defaultdict(dict)
    for r in rows:
        got[r.k][r.term] = r.weight
    for k, s in enumerate(texts):
        assert got.get(k, {}) == model_parse(s, item_sep, kv_sep), s


@SETTINGS
@given(batches)
def test_tag_terms_count_occurrences(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, s string")
    rows = merge_terms(explode_terms(df, "k", tag_terms("s")), "k").collect()
    got = defaultdict(dict)
    for r in rows:
        got[r.k][r.term] = r.weight
    for k, s in enumerate(texts):
        exp = defaultdict(float)
        if s != "-":
            for t in s.split(","):
                exp[t] += 1.0
        assert got.get(k, {}) == dict(exp), s


@SETTINGS
@given(st.lists(st.text(alphabet="ab,\t", max_size=20), min_size=1, max_size=40), st.integers(1, 5))
def test_split_limited_is_python_maxsplit(spark, texts, n):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(split_limited("s", "\t", n)).collect()]
    assert got == [t.split("\t", n - 1) for t in texts]


@SETTINGS
@given(st.lists(st.text(alphabet=" \t　\x1cxy", max_size=12), min_size=1, max_size=40))
def test_clean_field_is_python_strip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(clean_field("s")).collect()]
    assert got == [(t.strip() or "-") for t in texts]
