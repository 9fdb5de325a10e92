"""Segmentation, drifting JSON, leave-one-out features and pruned recommendations."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlab.operators import recommend as R
from feedlab.operators import segment as S
from feedlab.sources import drift as D


# --- segmentation -------------------------------------------------------------

def brute_lexicon(counts, longest=S.MAX_WORD, min_count=3, min_pmi=S.MIN_PMI, min_entropy=S.MIN_ENTROPY):
    grams = Counter()
    for run, n in counts.items():
        for i in range(len(run)):
            for k in range(1, longest + 2):
                if i + k <= len(run):
                    grams[run[i:i + k]] += n
    total = sum(c for g, c in grams.items() if len(g) == 1)

    def entropy(part):
        xs = [c for g, c in grams.items() if len(g) == len(part[0]) + 1 and (g[:-1] if part[1] else g[1:]) == part[0]]
        return math.log(sum(xs)) - sum(x * math.log(x) for x in xs) / sum(xs) if xs else 0.0
    words = {g: c for g, c in grams.items() if len(g) == 1}
    for g, c in grams.items():
        if 2 <= len(g) <= longest and c >= min_count:
            pmi = min(math.log(c * total / (grams[g[:k]] * grams[g[k:]])) for k in range(1, len(g)))
            if round(pmi, 6) >= min_pmi and round(min(entropy((g, 1)), entropy((g, 0))), 6) >= min_entropy:
                words[g] = c
    mass = sum(words.values())
    return {g: round(math.log(c / mass), 6) for g, c in words.items()}


def brute_path(run, logp, longest=S.MAX_WORD):
    best, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        top = (-math.inf, 0)
        for k in range(min(longest, end), 0, -1):
            if run[end - k:end] in logp and best[end - k] + logp[run[end - k:end]] > top[0]:
                top = (best[end - k] + logp[run[end - k:end]], k)
        best.append(top[0])
        back.append(top[1])
    out, at = [], len(run)
    while at:
        out.insert(0, run[at - back[at]:at])
        at -= back[at]
    return out


def han_texts(n=300, seed=0):
    rng = random.Random(seed)
    words = ["中国", "北京", "大学", "学生", "人工智能", "的", "了", "是", "电脑", "天气", "好"]
    texts = ["".join(rng.choices(words, k=rng.randint(1, 12))) + rng.choice(["。", ",abc ", "!", ""]) +
             "".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(n)]
    return texts + [None, "", "abc", "中", texts[0], texts[0], "好" * 300]


def test_lexicon_and_path_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(han_texts())), "id long, text string").select(
        "id", S.unspaced_runs("text").alias("runs"))
    counted = S.run_counts(df)
    lex = S.lexicon(counted, min_count=3)
    counts = {r.run: r.n for r in counted.collect()}
    want = brute_lexicon(counts)
    assert {r.term: r.logp for r in lex.collect()} == pytest.approx(want, abs=2e-6)
    assert {"中国", "北京", "人工智能"} <= set(want)
    got = {r.run: r.terms for r in S.segment(counted, lex).collect()}
    assert set(got) == set(counts)
    assert got == {run: brute_path(run, {r.term: r.logp for r in lex.collect()}) for run in counts}
    rows = S.tokenize_runs(df, "id", "runs", S.segment(counted, lex)).orderBy("id", "position").collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.id, []).append(r.term)
    assert all("".join(by_id.get(r.id, [])) == "".join(r.runs) for r in df.collect())


def test_runs_are_cut_where_they_lie_and_large_lexicons_are_joined(spark, monkeypatch):
    runs = [(r,) for t in han_texts(40) if t for r in [t, t[::-1]]] + [("𝄞é中国a",), ("好" * 600,), ("中国北京" * 150,)]
    counted = S.run_counts(spark.createDataFrame([([r for (r,) in runs],)], "runs array<string>")).localCheckpoint()
    lex = S.lexicon(counted, min_count=2, min_entropy=0.1).localCheckpoint()
    by_table = S.segment(counted, lex)
    assert "Exchange" not in by_table._jdf.queryExecution().executedPlan().toString()
    got = {r.run: r.terms for r in by_table.collect()}
    logp = {r.term: r.logp for r in lex.collect()}
    assert got == {r.run: brute_path(r.run, logp) for r in counted.collect()}
    # words looked up by search, a few characters at once
    monkeypatch.setattr(S, "_DENSE", 0)
    monkeypatch.setattr(S, "_CUT_CHARS", 50)
    assert {r.run: r.terms for r in S.segment(counted, lex).collect()} == got
    monkeypatch.setattr(S, "TABLE_WORDS", 3)
    joined = S.segment(counted, lex)
    assert "Exchange" in joined._jdf.queryExecution().executedPlan().toString()
    assert {r.run: r.terms for r in joined.collect()} == got


@pytest.mark.parametrize("longest", [1, 2, 5])
def test_one_piece_a_character_is_counted(spark, longest):
    rng = random.Random(1)
    runs = {"".join(rng.choices("abcé中", k=n)): rng.randint(1, 9) for n in (1, 2, 4, 5, 6, 255, 256, 257, 600)}
    counted = spark.createDataFrame(list(runs.items()), "run string, n long").coalesce(1)
    want = Counter()
    for run, n in runs.items():
        for i in range(len(run)):
            for k in range(1, min(longest, len(run) - i) + 1):
                want[run[i:i + k]] += n
    assert {r.gram: r["count"] for r in S.ngrams(counted, longest).collect()} == dict(want)
    seen = spark.sparkContext.accumulator(0)
    starts = S._starts(counted, longest, "n")
    starts.foreach(lambda r: seen.add(1))
    assert seen.value == sum(map(len, runs))


def test_segmentation_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "latin only")], "id long, text string").select(
        "id", S.unspaced_runs("text").alias("runs"))
    counted = S.run_counts(df)
    lex = S.lexicon(counted)
    assert lex.collect() == [] and S.segment(counted, lex).collect() == []


# --- drifting JSON --------------------------------------------------------------

def test_schema_of_drifting_lines(spark):
    lines = ['{"a": 1, "b": "x", "n": {"q": 1.5}, "odd name": [1, 2], "always null": null}', '{"a": "s", "n": {"q": 2e3}}',
             '{"a": 2, "z": true, "a.b": "dot"}', '{"a": 2.5}', "{broken", "[1, 2]", "7", "", '{"a": {"deep": 1}}', "{}",
             '{"a": 3, "it\'s": 1}', '{"a": 4}']
    table, bad = D.read_json_inferred(spark, None, spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1))
    assert dict(table.dtypes) == {"a": "bigint", "a.b": "string", "always null": "string", "b": "string", "it's": "bigint",
                                  "n": "struct<q:double>", "odd name": "array<bigint>", "z": "boolean"}
    assert [r.a for r in table.collect()] == [1, None, 2, None, None, None, 3, 4]
    assert [r["n"].q for r in table.collect()[:2]] == [1.5, 2000.0] and table.first()["odd name"] == [1, 2]
    assert table.collect()[6]["it's"] == 1 and table.collect()[2]["a.b"] == "dot"
    got = sorted(((r.field, r.found, r.type) for r in bad.collect()), key=str)
    assert got == sorted([(None, None, None)] * 3 + [("a", "s", "STRING"), ("a", "2.5", "DECIMAL(2,1)"),
                                                     ("a", '{"deep":1}', "OBJECT<deep: BIGINT>")], key=str)


def test_schema_of_no_lines(spark):
    table, bad = D.read_json_inferred(spark, None, spark.createDataFrame([], "value string"))
    assert table.columns == [] and bad.collect() == []


# --- leave-one-out features ------------------------------------------------------

def test_loo_top_list_takes_up_terms_from_below(spark):
    """With a list of two, removing a page lets the third term in, and a term that
    only the removed row brought is gone."""
    from feedlab.operators.features import train_feature_loo
    log = spark.createDataFrame([("u", 1, 1), ("u", 2, 1), ("u", 2, 1), ("u", 3, 0), ("v", 1, 1), (None, 1, 0), ("w", 9, 1)],
                                "uid string, urlid long, label int")
    vec = spark.createDataFrame([(1, "a", 5.0), (1, "b", 1.0), (2, "b", 2.0), (2, "c", 1.5), (3, "a", 1.0), (3, "d", 4.0)],
                                "urlid long, term string, weight double")
    attrs = spark.createDataFrame([(1, 10, 1.0, 0.0), (2, 20, 0.0, 0.0)], "urlid long, pnum int, pdef double, pbeau double")
    rows = [tuple(r) for r in log.collect()]
    pages = {}
    for u, t, w in (tuple(r) for r in vec.collect()):
        pages.setdefault(u, {})[t] = w
    want = []
    for at, (uid, url, label) in enumerate(rows):
        rest = [r for i, r in enumerate(rows) if i != at]
        same = [r for r in rest if r[1] == url]
        prof = {}
        for u, x, y in rest:
            if u == uid and uid is not None:
                for t, w in pages.get(x, {}).items():
                    prof[t] = prof.get(t, 0.0) + (w if y else -w)
        top = dict(sorted(prof.items(), key=lambda e: (-round(e[1], 6), e[0]))[:2])
        dot = sum(w * top.get(t, 0.0) for t, w in pages.get(url, {}).items()) * (1 if label else -1)
        clicks, shows = sum(r[2] for r in same), len(same)
        want.append((uid, label, clicks, shows, clicks / shows if shows else None, round(dot, 6) + 0.0))
    got = [(r.uid, r.label, r.sumclick, r.sumshow, r.ctr, r.s_term_score) for r in
           train_feature_loo(log, attrs, vec, top_n=2).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


# --- recommendations ---------------------------------------------------------------

def factors(spark, n, rank, seed, spread):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, rank)) * np.exp(spread * rng.standard_normal((n, 1)))
    return x, spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "id long, features array<double>")


def test_pruned_recommendations_equal_all_pairs(spark):
    u, users = factors(spark, 300, 8, 0, 0.3)
    i, items = factors(spark, 2000, 8, 1, 1.0)
    best, tiles = R.best_items(users, items, 10, range_bytes=20_000, tile=64)
    rows = best.collect()
    scores = u @ i.T
    for r in rows:
        order = np.lexsort((np.arange(2000), -scores[r.user]))[:10]
        assert r["items"] == order.tolist() and r.scores == pytest.approx(scores[r.user][order])
    share = sum(r.compared for r in rows) / (tiles * len(rows))
    assert len(rows) == 300 and share < 0.4               # the rest was pruned


def test_pruned_recommendations_edges(spark):
    _, users = factors(spark, 3, 2, 0, 0)
    few = spark.createDataFrame([(7, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [9.0, 9.0]), (8, None), (9, [None, 1.0])],
                                "id long, features array<double>")
    rows = R.best_items(users.limit(1), few, 10)[0].collect()
    assert [sorted(r["items"]) for r in rows] == [[5, 7]] and rows[0]["items"] == [5, 7]     # ties by id
    assert [r["items"] for r in R.best_items(users, few.limit(0), 10)[0].collect()] == [[]] * 3
    assert R.recommend_pruned(users.limit(0), few, 10).collect() == []


def test_pruned_recommendations_equal_the_library(spark):
    from feedlab.operators.models import recommend_items
    from pyspark.ml.recommendation import ALS
    rng = random.Random(0)
    data = spark.createDataFrame([(rng.randrange(60), rng.randrange(200), float(rng.randrange(5))) for _ in range(3000)],
                                 "uid int, urlid int, label double")
    model = ALS(userCol="uid", itemCol="urlid", ratingCol="label", rank=6, maxIter=3, seed=1).fit(data)
    want = {(r.uid, r.urlid): r.rating for r in recommend_items(model, 10).collect()}
    got = {(r.uid, r.urlid): r.rating for r in R.recommend_pruned(model.userFactors, model.itemFactors, 10).collect()}
    assert got.keys() == want.keys() and got == pytest.approx(want, abs=1e-4)


def test_leave_one_out_sums_meet_the_pairs_once(spark, monkeypatch):
    from feedlab.operators import features
    written = []
    monkeypatch.setattr(features, "materialize", lambda df, name: written.append((name, df)) or df.localCheckpoint())
    rng = random.Random(5)
    log = [(rng.choice([1, 2, 3, None]), rng.randrange(6), rng.randrange(2)) for _ in range(60)]
    # many pages share a term, weights tie
    vec = {u: {f"t{t}": float(rng.randint(-2, 3)) for t in rng.sample(range(9), 4)} for u in range(5)}
    pages = spark.createDataFrame([(u, u, 0.5, 0.0) for u in range(5)], "urlid long, pnum int, pdef double, pbeau double")
    rows = spark.createDataFrame([(u, t, w) for u, ts in vec.items() for t, w in ts.items()],
                                 "urlid long, term string, weight double")
    got = features.train_feature_loo(spark.createDataFrame(log, "uid long, urlid long, label int"), pages, rows, top_n=3)
    want = []
    for i, (uid, url, label) in enumerate(log):
        profile = {}
        for j, (u, v, y) in enumerate(log):
            if j != i and uid is not None and u == uid:
                for t, w in vec.get(v, {}).items():
                    profile[t] = profile.get(t, 0.0) + (w if y else -w)
        top = dict(sorted(profile.items(), key=lambda x: (-x[1], x[0]))[:3])
        dot = sum(w * top.get(t, 0.0) for t, w in vec.get(url, {}).items())
        want.append((uid, label, (dot if label else -dot) + 0.0))
    assert Counter(got.select("uid", "label", "s_term_score").collect()) == Counter(want)
    # the sums are not written beside the rows and joined back
    assert [n for n, df in written if {"uid", "term"} <= set(df.columns)] == ["pair_terms"]
