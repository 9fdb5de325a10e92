"""Term vectors, profiles, scores and the feature table (FIXTURES.md §4)."""

import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from feedlab.functions.terms import parse_terms, tag_terms
from feedlab.operators.features import expand_counts, train_feature
from feedlab.operators.stats import ctr_by_key, join_page
from feedlab.operators.terms import (explode_terms, merge_terms, merge_terms_topn, page_vector_from_text,
                                     term_score, terms_to_text, user_profile)


def as_dict(rows, k="term", v="weight"):
    return {r[k]: r[v] for r in rows}


def test_parse_terms_skips_bad_items_and_sums(spark):
    df = spark.createDataFrame([(1, "a:1.5,b:2,a:1,bad,x:y:z")], "urlid long, s string")
    out = merge_terms(explode_terms(df, "urlid", parse_terms("s")), "urlid")
    assert as_dict(out.collect()) == {"a": 2.5, "b": 2.0}


def test_points_and_tags(spark):
    df = spark.createDataFrame([(1, "-", "a:1;b:2", "a,a,c")], "urlid long, s_title string, ppoint string, tpoint string")
    out = page_vector_from_text(df, "urlid", "s_title", "ppoint", "tpoint")
    assert as_dict(out.collect()) == {"a": 3.0, "b": 2.0, "c": 1.0}


def test_null_and_dash_give_no_terms(spark):
    df = spark.createDataFrame([(1, None, "-"), (2, "", None)], "urlid long, s string, t string")
    parts = F.concat(parse_terms("s"), tag_terms("t"))
    assert explode_terms(df, "urlid", parts).count() == 0


def test_profile_weights_cancel(spark):
    log = spark.createDataFrame([(1, 10, 1), (1, 10, 0)], "uid long, urlid long, label int")
    pv = spark.createDataFrame([(10, "a", 2.0), (10, "b", 0.5)], "urlid long, term string, weight double")
    prof = user_profile(log, pv)
    assert as_dict(prof.collect()) == {"a": 0.0, "b": 0.0}


def test_topn_exactly_21_sorted_with_term_tiebreak(spark):
    rows = [(1, f"t{i:02d}", float(i)) for i in range(30)]
    rows += [(1, "zz", 9.0), (1, "aa", 9.0)]            # ties at the cut
    df = spark.createDataFrame(rows, "uid long, term string, weight double")
    top = merge_terms_topn(df, "uid", n=21, rank_col="rank").orderBy("rank").collect()
    assert len(top) == 21
    ws = [r.weight for r in top]
    assert ws == sorted(ws, reverse=True)
    # weights 29..10 fill 20 slots; three terms share 9.0 and "aa" wins the last one
    assert top[-1].term == "aa"


def test_term_score_dot_product(spark):
    rows = spark.createDataFrame([(1, 10, 1), (1, 10, 0), (2, 10, 1), (1, 11, 1)],
                                 "uid long, urlid long, label int")
    pv = spark.createDataFrame([(10, "a", 3.0), (10, "b", 1.0), (10, "z", 9.0)], "urlid long, term string, weight double")
    prof = spark.createDataFrame([(1, "a", 2.0), (1, "b", -1.0)], "uid long, term string, weight double")
    got = sorted((r.uid, r.urlid, r.label, r.s_term_score) for r in term_score(rows, pv, prof).collect())
    # user 1 / page 10: +5 when clicked, -5 when not; user 2 has no profile, page 11 no terms
    assert got == [(1, 10, 0, -5.0), (1, 10, 1, 5.0), (1, 11, 1, 0.0), (2, 10, 1, 0.0)]


def test_ctr(spark):
    df = spark.createDataFrame([(7, 1), (7, 0), (7, 0)], "urlid long, label int")
    r = ctr_by_key(df).collect()[0]
    assert (r.sumclick, r.sumshow) == (1, 3) and math.isclose(r.ctr, 1 / 3)


def test_left_join_keeps_missing_and_fans_out(spark):
    log = spark.createDataFrame([(1, 10), (2, 20)], "uid long, urlid long")
    page = spark.createDataFrame([(10, "x"), (10, "y")], "urlid long, title string")
    got = sorted((r.uid, r.title) for r in join_page(log, page).collect())
    assert got == [(1, "x"), (1, "y"), (2, None)]
    for limit in (1 << 20, 3):              # broadcast, and too large for it
        j = join_page(log, page, broadcast_max_bytes=limit)
        assert sorted((r.uid, r.title) for r in j.collect()) == got


def test_row_bytes_counts_texts(spark):
    from feedlab.operators.stats import row_bytes
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "urlid long, title string")
    assert row_bytes(df) == 2 * 16 + 1000 and row_bytes(df.limit(0)) == 0


def test_topn_scores_equal_row_scores(spark):
    import random
    from feedlab.operators.terms import pair_scores, pair_scores_topn
    rng = random.Random(4)
    pairs = spark.createDataFrame([(u, i) for u in range(8) for i in range(6)], "uid long, urlid long")
    page = spark.createDataFrame([(i, f"t{t}", rng.random()) for i in range(5) for t in rng.sample(range(12), 6)],
                                 "urlid long, term string, weight double")
    prof = spark.createDataFrame([(u, f"t{t}", rng.random() - 0.5) for u in range(7) for t in rng.sample(range(12), 5)],
                                 "uid long, term string, weight double")
    get = lambda f: {(r.uid, r.urlid): round(r.dot, 9) for r in f(pairs, page, prof).collect() if abs(r.dot) > 1e-12}
    assert get(pair_scores) == get(pair_scores_topn)


def test_terms_to_text_sorted(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", -0.5)], "k long, term string, weight double")
    assert terms_to_text(df, "k").collect()[0].s_term == "a:-0.500000,b:2.000000"


def test_expand_counts_restores_multiplicity(spark):
    df = spark.createDataFrame([("hot", 25_003), ("cold", 2)], "k string, cnt long")
    out = expand_counts(df, "cnt", chunk=1000)
    got = dict(out.groupBy("k").count().collect())
    assert got == {"hot": 25_003, "cold": 2}
    assert set(out.columns) == {"k"}


def brute_force_features(log, attrs, pv, top_n=21):
    """Per-impression brute-force computation in plain Python."""
    vec = defaultdict(dict)
    for u, t, w in pv:
        vec[u][t] = vec[u].get(t, 0.0) + w
    stats = defaultdict(lambda: [0, 0])
    for uid, url, lab in log:
        stats[url][0] += lab
        stats[url][1] += 1
    prof = defaultdict(lambda: defaultdict(float))
    for uid, url, lab in log:
        if uid is None:
            continue
        for t, w in vec.get(url, {}).items():
            prof[uid][t] += w if lab != 0 else -w
    top = {}
    for uid, d in prof.items():
        items = sorted(((round(w, 6), t) for t, w in d.items()), key=lambda x: (-x[0], x[1]))[:top_n]
        top[uid] = {t: w for w, t in items}
    out = []
    for uid, url, lab in log:
        s = sum(w * top.get(uid, {}).get(t, 0.0) for t, w in vec.get(url, {}).items())
        s = s if lab != 0 else -s
        a = attrs.get(url, (-1, -1.0, -1.0))
        c, n = stats[url]
        out.append((uid, lab, c, n, c / n, a[0], a[1], a[2], round(s, 6) + 0.0))
    return out


def test_train_feature_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    log = [(rnd.randrange(6), rnd.randrange(8), rnd.randrange(2)) for _ in range(400)]
    log += [(0, 0, 1)] * 50                         # a hot group
    attrs = {u: (u * 10, float(u % 2), 0.5) for u in range(6)}   # urls 6, 7 have no page
    pv = [(u, f"t{rnd.randrange(30)}", round(rnd.uniform(-1, 3), 3)) for u in range(6) for _ in range(25)]
    ldf = spark.createDataFrame(log, "uid long, urlid long, label int")
    adf = spark.createDataFrame([(u, *a) for u, a in attrs.items()], "urlid long, pnum int, pdef double, pbeau double")
    pdf = merge_terms(spark.createDataFrame(pv, "urlid long, term string, weight double"), "urlid")
    got = train_feature(ldf, adf, pdf).select("uid", "label", "sumclick", "sumshow", "ctr", "pnum", "pdef",
                                              "pbeau", "s_term_score").collect()
    pv_rounded = [(r.urlid, r.term, r.weight) for r in pdf.collect()]
    exp = brute_force_features(log, attrs, pv_rounded)
    norm = lambda rows: Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    assert norm(tuple(r) for r in got) == norm(exp)


def test_terms_are_dealt_to_tasks_by_the_inputs_bytes(spark, tmp_path, monkeypatch):
    """The aggregates over exploded terms get more tasks as their inputs grow."""
    import os
    from feedlab import session
    from feedlab.operators import terms as T, text as X

    def tasks(df):
        return df.rdd.getNumPartitions()

    def tables(copies):
        log = spark.range(copies * 4000).selectExpr("id % 97 as uid", "id % 50 as urlid", "cast(id % 2 as int) as label")
        docs = spark.range(copies * 4000).selectExpr("id as urlid", "concat('t', id) as title", "repeat('a,b,a,', 5) as terms")
        out = []
        for name, df in (("log", log), ("docs", docs)):
            path = f"{tmp_path}/{name}{copies}"
            df.coalesce(1).write.parquet(path)
            out.append(spark.read.parquet(path))
        return out
    pages = spark.createDataFrame([(i, f"t{i % 7}", 1.0) for i in range(50)], "urlid long, term string, weight double")
    small, large = tables(1), tables(30)
    stored = sum(os.path.getsize(f.removeprefix("file:")) for f in large[1].inputFiles())
    assert session.input_bytes(large[1]) == stored and session.input_bytes(pages) == 0
    monkeypatch.setattr(session.spread, "__kwdefaults__", {"bytes_a_task": stored // 40})
    for make in (lambda log, docs: X.term_doc_count(docs, "urlid", "title", "terms"),
                 lambda log, docs: X.term_frequencies(session.spread(docs, "urlid").selectExpr("urlid", "split(terms, ',') as t"), "urlid", "t")):
        assert tasks(make(*small)) < 40 <= tasks(make(*large))
    monkeypatch.setattr(session.spread, "__kwdefaults__", {"bytes_a_task": session.input_bytes(large[0]) // 40})
    assert tasks(T.user_profile(small[0], pages)) < 40 <= tasks(T.user_profile(large[0], pages))
    got = {(r.uid, r.term): r.weight for r in T.user_profile(small[0], pages).collect()}
    want = {}
    for i in range(4000):
        key = (i % 97, f"t{i % 50 % 7}")
        want[key] = want.get(key, 0.0) + (1 if i % 2 else -1)
    assert got == want


def test_profile_cuts_and_pair_scores_are_dealt_by_the_bytes_of_the_log(spark, tmp_path, monkeypatch):
    """What follows a profile's aggregate held a fixed number of tasks, whatever the log."""
    from pyspark.sql import functions as F
    from feedlab import session
    from feedlab.operators import features, terms as T

    def tasks(df):
        return df.rdd.getNumPartitions()

    logs = []
    for copies in (1, 30):
        path = f"{tmp_path}/log{copies}"
        spark.range(copies * 4000).selectExpr("id % 97 as uid", "id % 50 as urlid", "cast(id % 3 as int) as label",
                                              "id as event_id").coalesce(1).write.parquet(path)
        logs.append(spark.read.parquet(path))
    small, large = logs
    pages = spark.createDataFrame([(i, f"t{(i * 5 + j) % 11}", 1.0 + j) for i in range(50) for j in range(3)],
                                  "urlid long, term string, weight double")
    attrs = spark.createDataFrame([(i, i, 1.0, 0.0) for i in range(50)], "urlid long, pnum int, pdef double, pbeau double")
    for f in (session.spread, session.spread_like):
        monkeypatch.setattr(f, "__kwdefaults__", {"bytes_a_task": session.input_bytes(large) // 40})
    profiles = [T.user_profile_topn(log, pages, n=2) for log in logs]
    assert tasks(profiles[0]) < 40 <= tasks(profiles[1])
    assert tasks(T.clicked_profile(small, pages)) < 40 <= tasks(T.clicked_profile(large, pages))
    pairs = large.select("uid", "urlid").distinct()
    assert tasks(T.map_scores(pairs, T.page_maps(pages), profiles[1])) >= 40
    # a reduced copy of the log counts as the log
    few = spark.createDataFrame([(1, 2)], "uid long, urlid long")
    assert tasks(session.spread(few, "uid")) < 40 <= tasks(session.spread_like(large, few, "uid"))
    seen = []
    monkeypatch.setattr(features, "spread_like", lambda log, df, *k: (seen.append((session.input_bytes(log), k)),
                                                                     session.spread_like(log, df, *k))[1])
    groups = features.feature_groups(large, attrs, pages, 2)
    assert seen == [(session.input_bytes(large), ("uid", "term")), (session.input_bytes(large), ("uid",))]
    assert groups.agg(F.sum("cnt")).first()[0] == large.count()

    # the results are those of plain joins
    page, prof = {}, {}
    for r in pages.collect():
        page.setdefault(r.urlid, {})[r.term] = r.weight
    for r in small.collect():
        for term, w in page[r.urlid].items():
            prof[r.uid, term] = prof.get((r.uid, term), 0.0) + (w if r.label else -w)
    cut = {}
    for (u, term), w in sorted(prof.items(), key=lambda x: (x[0][0], -x[1], x[0][1])):
        if len(cut.setdefault(u, {})) < 2:
            cut[u][term] = w
    dot = {(u, i): sum(w * page[i].get(t, 0.0) for t, w in cut[u].items()) for u in cut for i in page}
    got = T.term_score(small, pages, profiles[0], topn_profile=True).collect()
    assert len(got) == small.count()
    assert all(r.s_term_score == (dot[r.uid, r.urlid] if r.label else -dot[r.uid, r.urlid]) for r in got)
    plain = T.term_score(small, pages, profiles[0]).collect()
    assert sorted((r.event_id, r.s_term_score) for r in plain) == sorted((r.event_id, r.s_term_score) for r in got)
