"""Trees as rows, profiles by batches, restarted jobs, hard-label areas and bucket search."""

import random
from collections import defaultdict

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from feedlab.operators import models as M
from feedlab.operators import rules as R
from feedlab.operators.evaluate import auc_roc, auc_roc_hard
from feedlab.operators.incremental import ProfileStore, profile_delta
from feedlab.operators.relational import range_buckets
from feedlab.operators.terms import user_profile_topn
from feedlab.plans import jobs
from feedlab.plans.stages import Stages
from feedlab.session import scratch_path
from test_jobs import _exports


# --- trees as rows --------------------------------------------------------------

@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        x = [float(rng.randint(0, 9)), rng.random(), rng.choice([0.0, 1.0, 2.0])]
        rows.append((x, float((x[0] > 4) ^ (x[1] > 0.6) or (x[2] == 1.0 and rng.random() < 0.8))))
    df = spark.createDataFrame(rows, "x array<double>, label double")
    return df.withColumn("features", array_to_vector("x")).cache()


@pytest.mark.parametrize("fit", [M.fit_tree, M.fit_forest, lambda d: M.fit_gbt(d, max_iter=4)])
def test_walk_predicts_as_the_model(spark, training, fit):
    model = fit(training)
    nodes = R.node_table(spark, model)
    got = R.score_nodes(model.transform(training).drop("rawPrediction", "probability"), nodes, R.model_kind(model),
                        R.tree_depth(model), "x", "walked")
    assert got.filter("walked <> prediction").count() == 0 and got.count() == 600
    assert got.select("walked").distinct().count() == 2


def test_categorical_splits_and_rules(spark, training):
    from pyspark.ml.feature import VectorIndexer
    indexed = VectorIndexer(inputCol="features", outputCol="coded", maxCategories=3).fit(training).transform(training)
    model = M.fit_tree(indexed, features="coded")
    nodes = R.node_table(spark, model)
    from pyspark.ml.functions import vector_to_array
    coded = indexed.withColumn("x", vector_to_array("coded"))
    walked = R.score_nodes(model.transform(coded), nodes, R.CLASSES, R.tree_depth(model), "x", "walked")
    assert nodes.filter("left_values is not null").count() > 0
    assert walked.filter("walked <> prediction").count() == 0
    rules = R.leaf_rules(nodes, ["a", "b", "c"], R.tree_depth(model)).collect()
    assert len(rules) == nodes.filter("feature < 0").count()
    assert abs(sum(r.share for r in rules) - 1) < 1e-9 and sum(r.rows for r in rules) == 600
    # the rules part the rows: each row fulfils one rule, whose prediction it gets
    def holds(rule, x):
        for cond in filter(None, rule.split(" and ")):
            name, op, rest = cond.split(" ", 2) if " not in " not in cond else (cond[0], "not in", cond.split("not in ")[1])
            v = x["abc".index(name)]
            listed = [float(s) for s in rest.strip("{}").split(", ")]
            if not {"<=": v <= listed[0], ">": v > listed[0], "in": v in listed, "not in": v not in listed}[op]:
                return False
        return True
    for row in walked.limit(200).collect():
        hits = [r for r in rules if holds(r.rule, row.x)]
        assert len(hits) == 1 and hits[0].prediction == row.prediction and hits[0].level == len(hits[0].rule.split(" and "))


def test_tree_of_one_leaf(spark, training):
    model = M.fit_tree(training.withColumn("label", F.lit(1.0)))
    nodes = R.node_table(spark, model)
    assert [(r.rule, r.level, r.share) for r in R.leaf_rules(nodes, ["a", "b", "c"], R.tree_depth(model)).collect()] == [("", 0, 1.0)]
    out = R.score_nodes(training, nodes, R.CLASSES, R.tree_depth(model), "x", "walked")
    assert out.filter("walked = 1").count() == 600
    assert R.score_nodes(training.limit(0), nodes, R.CLASSES, 0, "x", "walked").count() == 0


# --- profiles by batches ----------------------------------------------------------

def _log(spark, rows):
    return spark.createDataFrame(rows, "uid bigint, urlid bigint, label int")


def _rows(df):
    return sorted((r.uid, r.term, round(r.weight, 6)) for r in df.collect())


def test_batches_give_the_profile_of_one_pass(spark):
    rng = random.Random(5)
    # user 0 holds a third of all rows; a null user has no profile
    log = [(0 if rng.random() < 0.33 else rng.choice([None, 1, 2, 3, 4, 5]), rng.randint(0, 11), rng.randint(0, 1)) for _ in range(400)]
    pv = spark.createDataFrame([(u, f"t{t}", round(rng.random(), 6)) for u in range(10) for t in rng.sample(range(12), 5)],
                               "urlid bigint, term string, weight double")
    store = ProfileStore(spark, scratch_path(spark, "store"), top_n=4)
    assert store.profile().count() == 0 and store.batches() == 0
    touched = [store.merge(profile_delta(_log(spark, b), pv)) for b in (log[:150], [], log[150:390], [(5, 3, 1)], log[390:])]
    assert touched[1] == 0 and touched[3] == 1 and store.batches() == 5
    want = _rows(user_profile_topn(_log(spark, log + [(5, 3, 1)]), pv, n=4))
    assert _rows(store.profile()) == want
    # a batch that touches one user writes that user only
    assert {r.uid for r in spark.read.parquet(f"{store.path}/top/batch=3").collect()} == {5}
    small = store.compacted(scratch_path(spark, "compacted"))
    assert _rows(small.profile()) == want and small.batches() == 1
    full = {(r.uid, r.term): r.weight for r in small.sums().collect()}
    assert len(full) > len(want) and full.keys() >= {(u, t) for u, t, _ in want}


def test_a_batch_that_died_is_written_again(spark, monkeypatch):
    pv = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "urlid bigint, term string, weight double")
    store = ProfileStore(spark, scratch_path(spark, "store"))
    store.merge(profile_delta(_log(spark, [(1, 1, 1)]), pv))
    delta = profile_delta(_log(spark, [(1, 1, 1), (2, 1, 0)]), pv)
    cut = ProfileStore._cut
    monkeypatch.setattr(ProfileStore, "_cut", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.merge(delta)
    monkeypatch.setattr(ProfileStore, "_cut", cut)
    assert _rows(store.profile()) == [(1, "a", 1.0), (1, "b", 2.0)]
    store.merge(delta)
    assert _rows(store.profile()) == [(1, "a", 2.0), (1, "b", 4.0), (2, "a", -1.0), (2, "b", -2.0)]


# --- restarted jobs ---------------------------------------------------------------

def test_a_restarted_job_goes_on_after_its_last_stage(spark, monkeypatch):
    imp_path, page_path = _exports(spark)
    root, out = scratch_path(spark, "stages"), scratch_path(spark, "restart")
    first = Stages(spark, root)
    real = jobs.page_vector
    monkeypatch.setattr(jobs, "page_vector", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.feature_job(spark, imp_path, page_path, out, "parquet", stages=first)
    assert first.ran == ["pages", "title_keywords"]
    monkeypatch.setattr(jobs, "page_vector", real)
    again = Stages(spark, root)
    got = jobs.feature_job(spark, imp_path, page_path, out, "parquet", stages=again)
    assert again.reused == ["pages", "title_keywords"] and again.ran == ["page_vector", "impressions", "features"]
    plain = jobs.feature_job(spark, imp_path, page_path, scratch_path(spark, "plain"), "parquet")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    # a parameter of the last stage, then new impressions: only what depends on them
    other = Stages(spark, root)
    jobs.feature_job(spark, imp_path, page_path, out, "parquet", top_n=5, stages=other)
    assert other.ran == ["features"]
    spark.createDataFrame([("u:1\tp:2\t3\t1",)], "value string").write.mode("append").text(imp_path)
    more = Stages(spark, root)
    n = jobs.feature_job(spark, imp_path, page_path, out, "parquet", stages=more).count()
    assert more.ran == ["impressions", "features"] and n == plain.count() + 1


def test_stage_without_marker_is_written_anew_and_forgotten(spark):
    s = Stages(spark, scratch_path(spark, "stages"))
    one = s.run("numbers", lambda: spark.range(3), limit=3)
    p, fs = s._fs(f"{one.path}.done")
    fs.delete(p, False)
    one = s.run("numbers", lambda: spark.range(3), limit=3)
    assert one.df.count() == 3 and s.ran == ["numbers"] * 2
    two = s.run("doubled", lambda: one.df.selectExpr("id * 2 AS id"), [one])
    s.forget(keep=[two])
    assert not fs.exists(p) and s.run("doubled", lambda: None, [one]).df.count() == 3 and s.reused == ["doubled"]
    with pytest.raises(FileNotFoundError):
        s.run("missing", lambda: None, [one.path + "-nowhere"])


# --- areas and buckets --------------------------------------------------------------

def test_hard_label_area(spark):
    rows = [(random.Random(i).choice([0.0, 1.0, None]), i % 3 // 2) for i in range(200)]
    df = spark.createDataFrame(rows, "prediction double, label int")
    known = df.where("prediction is not null")
    assert abs(auc_roc_hard(df).first()[0] - auc_roc(known, "prediction").first()[0]) < 1e-12
    assert auc_roc_hard(df.where("label = 1")).first()[0] is None and auc_roc_hard(df.limit(0)).first()[0] is None


@pytest.mark.parametrize("descending", [False, True])
def test_bucket_search_orders_values(spark, descending):
    rng = random.Random(8)
    values = [rng.choice([0.5, rng.random()]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for n in (1, 2, 7, 64):
        by = defaultdict(set)
        for r in range_buckets(df, "v", n, "b", descending).collect():
            by[r.b].add(r.v)
        order = sorted(by, reverse=descending)
        assert set(order) <= set(range(n)) and all(max(by[a]) < min(by[b]) for a, b in zip(order, order[1:]))
        assert len(order) >= min(n, 30) // 2
