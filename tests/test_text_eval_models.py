"""Text, evaluation, embedding and model invariants (FIXTURES.md §4, SURVEY §5)."""

import math

from pyspark.sql import functions as F

from feedlab.functions.terms import truncate_tokens
from feedlab.operators.embed import mean_vectors, nearest
from feedlab.operators.evaluate import auc_pr, auc_roc, best_threshold, roc_curve, weighted_f1
from feedlab.operators.models import chi2_p_value, chi2_select, chi2_stats
from feedlab.operators.text import (combine_tokens, keywords, remove_stopwords, remove_stopwords_table,
                                    term_doc_count, term_share, term_total_count, tokens_from_text)


def test_combine_tokens_by_width(spark):
    df = spark.createDataFrame([("1\tT\ta,b\tc",), ("2\tT\ta,b",), ("3\tT",), ("lone",)], "value string")
    good, wide = combine_tokens(df)
    assert wide.collect() == []
    got = {r.urlid: (r.title, r.s_term) for r in good.collect()}
    assert got == {"1": ("T", ["a", "b", "c"]), "2": ("T", ["a", "b"]), "3": ("T", ["T"]), "lone": ("-", [])}


def test_wide_token_lines_are_quarantined(spark):
    from feedlab.operators.text import title_tokens
    df = spark.createDataFrame([("1\tT\ta\tb\tLOST",), ("2\tT\ta",)], "value string")
    for f in (combine_tokens, title_tokens):
        good, wide = f(df)
        assert [r.urlid for r in good.collect()] == ["2"]
        assert [r.value for r in wide.collect()] == ["1\tT\ta\tb\tLOST"]


def test_null_tokens(spark):
    df = spark.createDataFrame([("1", "T", None), ("2", "T", "a,b")], "urlid string, title string, s string")
    got = {r.urlid: (r.title, r.s_term) for r in tokens_from_text(df, "urlid", "title", "s").collect()}
    assert got == {"1": ("-", []), "2": ("T", ["a", "b"])}


def test_default_stopwords_case_insensitive(spark):
    df = spark.createDataFrame([(1, ["The", "cat", "a"])], "k long, t array<string>")
    assert remove_stopwords(df, "t", "o").collect()[0].o == ["cat"]


def test_table_stopwords_keep_order(spark):
    df = spark.createDataFrame([(1, ["x", "The", "y", "x"]), (2, ["the"])], "k long, t array<string>")
    stop = spark.createDataFrame([("the",)], "word string")
    got = {r.k: r.o for r in remove_stopwords_table(df, "k", "t", "o", stop).collect()}
    assert got == {1: ["x", "y", "x"], 2: []}


def test_truncate(spark):
    df = spark.createDataFrame([([str(i) for i in range(12)],)], "t array<string>")
    assert df.select(truncate_tokens("t", 10)).collect()[0][0] == [str(i) for i in range(10)]


def test_term_doc_count(spark):
    df = spark.createDataFrame([("1", "T", "x,y,x"), ("2", "U", None)], "urlid string, title string, s string")
    got = sorted((r.urlid, r.term, r.tf) for r in term_doc_count(df, "urlid", "title", "s").collect())
    assert got == [("1", "x", 2), ("1", "y", 1), ("2", "-", 0)]


def test_term_counts_without_title_do_not_carry_it(spark):
    """The title, which may be a whole text, was copied and hashed with every term."""
    rows = [(1, "T", "x,y,x"), (1, "T", "x"), (1, "U", "x"), (1, None, "x"), (None, "T", "x,z"), (None, None, None), (2, "", None)]
    df = spark.createDataFrame(rows, "urlid long, title string, s string")
    without = term_doc_count(df, "urlid", "title", "s", keep_title=False)
    key = lambda r: (r.urlid or 0, r.term, r.tf)
    assert without.columns == ["urlid", "term", "tf"]
    assert sorted(map(key, without.collect())) == sorted(map(key, term_doc_count(df, "urlid", "title", "s").collect()))
    aggregates = [x for x in without._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x]
    assert aggregates and all("title#" not in x.replace("_title#", "") for x in aggregates)


def test_term_share_of_documents_without_terms(spark):
    """The share of their ``-`` is 0 / 0, which ended the query; NaN as in its SQL."""
    tf = spark.createDataFrame([(1, "x", 3), (None, "x", 1), (2, "-", 0), (3, "-", 0)], "urlid long, term string, tf long")
    got = sorted((r.urlid or 0, r.term, r.tf, r.total, str(r.share)) for r in term_share(tf, term_total_count(tf), "urlid").collect())
    assert got == [(0, "x", 1, 4, "0.25"), (1, "x", 3, 4, "0.75"), (2, "-", 0, 0, "nan"), (3, "-", 0, 0, "nan")]


def test_keywords_rank_and_weight(spark):
    df = spark.createDataFrame([(1, "apple apple pear"), (2, "pear plum"), (3, "")], "k long, text string")
    kw = {(r.k, r.term): (r.weight, r.rank) for r in keywords(df, "k", "text", 2).collect()}
    # N = 2 documents with tokens; idf(apple) = ln(3/2), idf(pear) = ln(3/3) = 0
    assert math.isclose(kw[(1, "apple")][0], round(2 / 3 * math.log(1.5), 6))
    assert kw[(1, "apple")][1] == 1 and kw[(1, "pear")] == (0.0, 2)
    assert (3, "") not in kw


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label double")


def test_auc_all_equal_scores_is_half(spark):
    df = scored(spark, [(0.5, 1.0), (0.5, 0.0), (0.5, 1.0), (0.5, 0.0)])
    assert auc_roc(df).collect()[0].auc_roc == 0.5


def test_auc_matches_mllib(spark):
    import random
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 2), float(rnd.random() < 0.4)) for _ in range(3000)]
    df = scored(spark, rows)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert math.isclose(auc_roc(df).collect()[0].auc_roc, ev.evaluate(df), abs_tol=1e-12)
    ev_pr = ev.setMetricName("areaUnderPR")
    assert math.isclose(auc_pr(df).collect()[0].auc_pr, ev_pr.evaluate(df), abs_tol=1e-8)


def test_roc_curve_spans_buckets(spark):
    # many distinct scores: the two-level prefix sum must still be exact
    rows = [(i / 5000.0, float(i % 3 == 0)) for i in range(5000)]
    df = scored(spark, rows)
    curve = sorted(roc_curve(df).collect(), key=lambda r: -r.threshold)
    P = sum(1 for _, l in rows if l > 0.5)
    N = len(rows) - P
    tp = fp = 0
    for (s, l), r in zip(sorted(rows, key=lambda x: -x[0]), curve):
        tp += l > 0.5
        fp += l <= 0.5
        assert r.threshold == s and r.tpr == tp / P and r.fpr == fp / N


def test_best_threshold_prefers_higher(spark):
    curve = spark.createDataFrame([(0.9, 0.5), (0.7, 0.8), (0.6, 0.800001), (0.3, 0.6)],
                                  "threshold double, f_measure double")
    r = best_threshold(curve, "f_measure").collect()[0]
    assert r.threshold == 0.7


def test_weighted_f1_matches_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = [(float(i % 3), float((i * 7) % 3 if i % 4 else i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    assert math.isclose(weighted_f1(df).collect()[0].weighted_f1, ev.evaluate(df), abs_tol=1e-9)


def test_mean_vector_counts_unknown_items(spark):
    vecs = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "id long, vec array<double>")
    seqs = spark.createDataFrame([("s", 1), ("s", 2), ("s", 99), ("t", 99)], "seq string, item long")
    got = {r.seq: r.mean_vec for r in mean_vectors(seqs, vecs, "seq", "item").collect()}
    assert got["s"] == [4.0 / 3, 6.0 / 3]
    assert got["t"] == [0.0, 0.0]


def test_nearest_excludes_query(spark):
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [-1.0, 0.0])],
                                 "id long, vec array<double>")
    got = [r.id for r in nearest(vecs, vecs.where("id = 1"), 2).collect()]
    assert got == [2, 3]


def test_chi2_matches_mllib_and_bins(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    rows = [(float(i % 3), float(i % 5), float((i * 13) % 20000), float(i % 2)) for i in range(30000)]
    df = spark.createDataFrame(rows, "a double, b double, wide double, label double")
    stats = {r.feature: r.statistic for r in chi2_stats(df, ["a", "b"], "label").collect()}
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    ref = ChiSquareTest.test(vec, "f", "label").collect()[0].statistics
    assert math.isclose(stats["a"], ref[0], rel_tol=1e-9) and math.isclose(stats["b"], ref[1], rel_tol=1e-9)
    test = ChiSquareTest.test(vec, "f", "label").collect()[0]
    for name, p in zip(("a", "b"), test.pValues):
        row = next(r for r in chi2_stats(df, ["a", "b"], "label").collect() if r.feature == name)
        assert math.isclose(chi2_p_value(row.statistic, row.dof), p, rel_tol=1e-6, abs_tol=1e-300)
    # a column of 400 values needs no bins, and counted groups give the same
    grouped = df.groupBy("a", "b", "wide", "label").count()
    key = lambda d: sorted((r.feature, r.statistic, r.dof) for r in d.collect())
    assert key(chi2_stats(df, ["a", "b", "wide"], "label")) == key(
        chi2_stats(grouped, ["a", "b", "wide"], "label", count="count"))


def test_chi2_select_equals_the_library(spark):
    from pyspark.ml.feature import UnivariateFeatureSelector
    from feedlab.operators.features import assemble
    rows = [(float(i % 2), float(i % 2 if i % 10 else 3), float(i % 3), float((i * 7) % 5 + (i % 2) * (i % 4 == 0)),
             float(i % 7)) for i in range(500)]
    cols = ["p", "q", "r", "s"]
    df = spark.createDataFrame(rows, "label double, p double, q double, r double, s double")
    sel = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="o",
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(2)
    want = sorted(sel.fit(assemble(df, cols)).selectedFeatures)
    assert [i for i, _ in chi2_select(chi2_stats(df, cols, "label"), cols, 2)] == want


def test_dense_index_many_values(spark):
    from feedlab.operators.relational import dense_index
    df = spark.range(0, 50_000).select(((F.col("id") * 7919) % 1_000_003 * 1_000_000_007).alias("k"))
    idx = dense_index(df, "k", "i", n_buckets=16)
    rows = sorted((r.k, r.i) for r in idx.collect())
    assert [i for _, i in rows] == list(range(len(rows)))


def test_als_returns_original_ids(spark):
    from feedlab.operators.models import (als_input, fit_als, recommend_items, recommend_users, user_factors, with_ids)
    users, items = [2 ** 40 + u for u in range(6)], [-3, 2 ** 33, 5, 6, 2 ** 50]
    rows = [(u, i, (n * 7) % 2) for n, (u, i) in enumerate((u, i) for u in users for i in items)]
    df = spark.createDataFrame(rows + [(None, 5, 1), (users[0], None, 1)], "uid long, urlid long, label int")
    out, umap, imap = als_input(df)
    assert out.count() == len(rows)          # rows without an id are dropped
    assert out.schema["uid"].dataType.simpleString() == out.schema["urlid"].dataType.simpleString() == "int"
    model = fit_als(out, iters=2, user_blocks=2, item_blocks=2)
    pred = with_ids(with_ids(model.transform(out), umap, "uid"), imap, "urlid")
    assert {(r.uid, r.urlid) for r in pred.collect()} == {(u, i) for u, i, _ in rows}
    assert {r.id for r in user_factors(model, umap).collect()} == set(users)
    for recs in (recommend_items(model, 3, user_map=umap, item_map=imap), recommend_users(model, 3, user_map=umap, item_map=imap)):
        got = recs.collect()
        assert {r.uid for r in got} <= set(users) and {r.urlid for r in got} <= set(items) and len(got) >= 15


def test_lr_save_load_same_predictions(spark):
    from pyspark.ml.classification import LogisticRegressionModel
    from feedlab.operators.features import assemble
    from feedlab.operators.models import fit_lr, save_model
    from feedlab.session import scratch_path
    rows = [(float(i % 2), float(i % 7), float(i % 5) * (i % 2)) for i in range(300)]
    df = assemble(spark.createDataFrame(rows, "label double, x double, y double"), ["x", "y"])
    m = fit_lr(df, 30, 0.3, 0.1)
    p = scratch_path(spark, "lr")
    save_model(m, p)
    back = LogisticRegressionModel.load(p)
    a = [r.prediction for r in m.transform(df).collect()]
    b = [r.prediction for r in back.transform(df).collect()]
    assert a == b
    assert len(m.summary.objectiveHistory) >= 1


def test_estimator_save_load(spark):
    from pyspark.ml.recommendation import ALS
    from feedlab.operators.models import save_model
    from feedlab.session import scratch_path
    est = ALS(maxIter=5, regParam=0.01, numUserBlocks=20, numItemBlocks=100, userCol="uid", itemCol="urlid",
              ratingCol="label", seed=42)
    p = scratch_path(spark, "als_est")
    save_model(est, p)
    back = ALS.load(p)
    assert (back.getMaxIter(), back.getRegParam(), back.getNumUserBlocks(), back.getNumItemBlocks()) == (5, 0.01, 20, 100)


def test_als_seeded_repeatable(spark):
    from feedlab.operators.models import fit_als
    rows = [(u, i, float((u * i) % 2)) for u in range(20) for i in range(15) if (u + i) % 3]
    df = spark.createDataFrame(rows, "uid int, urlid int, label float")
    a = fit_als(df, 5, 0.01, 2, 2).userFactors.orderBy("id").collect()
    b = fit_als(df, 5, 0.01, 2, 2).userFactors.orderBy("id").collect()
    assert a == b


def test_dense_index_skips_nulls_and_duplicates(spark):
    from feedlab.operators.relational import dense_index
    df = spark.createDataFrame([(3,), (None,), (3,), (10,), (-4,)], "k long")
    got = sorted((r.k, r.i) for r in dense_index(df, "k", "i", n_buckets=4).collect())
    assert got == [(-4, 0), (3, 1), (10, 2)]


def test_tree_fits_read_a_split_once_and_give_the_models_of_single_fits(spark):
    from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from feedlab.operators.models import SEED as model_seed, fit_trees
    from feedlab.operators.relational import random_split
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x
    rows = spark.range(400).repartition(3, "id").select(
        (F.col("id") % 7 > 2).cast("double").alias("label"), F.udf(seen, "double")(F.col("id") * 1.0).alias("a"),
        (F.col("id") % 5).cast("double").alias("b"))
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).select("label", "features")
    train, _ = random_split(data, [0.9, 0.1], 1)
    models = dict(fit_trees(train))
    assert read.value == 400
    assert not train.storageLevel.useDisk and not train.storageLevel.useMemory
    single = {"decision_tree": DecisionTreeClassifier(maxDepth=5, seed=model_seed),
              "random_forest": RandomForestClassifier(numTrees=10, subsamplingRate=0.7, seed=model_seed),
              "gbt": GBTClassifier(subsamplingRate=0.7, maxIter=20, seed=model_seed)}

    def text(model):
        return model.toDebugString.split("\n", 1)[1]
    assert {n: text(m) for n, m in models.items()} == {n: text(e.fit(train)) for n, e in single.items()}
