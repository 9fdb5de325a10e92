"""The inverted file: recall, the exact pass, hot lists, odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from feedlab.operators import nearest_lists as N


def frame(spark, vectors, ids=None, kind="long"):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, f"id {kind}, vec array<double>")


def brute(vectors, queries, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = np.round(unit @ unit[q], N.SCORE_DIGITS)
        out[q] = [i for _, i in sorted((-s[i], i) for i in range(len(unit)) if i != q)][:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


def clustered(n=1500, width=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width)) * 3
    return centres[rng.integers(0, 12, n)] + rng.normal(size=(n, width))


def test_recall_and_exact_pass(spark):
    v = clustered()
    df, k = frame(spark, v), 5
    queries = df.where("id % 50 = 0")
    want = brute(v, range(0, len(v), 50), k)
    index = N.build_index(df, k)
    assert index.rows.count() == len(v) and index.probes < index.lists.count()
    got = found(N.search(index, queries, k))
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * k * len(want)
    assert found(N.search(index, queries, k, exact=True)) == want


def test_recall_on_the_embeddings(spark):
    """Vectors without clusters: the calibration visits more lists."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    rows = e.orderBy("id").collect()
    v = np.array([r["vec"] for r in rows], dtype=np.float64)
    want = brute(v, range(0, len(v), 50), 5)
    got = found(N.nearest_many(e, e.where("id % 50 = 0"), 5))
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)


def test_hot_list_is_cut_into_blocks(spark):
    v = clustered(600)
    v[:200] = v[0]
    index = N.build_index(frame(spark, v), 5, lists=6, block_rows=20)
    assert index.rows.groupBy("list", "block").count().agg(F.max("count")).first()[0] <= 200
    assert index.lists.agg(F.max("blocks")).first()[0] >= 10
    queries = frame(spark, v).where("id % 50 = 0")
    # ties among the copies go by id
    assert found(N.search(index, queries, 5, exact=True)) == brute(v, range(0, 600, 50), 5)


def test_copies_of_one_vector_and_few_rows(spark):
    same = frame(spark, [[1.0, 2.0]] * 4)
    assert found(N.nearest_many(same, same, 2, exact=True)) == {0: [1, 2], 1: [0, 2], 2: [0, 1], 3: [0, 1]}
    one = frame(spark, [[1.0, 2.0]])
    assert N.nearest_many(one, one, 2).count() == 0


def test_rows_without_direction_take_no_part(spark):
    odd = frame(spark, [[1.0, 0.0], None, [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [],
                        [1e-200, 1e-200], [1e200, 0.0]])
    got = found(N.nearest_many(odd, odd, 3, exact=True))
    assert got == {0: [8, 7], 7: [0, 8], 8: [0, 7]}


def test_empty_table_words_as_ids_and_other_names(spark):
    empty = spark.createDataFrame([], "id long, vec array<float>")
    assert N.nearest_many(empty, empty, 3).columns == ["query_id", "rank", "id", "similarity"]
    words = frame(spark, [[1, 0], [0.9, 0.1], [0, 1]], ["a", "b", "c"], "string").select(
        F.col("id").alias("word"), F.col("vec").alias("unit"), F.lit(1).alias("list"))
    got = found(N.nearest_many(words, words.where("word = 'a'"), 2, id_col="word", vec_col="unit", exact=True))
    assert got == {"a": ["b", "c"]}


def test_calibration_is_the_smallest_number_that_holds_the_share():
    rng = np.random.default_rng(1)
    s = rng.normal(size=(200, 8))
    s /= np.linalg.norm(s, axis=1, keepdims=True)
    c = s[:10]
    assert N.probes_for(s, c, 5, 1.0) <= 10
    assert N.probes_for(s, c, 5, 0.5) <= N.probes_for(s, c, 5, 0.9) <= N.probes_for(s, c, 5, 1.0)


def test_a_block_hands_on_little_and_keeps_the_order_of_equal_scores(spark, monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 8))
    v[100:200] = v[7]  # a hundred copies
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    ids = rng.permutation(300)
    rows = pa.table({"id": ids, "unit": unit.tolist()})
    queries = pa.table({"query_id": ids[:20], "_q": unit[:20].tolist(), "floor": pa.array([None] * 19 + [2.0], pa.float64())})
    for slab in (1, 1 << 22):
        monkeypatch.setattr(N, "_SLAB", slab)
        got = {}
        for r in N._block_best(3, queries, rows).to_pylist():
            got.setdefault(r["query_id"], []).append((-round(r["score"], N.SCORE_DIGITS), r["id"]))
        assert sum(map(len, got.values())) < 20 * 8 and ids[19] not in got
        for i in range(19):
            s = np.round(unit @ unit[i], N.SCORE_DIGITS)
            want = sorted((-s[j], ids[j]) for j in range(300) if j != i)[:3]
            assert [x for _, x in sorted(got[ids[i]])[:3]] == [x for _, x in want]


def test_lists_are_compared_as_groups(spark):
    df = frame(spark, clustered(200))
    plan = N.nearest_many(df, df.where("id % 50 = 0"), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroupsInArrow" in plan and "zip_with" not in plan.lower()
