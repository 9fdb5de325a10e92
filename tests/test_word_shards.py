"""Word2Vec by shards: planted synonyms, repeatability, odd rows, means, nothing on the driver."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array

from feedlab.operators import word_shards as W
from feedlab.operators.embed import fit_word2vec, synonyms, word_vectors
from test_word_blocks import corpus


def vectors_of(model):
    return {r["word"]: np.array(r["vector"]) for r in
            word_vectors(model).select("word", vector_to_array("vector").alias("vector")).collect()}


@pytest.mark.parametrize("partitions, common", [(1, 9), (8, 2_000_000), (8, 4_000)])
def test_planted_synonyms_are_neighbours_and_the_vocabulary_is_whole(spark, monkeypatch, partitions, common):
    monkeypatch.setattr(W, "COMMON", common)
    rows = corpus(texts=1500)
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>").repartition(3)
    got = vectors_of(fit_word2vec(df, "t", 16, 2, partitions=partitions))
    assert set(got) == {w for w, n in Counter(w for r in rows for w in r).items() if n >= 2}
    names = sorted(w for w in got if w.startswith("syn"))
    unit = np.array([got[w] / np.linalg.norm(got[w]) for w in names])
    near = unit @ unit.T - 9 * np.eye(len(names))
    assert sum(names[j].split("_")[0] == names[i].split("_")[0] for i, j in enumerate(near.argmax(axis=1))) >= 14


def test_one_shard_repeats_exactly_and_every_pair_counts(spark, monkeypatch):
    rows = [r + ["once" + str(i)] for i, r in enumerate(corpus(texts=80))] + [[f"w{i % 7}" for i in range(50)]]
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>")
    a, b = (vectors_of(fit_word2vec(df.repartition(n), "t", 6, 2, partitions=1)) for n in (2, 5))
    assert a.keys() == b.keys() and all((a[w] == b[w]).all() for w in a)
    # pairs of a text's words up to a word's reach apart, over the edges of batches too
    taken = []
    learn = W._learn
    reach_of_all = 3

    def counted(w, at, sentence, reach, n, *rest):
        before = w.updates.sum()
        learn(w, at, sentence, np.full(len(at), reach_of_all), n, *rest)
        taken.append(w.updates.sum() - before)
    monkeypatch.setattr(W, "_learn", counted)
    monkeypatch.setattr(W, "_BATCH", 8)
    monkeypatch.setattr(W, "SENTENCE", 20)
    texts = [[i % 5 for i in range(50)], [0], [], [1, 99, 2], [3, 4, 0]]
    batch = pa.RecordBatch.from_pydict({
        "shard": pa.array([0] * 7, pa.int32()), "kind": pa.array([0, 0] + [2] * 5, pa.int32()),
        "hashes": pa.array([[3, 1, 0], [4, 2], *texts], pa.list_(pa.int64())),
        "numbers": pa.array([[1.0] * 3, [1.0] * 2, *[[]] * 5], pa.list_(pa.float32()))})
    out = pa.Table.from_batches(list(W._train(4, 1, 5, 5, 0.1)(iter([batch]))))
    assert sorted(out["hash"].to_pylist()) == [0, 1, 2, 3, 4]

    def pairs(n):
        return sum(1 for i in range(n) for j in range(n) if i != j and abs(i - j) <= reach_of_all)
    assert sum(taken) == sum(map(pairs, (20, 20, 10, 1, 2, 3)))


def test_words_of_one_hash_count_together():
    w = W._Words(np.array([7, -2, 7]), np.array([1.0, 16.0, 15.0]), 4, 1)
    assert w.hashes.tolist() == [-2, 7] and np.allclose(w.share, [8.0, 16.0])


def test_means_and_odd_rows(spark):
    rows = [(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["a", None, "new"]), (5, ["x\0y", "a"]), (6, [""]),
            (7, [None]), (8, ["", ""]), (1, ["a", "b", "a"]), (None, ["x\0y", "b"])]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    model = fit_word2vec(df, "t", 4, 2)
    known = vectors_of(model)
    assert set(known) == {"a", "b", "", "x\0y"}
    got = model.transform(df).select("id", "t", vector_to_array("result").alias("result")).collect()
    assert sorted(((r.id, r.t) for r in got), key=str) == sorted(rows, key=str)
    for r in got:
        mean = sum((known.get(w, np.zeros(4)) for w in r.t or []), np.zeros(4)) / max(1, len(r.t or []))
        assert np.allclose(r.result, mean, atol=1e-6), r
    with pytest.raises(ValueError):
        fit_word2vec(df, "t", 4, 100)
    with pytest.raises(ValueError):
        synonyms(model, "new")
    found = synonyms(model, "a", 2).collect()
    assert len(found) == 2 and "a" not in {r.word for r in found} and found[0].similarity >= found[1].similarity


def test_no_vocabulary_on_the_driver(spark):
    """MLlib's fit collected the vocabulary with its codes and all vectors."""
    df = spark.createDataFrame([([f"w{i % 40}", f"w{i % 7}"],) for i in range(200)], "t array<string>")
    model = fit_word2vec(df, "t", 4, 2)
    assert not hasattr(model, "_java_obj") and model.vectors.inputFiles()
