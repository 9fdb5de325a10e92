"""Word vectors by blocks: pair counts, planted synonyms, block counts, odd rows."""

import random
from collections import Counter

import numpy as np
import pytest

from feedlab.operators import word_blocks as W
from feedlab.operators.nearest_lists import nearest_many


def brute_pairs(rows, window):
    out = Counter()
    for t in rows:
        for i, a in enumerate(t):
            for j in range(max(0, i - window), min(len(t), i + window + 1)):
                if i != j and a is not None and t[j] is not None:
                    out[a, t[j]] += 1
    return out


def test_pair_counts_equal_brute_force_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(W, "_CHUNK", 7)
    rng = random.Random(3)
    rows = [[rng.choice("abcdefgh") for _ in range(n)] for n in (0, 1, 2, 6, 7, 8, 13, 14, 15, 60)]
    rows += [["a", None, "b"], ["x"] * 9]
    df = spark.createDataFrame([(i, r) for i, r in enumerate([*rows, None])], "id long, t array<string>")
    for window in (1, 3, 5):
        got = {(r["word"], r["context"]): r["n"] for r in W.pair_counts(df, "t", window).collect()}
        assert got == dict(brute_pairs(rows, window))


def test_pairs_are_counted_once_and_only_those_of_the_words_given(spark):
    rows = [["b", "a", "a", None, "rare", "c"], ["c", "b", "a", "c"], ["a"], [], None, ["é", "a", "é"]]
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>")
    pairs = W.pair_counts(df, "t", 2)
    # one shuffle of the pairs of two words, none of their two directions
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = brute_pairs([r or [] for r in rows], 2)
    assert {(r.word, r.context): r.n for r in pairs.collect()} == dict(want)
    words = spark.createDataFrame([("a", 1), ("b", 2), ("é", 3), ("unseen", 4)], "word string, slot int")
    slots = {r.word: r.slot for r in words.collect()}
    got = sorted((r.word, r.context, r.n, r.word_slot, r.context_slot) for r in W.pair_counts(df, "t", 2, words).collect())
    assert got == sorted((a, b, n, slots[a], slots[b]) for (a, b), n in want.items() if a in slots and b in slots)


def corpus(topics=8, texts=700, seed=0):
    """Two synonyms a topic, which stand among the same words but never together."""
    rng = random.Random(seed)
    rows = []
    for _ in range(texts):
        t = rng.randrange(topics)
        around = [f"w{t}_{rng.randrange(6)}" for _ in range(8)]
        around.insert(4, f"syn{t}_{rng.randrange(2)}")
        rows.append(around + [f"common{rng.randrange(3)}"])
    return rows


@pytest.mark.parametrize("blocks", [1, 3])
def test_planted_synonyms_are_neighbours(spark, blocks):
    rows = corpus()
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>")
    vectors = W.fit_word_blocks(df, "t", size=12, blocks=blocks, epochs=6)
    counts = Counter(w for r in rows for w in r)
    got = {r["word"]: np.array(r["vector"]) for r in vectors.collect()}
    assert set(got) == {w for w, n in counts.items() if n >= 2}
    syn = vectors.where("word like 'syn%'")
    near = {r["query_id"]: r["id"] for r in nearest_many(syn, syn, 1, id_col="word", vec_col="vector", exact=True).collect()}
    right = sum(near[f"syn{t}_{s}"] == f"syn{t}_{1 - s}" for t in range(8) for s in range(2))
    assert right >= 14, near


def test_repeats_exactly_and_outputs_of_rounds_are_removed(spark):
    from feedlab.session import ensure_checkpoint_dir
    import glob
    df = spark.createDataFrame([(r,) for r in corpus(texts=60)], "t array<string>").repartition(5)
    a, b = ({r["word"]: list(r["vector"]) for r in W.fit_word_blocks(df.repartition(n), "t", size=6, blocks=2, epochs=1).collect()}
            for n in (2, 7))
    assert a == b
    root = f"{ensure_checkpoint_dir(spark)}/feedlab-scratch/{spark.sparkContext.applicationId}"
    before = len(glob.glob(f"{root}/vectors-*"))
    W.fit_word_blocks(df, "t", size=6, blocks=2, epochs=1)
    assert len(glob.glob(f"{root}/vectors-*")) == before + 1


def test_odd_rows(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],), ([None, "a"],), (["solo", "solo"],)], "t array<string>")
    got = {r["word"]: r["vector"] for r in W.fit_word_blocks(df, "t", size=4, blocks=3, epochs=1).collect()}
    assert set(got) == {"a", "solo"} and all(np.isfinite(v).all() for v in got.values())
    empty = spark.createDataFrame([], "t array<string>")
    assert W.fit_word_blocks(empty, "t").collect() == []
