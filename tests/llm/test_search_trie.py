"""Prefix trie, lexical search and nearest neighbours against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlab.llm import lexical_search as LS
from feedlab.llm import lsh_search as NN
from feedlab.llm import prefix_trie as PT

CLASH = ["hi", "lo", "d", "pos", "len", "content", "own", "rank", "score", "row", "block", "table", "term", "n", "norm"]


def clash(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH) if c not in df.columns])


# --- prefix trie ------------------------------------------------------------

CONV_DDL = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(r[:len(q)] == q and len(r) > len(q) for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(full[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TRIE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(spark, rows, **kw):
    df = clash(spark.createDataFrame(rows, CONV_DDL).repartition(4))
    return sorted((tuple(r[c] for c in TRIE_COLUMNS) for r in PT.prefix_trie(df, **kw).collect()), key=str)


def conversations(seed=0):
    rng = random.Random(seed)
    rows = []
    for c in range(-12, 60):
        if c % 7 == 3:
            continue
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "long " * 50])))
    rows += [(61, None, "user", "x"), (61, None, "user", "x"), (61, 1, "user", "x"), (61, 1, "assistant", "x"),
             (None, 0, "user", "lost"), (64, 0, "ab", "c"), (63, 0, "a", "bc"), (66, 0, None, "y" * 300_000)]
    rows += [(c, t, "user", f"copy {t}") for c in (100, 105, 110, 115) for t in range(6)]
    return rows


@pytest.mark.parametrize("shard_rows", [PT.SHARD_ROWS, 4])
def test_trie_equals_brute_force(spark, shard_rows):
    rows = conversations()
    assert trie(spark, rows, shard_rows=shard_rows) == brute_trie(rows)


def test_trie_conversation_with_a_third_of_all_turns(spark, monkeypatch):
    """The hot conversation goes over several range partitions."""
    monkeypatch.setattr(PT, "RANGE_ROWS", 20)
    monkeypatch.setattr(PT, "TASK_NODES", 30)
    rows = conversations(1)
    rows += [(200, t, "user", f"turn {t % 7}") for t in range(len(rows) // 2)]
    rows += [(205, t, "user", f"turn {t % 7}") for t in range(len(rows) // 3)]
    assert trie(spark, rows, shard_rows=30) == brute_trie(rows)


def test_trie_many_members_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(PT, "PIECE_BYTES", 50)
    rows = [(c, 0, "user", "hello") for c in range(0, 1500, 5)] + [(7, 0, "user", "other")]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_empty_and_turnless(spark):
    assert trie(spark, []) == []
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "gone")]               # no base, and its turn lies within the head
    assert trie(spark, rows) == brute_trie(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_trie_draws_again_on_a_collision(spark, monkeypatch):
    """A salt under which all digests of a depth are equal is given up."""
    real = F.xxhash64
    monkeypatch.setattr(PT.F, "xxhash64", lambda salt, *c: F.when(salt.startswith("0"), real(*c[:1])).otherwise(
        real(salt, *c)) if len(c) == 2 and not isinstance(salt, str) else real(salt, *c))
    rows = conversations(2)
    assert trie(spark, rows) == brute_trie(rows)


def test_minimal_perfect_hash():
    rng = np.random.default_rng(0)
    hi, lo = (rng.integers(-2**62, 2**62, 20_000) for _ in range(2))
    hi[0], lo[0] = 0, 0
    table = PT.MinimalPerfectHash(hi, lo)
    assert sorted(table.slots(hi, lo)) == list(range(len(hi)))
    assert (table.slots(hi + 1, lo) == -1).all()
    assert len(PT.MinimalPerfectHash(hi[:0], lo[:0]).slots(hi[:3], lo[:3])) == 3


# --- lexical search ---------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k=10):
    bags = [(d, Counter(TERM.findall((t or "").translate(FOLD)))) for d, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for i, text in items:
        scored = []
        for d, b in bags:
            if b:
                m = 100 - 75 + (75 * b.total() * n_docs) // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                    (1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in TERM.findall((text or "").translate(FOLD)) if b[t])
                if s > 0:
                    scored.append((-s, d is None, d or 0))
        out += [(i, r, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def lexical(spark, docs, items, **kw):
    d = clash(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    i = clash(spark.createDataFrame(items, "item_id long, text string").repartition(2))
    got = LS.search(d, i, **kw).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str)


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ß", "日本", "A1", "a1", "x_y", "don't"]
    text = lambda: rng.choice([" ", ", "]).join(rng.choices(vocab, weights=range(len(vocab), 0, -1), k=rng.randint(0, 40)))
    docs = [(i, text()) for i in range(n)]
    docs += [(5, docs[5][1]), (None, docs[7][1]), (200, None), (201, ""), (202, " .,;"), (203, "w1 W2 " * 40_000)]
    docs += [(300 + i, "same words here") for i in range(60)]
    shared = text() + " shared tail of words"
    items = [(i, text() + " " + shared if i % 2 else text()) for i in range(20)]
    items += [(3, "w1 w1 w1 w2"), (None, "w3 same"), (90, None), (91, "?!"), (92, "same WORDS"), (93, "notthere"), (92, "same WORDS")]
    return docs, items


@pytest.mark.parametrize("block_terms", [LS.BLOCK_TERMS, 60])
def test_search_equals_brute_force(spark, block_terms, monkeypatch):
    monkeypatch.setattr(LS, "CELLS", 2000)
    docs, items = corpus()
    assert lexical(spark, docs, items, block_terms=block_terms) == brute_search(docs, items)


def test_search_empty_tables(spark):
    docs, items = corpus(1)
    assert lexical(spark, [], items) == lexical(spark, docs, []) == lexical(spark, [(1, None)], items) == []


def test_sharing_graph_adds_up_and_shares():
    rng = random.Random(3)
    shared = [rng.sample(range(300), 30) for _ in range(5)]
    items = []
    for _ in range(40):
        bag = Counter(x for s in rng.sample(shared, 2) for x in s)
        bag.update(rng.choices(range(300, 400), k=4))
        items.append(bag)
    plan = LS.Plan(items, 400)
    value = np.array([rng.randrange(10**9) for _ in range(400)], dtype=np.int64)
    partial = np.zeros((plan.n_sets, 1), dtype=np.int64)
    np.add.at(partial[:, 0], plan.set_of[plan.set_of >= 0], value[plan.set_of >= 0])
    want = [sum(int(value[t]) * n for t, n in bag.items()) for bag in items]
    assert plan.scores(partial)[:, 0].tolist() == want
    additions = len(plan.nodes) + sum(len(p) for p in plan.items)
    assert additions < sum(len(b) for b in items) / 5
    # no pair of parts is left that two items share
    pairs = Counter(frozenset((x, y)) for p in plan.items for x in p for y in p if x < y)
    assert max(pairs.values(), default=0) < LS.LEAST_SHARED


# --- nearest neighbours -----------------------------------------------------

VEC_DDL = "vec_id long, embedding array<float>, label int"


def neighbours(spark, rows, k=20, **kw):
    df = clash(spark.createDataFrame(rows, VEC_DDL).repartition(3))
    got = NN.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k, **kw).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def brute_neighbours(rows, k=20):
    """Valid rows of the commonest length; None for queries that share an id."""
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows
          if i is not None and v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    dim = max(Counter(len(v) for _, v in ok).items(), key=lambda e: (e[1], e[0]))[0]
    ok = [(i, v) for i, v in ok if len(v) == dim]
    out = {}
    for at, (i, v) in enumerate(ok):
        if i % 20 == 0:
            s = sorted((-float((w * v).sum()), j) for b, (j, w) in enumerate(ok) if b != at)[:k]
            out[i] = [(r, j, -x) for r, (x, j) in enumerate(s, 1)]
    return out


def vectors(n=400, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * rng.uniform(0.2, 3, (n, 1))
    x[n // 2: n // 2 + n // 3] = x[n // 2]              # a third of all rows are copies
    return [(i, [float(np.float32(y)) for y in v], 0) for i, v in enumerate(x)]


def test_neighbours_equal_brute_force_where_all_is_probed(spark):
    rows = vectors() + [(None, [1.0] * 16, 0), (1000, None, 0), (1001, [], 0), (1002, [0.0] * 16, 0),
                        (1020, [float("nan")] + [1.0] * 15, 0), (1040, [float("inf")] + [1.0] * 15, 0),
                        (1060, [None] + [1.0] * 15, 0), (1080, [1.0, 2.0], 0), (33, [0.5] * 16, 0)]
    assert neighbours(spark, rows, recall=1 - 1e-12) == brute_neighbours(rows)


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(NN, "TASK_ROWS", 500)
    monkeypatch.setattr(NN, "QUERY_BYTES", 4000)        # several blocks of queries
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 24))
    rows = [(i, [float(np.float32(y)) for y in v], 0) for i, v in enumerate(x)]
    got, want = neighbours(spark, rows), brute_neighbours(rows)
    hits = sum(len({j for _, j, _ in got[q]} & {j for _, j, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        for _, j, s in found:
            exact = float((np.array(rows[j][1]) * np.array(rows[q][1])).sum())
            assert s == pytest.approx(exact, abs=1e-12)


def test_neighbours_few_repeated_and_none(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [-1.0, 0.5], 0)]
    assert neighbours(spark, rows) == brute_neighbours(rows)
    assert neighbours(spark, []) == {} and neighbours(spark, rows[1:]) == {} and neighbours(spark, rows[:1]) == {}
    twice = neighbours(spark, rows + [rows[0]])[0]       # each of the two rows finds the other
    assert sorted(j for _, j, _ in twice) == [0, 0, 1, 1, 2, 2]


def test_chi_square_quantile():
    draws = (np.random.default_rng(0).standard_normal((200_000, 32)) ** 2).sum(axis=1)
    for p in (0.1, 0.5, 0.9):
        assert NN.chi_square_quantile(p, 32) == pytest.approx(np.quantile(draws, p), rel=0.01)
