"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedlab.llm import exact_dedup as ED
from feedlab.llm import simhash as SH
from feedlab.llm import substring_dedup as SD

SPACE = re.compile(r"[\x20\x09-\x0D]+")
DDL = "doc_id long, text string"
CLASH = ["id", "row_id", "keep_id", "fp", "payload", "kind", "content", "component", "n_words", "bucket"]


def table(spark, rows, parts=3):
    """Rows with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, DDL).repartition(parts)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def edge_rows():
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    return [(1, "a b  c"), (2, "abc"), (3, "a\tbc\n"), (4, None), (5, ""), (6, " \n"), (7, long_text),
            (8, long_text + " "), (9, "A b c"), (10, " abc"), (11, "a b  c"), (11, "a b  c"), (None, "abc"),
            (None, None), (12, "é ü 日本"), (13, "éü日本")]


def brute_exact(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        t = t or ""
        groups.setdefault(SPACE.sub("", t), []).append((-len(t), float("inf") if d is None else d, i))
    out = []
    for key, members in groups.items():
        best = min(members)
        for m in members:
            out.append((rows[m[2]][0], rows[best[2]][0], len(members), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("budget", [ED.TABLE_BYTES, 600])
def test_exact_dedup_edges(spark, budget):
    rows = edge_rows()
    got = ED.exact_dedup(table(spark, rows), table_bytes=budget).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_exact(rows)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})


def test_exact_dedup_empty_table(spark):
    assert ED.exact_dedup(spark.createDataFrame([], DDL)).collect() == []


def test_grace_spills_and_compares_contents(tmp_path):
    rng = random.Random(1)
    texts = [f"t{rng.randrange(400)}".encode() * 5 for _ in range(3000)]
    # all hashes equal: only the contents tell texts apart
    records = [(7, t, i, 1, len(t), i, i) for i, t in enumerate(texts)]
    groups = list(ED.grace(iter(records), budget=2000))
    assert sorted(g[5] for g in groups) == sorted(set(texts))
    assert all(sorted(g[4]) == [i for i, t in enumerate(texts) if t == g[5]] for g in groups)
    assert all(g[1] == min(g[4]) and g[3] == len(g[4]) for g in groups)


def test_exact_dedup_hot_group_leaves_a_task_once(spark):
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text"))
                                  .otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = ED.exact_dedup(df)
    assert got.filter("group_size = 3000").count() == 3000
    assert got.filter("kept").count() == 6001
    assert {r.keep_id for r in got.filter("group_size = 3000").select("keep_id").distinct().collect()} == {0}


# --- SimHash -------------------------------------------------------------------

def brute_fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fp = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fp[i] ^ fp[j]).bit_count() <= 2 and label[j] > label[i]:
                    label[j] = label[i]
                    changed = True
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[label[i]] = min(d, least.get(label[i], d))
    return sorted(((d, f"{f:016x}", least.get(label[i])) for i, ((d, _), f) in enumerate(zip(rows, fp))), key=str)


@pytest.mark.parametrize("tile", [SH.TILE, 4])
def test_simhash_edges(spark, tile):
    rng = random.Random(3)
    rows = edge_rows()
    base = [f"word{rng.randrange(500)}" for _ in range(400)]
    for i in range(60):                      # chains of small edits
        w = base[:]
        w[rng.randrange(400)] = f"edit{i % 7}"
        rows.append((100 + i, " ".join(w)))
    rows += [(500 + i, f"x{i % 9}") for i in range(20)]
    got = SH.near_duplicates(table(spark, rows), tile=tile).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute_components(rows)


def test_simhash_empty_table(spark):
    assert SH.near_duplicates(spark.createDataFrame([], DDL)).collect() == []


@pytest.mark.parametrize("tile", [SH.TILE, 16])
def test_links_against_all_pairs(spark, tile):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2 ** 63, size=30, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:                        # dense neighbourhoods and far ones, sharing blocks
        for _ in range(25):
            x = int(c)
            for b in rng.integers(0, 64, size=rng.integers(0, 6)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = np.array(sorted(fps), dtype=np.uint64)
    nodes = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps.view(np.int64))], "node long, fp long")
    got = {tuple(sorted((r.a, r.b))) for r in SH.links(nodes, tile=tile).collect()}
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= 2}
    assert got == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 200), (250, 300), (200, 250)]
    got = {r.node: r.component for r in SH.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 300: 200, 250: 200}


# --- substrings ------------------------------------------------------------------

def brute_substring(rows, k=13):
    order = lambda d: float("inf") if d is None else d
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            first[key] = min(order(d), first.get(key, order(d)))
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < order(d):
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_words", [SD.SHARD_WORDS, 60])
def test_substring_dedup_edges(spark, shard_words):
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(12)] + ["é", "日本"]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(8, 40))] for _ in range(12)]
    rows = [(1, None), (2, ""), (3, "one two"), (4, " ".join(["same"] * 60)), (5, "x " + " ".join(["same"] * 30))]
    for i in range(70):
        w = []
        for _ in range(rng.randint(1, 5)):
            w += rng.choice(passages) if rng.random() < 0.6 else [f"u{rng.randrange(10 ** 6)}" for _ in range(15)]
        rows.append((rng.choice([10 + i, 10 + i, 10 + i, 20]), rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(900, rows[20][1]), (900, rows[20][1]), (None, rows[21][1]), (None, rows[22][1])]
    got = SD.substring_dedup(table(spark, rows), shard_words=shard_words).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_substring(rows)


def test_hot_anchor_goes_on_by_its_windows(monkeypatch):
    # one anchor, 600 surroundings: no automaton holds or streams them all
    import numpy as np
    import pyarrow as pa
    streamed = []
    real = SD.SuffixAutomaton.earliest_windows
    monkeypatch.setattr(SD.SuffixAutomaton, "earliest_windows", lambda m, *a: streamed.append(1) or real(m, *a))
    rng = random.Random(5)
    segments = []
    for i in range(600):
        before, after = (f"{x}{rng.randrange(30)}" for x in "ba")
        segments.append(" ".join([before] * 8 + "one two three four five".split() + [after] * 8).encode())
    places = [np.array([(i, 0, 7)], dtype=SD._PLACE).tobytes() for i in range(len(segments))]
    batch = pa.RecordBatch.from_arrays([pa.array([3] * len(segments), pa.int64()), pa.array(segments), pa.array(places)],
                                       names=["anchor", "segment", "places"])
    sent = list(SD._shards(13, 500)(iter([batch])))
    assert len(streamed) <= len(set(segments))
    rows = sorted((r for b in sent for r in b.to_pylist()), key=lambda r: r["key"])
    assert all(r["earliest"] is None for r in rows) and len(rows) == len({r["segment"] for r in rows})
    got = set()
    for b in SD._windows(iter([pa.RecordBatch.from_pylist(rows, schema=sent[0].schema)])):
        for r in b.to_pylist():
            least, = np.frombuffer(r["earliest"], dtype="<i8")
            got |= {(int(p["id"]), int(p["at"]) - 7) for p in np.frombuffer(r["places"], dtype=SD._PLACE) if p["id"] > least}
    first, want = {}, set()
    for i, s in enumerate(segments):
        w = s.split()
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k:k + 13]), i) < i:
                want.add((i, k))
    assert want and got == want


def test_substring_dedup_long_text_and_empty_table(spark):
    long_text = " ".join(f"w{i % 7919}" for i in range(50_000))
    rows = [(1, long_text), (2, long_text[: len(long_text) // 2])]
    got = {r.doc_id: r for r in SD.substring_dedup(table(spark, rows)).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed in (got[2].n_words, got[2].n_words - 1)
    assert SD.substring_dedup(spark.createDataFrame([], DDL)).collect() == []


def test_automaton_states_know_the_earliest_document():
    rng = random.Random(2)
    docs = [[rng.randrange(3) for _ in range(rng.randint(1, 30))] for _ in range(40)]
    ids = [rng.randrange(1000) for _ in docs]
    m = SD.SuffixAutomaton()
    for d, i in zip(docs, ids):
        m.add(d, i)
    m.close()
    for q in docs + [[rng.randrange(4) for _ in range(30)] for _ in range(20)]:
        for k in (1, 3, 5):
            want = [min((i for d, i in zip(docs, ids) if any(d[p:p + k] == q[a:a + k] for p in range(len(d) - k + 1))),
                        default=SD.LAST) for a in range(len(q) - k + 1)]
            assert m.earliest_windows(q, k) == want


def test_held_segments_keep_their_places_packed():
    import tracemalloc

    import pyarrow as pa
    import zstandard

    rng, z = random.Random(1), zstandard.ZstdCompressor()
    vocab = [b"w%d" % i for i in range(3000)]
    texts = [b" ".join(rng.choice(vocab) for _ in range(400)) for _ in range(60)]

    def batches():
        for i in range(120):
            hits = np.unique(SD.anchors(texts[i % 60].split(), 13, 5)[0])
            side = np.full(len(hits), i, "<i8").tobytes() + hits.astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([i, i], pa.int64()), pa.array([0, 1], pa.int32()), pa.array([None, i], pa.int64()),
                 pa.array([side, z.compress(texts[i % 60])], pa.binary()), pa.array([None, i], pa.int64())],
                names=["dest", "kind", "id", "payload", "doc_id"])

    list(SD._segments(13, 5)(batches()))
    tracemalloc.start()
    out, = SD._segments(13, 5)(batches())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 480 * out.num_rows, peak / out.num_rows
    at = {}
    for i, t in enumerate(texts):
        words = t.split()
        for _, first, n in zip(*(x.tolist() for x in SD.anchors(words, 13, 5))):
            at.setdefault(b" ".join(words[first:first + n + 12]), []).extend([(i, 0, first), (i + 60, 0, first)])
    got = {r["segment"]: np.frombuffer(r["places"], dtype=SD._PLACE).tolist() for r in out.to_pylist()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in at.items()}
