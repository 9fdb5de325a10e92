"""Nearest neighbours by multiprobe p-stable hashing.

A vector falls into one bucket in each of ``TABLES`` tables.  A bucket is a cell
of ``HASHES`` p-stable hash functions floor((a.x + b) / WIDTH), a drawn from the
normal distribution, so a projection difference of two vectors at distance r is
r times a normal variable (Datar et al., "Locality-Sensitive Hashing Scheme
Based on p-Stable Distributions", 2004).

A query looks beyond its own bucket (Lv et al., "Multi-Probe LSH", 2007).  The
chance that a neighbour at distance r lies in a perturbed bucket falls with the
squared distance between the query's projections and the middle of the bucket's
slabs, so that is a bucket's score, and buckets are visited in ascending score.
The score of a neighbour's bucket is (r^2 + WIDTH^2 / 12) times a chi-square
variable (the second term is the spread within a slab); probing ends where a
vector as near as the query's current k-th neighbour would be missed with the
table's share of 1 - ``RECALL``, and never before k candidates have been seen.
There is no cap on buckets, probes or candidates: the rule is the same at every
size.  Candidates of all tables are scored by the exact inner product and merged.

The largest inner product is turned into the smallest distance by one more
coordinate: x -> (x / M, sqrt(1 - |x|^2 / M^2)), q -> (q / |q|, 0), with M the
largest norm.

Scale: the index is ranged by (table, bucket, row), so a bucket with a third of
all vectors lies in many tasks.  Queries go in blocks of at most ``QUERY_BYTES``;
one block is broadcast at a time and every task streams its buckets past it.
A task returns one row of at most k neighbours per query.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlab.llm.common import map_arrow, materialize
from feedlab.session import scratch_path

TABLES = 2
HASHES = 48
WIDTH = 0.5
SLABS = 32           # a slab's number is a byte of the code; the outermost are open
RECALL = 0.9         # aimed at by the probing bound, per neighbour
SEED = 13
# Bytes of a broadcast block of queries, rows of the sample that gives a first
# bound of the k-th neighbour, and indexed rows of one task.
QUERY_BYTES = 16 << 20
FIRST_ROWS = 4096
TASK_ROWS = 16384
_CHUNK = 64          # queries scored together against a batch of buckets


def chi_square_quantile(p: float, k: int) -> float:
    """Wilson and Hilferty's approximation."""
    c = 2 / (9 * k)
    return k * (1 - c + NormalDist().inv_cdf(p) * math.sqrt(c)) ** 3


def probing_bound(tables: int = TABLES, hashes: int = HASHES, recall: float = RECALL) -> float:
    """Score, in units of r^2 + WIDTH^2 / 12, up to which a table's buckets are
    visited: all tables together miss 1 - recall."""
    return chi_square_quantile(1 - (1 - recall) ** (1 / tables), hashes)


def directions(dim: int, tables: int = TABLES, hashes: int = HASHES, seed: int = SEED):
    """(tables, hashes, dim + 1) normal directions and (tables, hashes) offsets."""
    rng = np.random.default_rng(seed)
    return rng.standard_normal((tables, hashes, dim + 1)), rng.uniform(0, WIDTH, (tables, hashes))


def inner_products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Summed row by row, so equal vectors get equal products wherever they lie."""
    return (rows * q).sum(axis=1)


def _matrix(column: pa.Array, dtype: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, dim).astype(np.float64)


def _valid(dtype: str):
    """vec_id, dim, norm, vec (bytes) of the vectors that take part."""
    def run(batches):
        for b in batches:
            ids, lists = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list = [[], [], [], []]
            for i, x in zip(ids, lists):
                if i is None or not x or None in x:
                    continue
                v = np.array(x, dtype=dtype)
                w = v.astype(np.float64)
                norm = float(np.sqrt((w * w).sum()))
                if norm > 0 and math.isfinite(norm):
                    for c, y in zip(out, (i, len(x), norm, v.tobytes())):
                        c.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.float64()),
                 pa.array(out[3], pa.binary())], names=["vec_id", "dim", "norm", "vec"])
    return run


def _projections(x: np.ndarray, last: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.concatenate([x, last[:, None]], axis=1) @ a.T + b


def _codes(proj: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(proj / WIDTH) + SLABS // 2, 0, SLABS - 1).astype(np.uint8)


def _middles(code: np.ndarray) -> np.ndarray:
    return ((code.astype(np.float32) - SLABS // 2) + 0.5) * np.float32(WIDTH)


def _buckets(dtype: str, dim: int, top: float, tables: int, hashes: int, seed: int):
    """One row per vector and table: its bucket's code."""
    a, off = directions(dim, tables, hashes, seed)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(2), dtype, dim) / top
            last = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
            for t in range(tables):
                code = _codes(_projections(x, last, a[t], off[t]))
                packed = pa.array([c.tobytes() for c in code], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, t, dtype=np.int32)), packed, *b.columns],
                    names=["table", "code", "row", "vec_id", "vec"])
    return run


def _first_bound(dtype: str, dim: int, k: int, rows: np.ndarray, sample: np.ndarray):
    """The k-th best product within the sample: no more than the true one."""
    def run(batches):
        for b in batches:
            out = []
            for row, v in zip(b.column(0).to_pylist(), b.column(2)):
                s = inner_products(sample, np.frombuffer(v.as_py(), dtype).astype(np.float64))[rows != row]
                out.append(float(np.partition(s, -k)[-k]) if len(s) >= k else -math.inf)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())],
                                             names=["row", "vec_id", "vec", "bound"])
    return run


class _Best:
    """A query's k best so far: products, ids and row numbers.  ``bound`` is the
    k-th product, ``known`` the larger of it and a bound known from elsewhere."""

    def __init__(self, k: int, known: float = -math.inf):
        self.k, self.bound, self.known = k, -math.inf, known
        self.score, self.id, self.row = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, score, ids, rows):
        keep = score >= self.bound
        if not keep.any():
            return
        score, ids, rows = (np.concatenate(x) for x in ((self.score, score[keep]), (self.id, ids[keep]),
                                                       (self.row, rows[keep])))
        _, first = np.unique(rows, return_index=True)       # a row may come from several tables
        score, ids, rows = score[first], ids[first], rows[first]
        order = np.lexsort((rows, ids, -score))[:self.k]
        self.score, self.id, self.row = score[order], ids[order], rows[order]
        if len(order) == self.k:
            self.bound = float(self.score[-1])
            self.known = max(self.known, self.bound)


def _probe(queries: list, dtype: str, dim: int, top: float, k: int, tables: int, hashes: int, seed: int,
           bound: float):
    """Every batch of indexed rows past a block of queries (row, id, bytes, first bound)."""
    a, off = directions(dim, tables, hashes, seed)
    q = np.frombuffer(b"".join(x[2] for x in queries), dtype).reshape(-1, dim).astype(np.float64)
    norm = np.sqrt((q * q).sum(axis=1))
    own = np.array([x[0] for x in queries], dtype=np.int64)
    spread, slack = WIDTH ** 2 / 12, dim * 2.0 ** -22
    reach = lambda best, j: bound * (max(0.0, 2 - 2 * best.known / (top * norm[j])) + spread)

    q32 = q.astype(np.float32)

    def batch(table, code, rows, ids, x, best):
        x32 = x.astype(np.float32)
        fresh = np.concatenate([[True], (code[1:] != code[:-1]).any(axis=1)])
        start = np.flatnonzero(fresh)
        size = np.diff(np.concatenate([start, [len(code)]]))
        middle = _middles(code[start])
        square = (middle * middle).sum(axis=1)
        for at in range(0, len(q), _CHUNK):
            part = slice(at, min(at + _CHUNK, len(q)))
            unit = q[part] / norm[part, None]
            y = _projections(unit, np.zeros(len(unit)), a[table], off[table]).astype(np.float32)
            score = (y * y).sum(axis=1)[:, None] - 2 * (y @ middle.T) + square
            for j in range(part.start, part.stop):
                s = score[j - at]
                # until it has k neighbours a query goes on to the next bucket anyway
                full, step = len(best[j].row) == k, 64
                near = np.flatnonzero(s <= reach(best[j], j)) if full else np.arange(len(s))
                while len(near):
                    # the next buckets in estimated success order, more at a time
                    first = np.argpartition(s[near], step)[:step] if len(near) > step else slice(None)
                    visit, near = near[first], np.delete(near, first)
                    n = size[visit]
                    at_rows = np.repeat(start[visit] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    at_rows = at_rows[rows[at_rows] != own[j]]
                    # single precision puts aside what is surely beyond the k-th
                    rough = x32[at_rows] @ q32[j]
                    at_rows = at_rows[rough >= best[j].bound - slack * top * norm[j]]
                    best[j].add(inner_products(x[at_rows], q[j]), ids[at_rows], rows[at_rows])
                    full, step = len(best[j].row) == k, step * 8
                    if full:
                        near = near[s[near] <= reach(best[j], j)]

    def run(batches):
        best = [_Best(k, x[3]) for x in queries]
        for b in batches:
            if not b.num_rows:
                continue
            table, rows, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            code = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            x = _matrix(b.column(4), dtype, dim)
            edges = np.flatnonzero(np.diff(table)) + 1
            for lo, hi in zip([0, *edges], [*edges, b.num_rows]):
                batch(int(table[lo]), code[lo:hi], rows[lo:hi], ids[lo:hi], x[lo:hi], best)
        found = [(x[0], x[1], y) for x, y in zip(queries, best) if len(y.row)]
        for at in range(0, len(found), 1024):
            part = found[at:at + 1024]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.int64()),
                 pa.array([p[2].row for p in part], pa.list_(pa.int64())),
                 pa.array([p[2].id for p in part], pa.list_(pa.int64())),
                 pa.array([p[2].score for p in part], pa.list_(pa.float64()))],
                names=["query_row", "query_id", "rows", "ids", "scores"])
    return run


_FOUND = "query_row long, query_id long, rows array<long>, ids array<long>, scores array<double>"


def _merge(k: int):
    """A query's lists, which arrive together, into one of k."""
    def run(batches):
        now, best = None, None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([now[1]], pa.int64()), pa.array([best.id], pa.list_(pa.int64())),
                 pa.array([best.score], pa.list_(pa.float64()))], names=["query_id", "ids", "scores"])
        for b in batches:
            for row, qid, rows, ids, scores in zip(*(c.to_pylist() for c in b.columns)):
                if now != (row, qid):
                    if now:
                        yield out()
                    now, best = (row, qid), _Best(k)
                best.add(np.array(scores), np.array(ids, dtype=np.int64), np.array(rows, dtype=np.int64))
        if now:
            yield out()
    return run


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id",
                       embedding: str = "embedding", tables: int = TABLES, hashes: int = HASHES,
                       recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the largest inner
    product that probing finds for each row of ``vectors`` where the condition
    ``is_query`` (over vec_id) holds, its own row aside; nearest first, equal
    products by ascending vec_id.

    Rows with a null id, and vectors that are null, empty, zero or hold a null or
    non-finite component, take no part; of several lengths only the commonest
    takes part (the longer of equally common ones).  Rows that share an id are
    rows of their own: each is a candidate, and a query if its id is one.  With
    fewer than k candidates all of them are returned.  An empty table gives an
    empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    dtype = "<f4" if isinstance(source.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    if dtype == "<f8":
        source = source.withColumn("embedding", F.col("embedding").cast("array<double>"))
    base = map_arrow(source, _valid(dtype), "vec_id long, dim int, norm double, vec binary")
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    shape = (base.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top"))
             .orderBy(F.desc("n"), F.desc("dim")).first())
    result = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], result)
    dim, n, top = shape.dim, shape.n, shape.top
    rows = base.filter(F.col("dim") == dim).select("row", "vec_id", "vec")
    parts = max(spark.sparkContext.defaultParallelism, -(-n * tables // TASK_ROWS))
    index = map_arrow(rows, _buckets(dtype, dim, top, tables, hashes, seed),
                      "table int, code binary, row long, vec_id long, vec binary")
    index = materialize(index.repartitionByRange(parts, "table", "code", "row")
                        .sortWithinPartitions("table", "code", "row"), "ann-index")

    sample = rows.orderBy(F.xxhash64("row")).limit(FIRST_ROWS).collect()
    drawn = np.frombuffer(b"".join(r.vec for r in sample), dtype).reshape(-1, dim).astype(np.float64)
    queries = map_arrow(rows.filter(is_query), _first_bound(dtype, dim, k, np.array([r.row for r in sample]), drawn),
                        "row long, vec_id long, vec binary, bound double")
    queries = materialize(queries, "ann-queries")
    blocks = -(-queries.count() * (dim * 8 + 64) // QUERY_BYTES)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, blocks))))
    found = []
    for i in range(blocks):
        block = [(r.row, r.vec_id, r.vec, r.bound) for r in
                 queries.filter(F.col("block") == i).select("row", "vec_id", "vec", "bound").collect()]
        if block:
            path = scratch_path(spark, "ann-found")
            map_arrow(index, _probe(block, dtype, dim, top, k, tables, hashes, seed,
                                    probing_bound(tables, hashes, recall)), _FOUND).write.parquet(path)
            found.append(path)
    if not found:
        return spark.createDataFrame([], result)
    lists = spark.read.parquet(*found)
    merged = map_arrow(lists.repartition("query_row").sortWithinPartitions("query_row"), _merge(k),
                       "query_id long, ids array<long>, scores array<double>")
    pairs = merged.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("i", "x"))
    return pairs.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.ids").alias("vec_id"),
                        F.col("x.scores").alias("score"))
