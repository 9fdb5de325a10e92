"""Nearest vectors of many queries through an inverted file.

Vectors are scaled to length one and put into lists around centroids; a query is
compared with the vectors of the lists nearest to it only.  The centroids are
fitted on a bounded sample (``SAMPLE_ROWS``); every vector is indexed.  How many
lists a query visits is calibrated on the same sample: the fewest that hold the
wanted share of the sample's own neighbours, which lie further apart than those
of all rows and so ask for more lists, not fewer.

``exact=True`` adds a second pass.  A list whose members lie within an angle r of
its centroid holds nothing nearer to the query than (angle to the centroid) - r,
so only the unvisited lists that may still beat the query's k-th score are read.

Scale: vectors and queries meet in groups of one (list, block).  A list is cut
into blocks of about ``BLOCK_ROWS`` vectors by a hash of the id, so one that holds a
third of all vectors is spread over tasks.  A group compares by matrix products, a
slab of ``_SLAB`` scores at once, and hands on only what may be among a query's k
best: those are scored again component by component, so the order of the sums, and
with it every digit, is that of a plain fold.  The driver holds the sample, the centroids and nothing else.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlab.session import materialize, ship_package

SAMPLE_ROWS = 16_384
CALIBRATION_QUERIES = 512
MAX_LISTS = 1_024
BLOCK_ROWS = 50_000
SCORE_DIGITS = 9
SEED = 42
# Room for rounding in the bound of the exact pass.
_SLACK = 1e-7
# Scores this near may be equal once rounded, whatever the order of their sums.
_NEAR = 1.5 * 10 ** -SCORE_DIGITS
# Scores of a group held at once.
_SLAB = 1 << 22


@dataclass(frozen=True)
class ListIndex:
    """``rows``: ``(id, unit, list, block)``; ``lists``: one row a list with its
    centroid, smallest cosine to a member and number of blocks; ``probes``: lists a
    query visits."""

    rows: DataFrame
    lists: DataFrame
    probes: int


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def unit_vectors(vectors: DataFrame, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """``(id, unit)``.  Rows without an id, and vectors that are null, empty, zero
    or hold a null or non-finite component, have no direction and are left out."""
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    # scaled by the largest component first: squares neither overflow nor vanish
    v = v.withColumn("m", F.array_max(F.transform("v", F.abs))).where("m > 0")
    v = v.withColumn("s", F.transform("v", lambda x: x / F.col("m")))
    return v.withColumn("n", F.sqrt(_dot(F.col("s"), F.col("s")))).select(
        "id", F.transform("s", lambda x: x / F.col("n")).alias("unit"))


def probes_for(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float,
               queries: int = CALIBRATION_QUERIES) -> int:
    """Fewest nearest lists that hold ``recall`` of the sample's k nearest pairs."""
    if len(sample) < 2:
        return len(centroids)
    home = (sample @ centroids.T).argmax(axis=1)
    needed = []
    for i in range(min(queries, len(sample))):
        near = sample @ sample[i]
        near[i] = -np.inf
        best = np.argsort(-near, kind="stable")[:min(k, len(sample) - 1)]
        place = np.empty(len(centroids), dtype=np.int64)
        place[np.argsort(-(centroids @ sample[i]), kind="stable")] = np.arange(len(centroids))
        needed.append(place[home[best]] + 1)
    needed = np.sort(np.concatenate(needed))
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)])


def build_index(vectors: DataFrame, k: int, recall: float = 0.95, id_col: str = "id", vec_col: str = "vec",
                lists: int | None = None, block_rows: int = BLOCK_ROWS) -> ListIndex | None:
    """Index of every vector, or None if there is none.  ``lists`` defaults to the
    square root of the number of vectors, at most ``MAX_LISTS``."""
    unit = materialize(unit_vectors(vectors, id_col, vec_col), "unit-vectors")
    n = unit.count()
    if not n:
        return None
    # drawn by content: rows that repeat one id or one vector are drawn by their number
    drawn = unit.withColumn("_row", F.monotonically_increasing_id())
    drawn = materialize(drawn.orderBy(F.xxhash64("id", "_row"), "_row").limit(SAMPLE_ROWS).select("unit"), "sample")
    wanted = max(2, min(lists or math.isqrt(n), MAX_LISTS))  # two at least for the fit, which may find fewer
    model: KMeansModel = KMeans(k=wanted, seed=SEED, maxIter=10, featuresCol="_v", predictionCol="list",
                                distanceMeasure="cosine").fit(drawn.select(array_to_vector("unit").alias("_v")))
    centroids = np.array(model.clusterCenters())
    sample = np.array([r[0] for r in drawn.collect()])
    probes = probes_for(sample, centroids / np.linalg.norm(centroids, axis=1, keepdims=True), k, recall)

    spark = vectors.sparkSession
    # (list, centroid): at most MAX_LISTS rows
    centre = spark.createDataFrame([(i, (c / np.linalg.norm(c)).tolist()) for i, c in enumerate(centroids)],
                                   "list int, centroid array<double>")
    placed = model.transform(unit.withColumn("_v", array_to_vector("unit"))).select("id", "unit", "list")
    placed = materialize(placed, "placed")
    members = placed.join(F.broadcast(centre), "list").groupBy("list").agg(
        F.count(F.lit(1)).alias("members"), F.min(_dot(F.col("unit"), F.col("centroid"))).alias("reach"))
    info = materialize(centre.join(members, "list").withColumn(
        "blocks", F.ceil(F.col("members") / F.lit(block_rows)).cast("int")), "lists")
    rows = placed.join(F.broadcast(info.select("list", "blocks")), "list").select(
        "id", "unit", "list", F.pmod(F.xxhash64("id", "unit"), F.col("blocks")).cast("int").alias("block"))
    return ListIndex(rows, info, min(probes, len(centroids)))


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    lists = lists.combine_chunks()
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def _block_best(k: int, queries: pa.Table, rows: pa.Table) -> pa.Table:
    """``(query_id, id, score)`` of one (list, block): every row that may be among the
    k best of a query, by rounded score and ascending id.  Scores below a query's
    ``floor`` do not count; of equal scores the k first ids do."""
    fields = [("query_id", queries["query_id"].type), ("id", rows["id"].type), ("score", pa.float64())]
    if not queries.num_rows or not rows.num_rows:
        return pa.schema(fields).empty_table()
    rows = rows.take(pc.sort_indices(rows, [("id", "ascending")]))
    both = pa.chunked_array([*rows["id"].chunks, *queries["query_id"].cast(rows["id"].type).chunks])
    code = both.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    own, asked = code[:rows.num_rows], code[rows.num_rows:]
    unit, q = _matrix(rows["unit"]), _matrix(queries["_q"])
    floor = queries["floor"].fill_null(-np.inf).to_numpy()
    at, of, scores = [], [], []
    step = max(1, _SLAB // len(unit))
    for lo in range(0, len(q), step):
        some = slice(lo, lo + step)
        near = q[some] @ unit.T
        near[asked[some, None] == own[None, :]] = -np.inf
        least = np.maximum(floor[some], -2.0)  # below any cosine, above what is left out
        if k < len(unit):
            least = np.maximum(least, np.partition(near, len(unit) - k, axis=1)[:, len(unit) - k])
        i, j = np.nonzero(near >= least[:, None] - _NEAR)
        i += lo
        score = np.zeros(len(i))
        for d in range(unit.shape[1]):
            score += unit[j, d] * q[i, d]
        # rows are in order of their ids: the place among a query's equal scores
        order = np.lexsort((j, -score, i))
        i, j, score = i[order], j[order], score[order]
        fresh = np.append(True, (i[1:] != i[:-1]) | (score[1:] != score[:-1]))[:len(i)]
        first = np.flatnonzero(fresh)
        kept = np.arange(len(i)) - first[np.cumsum(fresh) - 1] < k if len(i) else fresh
        at.append(i[kept])
        of.append(j[kept])
        scores.append(score[kept])
    return pa.Table.from_arrays([queries["query_id"].take(pa.array(np.concatenate(at))),
                                 rows["id"].take(pa.array(np.concatenate(of))), pa.array(np.concatenate(scores))],
                                schema=pa.schema(fields))


def _best(index: ListIndex, visits: DataFrame, k: int) -> DataFrame:
    """The k best of each query among the lists it visits; a query whose ``floor`` is
    not null has k of that similarity already."""
    floor = (F.col("floor") - F.lit(_NEAR)).alias("floor")
    q = visits.select(F.col("id").alias("query_id"), F.col("unit").alias("_q"), floor, "list",
                      F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    ship_package(visits.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in [*q.schema, *index.rows.schema]}
    scored = q.groupBy("list", "block").cogroup(index.rows.groupBy("list", "block")).applyInArrow(
        lambda queries, rows: _block_best(k, queries, rows),
        f"query_id {kinds['query_id']}, id {kinds['id']}, score double")
    return _top(scored.select("query_id", "id", F.round("score", SCORE_DIGITS).alias("similarity")), k)


def _top(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col("id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: ListIndex, queries: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec",
           exact: bool = False) -> DataFrame:
    """``(query_id, rank, id, similarity)``: each query's k vectors of largest cosine
    (rounded to 9 decimals), equal ones by ascending id, its own id left out.

    Queries without a direction have no rows.  Ids should be distinct: rows that
    share the query's id are all left out, and a query id given twice is one query
    whose vectors compete.  ``exact`` returns what comparing all pairs would.
    """
    lists = index.lists.agg(F.collect_list(F.struct("list", "blocks", "reach", "centroid"))).scalar()
    q = unit_vectors(queries, id_col, vec_col).withColumn("_lists", lists)
    ranked = F.transform("_lists", lambda c: F.struct((-_dot(c["centroid"], F.col("unit"))).alias("far"),
                                                       c["list"].alias("list"), c["blocks"].alias("blocks"),
                                                       c["reach"].alias("reach")))
    q = materialize(q.select("id", "unit", F.array_sort(ranked).alias("_order")), "queries")
    near = q.select("id", "unit", F.explode(F.slice("_order", 1, index.probes)).alias("_l"))
    nothing = F.lit(None).cast("double").alias("floor")
    first = _best(index, near.select("id", "unit", "_l.list", "_l.blocks", nothing), k)
    if not exact:
        return first.select("query_id", "rank", "id", "similarity")
    first = materialize(first, "first-pass")
    kth = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"), F.min("similarity").alias("_kth"))
    rest = q.select("id", "unit", F.explode(F.slice("_order", index.probes + 1, MAX_LISTS)).alias("_l"))
    rest = rest.join(kth, F.col("id") == F.col("query_id"), "left")
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -F.col("_l.far"))))
    reach = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_l.reach"))))
    bound = F.cos(F.greatest(F.lit(0.0), angle - reach - F.lit(_SLACK)))
    open_ = F.col("_n").isNull() | (F.col("_n") < k) | (bound + F.lit(_SLACK) >= F.col("_kth"))
    floor = F.when(F.col("_n") >= k, F.col("_kth")).alias("floor")
    second = _best(index, rest.where(open_).select("id", "unit", "_l.list", "_l.blocks", floor), k)
    both = first.select("query_id", "id", "similarity").unionByName(second.select("query_id", "id", "similarity"))
    return _top(both, k).select("query_id", "rank", "id", "similarity")


def nearest_many(vectors: DataFrame, queries: DataFrame, k: int, recall: float = 0.95, id_col: str = "id",
                 vec_col: str = "vec", exact: bool = False) -> DataFrame:
    """``search`` over a fresh index; no vectors give no rows."""
    index = build_index(vectors, k, recall, id_col, vec_col)
    if index is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, id {kind}, similarity double")
    return search(index, queries, k, id_col, vec_col, exact)
