"""The best items of every user without comparing every pair.

Items are ordered by the norm of their factors and cut into tiles.  By the
Cauchy-Schwarz inequality no item of a tile scores more than |user| x (largest
norm of the tile), so a user whose k-th score so far is larger is done: the later
tiles, whose norms are smaller still, are never compared with it.

Scale: the items are written in ranges of descending norm.  Ranges of at most
``RANGE_BYTES`` are broadcast one after the other; between them only the users
that are not done go on, so the rounds get cheaper.  A task holds one batch of
users and one range.  Numpy runs inside the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.session import map_arrow, materialize

RANGE_BYTES = 32 << 20
TILE_ITEMS = 512
# Room for rounding in the bound.
_SLACK = 1 + 1e-9
_STATE = "user long, features array<double>, items array<long>, scores array<double>, compared long"


def _factors(df: DataFrame, id_col: str, features: str) -> DataFrame:
    """Rows with an id and a vector without nulls; others have no score."""
    f = F.col(features).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), f.alias("features")).filter(
        "id is not null and features is not null and size(features) > 0 "
        "and not exists(features, x -> x is null or isnan(x))")


def _round(ids: np.ndarray, items: np.ndarray, norms: np.ndarray, k: int, tile: int):
    """A range of items (descending norm) past every batch of users."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            users = np.array(b.column(1).to_pylist(), dtype=np.float64).reshape(b.num_rows, -1)
            own = np.sqrt((users * users).sum(axis=1))
            best_i = [np.array(x, dtype=np.int64) for x in b.column(2).to_pylist()]
            best_s = [np.array(x, dtype=np.float64) for x in b.column(3).to_pylist()]
            compared = b.column(4).to_numpy().copy()
            kth = np.array([s[k - 1] if len(s) >= k else -np.inf for s in best_s])
            active = np.arange(b.num_rows)
            for at in range(0, len(ids), tile):
                active = active[own[active] * norms[at] * _SLACK >= kth[active]]
                if not len(active):
                    break
                part = slice(at, at + tile)
                scores = users[active] @ items[part].T
                compared[active] += 1
                for row, u in enumerate(active):
                    new = np.flatnonzero(scores[row] >= kth[u])
                    if not len(new):
                        continue
                    s, i = np.concatenate([best_s[u], scores[row, new]]), np.concatenate([best_i[u], ids[part][new]])
                    order = np.lexsort((i, -s))[:k]
                    best_s[u], best_i[u] = s[order], i[order]
                    if len(order) == k:
                        kth[u] = s[order[-1]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(best_i, pa.list_(pa.int64())), pa.array(best_s, pa.list_(pa.float64())),
                 pa.array(compared)], names=["user", "features", "items", "scores", "compared"])
    return run


def best_items(users: DataFrame, items: DataFrame, k: int, id_col: str = "id", features: str = "features",
               range_bytes: int = RANGE_BYTES, tile: int = TILE_ITEMS) -> tuple[DataFrame, int]:
    """``(user, items, scores, compared)`` and the number of tiles of all items.

    ``items`` are a user's k items of largest inner product, best first, equal
    scores by ascending id; fewer items than k are all returned.  ``compared``
    counts the tiles that the user was compared with.  Users without items get
    empty lists.  All vectors must have one length.
    """
    spark = users.sparkSession
    ranked = materialize(_factors(items, id_col, features).withColumn("norm", F.sqrt(F.aggregate(
        "features", F.lit(0.0), lambda a, x: a + x * x))), "items")
    n, width = ranked.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    none = F.array()
    state = _factors(users, id_col, features).select(
        F.col("id").alias("user"), "features", none.cast("array<long>").alias("items"),
        none.cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("compared"))
    if not n:
        return state.drop("features"), 0
    parts = max(1, -(-n * (8 * width + 16) // range_bytes))
    ordered = materialize(ranked.repartitionByRange(parts, F.desc("norm"), F.asc("id"))
                          .withColumn("part", F.spark_partition_id()), "items-by-norm")
    tops = [(r["part"], r["top"]) for r in
            ordered.groupBy("part").agg(F.max("norm").alias("top")).orderBy("part").collect()]
    finished, tiles = [], 0
    state = materialize(state, "users")
    own = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x))
    for part, top in tops:
        rows = ordered.filter(F.col("part") == part).orderBy(F.desc("norm"), "id").collect()
        ids = np.array([r["id"] for r in rows], dtype=np.int64)
        matrix = np.array([r["features"] for r in rows], dtype=np.float64)
        tiles += -(-len(ids) // tile)
        if finished or part != tops[0][0]:
            goes_on = (F.size("scores") < k) | (own * top * _SLACK >= F.element_at("scores", -1))
            finished.append(state.filter(~goes_on))
            state = state.filter(goes_on)
        state = materialize(map_arrow(state, _round(ids, matrix, np.array([r["norm"] for r in rows]), k, tile), _STATE), "users")
        if state.isEmpty():
            break
    for f in finished:
        state = state.unionByName(f)
    return state.drop("features"), tiles


def recommend_pruned(users: DataFrame, items: DataFrame, k: int, id_col: str = "id", features: str = "features",
                     user: str = "uid", item: str = "urlid") -> DataFrame:
    """``best_items`` as rows: user, item, rank (from 1), rating."""
    best, _ = best_items(users, items, k, id_col, features)
    rows = best.select(F.col("user").alias(user), F.posexplode(F.arrays_zip("items", "scores")).alias("_p", "_x"))
    return rows.select(user, F.col("_x.items").alias(item), (F.col("_p") + 1).alias("rank"), F.col("_x.scores").alias("rating"))
