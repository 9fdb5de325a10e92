"""Ranked lexical search for many queries by common-subexpression evaluation.

The items are evaluated together.  Terms that the same items hold, equally
often, form a shared term set (``term_sets``): a document's partial score for
the set is accumulated once, whatever the number of items that use it.  Sets
that still meet in several items are merged pairwise, the most shared pair
first, into a query-sharing graph (``sharing_graph``): every node is the sum of
two earlier nodes, every item the sum of a few nodes.  A task materialises the
partial accumulators of a run of documents as integer arrays, walks the graph
once and keeps each item's best documents.

Scale: documents are read twice, once for their query terms (written as a short
posting row per document) and, as those rows, for the scores.  Items go in
blocks of at most ``BLOCK_TERMS`` distinct terms or one item; a block's terms are
what is broadcast.  A task returns at most k documents per item, so the last
step ranks (tasks x k) rows per item, cut before the shuffle as well.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlab.llm.common import map_arrow, materialize, text_bytes

# Distinct terms of the items of a block, and cells of a task's accumulators.
BLOCK_TERMS = 200_000
CELLS = 4_000_000
# A pair of nodes is merged while at least this many items share it.
LEAST_SHARED = 2

# UTF-8 bytes: separators of a term become spaces, A-Z become a-z.
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes(32 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_FOLD).split()


def term_sets(items: list[Counter]) -> tuple[list[list[int]], list[dict[int, int]]]:
    """Sets of terms held equally often by the same items, and each item as
    {set: times}.  ``items`` are counters of term numbers."""
    holders: dict[int, list[tuple[int, int]]] = {}
    for i, item in enumerate(items):
        for term, times in item.items():
            holders.setdefault(term, []).append((i, times))
    sets: dict[tuple, list[int]] = {}
    for term in sorted(holders):
        sets.setdefault(tuple(holders[term]), []).append(term)
    parts: list[dict[int, int]] = [{} for _ in items]
    for number, key in enumerate(sets):
        for i, times in key:
            parts[i][number] = times
    return list(sets.values()), parts


def sharing_graph(n_sets: int, parts: list[dict[int, int]], least: int = LEAST_SHARED):
    """Nodes (a, times of a, b, times of b) numbered from n_sets on, and each item
    as {node: times}.  The most shared pair of an item's parts becomes a node,
    again and again, while at least ``least`` items share it."""
    item_parts = [set(p.items()) for p in parts]
    holders: dict[tuple[int, int], set[int]] = {}
    for i, p in enumerate(item_parts):
        for x in p:
            holders.setdefault(x, set()).add(i)

    def partners(x) -> Counter:
        """Parts beside x in its items, by the number of items."""
        return Counter(y for i in holders[x] for y in item_parts[i] if y != x)

    def best(x):
        """(items, x, partner) of x's most shared partner, the smallest of equals."""
        near = partners(x)
        if not near:
            return None
        y, n = min(near.items(), key=lambda e: (-e[1], e[0]))
        return (-n, x, y) if n >= least else None

    # A candidate is looked up again when it comes to the front: what is stored
    # can only have become less shared.
    heap = [c for x in holders if len(holders[x]) >= least and (c := best(x))]
    heapq.heapify(heap)
    nodes: list[tuple[int, int, int, int]] = []
    while heap:
        _, x, _ = top = heapq.heappop(heap)
        now = best(x) if len(holders[x]) >= least else None
        if now is None:
            continue
        if now != top:
            heapq.heappush(heap, now)
            continue
        y = now[2]
        new = (n_sets + len(nodes), 1)
        nodes.append((*x, *y))
        users = holders[x] & holders[y]
        holders[new] = users
        for i in users:
            item_parts[i] -= {x, y}
            item_parts[i].add(new)
        holders[x] = holders[x] - users
        holders[y] = holders[y] - users
        for z in (x, y, new):
            if len(holders[z]) >= least and (c := best(z)):
                heapq.heappush(heap, c)
    return nodes, [dict(p) for p in item_parts]


def _postings(vocabulary: dict[bytes, int]):
    """doc_id, n and the query terms of each document with their occurrences."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):          # a short run of texts at a time
                part = b.slice(at, 512)
                ns, ids, tfs, ends = [], [], [], [0]
                for text in part.column(1):
                    found = terms(text.as_py())
                    ns.append(len(found))
                    count = Counter(t for t in map(vocabulary.get, found) if t is not None)
                    ids.extend(count)
                    tfs.extend(count.values())
                    ends.append(len(ids))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])
    return run


class Plan:
    """A block's sets, graph and items as flat arrays."""

    def __init__(self, items: list[Counter], n_terms: int):
        sets, parts = term_sets(items)
        self.nodes, sums = sharing_graph(len(sets), parts)
        self.n_sets, self.n_items = len(sets), len(items)
        self.set_of = np.full(n_terms, -1, dtype=np.int64)
        for number, members in enumerate(sets):
            self.set_of[members] = number
        self.items = [sorted(s.items()) for s in sums]

    def scores(self, partial: np.ndarray) -> np.ndarray:
        """(items, documents) from the (sets, documents) accumulators."""
        acc = np.empty((self.n_sets + len(self.nodes), partial.shape[1]), dtype=np.int64)
        acc[:self.n_sets] = partial
        for at, (a, ta, b, tb) in enumerate(self.nodes, self.n_sets):
            np.add(acc[a] if ta == 1 else acc[a] * ta, acc[b] if tb == 1 else acc[b] * tb, out=acc[at])
        out = np.zeros((self.n_items, partial.shape[1]), dtype=np.int64)
        for i, parts in enumerate(self.items):
            for node, times in parts:
                out[i] += acc[node] if times == 1 else acc[node] * times
        return out


class _Top:
    """The best k documents of each item so far, ids null last among equals."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.ones(n_items, dtype=np.int64)
        self.rows = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))] * n_items

    def add(self, score, ids, null):
        hit, doc = np.nonzero(score >= self.floor[:, None])
        if not len(hit):
            return
        edges = np.flatnonzero(np.diff(hit)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(hit)]):
            i, d = int(hit[lo]), doc[lo:hi]
            s, x, no = (np.concatenate(p) for p in zip(self.rows[i], (score[i, d], ids[d], null[d])))
            order = np.lexsort((x, no, -s))[:self.k]
            self.rows[i] = s[order], x[order], no[order]
            if len(order) == self.k:
                self.floor[i] = s[order[-1]]


def _search(plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, first_item: int, k: int):
    """Each item's best k documents of the task: item, doc_id, score."""
    width = max(16, CELLS // max(1, plan.n_sets + len(plan.nodes) + plan.n_items))

    def run(batches):
        top = _Top(plan.n_items, k)
        for b in batches:
            for at in range(0, b.num_rows, width):
                part = b.slice(at, width)
                n = part.column(1).to_numpy()
                sizes = np.diff(part.column(2).offsets.to_numpy())
                term, tf = (part.column(c).flatten().to_numpy() for c in (2, 3))
                doc = np.repeat(np.arange(part.num_rows), sizes)
                m = (100 - 75 + (75 * n * n_docs) // n_terms)[doc]
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                partial = np.zeros((plan.n_sets, part.num_rows), dtype=np.int64)
                np.add.at(partial, (plan.set_of[term], doc), value)
                top.add(plan.scores(partial), part.column(0).fill_null(0).to_numpy(zero_copy_only=False),
                        part.column(0).is_null().to_numpy(zero_copy_only=False))
        item = np.concatenate([np.full(len(s), i, dtype=np.int64) for i, (s, _, _) in enumerate(top.rows)])
        score, ids, null = (np.concatenate(x) for x in zip(*top.rows))
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item + first_item), pa.array(ids, mask=null), pa.array(score)],
                                             names=["item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, block_terms: int) -> DataFrame:
    """row, item_id, terms (sorted list with repeats), block.  A running count of
    terms cuts the items into blocks; counts, not texts, pass through the window."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], pa.array([terms(t) for t in b.column(2).to_pylist()], pa.list_(pa.binary()))],
                names=["row", "item_id", "terms"])
    split = materialize(map_arrow(items.withColumn("row", F.monotonically_increasing_id())
                                  .select("row", "item_id", "text"), run,
                                  "row long, item_id long, terms array<binary>"), "search-items")
    # rows are cut into ranges of a few thousand; a range's total is one row
    sizes = split.select("row", F.size("terms").cast("long").alias("size"),
                         F.floor(F.col("row") / 4096).alias("range"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("range").agg(F.sum("size").alias("all")).withColumn(
        "before", F.coalesce(F.sum("all").over(before), F.lit(0)))
    inside = Window.partitionBy("range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
                .join(totals, "range")
                .select("row", F.floor((F.col("before") + F.col("inside")) / block_terms).alias("block")))
    return materialize(split.join(numbered, "row"), "search-blocks")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item.

    A term's weight is w = floor(1000 ln((2N + 2) / (2 df + 1))) over the N
    documents with a term; a document's score sums w * (10^9 tf div (1000 tf + 8 m)),
    m = 25 + 75 n N div L, over the item's terms, repeats included.  Documents
    with score 0 are not returned; equal scores go by ascending doc_id, null ids
    last.  A null text has no terms, so neither a document without terms nor an
    item without terms is in the result.  Every row is a document or an item of
    its own, also if rows repeat or share an id.  Very long texts are handled
    whole, one at a time.  Empty tables give an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    asked = _blocks(items.select(F.col(item_id).cast("long").alias("item_id"), text_bytes(item_text).alias("text")),
                    block_terms)
    found = None
    for (block,) in asked.select("block").distinct().orderBy("block").toLocalIterator():
        rows = asked.filter(F.col("block") == block).orderBy("row").select("item_id", "terms").collect()
        vocabulary: dict[bytes, int] = {}
        bags = [Counter(vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r.terms) for r in rows]
        if not vocabulary:
            continue
        posts = materialize(map_arrow(texts, _postings(vocabulary),
                                      "doc_id long, n long, terms array<int>, tfs array<long>"), "search-postings")
        n_docs, n_terms = posts.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for r in posts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()],
                           dtype=np.int64)
        plan = Plan(bags, len(vocabulary))
        best = map_arrow(posts.filter("size(terms) > 0"), _search(plan, weights, n_docs, n_terms, 0, k),
                         "item long, doc_id long, score long")
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item long, item_id long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = materialize(best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                             .join(ids, "item").select("item_id", "rank", "doc_id", "score"), "search-ranked")
        found = ranked if found is None else found.unionByName(ranked)
    return found if found is not None else spark.createDataFrame(
        [], "item_id long, rank int, doc_id long, score long")
