"""Conversation prefix trie through minimal-perfect-hash node tables.

A conversation's prefix has a digest that adds up: the exclusive-or of one
128-bit hash per (position, turn).  Every step over a conversation's turns is
therefore a running aggregate, which ``running`` computes over range partitions
with one carry per partition, so a conversation with a third of all turns is
spread over many tasks.

1. Distinct prefix digests are the nodes: an aggregate with map-side combine
   counts members and finds the smallest one.  The same aggregate compares what
   a digest stands for (depth, parent's digest, SHA-256 of the last turn); if two
   different prefixes ever share a digest, the salt is changed and the digests
   are drawn again (``collisions``).
2. Nodes with one member need no table: below them lies one path.
3. Shared nodes are cut into shards of whole subtrees with at most
   ``SHARD_ROWS`` prefixes.  A task puts its nodes into a minimal perfect hash
   (``MinimalPerfectHash``), whose slots store the whole digests and are compared
   on every look-up, scatters the counts into flat arrays by slot, and adds each
   depth's arrays to its parents' slots, deepest first.
4. What lies above the shards (subtrees with more prefixes) takes the shards'
   totals as its own start and is cut again with a larger bound, until it fits
   one table.  At a depth there are at most (prefixes / bound) such nodes.
5. Member lists of a node are hashed from a range-partitioned order: ranges
   become pieces of text, and the node's pieces run through one SHA-256.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlab.llm.common import map_arrow, materialize

# Prefixes below a shard's root, nodes of a task, rows of a range partition,
# bytes of a piece of a member list, and the factor between bounds of step 4.
SHARD_ROWS = 20_000
TASK_NODES = 40_000
RANGE_ROWS = 200_000
PIECE_BYTES = 1 << 20
GROWTH = 16
GROUP = 5
HEAD_MODULUS = 9
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def running(df: DataFrame, key: str, order: list[Column], value: Column, how, name: str, rows: int,
            drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``name``: the aggregate ``how`` of ``value`` over the key's rows up
    to this one.  Rows are ranged and sorted by key and order; a partition is
    summed on its own, and at most one key per partition goes on from the
    partition before it, so the carries are at most one row per partition.
    Columns that serve the order alone may be dropped once the rows are sorted."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // RANGE_ROWS))
    # the number of a sorted row has its partition in the bits from 33 on
    ranged = materialize(df.withColumn("_v", value).repartitionByRange(parts, key, *order)
                         .sortWithinPartitions(key, *order).withColumn("_at", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright("_at", 33)).drop(*drop), "trie-ranged")
    here = Window.partitionBy(key, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (ranged.groupBy(key, "_part").agg(how("_v").alias("_all"))
             .withColumn("_carry", how("_all").over(before)).filter("_carry is not null")
             .select(key, "_part", "_carry"))
    both = {F.sum: lambda a, b: a + b, F.bit_xor: lambda a, b: a.bitwiseXOR(b)}[how]
    return (ranged.withColumn("_here", how("_v").over(here)).join(F.broadcast(carry), [key, "_part"], "left")
            .withColumn(name, F.coalesce(both(F.col("_here"), F.col("_carry")), "_here"))
            .drop("_v", "_at", "_part", "_here", "_carry"))


# --- one shard's table ------------------------------------------------------

class MinimalPerfectHash:
    """Slots 0..n-1 for n distinct 128-bit digests (Limasset et al., "Fast and
    Scalable Minimal Perfect Hashing for Massive Key Sets", 2017).

    A level hashes the keys left over into a bit array; keys alone in their cell
    take it, the others go to the next level.  A key's slot is the rank of its
    cell.  ``slots`` compares the stored digest, so a foreign key gives -1.
    """

    GAMMA = 2

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[np.ndarray] = []          # rank of each cell of a level, -1 where none
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        left, used = np.arange(len(hi)), 0
        while len(left):
            size = max(1, self.GAMMA * len(left))
            cell = self._cell(hi[left], lo[left], len(self.levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            rank = np.where(alone, used + np.cumsum(alone) - 1, -1)
            self.levels.append(rank)
            fits = alone[cell]
            slot = rank[cell[fits]]
            self.hi[slot], self.lo[slot] = hi[left[fits]], lo[left[fits]]
            used, left = used + len(slot), left[~fits]

    @staticmethod
    def _cell(hi, lo, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = hi.view(np.uint64) ^ (lo.view(np.uint64) * np.uint64(2 * level + 0x9E3779B97F4A7C15))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out, left = np.full(len(hi), -1, dtype=np.int64), np.arange(len(hi))
        for level, rank in enumerate(self.levels):
            found = rank[self._cell(hi[left], lo[left], level, len(rank))]
            out[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
        hit = out >= 0
        same = np.zeros(len(hi), dtype=bool)
        same[hit] = (self.hi[out[hit]] == hi[hit]) & (self.lo[out[hit]] == lo[hit])
        return np.where(same, out, -1)


_NODE = "hi long, lo long, phi long, plo long, depth long, n_convs long, nbytes long, kids long, leaves long, saved long"
_TOTAL = "hi long, lo long, phi long, plo long, inner boolean, n_children long, n_leaves long, saved_tokens long"


def _accumulate(batches):
    """The partition's nodes with their subtree totals.  kids, leaves and saved are
    what children outside the table have contributed already."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    hi, lo, phi, plo, depth, n, size, kids, leaves, saved = (
        np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches]) for i in range(10))
    table = MinimalPerfectHash(hi, lo)
    slot = table.slots(hi, lo)
    if (slot < 0).any() or len(np.unique(slot)) != len(slot):
        raise RuntimeError("a node's slot does not hold its digest")
    up = table.slots(phi, plo)
    up[depth == 0] = -1
    parent, level = np.empty_like(up), np.empty_like(depth)
    parent[slot], level[slot] = up, depth
    # scattered by slot: members, own contributions and what came from outside
    children, leaf, total = np.empty_like(kids), np.empty_like(kids), np.empty_like(kids)
    children[slot], leaf[slot], total[slot] = kids, leaves, saved + (n - 1) * size
    np.add.at(children, parent[parent >= 0], 1)
    leaf[children == 0] = 1
    order = np.argsort(-level, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
        at = at[parent[at] >= 0]
        np.add.at(leaf, parent[at], leaf[at])
        np.add.at(total, parent[at], total[at])
    for at in range(0, len(hi), 20_000):
        s = slice(at, at + 20_000)
        cols = (hi[s], lo[s], phi[s], plo[s], up[s] >= 0, children[slot[s]], leaf[slot[s]], total[slot[s]])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                         names=["hi", "lo", "phi", "plo", "inner", "n_children", "n_leaves",
                                                "saved_tokens"])


# --- member lists -----------------------------------------------------------

def _pieces(batches):
    """Comma-joined ids of each run of equal (hi, lo), in pieces."""
    now, first, ids, size = None, None, [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, first, ",".join(ids))],
                                          names=["hi", "lo", "first", "piece"])
    for b in batches:
        for hi, lo, conv in zip(*(c.to_pylist() for c in b.columns)):
            if ids and (now != (hi, lo) or size >= PIECE_BYTES):
                yield out()
                ids, size = [], 0
            if not ids:
                now, first = (hi, lo), conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield out()


def _hash_pieces(batches):
    """SHA-256 of each node's pieces, which arrive together and in order."""
    now, state = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([state.hexdigest()])],
                                          names=["hi", "lo", "sha"])
    for b in batches:
        for hi, lo, _, piece in zip(*(c.to_pylist() for c in b.columns)):
            if now == (hi, lo):
                state.update(b"," + piece.encode())
                continue
            if now:
                yield out()
            now, state = (hi, lo), hashlib.sha256(piece.encode())
    if now:
        yield out()


def _list_hashes(ends: DataFrame) -> DataFrame:
    ranged = ends.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions("hi", "lo", "conv_id")
    pieces = map_arrow(ranged.select("hi", "lo", "conv_id"), _pieces, "hi long, lo long, first long, piece string")
    together = pieces.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first")
    return map_arrow(together, _hash_pieces, "hi long, lo long, sha string")


# --- the trie ---------------------------------------------------------------

def numbered_turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, pos (from 0), content (SHA-256 of role and text), nbytes of the text."""
    filled = rows.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).cast("binary").alias("role"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    content = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), "role", "text"),
                             256))
    turns = filled.withColumn("content", content).withColumn("nbytes", F.octet_length("text").cast("long"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    return materialize(running(turns, "conv_id", order, F.lit(1).cast("long"), F.sum, "pos", filled.count(),
                               drop=("turn", "role", "text"))
                       .select("conv_id", (F.col("pos") - 1).alias("pos"), "content", "nbytes"), "trie-numbered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (conv_id, len) and their rows (conv_id, d from 1,
    len, content, nbytes): the head of the group's first conversation, then the
    own turns behind the head's length."""
    sizes = materialize(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")), "trie-sizes")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD_MODULUS)).cast("long")
    convs = (sizes.withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
             .join(sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own")), "base", "left")
             .withColumn("k", F.least("h", F.coalesce("base_own", F.lit(0).cast("long"))))
             .withColumn("len", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long"))))
    convs = materialize(convs.select("conv_id", "base", "h", "k", "len"), "trie-convs")
    starts = turns.filter(F.col("pos") < HEAD_MODULUS - 1).withColumnRenamed("conv_id", "base")
    first = (convs.filter("k > 0").join(starts, "base").filter("pos < k")
             .select("conv_id", (F.col("pos") + 1).alias("d"), "len", "content", "nbytes"))
    rest = (turns.join(convs, "conv_id").filter("pos >= h")
            .select("conv_id", (F.col("k") + F.col("pos") - F.col("h") + 1).alias("d"), "len", "content", "nbytes"))
    return convs, materialize(first.unionByName(rest), "trie-rebuilt")


def prefixes(rows: DataFrame, salt: int) -> DataFrame:
    """Adds (hi, lo), the digest of the conversation's first d turns, and (phi, plo),
    that of its first d - 1 turns."""
    own = [F.xxhash64(F.lit(f"{salt}{side}"), "d", "content") for side in ("hi", "lo")]
    n = rows.count()
    out = rows.withColumn("own_hi", own[0]).withColumn("own_lo", own[1])
    for side in ("hi", "lo"):
        out = running(out, "conv_id", [F.asc("d")], F.col(f"own_{side}"), F.bit_xor, side, n)
    return materialize(out.select("conv_id", "d", "len", "content", "nbytes", "hi", "lo",
                                  F.col("hi").bitwiseXOR(F.col("own_hi")).alias("phi"),
                                  F.col("lo").bitwiseXOR(F.col("own_lo")).alias("plo")), "trie-prefixes")


def distinct_nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per digest: members, smallest member, members that end here and the
    smallest of them, prefixes below (weight), and ``mixed`` if it stands for more
    than one prefix."""
    one = lambda c: F.max(c) != F.min(c)
    nodes = paths.groupBy("hi", "lo").agg(
        F.min("conv_id").alias("conv_id"), F.max("d").alias("depth"), F.max("phi").alias("phi"),
        F.max("plo").alias("plo"), F.max("nbytes").alias("nbytes"), F.count(F.lit(1)).alias("n_convs"),
        F.sum((F.col("d") == F.col("len")).cast("long")).alias("n_ends"),
        F.min(F.when(F.col("d") == F.col("len"), F.col("conv_id"))).alias("end"),
        F.sum(F.col("len") - F.col("d") + 1).alias("weight"),
        (one("d") | one("phi") | one("plo") | one("content")
         | ((F.max("hi") == 0) & (F.max("lo") == 0))).alias("mixed"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                     F.sum((F.col("len") == 0).cast("long")).alias("n_ends"),
                     F.min(F.when(F.col("len") == 0, F.col("conv_id"))).alias("end"),
                     F.sum(F.col("len") + 1).alias("weight"))
    root = root.filter("n_convs > 0").select(
        zero.alias("hi"), zero.alias("lo"), "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("phi"),
        F.lit(None).cast("long").alias("plo"), zero.alias("nbytes"), "n_convs", "n_ends", "end", "weight",
        F.lit(False).alias("mixed"))
    return nodes.unionByName(root)


def _totals(spark: SparkSession, nodes: DataFrame, paths: DataFrame, shard_rows: int) -> DataFrame:
    """hi, lo, n_children, n_leaves, saved_tokens of the nodes with two or more members."""
    shared = nodes.filter("n_convs > 1")
    lone = (nodes.filter("n_convs = 1 and depth > 0").groupBy("phi", "plo").agg(F.count(F.lit(1)).alias("kids"))
            .select(F.col("phi").alias("hi"), F.col("plo").alias("lo"), "kids"))
    zero = F.lit(0).cast("long")
    none = F.coalesce("kids", zero)
    todo = materialize(shared.join(lone, ["hi", "lo"], "left")
                       .select("hi", "lo", "phi", "plo", "depth", "n_convs", "nbytes", none.alias("kids"),
                               none.alias("leaves"), zero.alias("saved"), "weight", "conv_id"), "trie-shared")
    done, bound = None, shard_rows
    while True:
        heavy = todo.filter(F.col("weight") > bound)
        n_heavy = heavy.count()
        here = todo.filter(F.col("weight") <= bound)
        n_here = here.count()
        if n_here:
            # a conversation leaves the heavy part below its last heavy prefix
            level = (paths.join(heavy.select("hi", "lo"), ["hi", "lo"], "left_semi")
                     .groupBy("conv_id").agg(F.max("d").alias("above")))
            whole = 0 if n_heavy else -1              # the root is the heaviest node of all
            tops = (here.select("conv_id").distinct().join(level, "conv_id", "left")
                    .select("conv_id", (F.coalesce("above", F.lit(whole)) + 1).alias("d")))
            key = (paths.select("conv_id", "d", F.xxhash64("hi", "lo").alias("shard")).join(tops, ["conv_id", "d"])
                   .select("conv_id", "shard"))
            placed = here.join(key, "conv_id", "left").withColumn("shard", F.coalesce("shard", F.lit(0)))
            parts = max(1, -(-n_here // TASK_NODES))
            if n_heavy:
                parts = max(parts, spark.sparkContext.defaultParallelism)
            columns = [c.split()[0] for c in _NODE.split(", ")]
            out = materialize(map_arrow(placed.repartition(parts, "shard")
                                        .select(*[F.coalesce(c, zero).alias(c) for c in columns]), _accumulate, _TOTAL),
                              "trie-totals")
            result = out.select("hi", "lo", "n_children", "n_leaves", "saved_tokens")
            done = result if done is None else done.unionByName(result)
            if n_heavy:
                gained = (out.filter("not inner").groupBy(F.col("phi").alias("hi"), F.col("plo").alias("lo"))
                          .agg(F.count(F.lit(1)).alias("k"), F.sum("n_leaves").alias("l"),
                               F.sum("saved_tokens").alias("s")))
                todo = materialize(heavy.join(gained, ["hi", "lo"], "left").select(
                    "hi", "lo", "phi", "plo", "depth", "n_convs", "nbytes",
                    (F.col("kids") + F.coalesce("k", zero)).alias("kids"),
                    (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"),
                    (F.col("saved") + F.coalesce("s", zero)).alias("saved"), "weight", "conv_id"), "trie-crown")
        if not n_heavy:
            break
        bound *= GROWTH
    if done is None:
        return spark.createDataFrame([], "hi long, lo long, n_children long, n_leaves long, saved_tokens long")
    return done


def prefix_trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", shard_rows: int = SHARD_ROWS, salts: int = 5) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id (smallest
    member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn``, null first; equal numbers go by role and text in
    byte order, so repeated rows are turns of their own, next to each other.  A
    null role or text counts as empty; a row with a null conv_id belongs to no
    conversation.  The group of a conversation c is c - c % 5, with the sign of c
    (as in SQL).  Long texts are hashed whole where they are read, and only their
    digests move.  A conversation that is rebuilt to no turn is a member of the
    root alone.  An empty table gives an empty result; other columns are ignored.
    """
    spark = rows.sparkSession
    turns = numbered_turns(rows, conv_id, turn, role, text)
    convs, parts = rebuilt(turns)
    for salt in range(salts):
        paths = prefixes(parts, salt)
        nodes = materialize(distinct_nodes(paths, convs), "trie-nodes")
        if nodes.filter("mixed").isEmpty():
            break
    else:
        raise RuntimeError(f"{salts} salts gave colliding digests")

    totals = _totals(spark, nodes, paths, shard_rows)
    several = nodes.filter("n_ends > 1").select("hi", "lo")
    zero = F.lit(0).cast("long")
    ends = (paths.filter("d = len").select("hi", "lo", "conv_id")
            .unionByName(convs.filter("len = 0").select(zero.alias("hi"), zero.alias("lo"), "conv_id")))
    lists = _list_hashes(ends.join(several, ["hi", "lo"], "left_semi"))
    parents = nodes.filter("n_convs > n_ends").select(F.col("hi").alias("phi"), F.col("lo").alias("plo"),
                                                      F.col("conv_id").alias("parent_conv_id"))
    sha = (F.when(F.col("n_ends") == 0, F.lit(_EMPTY_SHA))
           .when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string"), 256)).otherwise(F.col("sha")))
    return (nodes.join(materialize(totals, "trie-all-totals"), ["hi", "lo"], "left")
            .join(materialize(lists, "trie-lists"), ["hi", "lo"], "left")
            .join(materialize(parents, "trie-parents"), ["phi", "plo"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs",
                    F.coalesce("n_children", (1 - F.col("n_ends"))).alias("n_children"),
                    F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
                    F.coalesce("saved_tokens", zero).alias("saved_tokens"), sha.alias("ends_sha256")))
