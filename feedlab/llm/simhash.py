"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are computed per document.  Equal fingerprints collapse to one
node (their smallest doc_id) with a map-side aggregate, so copies never meet
pairwise.  Two 64-bit fingerprints at ``radius`` or fewer differing bits agree
in at least one of ``radius + 1`` disjoint bit blocks, so each distinct
fingerprint is routed by each block value and compared only there.  Inside a
block value, fingerprints are sorted by population count and cut into tiles;
pairs of tiles whose population counts differ by more than the radius are
skipped, the others are compared whole with exclusive-or and bit counts.  A
block value with many fingerprints becomes many tile pairs, each its own row
and task share: no group has to fit one task.

Components come from alternating large-star and small-star steps on the links
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014), with
every round written under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlab.llm.common import map_arrow, materialize, text_bytes

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
# Fingerprints in a tile.
TILE = 2048


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit b is 1 if it is set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    k = shingle_words
    if len(words) <= k:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    ones, n = np.zeros(64, dtype=np.int64), len(words) - k + 1
    for at in range(0, n, 1 << 16):           # bounded buffers however long the text
        part = words[at:at + (1 << 16) + k - 1]
        h = np.fromiter((digest(join(s), SEED) for s in zip(*(part[i:] for i in range(k)))), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(shingle_words: int):
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle_words) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    return run


def simhash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed 64-bit integer."""
    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text")),
                     _fingerprints(shingle_words), "doc_id long, fp long")


def bit_blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 1 disjoint blocks that cover 64 bits."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _compare(radius: int):
    """Links inside each row's two tiles (or one tile with itself)."""
    def pairs(a, na, b, nb, same):
        fa, fb = np.asarray(a, dtype=np.int64).view(np.uint64), np.asarray(b, dtype=np.int64).view(np.uint64)
        ia, ib = np.asarray(na, dtype=np.int64), np.asarray(nb, dtype=np.int64)
        for at in range(0, len(fa), 256):       # a slice of rows at a time keeps the matrix small
            near = np.bitwise_count(fa[at:at + 256, None] ^ fb[None, :]) <= radius
            if same:
                near = np.triu(near, at + 1)
            i, j = np.nonzero(near)
            yield ia[at + i], ib[j]

    def run(batches):
        for batch in batches:
            src, dst = [], []
            for fa, na, fb, nb, same in zip(*(c.to_pylist() for c in batch.columns)):
                for i, j in pairs(fa, na, fb, nb, same):
                    src.append(i)
                    dst.append(j)
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))],
                                                 names=["a", "b"])
    return run


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints differ in 1 to ``radius`` bits.

    ``nodes`` has node, fp with distinct fp.  A pair may come from more than
    one block.
    """
    block = F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"),
                 F.shiftrightunsigned(F.col("fp"), first).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
        for i, (first, width) in enumerate(bit_blocks(radius))]))
    routed = (nodes.select("node", "fp", F.bit_count("fp").alias("ones"), block.alias("k"))
              .select("node", "fp", "ones", "k.block", "k.value"))
    key = ["block", "value"]
    # A value's fingerprints are cut into tiles without gathering them: by their
    # population count (65 rows a value at most), then a hash within.
    per_count = routed.groupBy(*key, "ones").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(per_count.withColumn("all", F.sum("n").over(Window.partitionBy(*key))).filter("all > 1"),
                        "simhash-sizes")
    small = F.col("all") <= tile
    tiles = (routed.join(sizes, [*key, "ones"])
             .withColumn("tile", F.when(small, F.lit(0)).otherwise(
                 F.col("ones") * F.lit(1 << 40)
                 + F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile).cast("long"))))
             .groupBy(*key, "tile")
             .agg(F.min("ones").alias("low"), F.max("ones").alias("high"),
                  F.sort_array(F.collect_list(F.struct("fp", "node"))).alias("rows")))
    tiles = materialize(tiles.select(*key, "tile", "low", "high", F.col("rows.fp").alias("fps"),
                                     F.col("rows.node").alias("ids")), "simhash-tiles")
    within = tiles.select(F.col("fps").alias("fa"), F.col("ids").alias("na"), F.col("fps").alias("fb"),
                          F.col("ids").alias("nb"), F.lit(True).alias("same")).filter(F.size("fa") > 1)
    # Which tiles of a value can hold partners is decided on their counts alone.
    heads = tiles.select(*key, "tile", "low", "high")
    other = heads.select(*key, F.col("tile").alias("tile2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    meet = (heads.join(other, key).filter((F.col("tile") < F.col("tile2"))
                                          & (F.col("low2") - F.col("high") <= radius)
                                          & (F.col("low") - F.col("high2") <= radius))
            .select(*key, "tile", "tile2"))
    across = (meet.join(tiles.select(*key, "tile", F.col("fps").alias("fa"), F.col("ids").alias("na")), [*key, "tile"])
              .join(tiles.select(*key, F.col("tile").alias("tile2"), F.col("fps").alias("fb"),
                                 F.col("ids").alias("nb")), [*key, "tile2"])
              .select("fa", "na", "fb", "nb", F.lit(False).alias("same")))
    return map_arrow(within.unionByName(across), _compare(radius), "a long, b long")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, component: the smallest node reachable, for nodes with a link."""
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "simhash-links")
    mark = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node links to the node's minimum
        e = both(edges)
        low = materialize(e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "simhash-low")
        large = materialize(e.filter("b > a").join(low, "a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "simhash-large")
        # small star: every smaller neighbour of a node, and itself, links to its minimum
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "simhash-low")
        edges = materialize(large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(low.select("a", F.col("m").alias("b")))
                            .filter("a <> b").distinct(), "simhash-stars")
        was, mark = mark, edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                                    F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if mark == was:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most
    ``radius`` differing bits, itself included.  A null or empty text has
    fingerprint zero and links like any other.  Rows with a null id are not
    nodes: they take the component of their fingerprint (null if no other row
    has an id there).  Repeated rows give repeated results; an empty table an
    empty one.  Other columns are ignored.
    """
    fps = materialize(simhash(docs, doc_id, text, shingle_words), "simhash-fp")
    nodes = fps.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    nodes = materialize(nodes, "simhash-nodes")
    comp = components(links(nodes, radius, tile))
    label = nodes.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    label = materialize(label, "simhash-label")
    return (fps.join(label, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
