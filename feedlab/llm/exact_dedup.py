"""Exact deduplication by Grace hashing.

Three steps, each a Spark stage:

1. Every scan task collapses the copies it sees itself (bounded memory), so a
   text that makes up a third of all rows leaves a task as one representative
   with a count, not as its rows.
2. Representatives are hash-partitioned by content.  Each partition goes
   through an open-addressing table that compares complete contents.  When the
   table's budget is used up, records that it does not hold are partitioned
   into spill files by further bits of the hash, and each file is treated the
   same way, until a bucket fits.
3. Every row meets the verdict of its representative.

Step 1 is written once under ``spark.checkpoint.dir``; steps 2 and 3 read it,
so a lost executor re-reads files and row numbers never change between uses.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.llm.common import SPACES, map_arrow, materialize, tasks_for, text_bytes

# Bytes of distinct content that a scan task or a bucket's table holds at a time.
TABLE_BYTES = 48 << 20
# Spill files per recursion level.
FAN_OUT = 16

_NO_ID = np.iinfo(np.int64).max      # a null doc_id sorts after every id


class ContentTable:
    """Open addressing with linear probing; a slot matches only when the
    complete contents are equal, whatever the hashes say."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.slots = np.full(1 << 10, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.groups: list[list] = []

    def _probe(self, h: int, content: bytes) -> tuple[int, int]:
        mask = len(self.slots) - 1
        at = h & mask
        while (g := int(self.slots[at])) >= 0:
            if self.hashes[g] == h and self.contents[g] == content:
                return at, g
            at = (at + 1) & mask
        return at, -1

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for g, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = g

    def add(self, h: int, content: bytes, new_group: list) -> list | None:
        """The group of this content, entered as ``new_group`` if it is new and
        the budget allows; None if it has to wait for a later table."""
        at, g = self._probe(h, content)
        if g >= 0:
            return self.groups[g]
        if self.contents and self.used + len(content) > self.budget:
            return None
        self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.groups.append(new_group)
        self.used += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return new_group


def grace(records: Iterator[tuple], budget: int = TABLE_BYTES, level: int = 0) -> Iterator[list]:
    """Groups of records with equal content.  A record is (hash, content,
    rep_id, count, best_chars, best_id, best_row); a group is [best_chars,
    best_id, best_row, size, rep_ids, content]."""
    table, spill = ContentTable(budget), []
    try:
        for rec in records:
            h, content, rep, count, chars, doc, row = rec
            new = [chars, doc, row, 0, [], content]
            group = table.add(h, content, new)
            if group is None:
                if not spill:
                    spill = [tempfile.TemporaryFile() for _ in range(FAN_OUT)]
                pickle.dump(rec, spill[(h >> (60 - 4 * (level % 16))) % FAN_OUT])
                continue
            if (-chars, doc, row) < (-group[0], group[1], group[2]):
                group[:3] = chars, doc, row
            group[3] += count
            group[4].append(rep)
        yield from table.groups
        del table
        for f in spill:
            f.seek(0)
            yield from grace(_records(f), budget, level + 1)
            f.close()
    finally:
        for f in spill:
            f.close()


def _records(f) -> Iterator[tuple]:
    try:
        while True:
            yield pickle.load(f)
    except EOFError:
        return


_LOCAL = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("rep_id", pa.int64()),
                    ("bucket", pa.int64()), ("content", pa.binary()), ("size", pa.int64()),
                    ("chars", pa.int64()), ("best_id", pa.int64()), ("best_row", pa.int64())])
_LOCAL_DDL = ("row_id long, doc_id long, rep_id long, bucket long, content binary, size long, "
              "chars long, best_id long, best_row long")


def _bucket(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)


def _collapse(budget: int):
    def run(batches):
        held, used = {}, 0
        def leave(entries):
            rows = [(g[0], g[1], g[0], _bucket(c), c, g[2], g[3], g[4], g[5]) for c, g in entries]
            for i in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t.type) for x, t in zip(zip(*rows[i:i + 2000]), _LOCAL)], schema=_LOCAL)
        for b in batches:
            members = []
            for row, doc, text, chars in zip(*(c.to_pylist() for c in b.columns)):
                content = text.translate(None, SPACES.encode())
                order = _NO_ID if doc is None else doc
                g = held.get(content)
                if g is None:
                    held[content] = [row, doc, 1, chars, order, row]
                    used += len(content) + 400
                    continue
                members.append((row, doc, g[0]))
                g[2] += 1
                if (-chars, order) < (-g[3], g[4]):
                    g[3:] = chars, order, row
            if members:
                cols = list(zip(*members))
                nulls = [pa.nulls(len(members), t.type) for t in list(_LOCAL)[3:]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols] + nulls, schema=_LOCAL)
            if used > budget:
                # texts seen once leave; texts with copies stay for the copies to come
                once = [(c, g) for c, g in held.items() if g[2] == 1]
                more = {c: g for c, g in held.items() if g[2] > 1}
                if sum(len(c) + 400 for c in more) > budget // 2:
                    once, more = list(held.items()), {}
                yield from leave(once)
                held, used = more, sum(len(c) + 400 for c in more)
        yield from leave(list(held.items()))
    return run


_VERDICT = pa.schema([("rep_id", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()),
                      ("group_size", pa.int64()), ("text_sha256", pa.string())])
_VERDICT_DDL = "rep_id long, keep_id long, keep_row long, group_size long, text_sha256 string"


def _decide(budget: int):
    def records(batches):
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), _VERDICT)],
                                          schema=_VERDICT)

    def run(batches):
        rows = []
        for chars, doc, row, size, reps, content in grace(
                ((h & (2 ** 64 - 1), *rest) for h, *rest in records(batches)), budget):
            sha = hashlib.sha256(content).hexdigest()
            for rep in reps:
                rows.append((rep, None if doc == _NO_ID else doc, row, size, sha))
                if len(rows) == 10_000:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)
    return run


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space; of equal texts
    the row with the most code points stays, then the smallest id.  A null text
    is empty, and empty texts are one group.  A null id sorts after all ids.
    Repeated rows count as copies: exactly one row of a group has ``kept``.
    An empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    local, verdict = _groups(docs, F.monotonically_increasing_id(), doc_id, text, table_bytes)
    return (local.select("row_id", "doc_id", "rep_id").join(verdict, "rep_id")
            .select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
                    "text_sha256"))


def _groups(docs: DataFrame, row_id, doc_id: str, text: str, table_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their representatives, and the verdicts on representatives."""
    src = docs.select(row_id.alias("row_id"), F.col(doc_id).cast("long").alias("doc_id"),
                      text_bytes(text).alias("text"),
                      F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("chars"))
    local = materialize(map_arrow(src, _collapse(table_bytes), _LOCAL_DDL), "exact-local")
    reps = (local.filter(F.col("content").isNotNull())
            .select("bucket", "content", "rep_id", "size", "chars", "best_id", "best_row"))
    reps = reps.repartition(tasks_for(reps), "bucket")
    return local, materialize(map_arrow(reps, _decide(table_bytes), _VERDICT_DDL), "exact-verdict")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all columns: exactly
    one of each group, whatever the ids.  The rows are numbered in a written
    copy, so that a row is itself and not its id."""
    numbered = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "exact-rows")
    _, verdict = _groups(numbered, F.col("__row"), doc_id, text, table_bytes)
    kept = verdict.select(F.col("keep_row").alias("__row")).distinct()
    return numbered.join(kept, "__row", "left_semi").drop("__row")
