"""Packing token sequences with a bounded number of open windows.

Each scan task tokenizes its documents and packs them online: full windows are
cut off long documents, the rest goes best-fit into one of a fixed number of
open windows, and when none fits the fullest is topped up with a cut piece (or
left as it is when the gap is too small for one) and emitted.  At its end a
task merges its open windows, so it leaves one.  Those last windows meet in
further rounds of the same packing, 256 to a task, until one task is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.llm.chunks import encoder, pack_ids, tokenizer_path
from feedlab.llm.common import map_arrow, materialize

SEQUENCE_TOKENS = 1024
OPEN_WINDOWS = 64
# No piece shorter than this is cut off to fill a gap.
MIN_FRAGMENT = 8
END_ID = 0
MERGE_FAN_IN = 256


class Piece:
    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start: int, ids, doc_tokens: int):
        # a view: cutting a long document never copies what is left
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, memoryview(ids), doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:4 * n], self.doc_tokens),
                Piece(self.doc_id, self.start + n, self.ids[4 * n:], self.doc_tokens))


class OnlinePacker:
    """``add`` and ``finish`` yield closed windows (lists of pieces)."""

    def __init__(self, size: int, windows: int, min_fragment: int):
        self.size, self.windows, self.min_fragment = size, windows, min_fragment
        self.number = count()
        self.open: list[tuple[int, int]] = []        # (free tokens, window), by free tokens
        self.pieces: dict[int, list[Piece]] = {}

    def _put(self, at: int, piece: Piece):
        free, w = self.open.pop(at)
        self.pieces[w].append(piece)
        free -= len(piece)
        if free:
            insort(self.open, (free, w))
        else:
            yield self.pieces.pop(w)

    def add(self, piece: Piece):
        while len(piece) >= self.size:
            full, piece = piece.cut(self.size)
            yield [full]
        while len(piece):
            at = bisect_left(self.open, (len(piece), -1))
            if at < len(self.open):                    # best fit
                yield from self._put(at, piece)
                return
            if len(self.open) < self.windows:
                w = next(self.number)
                self.pieces[w] = []
                insort(self.open, (self.size, w))
                continue
            gap = self.open[0][0]                      # of the fullest
            if gap >= self.min_fragment and len(piece) - gap >= self.min_fragment:
                part, piece = piece.cut(gap)
                yield from self._put(0, part)
            else:
                yield self.pieces.pop(self.open.pop(0)[1])

    def finish(self):
        """Merge what is open: the emptiest windows are cut up to fill the fullest.
        Yields closed windows; the last one still open is returned by ``last``."""
        while len(self.open) > 1:
            _, w = self.open.pop()
            self.windows = len(self.open)
            for piece in self.pieces.pop(w):
                yield from self.add(piece)

    def last(self) -> list[Piece]:
        return self.pieces[self.open[0][1]] if self.open else []


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("ids", pa.binary())])
_PIECES_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
               "offset long, ids binary")


def _pack(pieces, size: int, windows: int, min_fragment: int, round_: int, last_round: bool):
    """Batches of piece rows.  ``ids`` is set on the rows of a window left open."""
    sequence = count((round_ << 54) + (TaskContext.get().partitionId() << 32))
    packer, rows = OnlinePacker(size, windows, min_fragment), []

    def batch():
        out = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PIECES)], schema=_PIECES)
        rows.clear()
        return out

    def enter(window, still_open=False):
        s, offset = next(sequence), 0
        for p in window:
            rows.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, s, offset,
                         bytes(p.ids) if still_open else None))
            offset += len(p)

    for piece in pieces:
        for window in packer.add(piece):
            enter(window)
        if len(rows) >= 10_000:
            yield batch()
    for window in packer.finish():
        enter(window)
    if window := packer.last():
        enter(window, still_open=not last_round)
    if rows:
        yield batch()


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                   tokenizer: str | None = None, end_id: int = END_ID, size: int = SEQUENCE_TOKENS,
                   windows: int = OPEN_WINDOWS, min_fragment: int = MIN_FRAGMENT) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its tokens and then ``end_id``; a null or empty text
    has the end id alone.  Every id lies in exactly one piece; a window's pieces
    lie gapless from offset 0.  Null ids pass through, and repeated rows are
    packed once each.  A very long text is encoded in one task and cut in time linear
    in its length.  An empty table gives an empty result; other columns are ignored.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    end = pack_ids([end_id])

    def first(batches):
        encode = encoder(path, True)
        def pieces():
            for b in batches:
                ids_, texts = b.columns
                for d, t in zip(ids_.to_pylist(), texts):
                    ids = encode(t.as_py()) + end
                    yield Piece(d, 0, ids, len(ids) // 4)
        yield from _pack(pieces(), size, windows, min_fragment, 0, False)

    def again(round_, last_round):
        def run(batches):
            def pieces():
                for b in batches:
                    for d, s, n, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))):
                        yield Piece(d, s, ids, n)
            yield from _pack(pieces(), size, windows, min_fragment, round_, last_round)
        return run

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    packed = materialize(map_arrow(src, first, _PIECES_DDL), "packed")
    done, left = packed.filter("ids is null"), packed.filter("ids is not null")
    round_ = 0
    while True:
        n = left.filter("offset = 0").count()
        if n == 0:
            break
        round_ += 1
        tasks = max(1, -(-n // MERGE_FAN_IN))
        packed = materialize(map_arrow(left.repartition(tasks, "sequence_id"), again(round_, tasks == 1),
                                       _PIECES_DDL), "packed")
        done, left = done.unionByName(packed.filter("ids is null")), packed.filter("ids is not null")
        if tasks == 1:
            break
    return done.drop("ids")
