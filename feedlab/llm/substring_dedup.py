"""Removal of passages that an earlier document already has.

A window is a run of ``window`` consecutive words.  Every word covered by a
window that also occurs in a document with a smaller id is removed.

The corpus is its own reference, so reference shards are cut by content: each
window is routed by its anchor, the smallest hash of an n-gram in it.  Equal
windows have equal anchors, hence lie in one shard, and a shard holds only text
around one anchor that more than one document has.  A shard's distinct segments
form a suffix automaton whose states carry the smallest id among their
occurrences; segments are streamed through it for matching statistics, and a
window's state says whether an earlier document has it.  (The automaton of a
single segment is a path: all its windows have the segment's smallest id.)
Windows compare as whole words; hashes only choose where.

Stages (each a shuffle, no step gathers a group):

1. scan tasks send (anchor, id) in blobs by anchor, one entry per anchor and
   batch, and know those seen twice in a batch as hits already: an anchor in a
   third of all documents arrives as one entry per batch;
2. anchors met in two entries become hits of their documents;
3. documents meet their hits and send distinct segments, each with the list of
   its places, to the shards;
4. shards answer each segment with the earliest document per window; an anchor
   whose distinct segments pass one automaton's bound is not answered there, its
   windows go on by the hash of all their words, which equal windows share;
5. answers are dealt out evenly, windows of hot anchors meet and are answered,
   and both are turned into removals and meet the documents.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
import tempfile
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.llm.common import map_arrow, materialize, shuffle_partitions, text_bytes

WINDOW = 13
# Words of an anchor.
ANCHOR = 5
# Words of reference text in one automaton.
SHARD_WORDS = 200_000
# Windows of a segment at most (a bit of a mask each).
SEGMENT_WINDOWS = 32
# Bytes of segments that a task holds before it sends them on, and of a shard's
# rows before they go to a temporary file.
HELD_BYTES = 96 << 20
SPOOL_BYTES = 32 << 20
# Stands for a null id, which sorts after every id.
LAST = np.iinfo(np.int64).max

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                               0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_PLACE = np.dtype([("id", "<i8"), ("variant", "<i4"), ("at", "<i4")])
_PLACE_BYTES = "<qii"


class WordHashes(dict):
    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = h
        return h


_hashes = WordHashes()


def _window_minima(g: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    reach = 1
    while 2 * reach <= width:
        g = np.minimum(g[:-reach], g[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(g[:-rest], g[rest:]) if rest else g


def anchors(words: list[bytes], window: int, n: int):
    """(hash, first window, windows) of each run of windows with one anchor: the
    smallest hash of an n-gram in the window.  Long runs come in parts."""
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    count = len(words) - n + 1
    g = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        g = (g ^ h[i:i + count]) * _MIX[i % len(_MIX)]
        g ^= g >> np.uint64(31)
    m = _window_minima(g, window - n + 1)
    first = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    length = np.diff(np.append(first, len(m)))
    if length.max() > SEGMENT_WINDOWS:
        parts = -(-length // SEGMENT_WINDOWS)
        first = np.concatenate([a + SEGMENT_WINDOWS * np.arange(k) for a, k in zip(first, parts)])
        length = np.minimum(np.diff(np.append(first, len(m))), SEGMENT_WINDOWS)
    return m[first], first, length


class SuffixAutomaton:
    """Of several word sequences; ``earliest[state]`` is the smallest id of a
    sequence with an occurrence of the state's words."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.earliest = [-1], [0], [LAST]

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        self.earliest.append(LAST)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of p's words and ``word`` alone, cut off state q."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words, doc_id: int) -> None:
        nxt, link, length, last = self.next, self.link, self.length, 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, w, q)
            else:
                cur = self._state(length[last] + 1, 0, {})
                p = last
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][w]
                    link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
                last = cur
            if doc_id < self.earliest[last]:
                self.earliest[last] = doc_id

    def close(self) -> None:
        """Let the ids of longer words reach their suffixes."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            if self.earliest[s] < self.earliest[up]:
                self.earliest[up] = self.earliest[s]

    def earliest_windows(self, words, window: int) -> list[int]:
        """Per window, the smallest id that has it (LAST if none): the matching
        statistics of ``words``, cut at the window's length."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            state, matched = (nxt[state][w], matched + 1) if w in nxt[state] else (0, 0)
            while state and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if i >= window - 1:
                out.append(self.earliest[state] if matched >= window else LAST)
        return out


# --- 1 and 2: anchors of more than one document --------------------------------

def _send_anchors(window: int, n: int, parts: int):
    def run(batches):
        for b in batches:
            ids, docs = [], []
            for d, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = text.as_py().split()
                if len(words) >= window:
                    h = anchors(words, window, n)[0]
                    ids.append(h)
                    docs.append(np.full(len(h), d, dtype=np.int64))
            if not ids:
                continue
            h, d = np.concatenate(ids), np.concatenate(docs)
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
            h, d = h[new], d[new]
            new = np.concatenate([[True], h[1:] != h[:-1]])
            first = np.flatnonzero(new)
            many = np.diff(np.append(first, len(h))) > 1
            twice = many[np.cumsum(new) - 1]
            # hits known in the batch
            yield from _hits(h[twice], d[twice], parts)
            # one entry of each anchor, by partition
            h, d = h[first], d[first]
            part = (h % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            h, d, part = h[order], d[order], part[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            blobs = [x.tobytes() + y.tobytes() for x, y in zip(np.split(h, cuts), np.split(d, cuts))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[np.concatenate([[0], cuts])].astype(np.int32)), pa.nulls(len(blobs), pa.int64()),
                 pa.array(blobs, pa.binary())], names=["part", "dest", "blob"])
    return run


def _destinations(parts: int) -> int:
    """Destinations of what belongs to documents: a prime, so that ids in steps
    spread too, a few to a shuffle partition."""
    n = 4 * parts + 1
    while any(n % i == 0 for i in range(2, int(n ** 0.5) + 1)):
        n += 2
    return n


def _by_destination(ids: np.ndarray, records: np.ndarray, dests: int):
    """(destinations, blobs): the ids and records that go to each."""
    dest = ids % dests
    order = np.argsort(dest, kind="stable")
    ids, records, dest = ids[order], records[order], dest[order]
    cuts = np.flatnonzero(np.diff(dest)) + 1
    blobs = [a.tobytes() + b.tobytes() for a, b in zip(np.split(ids, cuts), np.split(records, cuts))]
    return dest[np.concatenate([[0], cuts])], blobs


def _hits(h: np.ndarray, d: np.ndarray, parts: int):
    """Rows (some partition, destination, ids and anchors)."""
    if len(h):
        dest, blobs = _by_destination(d, h, _destinations(parts))
        yield pa.RecordBatch.from_arrays([pa.array((dest % parts).astype(np.int32)), pa.array(dest), pa.array(blobs, pa.binary())],
                                         names=["part", "dest", "blob"])


def _meet_anchors(parts: int):
    """Entries of whole partitions: anchors with two documents are hits.  Rows
    that are hits already go through."""
    def run(batches):
        held: list[bytes] = []
        current = None

        def close():
            if held:
                h = np.concatenate([np.frombuffer(x, dtype="<u8", count=len(x) // 16) for x in held])
                d = np.concatenate([np.frombuffer(x, dtype="<i8", offset=len(x) // 2) for x in held])
                held.clear()
                order = np.argsort(h, kind="stable")
                h, d = h[order], d[order]
                same = h[1:] == h[:-1]
                hit = np.concatenate([same, [False]]) | np.concatenate([[False], same])
                yield from _hits(h[hit], d[hit], parts)

        for b in batches:
            through = b.filter(b.column(1).is_valid())
            if through.num_rows:
                yield through
            entries = b.filter(b.column(1).is_null())
            for part, blob in zip(entries.column(0).to_pylist(), entries.column(2).to_pylist()):
                if part != current:
                    yield from close()
                    current = part
                held.append(blob)
        yield from close()
    return run


# --- documents together with what belongs to them ------------------------------

_MEET_DDL = "dest long, kind int, id long, payload binary, doc_id long"


def _compress(batches):
    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        packed = [z.compress(t.as_py()) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.ones(b.num_rows, dtype=np.int32)), b.column(1),
                                          pa.array(packed, pa.binary()), b.column(3)],
                                         names=["dest", "kind", "id", "payload", "doc_id"])


def _with_documents(src: DataFrame, side: DataFrame) -> DataFrame:
    """Per destination the blobs of ``side`` (dest, payload), then the texts by id."""
    parts = shuffle_partitions(src.sparkSession)
    dest = F.pmod("id", F.lit(_destinations(parts)).cast("long"))
    texts = map_arrow(src.select(dest.alias("dest"), "id", "text", "doc_id"), _compress, _MEET_DDL)
    none = F.lit(None).cast("long")
    side = side.select("dest", F.lit(0).alias("kind"), none.alias("id"), "payload", none.alias("doc_id"))
    return (texts.unionByName(side).repartition(parts, "dest").sortWithinPartitions("dest", "kind", "id", "payload"))


def _documents(batches, record: np.dtype) -> Iterator[tuple]:
    """(id, doc_id, variant, text, records): texts with the records of their id.
    Texts that share an id are its variants, numbered in order.  What is held is
    one destination's records, a part of a shuffle partition."""
    z = zstandard.ZstdDecompressor()
    current, blobs, ids, records, last, variant = None, [], None, None, None, 0
    width = 8 + record.itemsize
    for b in batches:
        for dest, kind, i, payload, doc_id in zip(*(b.column(c).to_pylist() for c in (0, 1, 2)), b.column(3),
                                                  b.column(4).to_pylist()):
            if dest != current:
                current, blobs, ids, last, variant = dest, [], None, None, 0
            if kind == 0:
                blobs.append(payload.as_py())
                continue
            if ids is None:
                counts = [len(x) // width for x in blobs]
                ids = np.concatenate([np.frombuffer(x, dtype="<i8", count=n) for x, n in zip(blobs, counts)] or [np.zeros(0, "<i8")])
                records = np.concatenate([np.frombuffer(x, dtype=record, offset=8 * n) for x, n in zip(blobs, counts)]
                                         or [np.zeros(0, record)])
                order = np.argsort(ids, kind="stable")
                ids, records, blobs = ids[order], records[order], []
            variant = variant + 1 if i == last else 0
            last = i
            own = records[np.searchsorted(ids, i):np.searchsorted(ids, i, side="right")]
            yield i, doc_id, variant, z.decompress(payload.as_py()), own


# --- 3: segments ----------------------------------------------------------------

def _segments(window: int, n: int):
    def run(batches):
        held: dict[tuple[int, bytes], bytearray] = {}
        size = 0

        def leave():
            anchor = np.fromiter((k[0] for k in held), dtype=np.uint64, count=len(held)).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array((k[1] for k in held), pa.binary()), pa.array(held.values(), pa.binary())],
                names=["anchor", "segment", "places"])

        for i, _, variant, text, hits in _documents(batches, np.dtype("<u8")):
            if not len(hits):
                continue
            words = text.split()
            if len(words) < window:
                continue
            h, first, count = anchors(words, window, n)
            wanted = np.isin(h, hits)
            for a, at, c in zip(h[wanted].tolist(), first[wanted].tolist(), count[wanted].tolist()):
                key = (a, b" ".join(words[at:at + c + window - 1]))
                where = held.get(key)
                if where is None:
                    held[key] = bytearray(struct.pack(_PLACE_BYTES, i, variant, at))
                    size += len(key[1]) + 400
                else:
                    where += struct.pack(_PLACE_BYTES, i, variant, at)
                    size += 20
            if size > HELD_BYTES:
                yield leave()
                held, size = {}, 0
        if held:
            yield leave()
    return run


# --- 4: shards --------------------------------------------------------------------

def _least_id(places: bytes) -> int:
    return int.from_bytes(places[:8], "little", signed=True) if len(places) == _PLACE.itemsize else int(
        np.frombuffer(places, dtype=_PLACE)["id"].min())


def _last_id(places: bytes) -> int:
    return int.from_bytes(places[:8], "little", signed=True) if len(places) == _PLACE.itemsize else int(
        np.frombuffer(places, dtype=_PLACE)["id"].max())


class Rows:
    """Rows (segment, places) that can be read again: in memory, and beyond
    SPOOL_BYTES in a temporary file."""

    def __init__(self):
        self.held, self.bytes, self.spool, self.n = [], 0, None, 0

    def add(self, row) -> None:
        self.n += 1
        self.held.append(row)
        self.bytes += len(row[0]) + len(row[1]) + 200
        if self.bytes > SPOOL_BYTES:
            self.spool = self.spool or tempfile.TemporaryFile()
            for x in self.held:
                pickle.dump(x, self.spool)
            self.held, self.bytes = [], 0

    def __iter__(self):
        if self.spool:
            self.spool.seek(0)
            for _ in range(self.n - len(self.held)):
                yield pickle.load(self.spool)
        yield from self.held

    def close(self) -> None:
        if self.spool:
            self.spool.close()


def _answer(rows: Rows, least: dict[bytes, int], window: int) -> Iterator[tuple[bytes, list[int]]]:
    """(places, earliest id per window) for the rows of one anchor, whose distinct
    segments and their smallest ids are ``least``: one automaton at most."""
    if len(least) == 1:
        (segment, i), = least.items()
        found = [i] * (segment.count(b" ") + 2 - window)
        for _, places in rows:
            yield places, found
        return
    machine, number = SuffixAutomaton(), {}
    for segment, i in least.items():
        machine.add([number.setdefault(w, len(number)) for w in segment.split(b" ")], i)
    machine.close()
    known: dict[bytes, list[int]] = {}
    for segment, places in rows:
        found = known.get(segment)
        if found is None:
            found = known[segment] = machine.earliest_windows([number[w] for w in segment.split(b" ")], window)
        yield places, found


class Onward:
    """Windows of hot anchors, each with its places, on their way to the task of
    their own hash."""

    def __init__(self, window: int):
        self.window, self.held, self.size = window, {}, 0

    def add(self, segment: bytes, places: bytes):
        words = segment.split(b" ")
        p = np.frombuffer(places, dtype=_PLACE)
        for k in range(len(words) - self.window + 1):
            own = p.copy()
            own["at"] += k
            key = b" ".join(words[k:k + self.window])
            where = self.held.get(key)
            if where is None:
                where = self.held[key] = []
                self.size += len(key) + 300
            where.append(own.tobytes())
            self.size += 100 * len(p)
            if self.size > HELD_BYTES:
                yield self.leave()

    def leave(self):
        keys = list(self.held)
        places = [b"".join(x) for x in self.held.values()]
        self.held, self.size = {}, 0
        return _routed([_content_key(k) for k in keys], keys, places, [None] * len(keys))


def _content_key(x: bytes) -> int:
    return xxhash.xxh64_intdigest(x) - (1 << 63)


_ROUTED_DDL = "key long, segment binary, places binary, earliest binary"


def _routed(keys, segments, places, earliest):
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())] + [pa.array(x, pa.binary()) for x in (segments, places, earliest)],
                                      names=["key", "segment", "places", "earliest"])


def _answered(out: list):
    """Rows of (places, earliest id per window), dealt out by the places."""
    places, found = zip(*out)
    ends = np.cumsum([0] + [len(x) for x in found])
    earliest = np.fromiter((i for x in found for i in x), dtype="<i8", count=int(ends[-1])).tobytes()
    return _routed([_content_key(x) for x in places], [None] * len(places), places,
                   [earliest[8 * a:8 * b] for a, b in zip(ends, ends[1:])])


def _shards(window: int, shard_words: int):
    """Answers of anchors whose distinct segments have at most ``shard_words``
    words; of a hotter anchor the windows, which go on by their own hash.  What is
    held is one automaton's text and a part of the rows."""
    def run(batches):
        onward = Onward(window)
        anchor, rows, least, words, hot = None, Rows(), {}, 0, False
        out: list = []

        def close():
            for places, found in _answer(rows, least, window) if least else ():
                # only where a place lies after the earliest one of a window
                if _last_id(places) > min(found):
                    out.append((places, found))
                    if len(out) >= 10_000:
                        yield _answered(out)
                        out.clear()
            rows.close()

        for b in batches:
            for a, segment, places in zip(*(c.to_pylist() for c in b.columns)):
                if a != anchor:
                    yield from close()
                    anchor, rows, least, words, hot = a, Rows(), {}, 0, False
                if hot:
                    yield from onward.add(segment, places)
                    continue
                rows.add((segment, places))
                i = _least_id(places)
                if segment not in least:           # copies add nothing
                    words += segment.count(b" ") + 1
                if i < least.get(segment, LAST + 1):
                    least[segment] = i
                if words > shard_words and len(least) > 1:
                    hot = True
                    for row in rows:
                        yield from onward.add(*row)
                    rows.close()
                    rows, least = Rows(), {}
        yield from close()
        if out:
            yield _answered(out)
        if onward.held:
            yield onward.leave()
    return run


def _windows(batches):
    """Answers to the windows of hot anchors, met by their hash and compared as
    whole words.  Rows that are answers already go through."""
    key, rows, least = None, Rows(), {}
    out: list = []

    def close():
        for segment, places in rows:
            if _last_id(places) > least[segment]:
                out.append((places, [least[segment]]))
                if len(out) >= 10_000:
                    yield _answered(out)
                    out.clear()
        rows.close()

    for b in batches:
        through = b.filter(b.column(3).is_valid())
        if through.num_rows:
            yield through
        for k, segment, places in zip(*(c.to_pylist() for c in b.filter(b.column(3).is_null()).columns[:3])):
            if k != key:
                yield from close()
                key, rows, least = k, Rows(), {}
            rows.add((segment, places))
            least[segment] = min(_least_id(places), least.get(segment, LAST))
    yield from close()
    if out:
        yield _answered(out)


# --- 5: removals --------------------------------------------------------------------

_REMOVAL = np.dtype([("variant", "<i4"), ("at", "<i4"), ("mask", "<u8")])


def _removals(dests: int):
    """Rows (dest, payload): ids with variant, first window and a bit per window
    to remove."""
    def run(batches):
        for b in _windows(batches):
            places, earliest = (c.to_pylist() for c in b.columns[2:])
            if not places:
                continue
            p = np.frombuffer(b"".join(places), dtype=_PLACE)
            e = np.frombuffer(b"".join(earliest), dtype="<i8")
            n_places = np.array([len(x) for x in places]) // _PLACE.itemsize
            n_windows = np.array([len(x) for x in earliest]) // 8
            # every place with every window of its segment
            row = np.repeat(np.arange(len(places)), n_places)
            size = n_windows[row]
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            k = np.arange(int(size.sum())) - np.repeat(begin, size)
            first = np.concatenate([[0], np.cumsum(n_windows)[:-1]])[row]
            later = e[np.repeat(first, size) + k] < np.repeat(p["id"], size)
            mask = np.bitwise_or.reduceat(later.astype(np.uint64) << k.astype(np.uint64), begin)
            some = mask > 0
            rows = np.zeros(int(some.sum()), dtype=_REMOVAL)
            rows["variant"], rows["at"], rows["mask"] = p["variant"][some], p["at"][some], mask[some]
            if len(rows):
                dest, blobs = _by_destination(p["id"][some].astype(np.int64), rows, dests)
                yield pa.RecordBatch.from_arrays([pa.array(dest), pa.array(blobs, pa.binary())], names=["dest", "payload"])
    return run


def _apply(window: int, with_text: bool):
    bit = np.arange(SEGMENT_WINDOWS, dtype=np.uint64)

    def run(batches):
        rows = []

        def leave():
            cols = list(zip(*rows))
            rows.clear()
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][:4 + with_text]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][:4 + with_text]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for _, doc_id, variant, text, r in _documents(batches, _REMOVAL):
            words = text.split()
            total = len(words)
            if len(r):
                r = r[r["variant"] == variant]
                i, k = np.nonzero((r["mask"][:, None] >> bit) & np.uint64(1))
                starts = r["at"][i] + k
                edge = np.bincount(starts, minlength=total + 1) - np.bincount(starts + window, minlength=total + 1)
                words = list(compress(words, (np.cumsum(edge[:total]) == 0).tolist()))
            kept = b" ".join(words)
            rows.append((doc_id, total, total - len(words), hashlib.sha256(kept).hexdigest(),
                         kept.decode())[:4 + with_text])
            if len(rows) >= (500 if with_text else 10_000):
                yield leave()
        if rows:
            yield leave()
    return run


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, window: int = WINDOW,
                    anchor: int = ANCHOR, shard_words: int = SHARD_WORDS, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, ``with_text``, kept_text (the
    kept words joined by single spaces); one row per row.

    A null or empty text has no words, and a text shorter than the window keeps
    all.  A null id sorts after every id.  Rows with one id never remove each
    other's words; each is judged by its own text.  An empty table gives an
    empty result; other columns are ignored.
    """
    if not 1 <= anchor <= window:
        raise ValueError("an anchor is no longer than the window")
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                      F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"), text_bytes(text).alias("text"))
    blob_ddl = "part int, dest long, blob binary"
    sent = map_arrow(src.select("id", "text"), _send_anchors(window, anchor, parts), blob_ddl)
    hits = map_arrow(sent.repartition(parts, "part").sortWithinPartitions("part"), _meet_anchors(parts), blob_ddl).select(
        "dest", F.col("blob").alias("payload"))
    segments = map_arrow(_with_documents(src, hits), _segments(window, anchor),
                         "anchor long, segment binary, places binary")
    answers = map_arrow(segments.repartition(parts, "anchor").sortWithinPartitions("anchor"),
                        _shards(window, shard_words), _ROUTED_DDL)
    removals = materialize(map_arrow(answers.repartition(parts, "key").sortWithinPartitions("key"),
                                     _removals(_destinations(parts)), "dest long, payload binary"), "substring-removals")
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return map_arrow(_with_documents(src, removals), _apply(window, with_text), ddl)
