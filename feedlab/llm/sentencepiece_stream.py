"""SentencePiece encoding and decoding by a streaming Viterbi search.

For a byte-pair model the best segmentation of every prefix is unique, and its
last piece is the one piece that ends there and may stand after the best last
piece of what comes before (two pieces may stand side by side when no merge
across them would have come before the merges inside them).  So the search
keeps one backpointer per character, looks back no further than the longest
piece, and holds text only until the backpointer paths of all positions that a
later piece can still start from run through one boundary: everything before
it is then final and its ids are committed.

A boundary inside which no piece of the vocabulary spans is such a point at
once, so texts are cut there and segments seen before are looked up.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.llm.chunks import MEMO_CHARS, _Memo, pack_ids, tokenizer_path
from feedlab.llm.common import map_arrow

SPACE = "▁"
MEMO_CHUNKS = 250_000
MEMO_SEGMENTS = 700_000
MEMO_PAIRS = 1_000_000
_NEVER = 1 << 60


class PieceModel:
    """Pieces of a byte-pair SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.out = [b""] * n                                   # what an id decodes to
        self.ids: dict[str, int] = {}
        scored = []
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:-1], 16)] = i
                self.out[i] = bytes([int(p[3:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[p] = i
                self.out[i] = p.replace(SPACE, " ").encode()
                if len(p) > 1:
                    scored.append((-sp.get_score(i), i, p))
        # Merges happen in order of score.  Runs of spaces share one score and
        # so merge from the left; they are merged after all else (``run_ids``).
        self.rank = {p: r for r, (_, _, p) in enumerate(sorted(s for s in scored if s[2].strip(SPACE)))}
        self.runs = {p for _, _, p in scored if not p.strip(SPACE)}
        self.longest = max(map(len, self.rank), default=1)
        self.inside = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        sizes = np.array([len(x) for x in self.out], dtype=np.int64)
        self.bytes_of = (np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes,
                         np.frombuffer(b"".join(self.out), dtype=np.uint8))
        # pieces that merging their own characters ends in
        self.whole = {p for p in self.rank if self.half(p)}

    def half(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes the piece; None if merging its
        characters does not end in it."""
        if piece not in self.halves:
            parts, last = list(piece), None
            while len(parts) > 1:
                ranks = [self.rank.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
                if (low := min(ranks)) == _NEVER:
                    break
                i = ranks.index(low)
                last = (parts[i], parts[i + 1])
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.halves[piece] = last if len(parts) == 1 else None
        return self.halves[piece]

    def side_by_side(self, a: str, b: str) -> bool:
        """Whether the merges leave piece ``a`` directly before piece ``b``."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            known = self._side_by_side(a, b)
            if len(self.pairs) < MEMO_PAIRS:
                self.pairs[key] = known
        return known

    def _side_by_side(self, a: str, b: str) -> bool:
        rank, bound = self.rank, _NEVER
        while True:
            if rank.get(a + b, _NEVER) < bound:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:                 # undo the later merge, and see what met before it
                bound, a = ra, self.half(a)[1]
            else:
                bound, b = rb + 1, self.half(b)[0]

    def piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [self.byte_ids[x] for x in piece.encode()]

    def run_ids(self, n: int) -> list[int]:
        """Ids of a run of n spaces that no word takes: merges from the left."""
        parts: list[str | None] = [SPACE] * n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        todo = list(range(n - 1)) if SPACE * 2 in self.runs else []
        heapq.heapify(todo)
        while todo:
            i = heapq.heappop(todo)
            if parts[i] is None or (j := after[i]) >= n or parts[i] + parts[j] not in self.runs:
                continue
            parts[i] += parts[j]
            parts[j], after[i] = None, after[j]
            if after[i] < n:
                before[after[i]] = i
                heapq.heappush(todo, i)
            if before[i] >= 0:
                heapq.heappush(todo, before[i])
        return [x for p in parts if p for x in self.piece_ids(p)]


class StreamingViterbi:
    """``feed`` characters in any portions; it yields the pieces that are final."""

    def __init__(self, model: PieceModel):
        self.m, self.text, self.begin = model, "", [0]     # begin[i]: start of the piece that ends at i

    def feed(self, chars: str):
        m, window = self.m, self.m.longest
        begin, whole, pairs, known = self.begin, m.whole, m.side_by_side, m.pairs.get
        for at in range(0, len(chars), 4 * window):
            self.text += chars[at:at + 4 * window]
            text = self.text
            for end in range(len(begin), len(text) + 1):
                for start in range(max(0, end - window), end):
                    piece = text[start:end]
                    if piece not in whole and end - start > 1:
                        continue
                    if start:
                        before = text[begin[start]:start]
                        fits = known((before, piece))
                        if not (pairs(before, piece) if fits is None else fits):
                            continue
                    begin.append(start)
                    break
            if len(text) >= 4 * window:
                yield from self._commit()

    def _path(self, end: int) -> list[int]:
        bounds = [end]
        while bounds[-1] > 0:
            bounds.append(self.begin[bounds[-1]])
        return bounds

    def _commit(self):
        """Pieces before the last boundary that every live path runs through."""
        end = len(self.text)
        shared = set(self._path(end))
        for p in range(max(0, end - self.m.longest + 1), end):
            shared.intersection_update(self._path(p))
        cut = max(shared, default=0)
        if cut:
            bounds = self._path(cut)[::-1]
            yield from (self.text[a:b] for a, b in zip(bounds, bounds[1:]))
            self.text = self.text[cut:]
            self.begin[:] = [0] + [b - cut for b in self.begin[cut + 1:]]

    def finish(self):
        bounds = self._path(len(self.text))[::-1]
        yield from (self.text[a:b] for a, b in zip(bounds, bounds[1:]))
        self.text, self.begin = "", [0]


class PieceEncoder:
    def __init__(self, path: str):
        self.m = PieceModel(path)
        self.chunks = _Memo(self._chunk, MEMO_CHUNKS)
        self.segments = _Memo(self._segment, MEMO_SEGMENTS)
        # a space begins a piece: nothing spans from another character into it
        self.words_apart = not any(b[1] == SPACE and b[0] != SPACE for b in self.m.inside)

    def _segment(self, segment: str) -> bytes:
        v = StreamingViterbi(self.m)
        pieces = [*v.feed(segment), *v.finish()]
        return pack_ids([i for p in pieces for i in self.m.piece_ids(p)])

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a word with one space before it."""
        word, inside = SPACE + chunk, self.m.inside
        cuts = [0] + [i for i in range(1, len(word)) if word[i - 1:i + 1] not in inside] + [len(word)]
        return b"".join(map(self.segments.__getitem__, (word[a:b] for a, b in zip(cuts, cuts[1:]))))

    def _run_and_word(self, n: int, word: str) -> bytes:
        """Ids of n spaces and a word."""
        if not word:
            return pack_ids(self.m.run_ids(n))
        ids = self.chunks[word]
        if n > 1:
            alone = pack_ids(self.m.piece_ids(SPACE))
            if ids.startswith(alone):      # the word takes no space
                return pack_ids(self.m.run_ids(n)) + ids[len(alone):]
            return pack_ids(self.m.run_ids(n - 1)) + ids
        return ids

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")
        if not self.words_apart:
            return self._segment(SPACE + text.replace(" ", SPACE))
        words = text.split(" ")
        if "" not in words:
            return b"".join(map(self.chunks.__getitem__, words))
        out, n = [], 0
        for w in words:
            n += 1
            if w:
                out.append(self._run_and_word(n, w))
                n = 0
        if n:
            out.append(self._run_and_word(n, ""))
        return b"".join(out)

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of the id runs that end at ``ends``: every id's bytes are copied
        from one table of all pieces' bytes."""
        starts, sizes, table = self.m.bytes_of
        n = sizes[ids]
        to = np.concatenate([[0], np.cumsum(n)])
        raw = table[np.repeat(starts[ids] - to[:-1], n) + np.arange(to[-1])].tobytes()
        cuts = to[np.concatenate([[0], ends])].tolist()
        texts = (raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:]))
        return [t[1:] if t.startswith(" ") else t for t in texts]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _encoded(encode, part) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a short run of texts, and where each text's ids end."""
    bufs = [encode(t.as_py()) for t in part]
    return np.frombuffer(b"".join(bufs), dtype="<i4"), np.cumsum([len(x) // 4 for x in bufs], dtype=np.int64)


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))


def encode_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None,
                  decoded_sha256: bool = False) -> DataFrame:
    """doc_id, ids, n_tokens, one row per row; with ``decoded_sha256`` the ids are
    decoded again where they are, and the SHA-256 of the decoded text is added.

    A null or empty text has no ids.  Very long texts stream through the search in
    windows; a whole text's ids are one list.  Null and repeated ids and rows pass
    through; an empty table stays empty; other columns are ignored.
    """
    path = model or tokenizer_path("piece_bpe_32k.model")
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        encode = piece_encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids, ends = _encoded(encode, part.column(1))
                columns = [part.column(0), _lists(ids, ends), pa.array(np.diff(ends, prepend=0))]
                if decoded_sha256:
                    columns.append(pa.array([hashlib.sha256(t.encode()).hexdigest() for t in encode.decode_all(ids, ends)],
                                            pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_tokens", "decoded_sha256"][:len(columns)])
    return map_arrow(src, run, "doc_id long, ids array<int>, n_tokens long"
                     + (", decoded_sha256 string" if decoded_sha256 else ""))


def decode_pieces(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", model: str | None = None,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and the columns of ``carry`` (other than these two), one row per
    row.  Null ids give a null text, no ids an empty one; an id list is decoded
    whole, however long; repeated rows pass through; an empty table stays empty."""
    path = model or tokenizer_path("piece_bpe_32k.model")
    if set(carry) & {"doc_id", "text"}:
        raise ValueError("carry must not name doc_id or text: they are results")

    def run(batches):
        decode = piece_encoder(path).decode_all
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                lists = part.column(1)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], dtype=np.int64)
                texts = pa.array(decode(flat, np.cumsum(sizes)), pa.string(), mask=np.asarray(lists.is_null()))
                yield pa.RecordBatch.from_arrays([part.column(0), texts, *part.columns[2:]],
                                                 names=["doc_id", "text", *carry])
    src = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("__ids"), *carry)
    return map_arrow(src, run, ", ".join(["doc_id long, text string",
                                          *(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in carry)]))
