"""Token ids of whole texts with the ``tokenizers`` library, through a memo of chunks.

Both byte-pair vocabularies here take special tokens' strings out of a text first
and split the rest at white space before merging, so the ids of a text are the
ids of its chunks in order.  A chunk is encoded by
the library once per task and then looked up; ids are kept as little-endian
unsigned 32-bit bytes, so a text's ids are one ``bytes.join``.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np

# Chunks and words remembered per Python worker, and the longest text of one.
MEMO_CHUNKS = 200_000
MEMO_SPACED = 100_000
MEMO_WORDS = 500_000
MEMO_CHARS = 48

# Latin-1 letters, then punctuation without the apostrophe (which begins
# contractions): such a chunk is two pre-tokens in both vocabularies.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARKS = r"!-&(-/:-@\[-`{-~"
_WORD = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)")
_BARE = re.compile(f"[{_LETTERS}]+")
_LETTER_CHARS = frozenset(c for c in map(chr, range(0x100)) if re.match(f"[{_LETTERS}]", c))
_MARK_CHARS = "".join(c for c in map(chr, range(0x80)) if re.match(f"[{_MARKS}]", c))
_WORD_LINE_WORD = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)\n([{_LETTERS}]+)([{_MARKS}]*)")

# A space with white space on both sides is not a safe place to cut.
_UNSAFE = re.compile(r" (?!\S)(?<!\S )")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pack_ids(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class _Memo(dict):
    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, chunk):
        ids = self.encode(chunk)
        if len(self) < self.limit and len(chunk) <= MEMO_CHARS:
            self[chunk] = ids
        return ids


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    itself if Latin-1 shows it, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_CHARACTERS = _byte_characters()
_SPACE = _CHARACTERS[0x20]


class _Encoder:
    def __init__(self, path: str):
        self.tokenizer = _load(path)
        self.merge = self.tokenizer.model.tokenize
        self.chunks = _Memo(self.chunk, MEMO_CHUNKS)
        self.marks = _Memo(self.whole, 10_000)
        added = {t.content: pack_ids([i]) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.special_ids = added

    def whole(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        """Ids of one pre-token, by the library's model alone."""
        if not word.isascii() or word[0] == " ":
            word = word.encode().decode("latin-1").translate(_CHARACTERS)
        return array("I", [t.id for t in self.merge(word)]).tobytes()

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, as ``Tokenizer.encode`` gives them."""
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self.plain(text[at:m.start()]), self.special_ids[m[0]]]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])


class _SpacedChunks(dict):
    """Ids of chunks with a leading space.  Words of letters alone have a limit of
    their own, so chunks with marks do not take their room."""

    def __init__(self, encoder: SpaceKeepingEncoder):
        super().__init__()
        self.encoder, self.words_left, self.others_left = encoder, MEMO_WORDS, MEMO_SPACED

    def __missing__(self, chunk):
        word = chunk.rstrip(_MARK_CHARS)
        if word == chunk and _BARE.fullmatch(chunk):
            ids = self.encoder.spaced_word(chunk)
            if self.words_left and len(chunk) <= MEMO_CHARS:
                self[chunk] = ids
                self.words_left -= 1
            return ids
        if word != chunk and word[-1:] in _LETTER_CHARS:
            # marks after a letter are a pre-token of their own, whatever comes before
            ids = self[word] + self.encoder.marks[chunk[len(word):]]
        else:
            ids = self.encoder.chunk(chunk)
        if self.others_left and len(chunk) <= MEMO_CHARS:
            self[chunk] = ids
            self.others_left -= 1
        return ids


class SpaceKeepingEncoder(_Encoder):
    """Byte-level BPE whose pre-tokens are words with one leading space.

    A text is cut before each space that has a character other than white
    space before or after it: there the pre-tokenizer always begins a new
    pre-token.  A text with any other space is encoded in one piece.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.chunks = _SpacedChunks(self)
        self.bare = _Memo(self.word, MEMO_CHUNKS)

    def spaced_word(self, word: str) -> bytes:
        """Ids of a space and a word of letters; ASCII letters stand for themselves."""
        if not word.isascii():
            return self.word(" " + word)
        return array("I", [t.id for t in self.merge(_SPACE + word)]).tobytes()

    def chunk(self, text: str) -> bytes:
        if m := _WORD_LINE_WORD.fullmatch(text):
            return (self.chunks[m[1]] + (self.marks[m[2]] if m[2] else b"") + self.marks["\n"]
                    + self.bare[m[3]] + (self.marks[m[4]] if m[4] else b""))
        return self.whole(" " + text)

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if _UNSAFE.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return (self.whole(first) if first else b"") + b"".join(map(self.chunks.__getitem__, rest))


class SpaceDroppingEncoder(_Encoder):
    """Lower-casing BPE that drops white space: every run between ASCII white
    space is a chunk."""

    def __init__(self, path: str):
        super().__init__(path)
        self.words = _Memo(self.word, MEMO_WORDS)

    def chunk(self, text: bytes) -> bytes:
        text = text.decode()
        if m := _WORD.fullmatch(text):
            return self.words[m[1].lower()] + (self.marks[m[2]] if m[2] else b"")
        return self.whole(text)

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.encode().split()))


def _load(path: str):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def encoder(path: str, keeps_space: bool):
    """One encoder, and so one memo, per worker process."""
    return (SpaceKeepingEncoder if keeps_space else SpaceDroppingEncoder)(path)
