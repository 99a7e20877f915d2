"""Token ids of whole texts by the ``tokenizers`` library, one BPE call per
distinct word.

A public vocabulary file is loaded once per Python worker.  A text is cut at
spaces.  A space after a word, or last in a run of white space before a word,
begins a piece of the split pattern (or is dropped), so the ids of a text are
the joined ids of its chunks, and a bounded dictionary of chunks saves the
library calls for words already seen.  A text with a space inside a run of
white space (white space before it, and more or the end of the text after it),
where the byte vocabulary has merges across spaces, goes through the library's
own full ``encode``; so do texts with a special token's string, which is that
one token as in the library's plain call, and chunks outside plain Latin
letters, ASCII signs and line ends.
"""

from __future__ import annotations

import re
import sys
from array import array
from codecs import charmap_decode
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# Entries kept per worker: a memory bound, not a limit on words (a word beyond
# it is encoded again each time).
CHUNK_CACHE = 600_000
PIECE_CACHE = 400_000

# The split patterns of the two vocabularies, over the plain
# characters, of which these are the letters.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
BYTE_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+"

_PLAIN = re.compile(f"[\n -~{LETTERS}]*")
# A space inside a run of white space: no border of a piece.
_INNER_SPACE = re.compile(r" (?<=[\s\u180e\ufeff] )(?=[\s\u180e\ufeff]|\Z)")


def _byte_alphabet() -> str:
    """The printable stand-in of each byte, in order: printable Latin-1 stands
    for itself, the rest for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    table = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(table[b] for b in range(256))


class _Pieces(dict):
    """Pre-token -> ids as little-endian uint32 bytes."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenize = tokenizer.model.tokenize
        self.alphabet = _byte_alphabet()

    def __missing__(self, piece: str) -> bytes:
        mapped = charmap_decode(piece.encode(), "strict", self.alphabet)[0]
        ids = _raw([t.id for t in self.tokenize(mapped)])
        if len(self) < PIECE_CACHE:
            self[piece] = ids
        return ids


def _raw(ids: list[int]) -> bytes:
    """Ids as little-endian uint32 bytes."""
    if sys.byteorder == "little" and array("I").itemsize == 4:
        return array("I", ids).tobytes()
    return np.array(ids, dtype="<u4").tobytes()


class _Chunks(dict):
    """Chunk between two spaces -> ids as little-endian uint32 bytes."""

    def __init__(self, encoder: "TextEncoder", lead: str):
        self.encoder, self.lead = encoder, lead

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encoder.chunk_ids(self.lead + chunk)
        if len(self) < CHUNK_CACHE:
            self[chunk] = ids
        return ids


class TextEncoder:
    """``encode(text)`` gives the ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.folds = self.tokenizer.normalizer is not None
        self.find = re.compile(WORD_PATTERN if self.folds else BYTE_PATTERN).findall
        self.pieces = _Pieces(self.tokenizer)
        self.first = _Chunks(self, "")
        self.rest = self.first if self.folds else _Chunks(self, " ")

    def whole(self, text: str) -> bytes:
        return _raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def chunk_ids(self, chunk: str) -> bytes:
        if not _PLAIN.fullmatch(chunk):
            return self.whole(chunk)
        if self.folds:
            chunk = chunk.lower()
        if chunk.isalpha() or (chunk[:1] == " " and chunk[1:].isalpha()):  # one piece
            return self.pieces[chunk]
        return b"".join([self.pieces[p] for p in self.find(chunk)])

    def encode(self, text: str) -> bytes:
        if any([t in text for t in self.added]) or (not self.folds and _INNER_SPACE.search(text)):
            return self.whole(text)
        parts = text.split(" ")
        head = self.first[parts[0]]
        return head + b"".join(map(self.rest.__getitem__, parts[1:]))


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)
