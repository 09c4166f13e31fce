"""Exact tokenizing through caches of space-separated pieces.

A byte-level or word-level BPE splits a text into pre-tokens, none of which holds a space except as its first
character.  A space with no white space beside it therefore always starts a new pre-token, and the text between two
such spaces can be encoded by itself.  Texts with other white-space runs are cut only at such safe spaces.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np

#: Bytes that a worker's cache may take before it starts anew, and what an entry takes beside its piece and value.
CACHE_BYTES, ENTRY_BYTES = 64 * 1024 * 1024, 150
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class _Unsafe(Exception):
    """A piece is empty or has white space at an end: the text has white-space runs."""


class PieceCache(dict):
    """Maps a piece (without its leading space) to ``encode(piece)``; filled on demand, bounded beside the ``first`` tier."""

    def __init__(self, encode, limit: int | None = None):
        super().__init__()
        self.encode, self.limit, self.size, self.first = encode, CACHE_BYTES if limit is None else limit, 0, {}

    def stock(self, first: dict) -> None:
        """Hold the first tier's entries at all times."""
        self.first = first
        self.update(first)

    def empty(self) -> None:
        """Forget everything, as at the end of a task."""
        self.clear()
        self.first, self.size = {}, 0

    def __missing__(self, piece: str):
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Unsafe
        value = self.encode(piece)
        if len(piece) <= 64:
            self.size += ENTRY_BYTES + len(piece) + (len(value) if isinstance(value, bytes) else 0)
            if self.size > self.limit:
                self.clear()
                self.update(self.first)
                self.size = 0
            self[piece] = value
        return value


def pieces(text: str, cache: PieceCache, encode_raw, joined):
    """``joined`` values of the pieces of ``text``; ``encode_raw`` encodes a string as it stands."""
    head, *rest = text.split(" ")
    try:
        if head and head[-1].isspace() or not rest and not head:
            raise _Unsafe
        return joined([encode_raw(head)] if head else [], map(cache.__getitem__, rest))
    except _Unsafe:
        head, *rest = _SAFE_SPACE.split(text)
        return joined([encode_raw(head)] if head else [],
                      (cache[p] if not p[-1:].isspace() else encode_raw(" " + p) for p in rest))


def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _le32(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class IdEncoder:
    """Token ids of whole texts as little-endian 32-bit integers, equal to ``tokenizers`` for the given file.

    Pieces of Latin letters without special strings are encoded by ``tiktoken`` from the same vocabulary as
    ranks when ``ranks_path`` is given (a few times faster, the same ids); every other piece by ``tokenizers``.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        self.tokenizer = load_tokenizer(path)
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cache = PieceCache(lambda p: self.raw(" " + p))

    def raw(self, text: str) -> bytes:
        if self.fast is not None and "<|" not in text and (text.isascii() or max(text) < "ɐ"):
            return _le32(self.fast.encode_ordinary(text))
        return _le32(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        return pieces(text, self.cache, self.raw, lambda first, rest: b"".join([*first, *rest])) if text else b""


@lru_cache(maxsize=4)
def id_encoder(path: str, ranks_path: str | None = None, pattern: str | None = None) -> IdEncoder:
    """One encoder per worker process and file."""
    return IdEncoder(path, ranks_path, pattern)
