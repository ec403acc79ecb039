"""Token ids of whole texts as the tokenizers library gives them, for byte-level BPE vocabularies, with a cache of pieces.

A byte-level BPE pre-tokenizer starts a new piece at a blank that has no white space before it or none after it, so a text may be
cut there and its ids are those of the parts. Texts with blanks that do not qualify, and texts that hold a special token, go to
the library whole. A new piece of Latin letters goes to tiktoken, with ranks from the same vocabulary file, where a call takes a
third of the time; others go to the library, as the two may know different versions of Unicode.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import tiktoken

_UNSAFE = re.compile(r"\s (?!\S)")
_LATIN = re.compile(r"[\x00-\u024f‐-⁞]*").fullmatch
#: The byte-level pre-tokenizer's pattern, a fixed value.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def bytes_by_sign() -> dict[str, int]:
    """A byte-level vocabulary's signs for bytes: printable ones stand for themselves, the others are numbered from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Ids by token bytes, if they rise with the merges, which is what tiktoken takes ids for; else None."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    signs = bytes_by_sign()
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    return {bytes(signs[c] for c in t): i for t, i in model["vocab"].items() if all(c in signs for c in t) and i <= merged[-1]}


class _Pieces(dict):
    """Ids of pieces that follow a blank. Once LIMIT are kept, further ones are computed each time, which bounds a worker's memory."""

    LIMIT = 250_000

    def __init__(self, one):
        self.one, self.missed = one, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.one(" " + piece)
        self.missed += 1
        if len(self) < self.LIMIT:
            self[piece] = ids
        return ids


class PieceTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        ranks = _ranks(path)
        self.fast = tiktoken.Encoding("pieces", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.pieces = _Pieces(self._one)

    def _one(self, piece: str) -> bytes:
        if self.fast is not None and _LATIN(piece):
            return array("I", self.fast.encode_ordinary(piece)).tobytes()
        return array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Unsigned 32-bit ids of each text, in the machine's order (little-endian here); NULL counts as empty."""
        out, before, seen = [], self.pieces.missed, 0
        get = self.pieces.__getitem__
        for t in texts:
            if not t or any(s in t for s in self.special) or _UNSAFE.search(t):
                out.append(array("I", self.library.encode(t or "", add_special_tokens=False).ids).tobytes())
                continue
            first, *rest = t.split(" ")
            seen += len(rest)
            out.append(self._one(first) + b"".join(map(get, rest)))
        if len(self.pieces) >= self.pieces.LIMIT and (self.pieces.missed - before) * 2 > seen:
            self.pieces.clear()  # what is kept is of another language
        return out


_READY: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """The tokenizer of a vocabulary file, read once per Python worker."""
    if path not in _READY:
        _READY[path] = PieceTokenizer(path)
    return _READY[path]
