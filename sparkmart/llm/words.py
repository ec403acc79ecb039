"""Word work inside Python tasks, on UTF-8 bytes: there lower() touches A-Z only and patterns over ASCII delimiters are fast."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Runs of ASCII letters, digits and anything beyond ASCII.
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that little of a batch is held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


class WordHashes(dict):
    """XXH64 of words, kept for words seen before; emptied when it has grown large, so memory stays bounded."""

    LIMIT = 120_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
