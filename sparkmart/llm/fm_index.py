"""FM-index over the words of a shard of documents: wavelet-tree ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Words of a shard, separators included, must fit this many bits: three of them make one sort key.
BITS = 21
LIMIT = 1 << BITS


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of ranks under LIMIT whose last one occurs once. Prefix doubling; only ties are sorted again."""
    n = len(text)
    low = (1 << BITS) - 1
    at = np.arange(n, dtype=np.int64)
    order = np.empty(n, np.int64)
    rank = text.astype(np.int64)
    slots, width = at, 1
    while len(slots):
        places = at if width == 1 else order[slots]
        ahead = places + width
        following = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        keys = np.sort((rank[places] << (2 * BITS)) | (following << BITS) | places)
        places = keys & low
        order[slots] = places
        keys >>= BITS
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        heads = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[places] = heads
        single = new & np.concatenate((new[1:], [True]))
        slots = slots[~single]
        width *= 2
    return order


class WaveletTree:
    """Rank of any symbol at any place, one bit vector for each bit of a symbol (levels laid out as a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.depth = max(1, int(symbols.max(initial=0)).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in reversed(range(self.depth)):
            bits = (symbols >> level & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(ones)[:-1])))
            self.zeros.append(n - int(ones.sum()))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each place."""
        both = np.concatenate((np.zeros_like(at), at))
        for level in range(self.depth):
            ones = self._ones(level, both)
            taken = np.tile((symbol >> (self.depth - 1 - level) & 1).astype(bool), 2)
            both = np.where(taken, self.zeros[level] + ones, both - ones)
        return both[len(at) :] - both[: len(at)]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it comes before it."""
        both, symbol = np.concatenate((np.zeros_like(at), at)), np.zeros(len(at), np.int64)
        for level in range(self.depth):
            here = both[len(at) :]
            bit = (self.words[level][here >> 6] >> (here & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            symbol = symbol << 1 | bit
            ones = self._ones(level, both)
            both = np.where(np.tile(bit, 2), self.zeros[level] + ones, both - ones)
        return symbol, both[len(at) :] - both[: len(at)]


class FMIndex:
    """Index of documents given as arrays of word ids from 1.

    Each document ends in a separator of its own, so no match crosses documents; the search tree holds all separators as 0.
    """

    def __init__(self, documents: list[np.ndarray], sample: int = 16):
        count = len(documents)
        lengths = np.array([len(d) for d in documents], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        self.starts = ends - lengths
        n = int(lengths.sum()) + count
        if n >= LIMIT:
            raise ValueError(f"a shard holds under {LIMIT} words")
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = np.concatenate([np.zeros(0, np.int64), *documents])
        ranked = text + (count - 1)
        ranked[ends] = np.arange(count)
        self.n = n
        if not n:
            return
        order = suffix_order(ranked)
        before = text[order - 1]
        self.tree = WaveletTree(before)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text))))
        opens = np.zeros(n, bool)
        opens[self.starts] = True
        kept = (order % sample == 0) | opens[order]
        self.kept, self.sampled = kept, order[kept]
        self.kept_before = np.cumsum(kept) - kept

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) whose suffixes start with each pattern; patterns are right-aligned, 0 stands for an unknown word."""
        count, width = patterns.shape
        low, high = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        known = (patterns > 0).sum(axis=1) == lengths
        high[~known] = 0
        for back in range(1, width + 1):
            live = np.flatnonzero((low < high) & (lengths >= back))
            if not len(live) or not self.n:
                break
            symbol = patterns[live, width - back]
            ranks = self.tree.rank(np.tile(symbol, 2), np.concatenate((low[live], high[live])))
            low[live], high[live] = self.less[symbol] + ranks[: len(live)], self.less[symbol] + ranks[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the shard of each row's suffix, by steps back to a sampled one."""
        rows, found, steps = rows.copy(), np.empty(len(rows), np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            there = self.kept[at]
            found[open_[there]] = self.sampled[self.kept_before[at[there]]] + steps
            open_ = open_[~there]
            symbol, rank = self.tree.access(rows[open_])
            rows[open_] = self.less[symbol] + rank
            steps += 1
        return found
