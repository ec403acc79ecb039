"""Token counts by a finite-state machine compiled from a byte-level BPE tokenizer.

The machine reads a text's UTF-8 bytes; each transition carries by how much the count of tokens changes. It does the work of the
pre-tokenizer's pattern and of the merges together:

* Merges. The tokens of a piece are the one way to cut it in which each token may follow the one before (merging them again gives
  the same two). So what the rest of a piece can still depend on are the places where a longer token may have begun: the bytes
  since then, the token that ends there, and the count there less the count now. A byte picks the one place from which a token
  that may follow ends here, and so fixes the new count.
* Pieces. Modes tell letters, digits, other signs, white space and the apostrophe forms apart. White space before a sign waits
  with the count as it would be without its last character, as that one may belong to what follows.

States are made when first met, so the machine is as large as the language it has read; it is emptied when it passes LIMIT.

A text is cut into chunks that are read side by side. A chunk's map leads from the state it is entered in to the state it is left
in and the tokens between. From white space after an ASCII sign on the state is always the same, so the map of a chunk that has
such a place is constant but for its first bytes. Any other chunk (Chinese text, one long run of letters) is read from the few
states that the bytes before it suggest, and maps of neighbours compose pairwise in a prefix scan, in as many rounds as the
chunks' number has binary digits. A map that lacks the state its chunk is truly entered in gets it, and the scan is done again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.piece_tokens import bytes_by_sign
from sparkmart.llm.words import utf8

CHUNK = 2048
#: States a chunk's map is made for before the true one is known, and the bytes before the chunk that suggest them.
WIDTH, LOOK = 16, 128
#: Texts that are read side by side.
LANES = 2500
#: Room for the states that one count may add past the limit.
ROOM = 1 << 17

# After an apostrophe that starts a piece, these letters end it with the apostrophe.
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")

_LETTER, _DIGIT, _SPACE = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")


class Merges:
    """The vocabulary, and which token may follow which."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        signs = bytes_by_sign()
        self.special = [t["content"] for t in whole.get("added_tokens", [])]
        raw = lambda s: bytes(signs[c] for c in s)
        self.tokens = {t: t for t in map(raw, (t for t in whole["model"]["vocab"] if t not in self.special))}
        pairs = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in whole["model"]["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.made: dict[bytes, tuple[int, bytes, bytes]] = {}
        for i, (a, b) in enumerate(pairs):
            self.made.setdefault(a + b, (i, a, b))
        self.starts = {s: s for t in self.tokens for s in (t[:i] for i in range(1, len(t)))}
        self.known: dict[tuple[bytes, bytes], bool] = {}
        self.edge = lru_cache(200_000)(self._edge)

    def _edge(self, token: bytes, right: bool) -> list[tuple[bytes, float]]:
        """What stands at a token's edge while it is merged: (part, rank of the merge that takes it up)."""
        parts, until = [], float("inf")
        while True:
            parts.append((token, until))
            if token not in self.made:
                return parts
            until, a, b = self.made[token]
            token = b if right else a

    def may_follow(self, a: bytes, b: bytes) -> bool:
        """Whether merging the bytes of a and b again gives a and b: no merge across the border comes before those within."""
        found = self.known.get((a, b))
        if found is None:
            rank = self.rank
            found = True
            for x, until_x in self.edge(a, True):
                for y, until_y in self.edge(b, False):
                    across = rank.get((x, y))
                    if across is not None and across < until_x and across <= until_y:  # equal merges go left to right
                        found = False
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[(a, b)] = found
        return found


#: Places in a piece from which a token may still run on: (bytes since, token that ends there, its count less the present one).
Open = tuple[tuple[bytes, bytes | None, int], ...]
_FRESH: Open = ((b"", None, 0),)

# Modes. A state is (mode, open places, count change that an ending or a following sign would undo, pending bytes of a character).
START, LETTERS, DIGITS, OTHERS, BLANK, LONE, LATER = range(7)
# BLANK: a piece of white space; the third item is the count of its last character, the fourth that character's bytes.
# LONE: an apostrophe that started a piece. LATER: and a letter after it that may begin an ending of two.


class Machine:
    LIMIT = 150_000

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.special = self.merges.special
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.list: list[tuple] = []
        self.shared: dict[tuple, tuple] = {}  # parts of states that many have in common
        # State after, and the change of the count in the low byte; 0 is not known yet. Rows take memory when first written.
        self.moves = np.zeros((self.LIMIT + ROOM, 256), np.int32)
        self.start = self.number((START, _FRESH, 0, b"", b""))
        self.after = {b: self.number((BLANK, *self._feed(_FRESH, b)[:1], 1, b, b"")) for b in (b" ", b"\n", b"\t", b"\r")}

    def number(self, state: tuple) -> int:
        found = self.states.get(state)
        if found is None:
            found = self.states[state] = len(self.list)
            self.list.append(state)
            if found >= len(self.moves):
                self.moves = np.concatenate((self.moves, np.zeros((ROOM, 256), np.int32)))
        return found

    def _feed(self, open_: Open, raw: bytes) -> tuple[Open, int]:
        """Read bytes within a piece: the places then open, and the change of the count."""
        total, m, shared = 0, self.merges, self.shared
        for i in range(len(raw)):
            byte, live, found = raw[i : i + 1], [], None
            for since, token, count in open_:
                longer = since + byte
                if found is None and longer in m.tokens and (token is None or m.may_follow(token, longer)):
                    found = (longer, count + 1)
                start = m.starts.get(longer)
                if start is not None:
                    live.append((start, token, count))
            token, change = m.tokens[found[0]], found[1]
            total += change
            places = [*((s, t, c - change) for s, t, c in live), (b"", token, 0)]
            open_ = tuple([shared.setdefault(x, x) for x in places])
        return open_, total

    def _char(self, state: tuple, raw: bytes) -> tuple[tuple, int]:
        """Read one whole character."""
        mode, open_, last, kept, _ = state
        char = raw.decode("utf-8", "surrogatepass")
        kind = LETTERS if _LETTER.match(char) else DIGITS if _DIGIT.match(char) else BLANK if _SPACE.match(char) else OTHERS
        begin = 0
        if mode == LATER:
            if kept + raw in ENDINGS:
                whole = self._feed(_FRESH, b"'" + kept + raw)[1]
                return (START, _FRESH, 0, b"", b""), whole - 1 - self._feed(_FRESH, kept)[1]
            mode = LETTERS
        elif mode == LONE:
            if raw in ENDINGS:
                return (START, _FRESH, 0, b"", b""), self._feed(_FRESH, b"'" + raw)[1] - 1
            if any(e[:1] == raw for e in ENDINGS):
                grown, count = self._feed(_FRESH, raw)
                return (LATER, grown, 0, raw, b""), count
            mode = OTHERS
        if mode == BLANK:
            if kind == BLANK:
                grown, count = self._feed(open_, raw)
                return (BLANK, grown, count, raw, b""), count
            open_, begin = _FRESH, 0
            if kept == b" ":  # the last blank belongs to this piece
                begin = -last
                open_, more = self._feed(open_, b" ")
                begin += more
            elif last != self._feed(_FRESH, kept)[1]:  # the last white space is a piece of its own
                begin = self._feed(_FRESH, kept)[1] - last
            grown, count = self._feed(open_, raw)
            lone = raw == b"'" and kept != b" "
            return (LONE if lone else kind, grown, 0, b"", b""), begin + count
        if kind == mode:
            grown, count = self._feed(open_, raw)
            return (mode, grown, 0, b"", b""), count
        grown, count = self._feed(_FRESH, raw)
        if kind == BLANK:
            return (BLANK, grown, count, raw, b""), count
        if raw == b"'":
            return (LONE, grown, 0, b"", b""), count
        return (kind, grown, 0, b"", b""), count

    def _step(self, state: tuple, byte: bytes) -> tuple[tuple, int]:
        mode, open_, last, kept, part = state
        raw = part + byte
        width = 1 if raw[0] < 0x80 else 2 if raw[0] < 0xE0 else 3 if raw[0] < 0xF0 else 4
        if len(raw) < width:
            return (mode, open_, last, kept, raw), 0
        return self._char((mode, open_, last, kept, b""), raw)

    def _compile(self, state: int, byte: int) -> None:
        after, change = self._step(self.list[state], bytes([byte]))
        number = self.number(after)
        self.moves[state, byte] = number << 8 | change + 128  # a change is above -128, so this is never 0

    def run(self, data: np.ndarray, first: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read data[first:end] for each lane from its state: the states then, and the changes of the counts."""
        order = np.argsort(first - end, kind="stable")  # longest first, so the lanes still open are a prefix
        at, lengths, state = first[order], (end - first)[order], state[order].astype(np.int64)
        count = np.zeros(len(at), np.int64)
        open_ = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")
        for step, n in enumerate(open_.tolist()):
            byte = data[at[:n] + step]
            place = state[:n] << 8 | byte
            move = self.moves.ravel()[place]
            new = move == 0
            if new.any():
                for p in set(place[new].tolist()):
                    self._compile(p >> 8, p & 255)
                move = self.moves.ravel()[place]
            count[:n] += (move & 255) - 128
            state[:n] = move >> 8
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def count(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Bytes and tokens of each text. Strings of special tokens count as one token and part the text, as the library has it."""
        if len(self.list) > self.LIMIT:
            self.reset()
        cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        parts, owner, extra = [], [], [0] * len(texts)
        sizes = [0] * len(texts)
        for k, t in enumerate(texts):
            t = t or ""
            pieces = cut.split(t) if cut else [t]
            extra[k] = len(pieces) - 1
            raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
            sizes[k] = len(utf8(t))
            parts += raw
            owner += [k] * len(raw)
        lengths = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        starts = np.cumsum(lengths) - lengths
        chunks = np.maximum(1, -(-lengths // CHUNK))
        first_chunk = np.cumsum(chunks) - chunks
        part = np.repeat(np.arange(len(parts)), chunks)
        nth = np.arange(len(part)) - np.repeat(first_chunk, chunks)
        first = starts[part] + nth * CHUNK
        end = np.minimum(first + CHUNK, (starts + lengths)[part])
        tokens = self._scan(data, first, end, nth == 0)
        total = np.bincount(np.array(owner, np.int64), np.bincount(part, tokens, len(parts)), len(texts))
        return sizes, [int(n) + e for n, e in zip(total, extra)]

    def _scan(self, data: np.ndarray, first: np.ndarray, end: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Tokens that each chunk adds to its text. opens marks the first chunk of a text."""
        sync = np.where(opens, first, end)  # a text's first chunk is entered in the start state
        state = np.full(len(first), self.start, np.int64)
        blanks = np.isin(data, np.frombuffer(b" \n\t\r", np.uint8))
        solid = (data > 0x20) & (data < 0x7F)
        fixed = np.flatnonzero(blanks & np.concatenate(([False], solid[:-1]))) if len(data) else np.zeros(0, np.int64)
        at = np.searchsorted(fixed, first + 1)  # the sign before must be in the chunk too
        there = np.where(at < len(fixed), fixed[np.minimum(at, max(0, len(fixed) - 1))] if len(fixed) else 0, len(data))
        known = ~opens & (there < end)
        for byte, number in self.after.items():
            state[known & (data[np.minimum(there, max(0, len(data) - 1))] == byte[0]) if len(data) else known] = number
        tail = np.where(known, there + 1, sync)
        constant = opens | known
        left, tokens = state.copy(), np.zeros(len(first), np.int64)
        done = np.flatnonzero(constant)
        left[done], tokens[done] = self.run(data, tail[done], end[done], state[done])
        # What the byte at the fixed place itself adds: it opens a piece of white space.
        tokens[known] += 1
        loose = np.flatnonzero(~constant)
        if len(loose):
            left[loose], tokens[loose] = self._composed(data, first, end, loose, left)
        heads = np.flatnonzero(known)
        tokens[heads] += self.run(data, first[heads], there[heads], left[heads - 1])[1]
        return tokens

    def _suggested(self, data: np.ndarray, lowest: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """States that places may be reached in, read from two neighbouring characters before them: which place, and the state."""
        found, place = [], np.maximum(lowest, at - LOOK)
        for _ in range(2):
            for _ in range(3):  # on to the first byte of a character
                place = place + ((place < at) & (data[np.minimum(place, len(data) - 1)] & 0xC0 == 0x80))
            some = np.flatnonzero(place < at)
            found.append((some, self.run(data, place[some], at[some], np.full(len(some), self.start, np.int64))[0]))
            place = np.minimum(place + 1, at)
        return found

    def _composed(self, data: np.ndarray, first: np.ndarray, end: np.ndarray, loose: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State each of these chunks is left in and its tokens; the chunk before a run of them has its state in left."""
        opens = np.concatenate(([True], loose[1:] != loose[:-1] + 1))
        begin = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        nth = np.arange(len(loose)) - begin[run]
        first, end, given = first[loose], end[loose], left[loose[begin] - 1]
        entry, exits = np.full((2, len(loose), WIDTH), -1, np.int64)
        gain, used = np.zeros((len(loose), WIDTH), np.int64), np.zeros(len(loose), np.int64)
        inner = np.flatnonzero(~opens)
        suggested = self._suggested(data, first[begin][run[inner]], first[inner])
        chunk = np.concatenate((begin, *(inner[some] for some, _ in suggested)))
        state = np.concatenate((given, *(states for _, states in suggested)))
        while True:
            pairs = np.unique(np.stack((chunk, state)), axis=1)
            chunk, state = pairs
            slot = used[chunk] + np.arange(len(chunk)) - np.searchsorted(chunk, chunk)
            chunk, state, slot = (x[slot < WIDTH] for x in (chunk, state, slot))
            entry[chunk, slot] = state
            exits[chunk, slot], gain[chunk, slot] = self.run(data, first[chunk], end[chunk], state)
            np.maximum.at(used, chunk, slot + 1)
            after, total = _prefixes(entry[:, : used.max()], exits[:, : used.max()], gain[:, : used.max()], nth)
            missing = after < 0
            if not missing.any():
                return after, total - np.where(opens, 0, np.concatenate(([0], total[:-1])))
            # The first chunk of a run that lacks its true state gets it alone; those after it get what their neighbours may leave.
            sure = np.flatnonzero(missing & (np.concatenate(([-1], after[:-1])) >= 0))
            entry[sure], exits[sure], used[sure] = -1, -1, 0
            rest = np.setdiff1d(np.flatnonzero(missing), sure)
            left_in = exits[rest - 1]
            new = (left_in >= 0) & ~(left_in[:, :, None] == entry[rest][:, None, :]).any(2)
            chunk = np.concatenate((sure, np.repeat(rest, new.sum(1))))
            state = np.concatenate((after[sure - 1], left_in[new]))


def _prefixes(entry: np.ndarray, exits: np.ndarray, gain: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inclusive prefix scan of the chunks' maps within each run: the state after each chunk, -1 if no map leads there, and the tokens so far.

    Row c maps entry[c, i] to exits[c, i] with gain[c, i] tokens. After the round of distance d row c holds the map of up to 2d chunks
    that end with c. A run's first chunk has one entry, the true one.
    """
    exits, gain = exits.copy(), gain.copy()
    distance = 1
    while distance <= nth.max():
        later = np.flatnonzero(nth >= distance)
        between, second = exits[later - distance], exits[later]
        same = (between[:, :, None] == entry[later - distance + 1][:, None, :]) & (between >= 0)[:, :, None]
        found, place = same.any(2), same.argmax(2)
        more = np.take_along_axis(gain[later], place, 1)
        gain[later] = gain[later - distance] + np.where(found, more, 0)
        exits[later] = np.where(found, np.take_along_axis(second, place, 1), -1)
        distance *= 2
    return exits[:, 0], gain[:, 0]


_READY: dict[str, Machine] = {}


def machine(path: str) -> Machine:
    """The machine of a vocabulary file; it grows with use and is kept by the Python worker."""
    if path not in _READY:
        _READY[path] = Machine(path)
    return _READY[path]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; no begin, end or other tokens are added.

    NULL counts as empty, which has no tokens. Repeated rows and NULL ids come out as they came in; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = machine(path)
        for batch in batches:
            for at in range(0, batch.num_rows, LANES):
                part = batch.slice(at, LANES)
                counts = [pa.array(c, pa.int64()) for c in own.count(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), *counts], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
