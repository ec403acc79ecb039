"""Benchmark decontamination: an FM-index per shard of documents, searched backwards for all benchmark windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.fm_index import FMIndex
from sparkmart.llm.store import unused
from sparkmart.llm.words import ALNUM, slices, utf8

WINDOW = 10
SHARD_WORDS = 1 << 18
#: Benchmark text that is sent to the executors at once; more goes in further blocks.
BLOCK_BYTES = 16 << 20
_LOCATED = 1 << 18

FOUND = (("n_words", T.LongType()), ("n_hit", T.LongType()), ("items", T.ArrayType(T.StringType())), ("clean_text", T.StringType()))


class Windows:
    """The distinct windows of a block of items, as rows of word numbers, and the items of each window."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        words: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], int] = {}
        pairs: set[tuple[int, int]] = set()
        self.items = sorted({i for i, _ in items})
        place = {i: k for k, i in enumerate(self.items)}
        for item, text in items:
            ids = [words.setdefault(w, len(words)) for w in ALNUM.findall(utf8(text).lower())]
            for at in range(max(1, len(ids) - width + 1) if ids else 0):
                pairs.add((windows.setdefault(tuple(ids[at : at + width]), len(windows)), place[item]))
        self.words = list(words)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.rows = np.full((len(windows), width), -1, np.int64)
        for k, w in enumerate(windows):
            self.rows[k, width - len(w) :] = w
        pairs_of = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.item_of = pairs_of[:, 1]
        self.first = np.searchsorted(pairs_of[:, 0], np.arange(len(windows) + 1))

    def patterns(self, vocabulary: dict[bytes, int]) -> np.ndarray:
        known = np.array([vocabulary.get(w, 0) for w in self.words] + [0], np.int64)
        return known[self.rows]


def _search(pieces: list[np.ndarray], vocabulary: dict[bytes, int], blocks: Iterable[Windows]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, str]]]:
    """Words hit (one flag per place of the shard), the place where each piece starts, and (piece, item) pairs."""
    index = FMIndex(pieces)
    edges = np.zeros(index.n + 1, np.int64)
    found: list[tuple[int, str]] = []
    for windows in blocks:
        low, high = index.search(windows.patterns(vocabulary), windows.lengths)
        hit = np.flatnonzero(low < high)
        sizes = (high - low)[hit]
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // _LOCATED)) + 1
        for part, n in zip(np.split(hit, cuts), np.split(sizes, cuts)):
            if not len(part):
                continue
            which = np.repeat(part, n)
            rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[part], n)
            places = index.locate(rows)
            np.add.at(edges, places, 1)
            np.add.at(edges, places + windows.lengths[which], -1)
            piece = np.searchsorted(index.starts, places, side="right") - 1
            for p, w in (divmod(x, len(windows.lengths)) for x in np.unique(piece * len(windows.lengths) + which).tolist()):
                found += [(p, windows.items[i]) for i in windows.item_of[windows.first[w] : windows.first[w + 1]].tolist()]
    return np.cumsum(edges[:-1]) > 0, index.starts, found


def _without(text: str, hit: np.ndarray) -> str:
    """The text without its merged runs of hit words; what stood before and after a run is joined by one blank."""
    raw = utf8(text)
    spans = [m.span() for m in ALNUM.finditer(raw.lower())]
    step = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    kept, at = [], 0
    for first, end in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
        kept.append(raw[at : spans[first][0]].rstrip(b" "))
        at = spans[end - 1][1]
    kept.append(raw[at:].lstrip(b" ") if kept else raw[at:])
    return b" ".join(x for x in kept if x).decode("utf-8", "surrogatepass")


class _Blocks:
    """The windows of broadcast blocks, one block in memory at a time; a single one is prepared once per task."""

    def __init__(self, blocks: list, width: int):
        self.blocks, self.width = blocks, width
        self.only = Windows(blocks[0].value, width) if len(blocks) == 1 else None

    def __iter__(self) -> Iterator[Windows]:
        if self.only is not None:
            yield self.only
            return
        for block in self.blocks:
            yield Windows(block.value, self.width)


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self) + 1
        return value


def _judge(texts: list[str | None], blocks: Iterable[Windows], width: int, clean: bool) -> list[tuple]:
    """(n_words, n_hit, items, clean text if it changes) per text, shard by shard."""
    results: list[tuple] = []
    vocabulary, shard, size = _Vocabulary(), [], 0
    totals: dict[int, int] = {}

    def close() -> None:
        nonlocal vocabulary, shard, size
        flags, starts, found = _search([ids for _, _, ids in shard], vocabulary, blocks)
        for (doc, at, ids), start in zip(shard, starts.tolist()):
            marks.setdefault(doc, np.zeros(totals[doc], bool))[at : at + len(ids)] |= flags[start : start + len(ids)]
        for piece, item in found:
            items.setdefault(shard[piece][0], set()).add(item)
        vocabulary, shard, size = _Vocabulary(), [], 0

    marks: dict[int, np.ndarray] = {}
    items: dict[int, set[str]] = {}
    for doc, text in enumerate(texts):
        words = ALNUM.findall(utf8(text).lower())
        totals[doc] = len(words)
        for at in range(0, len(words), SHARD_WORDS - width + 1) if len(words) > SHARD_WORDS else (0,):
            piece = words[at : at + SHARD_WORDS]  # pieces of one longer document overlap by a window less a word
            if size and size + len(piece) > SHARD_WORDS:
                close()
            shard.append((doc, at, np.fromiter(map(vocabulary.__getitem__, piece), np.int64, len(piece))))
            size += len(piece) + 1
    if shard:
        close()
    for doc, text in enumerate(texts):
        hit = marks[doc]
        n = int(hit.sum())
        results.append((totals[doc], n, sorted(items.get(doc, ())), _without(text, hit) if clean and n else None))
    return results


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list:
    """Broadcast blocks of (item, text), each of about block_bytes; only one passes through the driver at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    count = int(-(-total // block_bytes)) or 1
    return [
        spark.sparkContext.broadcast([tuple(r) for r in items.where(F.pmod(F.xxhash64("item"), F.lit(count)) == k).collect()])
        for k in range(count)
    ]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    clean: bool = True,
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns named in keep (all by default) of every row of docs with n_words, n_hit, items and clean_text.

    Text is lower-cased in A-Z and cut into words of ASCII letters, digits and anything beyond ASCII. A window is width
    consecutive words of an item, or the whole of a shorter one that has words. A document word inside any occurrence of a window
    is hit; items are the ids, sorted as text, with occurring windows. clean_text is the text without hit words where that differs
    and is asked for, else NULL.

    NULL and empty texts have no words and no hits. A NULL item id counts as an empty one; rows that share an id are one item.
    An empty benchmark hits nothing. Columns of docs named like the results, in any case, are replaced by them. Each document is judged within its
    task; shards and benchmark blocks are bounded, longer documents are indexed in overlapping pieces.
    """
    names = [n for n, _ in FOUND]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Blocks(blocks, width)
        for batch in slices(batches):
            rows = _judge(batch.column(0).to_pylist(), windows, width, clean)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string())
            found = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], [*kept, *names])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in FOUND])
    return docs.select(F.col(text_col).alias(unused(docs, "text")), *kept).mapInArrow(run, schema)

