"""Repeated passages: windows of consecutive words that start at two places or more, located by sharded Aho-Corasick automata.

1. Each window is filed under its least gram (a hash of GRAM consecutive words), which its content alone decides. Every document
   gives its grams that are least in some window, about two in WIDTH - GRAM + 2 words.
2. Grams that occur once in the corpus rule their windows out. Documents with exactly the same words are one class before that, so
   a group of copies of any size is one document here; all windows of a class of two or more are repeated.
3. What is left is cut into passages, each with the windows filed under one gram, and sent to that gram's shard. A shard confirms
   the windows that recur, compiles them to an automaton over word numbers, and streams its passages through it. Words are
   compared, not hashes. Grams are handled in batches, so an automaton's size is bounded.
4. A gram in more than HOT documents doesn't go to one shard: its windows are counted by digest, which combines inside the tasks,
   and joined back; a window that alone holds more than a task's fair share of these rows is spread over several tasks.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.store import written
from sparkmart.llm.words import WORD, WordHashes, slices, utf8
from sparkmart.operators.skew import hot_values, salted_join

WIDTH = 35
GRAM = 10
HOT = 2_000
#: Passages whose windows one automaton holds at most, apart from a single gram's.
BATCH = 4_000

_HASHES = WordHashes()
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _grams(words: list[bytes], gram: int) -> np.ndarray:
    """A well-mixed hash for each run of gram words."""
    h = _HASHES.of(words)
    n = len(words) - gram + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(gram):
        mixed = mixed * _MULTIPLIER + h[k : k + n]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of width values, by doubling."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def _least(words: list[bytes], width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams' hashes, and the least one in each window."""
    grams = _grams(words, gram)
    return grams, _slide(grams, width - gram + 1, np.minimum)


def anchors(words: list[bytes], width: int = WIDTH, gram: int = GRAM) -> np.ndarray:
    """Hashes that are least in some window, twice if they are at two places or more."""
    if len(words) < width:
        return np.zeros(0, np.int64)
    span = width - gram + 1
    grams, least = _least(words, width, gram)
    padded = np.concatenate((np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)))
    chosen = grams[grams == _slide(padded, span, np.maximum)]
    values, counts = np.unique(chosen, return_counts=True)
    return np.concatenate((values, values[counts > 1])).view(np.int64)


def _sketch(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, digest, found = [], [], []
            for text in batch.column(3).to_pylist():
                words = WORD.findall(utf8(text))
                n.append(len(words))
                digest.append(hashlib.sha256(b" ".join(words)).digest())
                found.append(anchors(words, width, gram))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
            columns = [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(digest, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k1", "k2", "n_words", "digest", "anchors"])

    return run


def _passages(width: int, gram: int, hot: bool, limit: int):
    """Passages of documents (rid, text, [(gram, documents that have it)]): those of hot grams as window digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, rids, starts, contents = [], [], [], []
            lists = batch.column(2)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            members = lists.flatten()
            hashes, counts = (members.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for rid, text, first, end in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
                mine = hashes[first:end][(counts[first:end] > limit) == hot].astype(np.int64)
                if not len(mine):
                    continue
                words = WORD.findall(utf8(text))
                least = _least(words, width, gram)[1].view(np.int64)
                wanted = np.isin(least, mine)
                change = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1], [True])))
                for a, b in zip(change[:-1].tolist(), change[1:].tolist()):
                    if not wanted[a]:
                        continue
                    if not hot:
                        grams.append(least[a])
                        rids.append(rid)
                        starts.append(a)
                        contents.append(b" ".join(words[a : b + width - 1]))
                        continue
                    for at in range(a, b):
                        grams.append(least[a])
                        rids.append(rid)
                        starts.append(at)
                        contents.append(hashlib.blake2b(b" ".join(words[at : at + width]), digest_size=16).hexdigest().encode())
            columns = [pa.array(grams, pa.int64()), pa.array(rids, pa.int64()), pa.array(starts, pa.int32()), pa.array(contents, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "rid", "start", "content"])

    return run


def locate(passages: list[list[bytes]], width: int = WIDTH) -> list[list[tuple[int, int]]]:
    """For each passage the runs of words in windows that start at two places or more among the passages."""
    numbers: dict[bytes, int] = {}
    coded = [tuple([numbers.setdefault(w, len(numbers)) for w in p]) for p in passages]
    windows = Counter(p[at : at + width] for p in coded for at in range(len(p) - width + 1))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    recurring = [w for w, n in windows.items() if n > 1]
    for w in recurring:
        automaton.add_word(w, True)
    if not recurring:
        return [[] for _ in passages]
    automaton.make_automaton()
    found = []
    for p in coded:
        runs: list[tuple[int, int]] = []
        for last, _ in automaton.iter(p):
            start = last - width + 1
            if runs and start <= runs[-1][1]:
                runs[-1] = (runs[-1][0], last + 1)
            else:
                runs.append((start, last + 1))
        found.append(runs)
    return found


def _shards(width: int, batch_size: int):
    """Rows of a shard in the order of their grams to the runs found: (rid, first, until)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []

        def close(rows: list) -> pa.RecordBatch:
            runs = locate([r[3].split(b" ") for r in rows], width)
            out = [(r[1], r[2] + a, r[2] + b) for r, own in zip(rows, runs) for a, b in own]
            rid, first, until = zip(*out) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(first, pa.int32()), pa.array(until, pa.int32())], ["rid", "first", "until"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= batch_size and row[0] != held[-1][0]:
                    yield close(held)
                    held = []
                held.append(row)
        if held:
            yield close(held)

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, text, runs) to (k1, k2, n_removed, kept_sha256, removed)."""
    for batch in batches:
        n, digest, merged = [], [], []
        for text, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = WORD.findall(utf8(text))
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, [r["first"] for r in runs], 1)
            np.add.at(step, [r["until"] for r in runs], -1)
            gone = np.cumsum(step[:-1]) > 0
            n.append(int(gone.sum()))
            digest.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist()) if not g)).hexdigest())
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
            merged.append([{"first": a, "until": b} for a, b in edge.tolist()])
        kind = pa.list_(pa.struct([("first", pa.int32()), ("until", pa.int32())]))
        columns = [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(merged, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n_removed", "kept_sha256", "removed"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, removed) for every row.

    A word is removed if a window of width words that covers it has the same words as one that starts elsewhere, in the same
    document or another; windows are judged on the input. removed holds the runs of removed words (first, until), kept_sha256 the
    digest of the kept words joined by single blanks. NULL, empty and short texts have no windows. Repeated rows are copies of each
    other, whatever their ids. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    # A document's key is made of its row alone, so it is the same however often and wherever it is computed.
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("k1"), F.xxhash64(F.lit(1), F.col(text_col), F.col(id_col)).alias("k2"), F.col(text_col).alias("text"))
    shape = f"doc_id {kind}, k1 long, k2 long, n_words long, digest binary, anchors array<long>"
    sketch = written(keyed.mapInArrow(_sketch(width, gram), shape), "sketch")

    long = sketch.where(F.col("n_words") >= width)
    classes = written(long.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("k1", "k2")).alias("k")), "classes")
    # Equal rows share their key; one of them stands for all, here and for the text, or they would meet in the join as pairs.
    single = long.groupBy("k1", "k2").agg(F.first("anchors").alias("anchors"))
    first = single.join(classes.select("k.*", "copies"), ["k1", "k2"]).select("k1", "k2", "copies", "anchors")
    first = written(first.withColumn("rid", F.monotonically_increasing_id()), "representatives")

    each = first.select("rid", F.explode("anchors").alias("gram"))
    again = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = each.distinct().join(again, "gram").groupBy("rid").agg(F.collect_list(F.struct("gram", "n")).alias("grams"))
    held = first.select("rid", "k1", "k2", "copies").join(shared, "rid")
    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    suspects = written(texts.join(held, ["k1", "k2"]), "suspects")

    rows = suspects.select("rid", "text", "grams")
    shape = "gram long, rid long, start int, content binary"
    cold = rows.mapInArrow(_passages(width, gram, False, hot), shape)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = cold.repartition(n, "gram").sortWithinPartitions("gram").mapInArrow(_shards(width, BATCH), "rid long, first int, until int")
    warm = rows.mapInArrow(_passages(width, gram, True, hot), shape).select(F.col("content").cast("string").alias("window"), "rid", "start")
    warm = written(warm, "windows")
    recurring = warm.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    located = salted_join(warm, recurring, "window", "inner", hot_values(warm, ["window"])["window"], ["rid", "start"])
    located = located.select("rid", F.col("start").alias("first"), (F.col("start") + width).cast("int").alias("until"))

    alone = suspects.where("copies = 1").select("rid", "k1", "k2", "text")
    found = runs.unionByName(located).groupBy("rid").agg(F.collect_list(F.struct("first", "until")).alias("runs"))
    shape = "k1 long, k2 long, n_removed long, kept_sha256 string, removed array<struct<first: int, until: int>>"
    parts = alone.join(found, "rid").select("k1", "k2", "text", "runs").mapInArrow(_removed, shape)

    copied = classes.where("copies > 1").select("digest", F.lit(True).alias("copied"))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("until")))
    nothing = F.array().cast("array<struct<first: int, until: int>>")
    is_copy = F.col("copied").isNotNull()
    return (
        sketch.drop("anchors")
        .join(copied, "digest", "left")
        .join(parts, ["k1", "k2"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(is_copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
            F.when(is_copy, whole).otherwise(F.coalesce("removed", nothing)).alias("removed"),
        )
    )
