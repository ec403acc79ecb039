"""Best-fit packing of tokenised documents by exact-complement hashing.

Piece lengths are whole numbers up to the sequence length, so how many pieces there are of each length says all that the plan
needs: a table of at most `capacity` rows, whatever the data. For each length, longest first, the plan looks for one, two or
three lengths that fill the gap exactly, by an index of the sums of single lengths and pairs, and uses a combination as often as
its scarcest length allows. What is left is packed best-fit. Each use exhausts a length, so the plan stays a few thousand rows.

Pieces find their places by their number among the pieces of their length: a count per task and length, added up over tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.piece_tokens import tokenizer
from sparkmart.llm.store import written

CAPACITY = 1024
END_ID = 2
_BATCH = 500

#: A way to fill sequences: the lengths in it, and in how many sequences it is used.
Pattern = tuple[tuple[int, ...], int]


def _singles(gap: int, left: dict[int, int], lengths: list[int], pairs: dict[int, list[tuple[int, int]]]) -> tuple[int, ...] | None:
    return (gap,) if left.get(gap, 0) else None


def _pairs(gap: int, left: dict[int, int], lengths: list[int], pairs: dict[int, list[tuple[int, int]]], taken: int = 0) -> tuple[int, ...] | None:
    """Two lengths left that add up to the gap, the larger one as large as can be; taken is a length in use besides."""
    options = pairs.get(gap, [])
    while options:  # what has run out never comes back
        a, b = options[-1]
        if left[a] and left[b] and (a != b or left[a] > 1):
            break
        options.pop()
    for a, b in reversed(options):
        if all(left[x] >= (a, b, taken).count(x) for x in {a, b, taken} - {0}):
            return a, b
    return None


def _triples(gap: int, left: dict[int, int], lengths: list[int], pairs: dict[int, list[tuple[int, int]]]) -> tuple[int, ...] | None:
    for third in reversed(lengths[: bisect_left(lengths, gap)]):
        if left[third] and (found := _pairs(gap - third, left, lengths, pairs, third)):
            return (*found, third)
    return None


def _complements(left: dict[int, int], capacity: int, finders: tuple) -> list[Pattern]:
    """Patterns that fill sequences exactly; takes what they use out of left."""
    lengths = sorted(left)
    pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, a in enumerate(lengths):
        for b in lengths[i:]:
            if a + b >= capacity:
                break
            pairs[a + b].append((a, b))
    for options in pairs.values():
        options.sort(key=lambda p: p[1])
    patterns: list[Pattern] = []
    for find in finders:
        for n in reversed(lengths):
            while left[n]:
                left[n] -= 1
                others = find(capacity - n, left, lengths, pairs)
                left[n] += 1
                if others is None:
                    break
                used = (n, *others)
                times = min(left[x] // used.count(x) for x in used)
                for x in used:
                    left[x] -= times
                patterns.append((used, times))
    return patterns


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up counts[length] pieces of each length, in as few sequences as the method finds.

    Pieces spent on exact triples, or pairs, may leave long ones without a partner, so the plan is also made with fewer kinds of
    complements, and the one with the fewest sequences is kept; the first of equals.
    """
    whole = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in whole):
        raise ValueError(f"lengths must be 1 to {capacity}")
    full: list[Pattern] = [((capacity,), whole.pop(capacity))] if capacity in whole else []
    found = []
    for finders in ((_singles, _pairs, _triples), (_singles, _pairs), (_singles,)):
        left = dict(whole)
        exact = _complements(left, capacity, finders)
        found.append(exact + _best_fit({n: c for n, c in left.items() if c}, capacity))
    return full + min(found, key=lambda patterns: sum(times for _, times in patterns))


def _best_fit(left: dict[int, int], capacity: int) -> list[Pattern]:
    """Longest pieces first, each into the fullest sequence it fits; equal sequences are handled together."""
    open_: dict[int, list[list]] = defaultdict(list)  # by gap: [lengths, times]
    gaps: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if not open_[gap]:
            insort(gaps, gap)
        open_[gap].append([lengths, times])

    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                each = capacity // n
                if count >= each:
                    put((n,) * each, count // each)
                if count % each:
                    put((n,) * (count % each), 1)
                break
            gap = gaps[at]
            lengths, times = open_[gap].pop()
            if not open_[gap]:
                gaps.remove(gap)
            used = min(count, times)
            if times > used:
                put(lengths, times - used)
            put((*lengths, n), used)
            count -= used
    return [(lengths, times) for groups in open_.values() for lengths, times in groups]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, place[, ids]): the documents' ids and an end id, cut to capacity.

    Only longer documents are cut; their first piece takes what does not fill a whole one. task and place number the pieces of
    each length within a task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = tokenizer(path).encode, TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                rows: list[tuple] = []
                for k, ids in enumerate(encode(part.column(1).to_pylist())):
                    ids += end
                    total, start, piece = len(ids) // 4, 0, 0
                    while start < total:
                        n = (total - 1) % capacity + 1 if not start else capacity
                        own = ids[4 * start : 4 * (start + n)]
                        rows.append((k, piece, start, n, zlib.crc32(own), seen[n], own))
                        seen[n] += 1
                        start, piece = start + n, piece + 1
                k, piece, start, n, crc, place, own = zip(*rows)
                found = [part.column(0).take(pa.array(k)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(n, pa.int64())]
                found += [pa.array(crc, pa.int64()), pa.array([task] * len(k), pa.int64()), pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays([*found, *[pa.array(own, pa.binary())] * with_ids], names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task long, place long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces as pieces() gives them, with sequence_id and offset, without task and place. cut is read three times: write it before."""
    spark = cut.sparkSession
    counts = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    spans, used, sequence = [], defaultdict(int), 0
    for lengths, times in plan(totals, capacity):
        offset = 0
        for n in lengths:
            spans.append((n, used[n], used[n] + times, sequence - used[n], offset))
            used[n] += times
            offset += n
        sequence += times
    places = spark.createDataFrame(spans, "length long, low long, high long, shift long, offset long")
    numbered = cut.join(base, ["task", "length"]).withColumn("number", F.col("base") + F.col("place"))
    fits = (F.col("c.length") == F.col("p.length")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    kept = [c for c in cut.columns if c not in ("task", "place")]
    return (
        numbered.alias("c")
        .join(F.broadcast(places.alias("p")), fits)  # a few rows for each length up to capacity, whatever the data
        .select(*[F.col(f"c.{c}") for c in kept], (F.col("number") + F.col("shift")).alias("sequence_id"), F.col("p.offset").alias("offset"))
    )


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Every document's ids, packed: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    NULL and empty texts are documents of the end id alone. Repeated rows are packed as often as they come, NULL ids too. Other
    columns are not read. An empty table gives no pieces.
    """
    return pack(written(pieces(docs, path, id_col, text_col, capacity, with_ids), "pieces"), capacity)
