"""SimHash near-duplicates with covering locality-sensitive hashing.

The bits of a fingerprint are dealt to seven blocks, the points of the Fano plane. Each of seven tables leaves out the three
blocks of one line and keys on the other four. Any two blocks lie on a line, so two fingerprints that differ in at most two bits
agree on all kept bits of some table: no pair within the radius is missed. Buckets over a size are dealt again by the bits that
their table left out, by the same construction, until the bits that are left bound the bucket.

A bucket gives a star of edges for each group that is linked in it, not its pairs, so the edges grow with the members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.components import components
from sparkmart.llm.store import written
from sparkmart.llm.words import WORD, slices, utf8

RADIUS = 2
SHINGLE = 3
BUCKET = 1024
_CHUNK = 60_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles, repeats included; 0 without words, one shingle of all words if they are fewer."""
    words = WORD.findall(utf8(text).lower())
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        bits = np.unpackbits(h[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row, fp as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def covering(kept: int, left: list[int]) -> list[tuple[int, list[int]]]:
    """Seven tables that refine the mask kept by the bits in left: (mask, bits it still leaves out)."""
    tables = []
    for line in range(1, 8):
        takes = [(((i % 7) + 1) & line).bit_count() % 2 for i in range(len(left))]
        mask = kept | sum(1 << b for b, t in zip(left, takes) if t)
        tables.append((mask, [b for b, t in zip(left, takes) if not t]))
    return tables


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each group linked within a bucket to its least node."""
    for batch in batches:
        a, b = [], []
        ends = np.cumsum(batch.column(0).value_lengths().to_numpy(zero_copy_only=False))
        members = batch.column(0).flatten()
        all_nodes, all_fps = (members.field(k).to_numpy(zero_copy_only=False) for k in ("node", "fp"))
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
            nodes, fps = all_nodes[start:end], all_fps[start:end].astype(np.int64).view(np.uint64)
            order = np.argsort(nodes)
            nodes, fps = nodes[order], fps[order]
            linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= RADIUS
            least = np.arange(len(nodes))
            while True:
                now = np.where(linked, least[None, :], len(nodes)).min(axis=1)
                now = now[now]
                if (now == least).all():
                    break
                least = now
            far = least != np.arange(len(nodes))
            a.append(nodes[far])
            b.append(nodes[least[far]])
        both = [np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (a, b)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["a", "b"])


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that join all of (node, fp) within RADIUS bits of each other, directly or through others. fp is distinct."""
    tables = covering(0, list(range(64)))
    edges = None

    def keys(masks: list[int], first: int) -> Column:
        return F.array(*[F.struct(F.lit(first + i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])

    rows = nodes.select("node", "fp", F.explode(keys([m for m, _ in tables], 0)).alias("k")).select("k.*", "node", "fp")
    while True:
        sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        last = min(len(left) for _, left in tables) <= bucket.bit_length() - 1
        shared = written(rows.join(sizes, ["t", "key"]), "buckets")
        small = shared if last else shared.where(F.col("n") <= bucket)
        gathered = small.groupBy("t", "key").agg(F.collect_list(F.struct("node", "fp")).alias("bucket")).select("bucket")
        found = gathered.mapInArrow(_stars, "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
        if last or shared.where(F.col("n") > bucket).isEmpty():
            return edges
        finer = [covering(mask, left) for mask, left in tables]
        deal = F.element_at(F.array(*[keys([m for m, _ in seven], 7 * i) for i, seven in enumerate(finer)]), F.col("t") + 1)
        rows = shared.where(F.col("n") > bucket).select("node", "fp", F.explode(deal).alias("k")).select("k.*", "node", "fp")
        tables = [t for seven in finer for t in seven]


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of docs.

    Fingerprints link at RADIUS or fewer differing bits; component_id is the least doc_id that can be reached, itself included.
    Equal fingerprints are one node, so a group of copies of any size costs one node. NULL and empty texts have fingerprint zero
    and link like any other. Repeated rows come out as often as they came in. A NULL doc_id takes part with its fingerprint, but
    cannot be a component's id unless no other is there. Ids are whole numbers. Other columns are not read.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    reached = components(links(nodes.where("node IS NOT NULL"), bucket), "a", "b")
    classes = nodes.join(reached, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(classes, "fp").select("doc_id", hexed, "component_id")
