"""Near copies: documents whose sets of word shingles are alike, found by MinHash bands and confirmed on the sets themselves.

1. Documents with the same words in the same order are one class before anything is joined, so copies cost one node.
2. A shingle set is hashed once into BANDS x ROWS bins; the least hash of each bin is a minimum (one-permutation hashing, empty bins filled
   from others). ROWS minima make a band. Two classes of similarity s share one of BANDS bands with probability
   1 - (1 - s^ROWS)^BANDS: 0.9994 for s = 0.8, 0.15 for s = 0.5. Classes that share no band with another never leave their sketch.
3. Members of a band are compared in blocks of at most about BLOCK, by signatures of one byte for each minimum. First, in FIRST of the
   bands, a spanning forest of pairs whose signatures agree in SURE of the places is confirmed on the whole sets; then, in blocks of
   any band that these links do not join, all members of different components that agree in NEAR of them. A pair at s = 0.8 agrees
   in less than NEAR with a probability of about 1e-5.
4. Bands of several blocks whose members are not joined by then are compared block against block, so no pair of a band is left out.

Whole sets are made only for classes of such pairs. Near members of a block meet as one cluster, whose sets go to one task and are
compared there, so rows grow with the members of the clusters and not with their pairs; a cluster of more than TILE hashes is cut into
tiles that hold every pair of its members between them.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.components import components
from sparkmart.llm.store import sent_if_small, written
from sparkmart.llm.words import WORD, WordHashes, slices, utf8

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 8
BLOCK = 512
#: Bands in which sure pairs are looked for; near copies at 0.9 share one with a probability of 0.99, others wait for all bands.
FIRST = 8
#: Shares of a signature's places in which a pair agrees: from NEAR on it may be similar enough, from SURE on it nearly always is.
NEAR, SURE = 0.7, 0.88
#: Hashes of shingles that a task holds at once to compare a cluster, 8 bytes each, beside larger sets.
TILE = 2_000_000

_BINS = BANDS * ROWS
_HASHES = WordHashes()
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Which bins an empty one looks at, in this order.
_PROBES = np.random.default_rng(0).integers(0, _BINS, (64, _BINS))


def shingles_of(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of shingle words, or of all words if they are fewer; none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = _HASHES.of(words)
    width = min(shingle, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ h[k : k + n]) * _MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minima_of(shingles: np.ndarray) -> np.ndarray:
    """The least hash of each bin; an empty bin takes that of the first filled bin among those it looks at, or the next one."""
    h = (shingles ^ np.uint64(0xD6E8FEB86659FD93)) * _MULTIPLIER
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLIER
    bins = ((h >> np.uint64(32)) * np.uint64(_BINS)) >> np.uint64(32)
    order = np.sort((bins << np.uint64(32)) | (h * _MULTIPLIER >> np.uint64(32)))
    bins = (order >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    least, filled = np.zeros(_BINS, np.uint64), np.zeros(_BINS, bool)
    least[bins[first]] = order[first] & np.uint64(0xFFFFFFFF)
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    for probe in _PROBES:
        if not len(empty):
            return least
        found = filled[probe[empty]]
        least[empty[found]] = least[probe[empty[found]]]
        empty = empty[~found]
    there = np.flatnonzero(filled)
    least[empty] = least[there[np.searchsorted(there, empty) % len(there)]]
    return least


def bands_of(minima: np.ndarray) -> np.ndarray:
    """One hash for each band."""
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = (key ^ minima[r::ROWS]) * _MULTIPLIER
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _words(text: str | None) -> list[bytes]:
    return WORD.findall(utf8(text).lower())


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)))


def _sketched(shingle: int):
    """(doc_id, text) to (doc_id, digest, bands, signature, size of the set); no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            words = [_words(t) for t in batch.column(1).to_pylist()]
            sets = [shingles_of(w, shingle) for w in words]
            minima = [minima_of(x) if len(x) else None for x in sets]
            bands = _lists([np.zeros(0, np.int64) if m is None else bands_of(m) for m in minima])
            signatures = [b"" if m is None else m.astype(np.uint8).tobytes() for m in minima]
            columns = [batch.column(0), pa.array(map(_digest, words), pa.binary()), bands, pa.array(signatures, pa.binary()), pa.array([len(x) for x in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "bands", "signature", "size"])

    return run


def _shingled(shingle: int):
    """(doc_id, text) to (digest, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 50):
            words = [_words(t) for t in batch.column(1).to_pylist()]
            parts = _lists([shingles_of(w, shingle).view(np.int64) for w in words])
            yield pa.RecordBatch.from_arrays([pa.array(map(_digest, words), pa.binary()), parts], ["digest", "shingles"])

    return run


def agreement(signatures: np.ndarray) -> np.ndarray:
    """For each two rows the share of places that agree."""
    m, places = signatures.shape
    step = max(1, (1 << 22) // max(1, m * places))
    return np.concatenate([(signatures[i : i + step, None] == signatures[None]).sum(axis=2) for i in range(0, m, step)]) / places


def forest(component: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """The pairs (i, j) of a spanning forest of the linked rows; rows of one component count as joined."""
    root = {c: i for i, c in reversed([*enumerate(component.tolist())])}
    label, pairs = np.array([root[c] for c in component.tolist()], np.int64), []
    for i in range(len(label)):
        for j in np.flatnonzero(linked[i] & (label != label[i])).tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                pairs.append((i, j))
    return pairs


def tiles(sizes: list[int], limit: int) -> list[list[int]]:
    """Groups that hold each two places together somewhere, of at most `limit` in sum beside a place that is larger than half of it."""
    if sum(sizes) <= limit or len(sizes) < 3:
        return [list(range(len(sizes)))]
    parts, held = [[]], 0
    for i, size in enumerate(sizes):
        if parts[-1] and held + size > limit // 2:
            parts.append([])
            held = 0
        parts[-1].append(i)
        held += size
    return [x + y for x, y in itertools.combinations(parts, 2)] or parts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each block, without the block, from rows in the order of their blocks."""
    held: list[tuple] = []
    last = None
    for batch in batches:
        for block, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if block != last and held:
                yield sorted(held)
                held = []
            last = block
            held.append(tuple(row))
    if held:
        yield sorted(held)


def _signed(rows: list[tuple], place: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[place] for r in rows), np.uint8).reshape(len(rows), -1)


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    typed = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], typed[kind]) for k, kind in enumerate(kinds)], list(names))


_PAIRS = "a long, b long, one binary, two binary"
_CLUSTERS = "cluster binary, node long, component long, digest binary"
_LINKS = "a long, b long"


def _proposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, node, component, part, digest, signature, size) to a spanning forest of each block's sure pairs."""
    for rows in _blocks(batches):
        pairs = forest(np.arange(len(rows)), agreement(_signed(rows, 4)) >= SURE)
        yield _columns([(rows[i][0], rows[j][0], rows[i][3], rows[j][3]) for i, j in pairs], _PAIRS)


def _clustered(crossing: bool, tile: int):
    """Rows (block, node, component, part, digest, signature, size) to clusters of near members of different components, named by
    what they hold, so that a cluster that several bands have is compared once; with crossing only of different parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            component, part = (np.array([r[k] for r in rows], np.int64) for k in (1, 2))
            near = (agreement(_signed(rows, 4)) >= NEAR) & (component[:, None] != component[None])
            if crossing:
                near &= part[:, None] != part[None]
            label = np.arange(len(rows))
            for i, j in forest(label, near):
                label[label == label[j]] = label[i]
            out = []
            for at in np.unique(label[near.any(axis=1)]).tolist():
                places = np.flatnonzero(label == at).tolist()
                for some in tiles([rows[p][5] for p in places], tile):
                    members = [rows[places[k]] for k in some]
                    name = hashlib.blake2b(b"".join(r[3] for r in members), digest_size=16).digest()
                    out += [(name, r[0], r[1], r[3]) for r in members]
            yield _columns(out, _CLUSTERS)

    return run


def overlaps(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the sizes of its intersections with all of them, row by row; no set is empty."""
    _, places = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([len(x) for x in sets])
    starts = ends - [len(x) for x in sets]
    for i, (start, end) in enumerate(zip(starts, ends)):
        held = np.zeros(len(places), np.int64)
        held[places[start:end]] = 1
        yield i, np.add.reduceat(held[places], starts)


def _compared(least: float):
    """Rows (cluster, node, component, shingles) in the order of their clusters to a spanning forest of the pairs that are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            rows.sort(key=lambda r: r[0])
            sizes, linked = np.array([len(r[2]) for r in rows]), np.zeros((len(rows), len(rows)), bool)
            for i, common in overlaps([r[2] for r in rows]):
                linked[i] = common >= least * (sizes + sizes[i] - common)
            pairs = forest(np.array([r[1] for r in rows], np.int64), linked)
            return _columns([(rows[i][0], rows[j][0]) for i, j in pairs], _LINKS)

        held: list[tuple[int, int, np.ndarray]] = []
        last = None
        for batch in batches:
            for k, cluster in enumerate(batch.column(0).to_pylist()):
                if cluster != last and held:
                    yield close(held)
                    held = []
                last = cluster
                held.append((batch.column(1)[k].as_py(), batch.column(2)[k].as_py(), batch.column(3)[k].values.to_numpy().copy()))
        if held:
            yield close(held)

    return run


def _dealt(members: DataFrame, key: list[str], nodes: DataFrame) -> DataFrame:
    """Rows (block, node, component, part, digest, signature, size) in the order of their blocks; blocks of equal members come once."""
    # Blocks are bounded, so gathering their members is too.
    blocks = members.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("node", "component", "part"))).alias("m")).where(F.size("m") > 1)
    blocks = written(blocks.select("m").distinct().withColumn("block", F.monotonically_increasing_id()), "blocks")
    rows = blocks.select("block", F.explode("m").alias("m")).select("block", "m.*").join(nodes.select("node", "digest", "signature", "size"), "node")
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("block", "node", "component", "part", "digest", "signature", "size").repartition(n, "block").sortWithinPartitions("block")


def _sets(wanted: DataFrame, read: DataFrame, sketch: DataFrame, shingle: int) -> DataFrame:
    """(digest, shingles) of the wanted digests. One text of each class is read."""
    wanted = written(wanted.distinct(), "wanted")
    ids = sketch.join(sent_if_small(wanted), "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    texts = read.join(sent_if_small(written(ids, "ids")), "doc_id", "left_semi").mapInArrow(_shingled(shingle), "digest binary, shingles array<long>")
    return written(texts.groupBy("digest").agg(F.first("shingles").alias("shingles")), "sets")


def _confirmed(pairs: DataFrame, read: DataFrame, sketch: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) whose sets are alike; sets are compared row by row in the JVM."""
    sets = _sets(pairs.select(F.explode(F.array("one", "two")).alias("digest")), read, sketch, shingle)
    both = pairs.join(sets.toDF("one", "x"), "one").join(sets.toDF("two", "y"), "two")
    common = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("n"), (F.size("x") + F.size("y")).alias("total"))
    return written(common.where(F.col("n") >= F.lit(least) * (F.col("total") - F.col("n"))).select("a", "b"), "edges")


def _joined(clusters: DataFrame, read: DataFrame, sketch: DataFrame, shingle: int, least: float) -> DataFrame:
    """Links (a, b) that join all members of different components within a cluster whose sets are alike, directly or through others."""
    sets = _sets(clusters.select("digest"), read, sketch, shingle)
    n = int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = clusters.join(sets, "digest").select("cluster", "node", "component", "shingles").repartition(n, "cluster").sortWithinPartitions("cluster")
    return written(rows.mapInArrow(_compared(least), _LINKS).distinct(), "edges")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY, block: int = BLOCK, linked: DataFrame | None = None, tile: int = TILE
) -> DataFrame:
    """(doc_id, component_id), one row per row of docs.

    Documents link if the Jaccard similarity of their sets of shingle-word runs is at least `least`; words are runs of other
    characters than white space, with A-Z in lower case. component_id is the least doc_id that can be reached, itself included.
    Texts of fewer words are one run; NULL and empty texts are alike. Repeated rows come out as often as they came in. A NULL
    doc_id takes the component of an equal text that has an id, but links to no other. Ids are whole numbers. Other columns are
    not read. `linked` (doc_id, component_id) names links that count beside these, such as those of equal or close fingerprints.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketch = written(read.mapInArrow(_sketched(shingle), f"doc_id {kind}, digest binary, bands array<long>, signature binary, size long"), "sketch")
    first = [F.first(c).alias(c) for c in ("bands", "signature", "size")]
    nodes = written(sketch.groupBy("digest").agg(F.min("doc_id").cast("long").alias("node"), *first).where("node IS NOT NULL"), "nodes")

    each = nodes.select("node", F.posexplode("bands").alias("at", "band"))
    sizes = each.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = F.ceil(F.col("n") / block)
    shared = each.join(sizes, "band").select("at", "band", "node", dealt.alias("parts"), F.pmod(F.xxhash64("band", "node"), dealt).alias("part"))
    shared = written(shared, "bands")

    alone = _dealt(shared.where(F.col("at") < FIRST).withColumn("component", F.col("node")), ["band", "part"], nodes)
    found = _confirmed(written(alone.mapInArrow(_proposed, _PAIRS).distinct(), "pairs"), read, sketch, shingle, least)
    if linked is not None:
        found = found.unionByName(linked.select(F.col("doc_id").cast("long").alias("a"), F.col("component_id").cast("long").alias("b")))
    reached = written(components(found, "a", "b"), "reached")

    for crossing in (False, True):
        placed = shared.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
        key = ["band"] if crossing else ["band", "part"]
        apart = placed.groupBy(*key).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select(*key)
        members = placed.where("parts > 1") if crossing else placed
        members = written(members.join(apart, key, "left_semi"), "apart")
        if members.isEmpty():
            continue
        if crossing:
            others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: p != F.col("part"))
            members = members.withColumn("other", F.explode(others))
            members = members.withColumn("lower", F.least("part", "other")).withColumn("upper", F.greatest("part", "other"))
            key = ["band", "lower", "upper"]
        clusters = written(_dealt(members, key, nodes).mapInArrow(_clustered(crossing, tile), _CLUSTERS).distinct(), "clusters")
        if clusters.isEmpty():
            continue
        more = _joined(clusters, read, sketch, shingle, least)
        if not more.isEmpty():
            found = found.unionByName(more)
            reached = written(components(found, "a", "b"), "reached")
    classes = nodes.select("digest", "node").join(reached, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    return sketch.select("doc_id", "digest").join(classes, "digest", "left").select("doc_id", F.col("component_id").cast(kind).alias("component_id"))
