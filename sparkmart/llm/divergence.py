"""How the sources of a language differ in their words: counts by term digest, text joined late.

1. One scan counts the terms of each (lang, source) inside the tasks and writes them, digest and text, where they were counted.
2. Only the 64-bit digests are shuffled to add counts up and to find the terms in enough documents of their language.
3. The least and the greatest text of each kept digest are compared. Where they differ, texts share a digest: such digests, and
   no others, are counted again with the text in their key, so a collision changes no result.
4. Pairs of sources are compared bucket by bucket of terms, a bucket of bounded size with one row for each source of its language;
   a bucket gives one partial sum for each pair.
5. Top terms are cut by value on digests; text is joined for those that may come out, and settles ties.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmart.llm.store import written
from sparkmart.llm.words import slices, utf8

#: Runs of ASCII letters and anything beyond ASCII.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
MIN_DOCS = 30
TOP = 50
#: What is added to each count, and the parts that a share is measured in.
SMOOTH, SCALE = 5, 1_000_000_000
#: Counted (term, source) entries in a bucket of the pair comparison, about.
BUCKET = 200_000
#: Terms that a task counts before it writes what it has.
HELD = 1_000_000
#: Kept terms, over all languages, up to which their digests are sent to the tasks to filter by; beyond, Spark joins them.
SENT = 1_000_000
_CELLS = 1 << 20
#: A term's occurrences and documents are one number in a task, the latter counted from this bit on; counts are written
#: before the task has read so much text that either could pass its half.
_DOCUMENT, _READ = 1 << 32, 1 << 30
_KEY = ["lang", "d", "s"]


def _counted(bits: int, held: int):
    """(lang, source, text) to (lang, source, d, term, count, docs), added up inside the task as far as memory allows."""
    mask = (1 << bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], dict[bytes, int]] = {}
        size = read = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size, read
            for (lang, source), terms in groups.items():
                words = list(terms)
                d = np.fromiter((xxhash.xxh64_intdigest(w) & mask for w in words), np.uint64, len(words)).view(np.int64)
                both = np.fromiter(terms.values(), np.int64, len(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(words), pa.string()),
                        pa.array([source] * len(words), pa.string()),
                        pa.array(d),
                        pa.array(words, pa.binary()).cast(pa.string()),
                        pa.array(both & (_DOCUMENT - 1)),
                        pa.array(both >> _DOCUMENT.bit_length() - 1),
                    ],
                    ["lang", "source", "d", "term", "count", "docs"],
                )
            groups.clear()
            size = read = 0

        for batch in slices(batches, 200):
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                terms = groups.setdefault((lang, source), {})
                size -= len(terms)
                for word, n in Counter(TERM.findall(utf8(text).lower())).items():
                    terms[word] = terms.get(word, 0) + n + _DOCUMENT
                size += len(terms)
                read += 1 + len(text or "")
                if size > held or read > _READ:
                    yield from flush()
        yield from flush()

    return run


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)), exact for counts of any size."""
    above = (count + F.lit(SMOOTH)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, (total + F.lit(SMOOTH) * kept).cast("decimal(20,0)"))


def _shares(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """The same in a task; Python's numbers where 64 bits do not hold the product."""
    below = total + SMOOTH * kept
    if counts.size and int(counts.max()) >= (1 << 63) // SCALE - SMOOTH:
        return (1 + SCALE * (counts.astype(object) + SMOOTH) // below.astype(object)).astype(np.int64)
    return 1 + SCALE * (counts + SMOOTH) // below


def _pairs(terms: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of |p - q| over the terms of one bucket, for each ordered pair of its language's sources."""
    sources = sources.sort_values("source", ignore_index=True)
    names, total = sources["source"].to_numpy(object), sources["n"].to_numpy(np.int64)
    n, sums = len(names), np.zeros((len(names), len(names)), np.int64)
    if len(terms):
        kept = int(sources["v"].iloc[0])
        none = _shares(np.zeros(n, np.int64), total, kept)
        column = pd.Index(names).get_indexer(terms["source"])
        row = terms.groupby(["d", "s"], sort=False).ngroup().to_numpy()
        order = np.argsort(row, kind="stable")
        row, column = row[order], column[order]
        p = _shares(terms["count"].to_numpy(np.int64)[order], total[column], kept)
        step = max(1, _CELLS // n)
        for first in range(0, int(row[-1]) + 1, step):
            a, b = np.searchsorted(row, [first, first + step])
            grid = np.tile(none, (int(row[b - 1]) + 1 - first, 1))
            grid[row[a:b] - first, column[a:b]] = p[a:b]
            for k in range(n - 1):
                sums[k, k + 1 :] += np.abs(grid[:, k + 1 :] - grid[:, k : k + 1]).sum(axis=0)
        sums += sums.T
    one, two = np.nonzero(~np.eye(n, dtype=bool))
    lang = sources["lang"].iloc[0] if n else ""
    return pd.DataFrame({"lang": lang, "source": names[one], "item": names[two], "value": sums[one, two]})


def divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    bits: int = 64,
    bucket: int = BUCKET,
    held: int = HELD,
    sent: int = SENT,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source stands from each other one, and the terms it favours.

    Terms are runs of ASCII letters and of anything beyond ASCII, with A-Z in lower case. A language keeps the terms in at least
    min_docs of its rows. A source gives each kept term the share p, in parts of SCALE, of its smoothed count. Part `pair` has
    every other source of the language with the sum of |p - q| over the kept terms, part `term` the top terms whose share is
    larger than the language's, by the difference. rank goes by value, largest first, then by item in the order of UTF-8.

    NULL text, lang and source count as empty. Rows without terms, or languages that keep none, still have their pairs, at 0.
    Repeated rows are documents of their own. An empty table gives no rows. Other columns are not read. ``bits`` cuts the digests
    down, for tests of collisions.
    """
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    groups = read.select("lang", "source").distinct()
    local = written(read.mapInArrow(_counted(bits, held), "lang string, source string, d long, term string, count long, docs long"), "terms")

    def frequent(rows: DataFrame, key: list[str]) -> DataFrame:
        """The terms of each language in enough documents, with how often they occur."""
        return rows.groupBy(*key).agg(F.sum("docs").alias("docs"), F.sum("count").alias("total")).where(F.col("docs") >= min_docs)

    enough = written(frequent(local, ["lang", "d"]), "kept")
    digests = enough.select("lang", "d")
    used = local.join(F.broadcast(digests) if enough.count() <= sent else digests, ["lang", "d"], "left_semi")
    by_digest = used.groupBy("lang", "d", "source").agg(F.sum("count").alias("count"))
    # Texts are made distinct by hash first; the count keeps Spark from sorting all rows for least and greatest at once.
    texts = used.groupBy("lang", "d", "term").agg(F.sum("docs").alias("docs"))
    texts = written(texts.groupBy("lang", "d").agg(F.min("term").alias("low"), F.max("term").alias("high"), F.sum("docs").alias("docs")), "texts")
    shared = texts.where("low <> high").select("lang", "d")
    none = F.lit("").alias("s")
    counts = by_digest.join(enough.select("lang", "d", "total"), ["lang", "d"]).select(*_KEY[:2], none, "source", "count", "total")
    named = texts.select("lang", "d", none, F.col("low").alias("item"))
    if not shared.isEmpty():
        rows = used.join(shared, ["lang", "d"]).withColumnRenamed("term", "s")
        several = frequent(rows, _KEY).select(*_KEY, "total")
        split = rows.groupBy(*_KEY, "source").agg(F.sum("count").alias("count")).join(several, _KEY).select(*_KEY, "source", "count", "total")
        counts = counts.join(shared, ["lang", "d"], "left_anti").unionByName(split)
        named = named.join(shared, ["lang", "d"], "left_anti").unionByName(several.select(*_KEY, F.col("s").alias("item")))
    counts = written(counts, "counts")

    kept = counts.groupBy(*_KEY).agg(F.first("total").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    by_group = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("entries"))
    sizes = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    filled = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "v", "lang_n", "entries")]
    sizes = written(sizes.select("lang", "source", *filled), "sources")

    buckets = sizes.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.sum("entries") / bucket)).cast("int").alias("buckets"))
    dealt = counts.join(buckets, "lang").withColumn("bucket", F.pmod(F.xxhash64("d", "s"), F.col("buckets").cast("long")))
    each = sizes.join(buckets, "lang").withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets").cast("long") - 1)))
    terms_of = dealt.select("lang", "bucket", "d", "s", "source", "count").groupBy("lang", "bucket")
    sources_of = each.select("lang", "bucket", "source", "n", "v").groupBy("lang", "bucket")
    partial = terms_of.cogroup(sources_of).applyInPandas(_pairs, "lang string, source string, item string, value long")
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    p, q = _share(F.col("count"), F.col("n"), F.col("v")), _share(F.col("total"), F.col("lang_n"), F.col("v"))
    over = counts.join(sizes, ["lang", "source"]).select(*_KEY, "source", (p - q).alias("value")).where("value > 0")
    first = over.withColumn("at", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).where(F.col("at") <= top)
    terms = first.join(named, _KEY).select("lang", "source", "item", "value")

    out = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return out.withColumn("rank", place).where((F.col("part") == "pair") | (F.col("rank") <= top))
