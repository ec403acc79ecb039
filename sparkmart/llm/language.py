"""Language identification by the nearest of several centroids per language, over TF-IDF vectors of character n-grams.

Texts become runs of lower-case letters; n-grams of one to three characters, word borders included, are hashed to a fixed number of
features. A language's sampled texts are clustered by cosine; a text takes the language of the most similar centroid. One that
lies further from it than nearly all texts that the centroid was made of is marked as rejected.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.store import unused, written
from sparkmart.llm.words import slices

#: n-grams are hashed to 2 ** FEATURE_BITS features.
FEATURE_BITS = 14
LONGEST = 3
CENTROIDS = 4
#: Different texts that a language is learned from, about; a bound on the labelled sample, not on what is predicted.
SAMPLE_TEXTS = 1_500
#: Languages that are learned, those with most texts first; bounds the model, which every task holds.
LANGUAGES = 500
#: Share of a language's sampled texts that lie beyond its distance of rejection.
BEYOND = 0.002
UNDETERMINED = "und"

_ROUNDS = 12
_CHUNK = 1 << 19
_GRAIN = 1 << 40
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case form, 0 where it is neither letter nor mark; and whether it is a letter."""
    codes, letters = np.zeros(sys.maxunicode + 1, np.uint32), np.zeros(sys.maxunicode + 1, bool)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LM":
            codes[i], letters[i] = ord(chr(i).lower()[0]), kind == "L"
    return codes, letters


def gram_counts(text: str | None) -> np.ndarray | None:
    """How often each feature occurs in the whole text; None for NULL or without a letter."""
    codes, letters = _tables()
    total, lettered = np.zeros(1 << FEATURE_BITS, np.int64), False
    seq = np.zeros(1, np.uint64)  # a border before the first word
    text = text or ""
    for at in range(0, len(text), _CHUNK):
        raw = np.frombuffer(text[at : at + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        lettered = lettered or bool(letters[raw].any())
        part = codes[raw].astype(np.uint64)
        if at + _CHUNK >= len(text):
            part = np.append(part, np.uint64(0))
        known, tail = len(seq), seq
        seq = np.concatenate([tail, part])
        new = seq[known:]
        seq = np.concatenate([tail, new[(new != 0) | (seq[known - 1 : -1] != 0)]])  # one border between words
        for n in range(1, LONGEST + 1):
            grams = seq[max(0, known - n + 1) :]
            if len(grams) < n:
                continue
            h = np.full(len(grams) - n + 1, n, np.uint64)
            inside = np.ones(len(h), bool)
            for k in range(n):
                piece = grams[k : k + len(h)]
                h = (h ^ piece) * _MULTIPLIER
                h ^= h >> np.uint64(29)
                if n == 1 or 0 < k < n - 1:
                    inside &= piece != 0
            total += np.bincount((h[inside] >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), minlength=len(total))
        seq = seq[-(LONGEST - 1) :]
    return total if lettered else None


def _weights(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that occur and their weights, of length one."""
    at = np.flatnonzero(counts)
    w = (1 + np.log(counts[at])) * idf[at]
    length = np.linalg.norm(w)
    return at, (w / length if length else w).astype(np.float32)


class LanguageModel:
    """Centroids of unit length with their languages and least similarities, and the weight of each feature."""

    def __init__(self, langs: list[str], centroids: np.ndarray, least: np.ndarray, idf: np.ndarray):
        self.langs, self.least, self.idf = langs, least, idf
        self.by_feature = np.ascontiguousarray(centroids.T)

    def nearest(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        counts = gram_counts(text)
        if counts is None or not self.langs:
            return UNDETERMINED, 0.0, True
        at, w = _weights(counts, self.idf)
        alike = w @ self.by_feature[at]
        best = int(alike.argmax())
        return self.langs[best], float(min(1.0, max(0.0, alike[best]))), bool(alike[best] < self.least[best])


def clustered(x: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Up to k centroids of unit length, and each row's own, by spherical k-means from spread-out rows."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    while len(chosen) < min(k, len(x)):
        far = np.maximum(0.0, 1 - (x @ x[chosen].T).max(axis=1)).astype(np.float64) ** 2
        if far.sum() <= 1e-9:
            break
        chosen.append(int(rng.choice(len(x), p=far / far.sum())))
    centroids = x[chosen]
    own = np.full(len(x), -1)
    for _ in range(_ROUNDS):
        now = (x @ centroids.T).argmax(axis=1)
        if (now == own).all():
            break
        own = now
        used = np.unique(own)
        sums = np.stack([x[own == c].sum(axis=0) for c in used])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        own = np.searchsorted(used, own)
    return centroids, (x @ centroids.T).argmax(axis=1)


def _sample(docs: DataFrame, bound: int) -> DataFrame:
    """(lang, h, text): about bound different texts of each of the LANGUAGES most frequent languages, chosen by a hash of the text."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("texts")).orderBy(F.desc("texts"), "lang").limit(LANGUAGES)
    share = F.ceil(F.lit(float(_GRAIN)) * F.least(F.lit(1.0), F.lit(float(bound)) / F.greatest(F.col("texts"), F.lit(1))))
    taken = rows.join(F.broadcast(sizes.select("lang", share.alias("share"))), "lang").where(F.pmod("h", F.lit(_GRAIN)) < F.col("share"))
    return taken.groupBy("lang", "h").agg(F.min("text").alias("text"))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bound: int = SAMPLE_TEXTS, k: int = CENTROIDS) -> LanguageModel:
    """A model of the rows with a language. Copies of a text count once; texts without letters teach nothing.

    The sample holds about `bound` different texts of each of at most LANGUAGES languages, so one task can cluster a language, and the
    model, LANGUAGES * k * 2 ** FEATURE_BITS numbers at most, fits a task. Without usable rows the model knows no language.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            rows = []
            for lang, h, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts = gram_counts(text)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    rows.append((lang, h, at.astype(np.int32), counts[at]))
            parts = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(p, kind) for p, kind in zip(parts, kinds)], ["lang", "h", "at", "counts"])

    read = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sample = written(_sample(read, bound).mapInArrow(features, "lang string, h long, at array<int>, counts array<long>"), "grams")
    frequency = np.zeros(1 << FEATURE_BITS)
    for r in sample.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # one row for each feature at most
        frequency[r["at"]] = r["count"]
    idf = np.log((1 + sample.count()) / (1 + frequency)) + 1

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h")
        x = np.zeros((len(rows), len(idf)), np.float32)
        for i, (at, counts) in enumerate(zip(rows["at"], rows["counts"])):
            dense = np.zeros(len(idf), np.int64)
            dense[at] = counts
            where, w = _weights(dense, idf)
            x[i, where] = w
        centroids, own = clustered(x, k)
        least = float(np.quantile(np.einsum("ij,ij->i", x, centroids[own]), BEYOND))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "c": range(len(centroids)), "least": least, "centroid": list(centroids)})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, c int, least double, centroid array<float>").collect()
    found.sort(key=lambda r: (r["lang"], r["c"]))
    centroids = np.array([r["centroid"] for r in found], np.float32).reshape(-1, len(idf))
    return LanguageModel([r["lang"] for r in found], centroids, np.array([r["least"] for r in found]), idf)


FOUND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", reject: bool = False, keep: list[str] | None = None) -> DataFrame:
    """The columns named in keep (all by default) of every row, with lang_pred, score and rejected.

    score is the cosine to the nearest centroid, from 0 to 1; ties go to the language that sorts first. rejected tells that the text lies
    beyond its language's distance; lang_pred is then still the nearest language unless reject is set, which makes it `und`. NULL
    texts and texts without a letter are `und` with score 0 and rejected, and so is every text if nothing was learned. Whole
    texts are read. Columns named like the results, in any case, are replaced by them; only the text is read.
    """
    names = FOUND.fieldNames()
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [sent.value.nearest(t) for t in batch.column(len(kept)).to_pylist()]
            lang = [UNDETERMINED if reject and r[2] else r[0] for r in rows]
            found = [pa.array(lang, pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*kept, *names])

    schema = T.StructType([docs.schema[c] for c in kept] + FOUND.fields)
    return docs.select(*kept, F.col(text_col).alias(unused(docs, "text"))).mapInArrow(run, schema)


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """True for the ids, as text, whose CRC-32 leaves this remainder; a NULL id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part
