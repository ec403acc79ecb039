"""Secret scans: fixed patterns, and random-looking strings told from identifiers by two character Markov models.

Both models are first-order chains over the characters of keys and identifiers. They are trained from labelled strings; a string
is taken for a secret when its mean log-likelihood ratio, random over ordinary, passes a threshold.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.store import unused
from sparkmart.llm.words import slices

# The base kinds in their order, with their patterns, and the shortest match that counts.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGNED = 6
_KEYWORDS = ("passw", "secret", "token", "api")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{6,}")
#: Documents whose strings train the models, at most twice as many; a bound on the labelled sample, not on what is scanned.
SAMPLE_DOCS = 2_000
#: Mean log-likelihood ratio a character, in nats, from which a string counts as random.
THRESHOLD = 0.5

Span = tuple[int, int, int]  # start, kind's number, end


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, by start, then kind."""
    low = text.lower()
    found: list[Span] = []
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class _Taken:
    """Which places the spans cover; spans may overlap."""

    def __init__(self, spans: list[Span]):
        self.starts, self.ends = [a for a, _, _ in spans], list(accumulate((b for _, _, b in spans), max))

    def free(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)  # the spans that start before the end
        return not before or self.ends[before - 1] <= start


class MarkovPair:
    """Log-likelihood ratio of a string under the random and the ordinary chain."""

    def __init__(self, counts: np.ndarray):
        """counts[label, a, b]: how often b follows a (the last a is the string's start); label 1 is random."""
        size = len(ALPHABET)
        uniform = 1 / size
        totals = counts.sum(axis=2, keepdims=True)
        random = (counts[1] + size * uniform) / (totals[1] + size)  # a random string may use any alphabet: far from sure
        ordinary = (counts[0] + 0.5 * uniform) / (totals[0] + 0.5)
        self.ratio = np.log(random) - np.log(ordinary)
        self.place = {c: i for i, c in enumerate(ALPHABET)}

    def score(self, string: str) -> float:
        """Mean ratio a character."""
        codes = np.array([len(ALPHABET), *map(self.place.__getitem__, string)])
        return float(self.ratio[codes[:-1], codes[1:]].mean())


def labelled(docs: DataFrame, text_col: str = "text", bound: int = SAMPLE_DOCS) -> DataFrame:
    """(string, secret) from a bounded sample of documents: matched secrets and digests are random, other strings ordinary.

    The sample takes about bound documents by a hash of their text, never more than twice as many. Each gives two digests of
    its text, in hexadecimal capitals and in base 64, so that the random chain knows more alphabets than the secrets at hand.
    """
    step = max(1, docs.count() // bound)
    text = F.col(text_col)
    chosen = docs.select(text.alias("text")).where(text.isNotNull() & (F.pmod(F.xxhash64(text), F.lit(step)) == 0)).limit(2 * bound)
    digests = F.array(F.upper(F.sha2("text", 256)), F.base64(F.unhex(F.sha2("text", 256))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, bool]] = []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                taken = _Taken(spans)
                rows += [(w, True) for a, _, b in spans for w in WORD.findall(text[a:b])[-1:]]
                rows += [(m.group(), False) for m in WORD.finditer(text) if taken.free(*m.span())]
            strings, labels = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(labels, pa.bool_())], ["string", "secret"])

    found = chosen.mapInArrow(run, "string string, secret boolean")
    return found.unionByName(chosen.select(F.explode(digests).alias("string"), F.lit(True).alias("secret")))


def train(samples: DataFrame) -> MarkovPair:
    """The two chains from (string, secret); strings with other characters than ALPHABET lose these. Counts are at most 2 x 67 x 67."""
    steps = samples.select(
        F.col("secret").cast("int").alias("label"),
        F.split(F.concat(F.lit("^"), F.regexp_replace("string", "[^A-Za-z0-9+/_=-]", "")), "").alias("c"),
    ).where("label IS NOT NULL AND c IS NOT NULL")
    pairs = F.explode(F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: F.concat(a, b)))
    counts = np.zeros((2, len(ALPHABET) + 1, len(ALPHABET)))
    for r in steps.where(F.size("c") > 1).select("label", pairs.alias("step")).groupBy("label", "step").count().collect():
        if len(r["step"]) == 2:
            counts[r["label"], (ALPHABET + "^").index(r["step"][0]), ALPHABET.index(r["step"][1])] = r["count"]
    return MarkovPair(counts)


FOUND = T.StructType(
    [
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("base", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StringType())),
        T.StructField("redacted", T.StringType()),
    ]
)


def all_spans(text: str, model: MarkovPair, threshold: float = THRESHOLD) -> list[Span]:
    """Base spans and, where none overlaps, strings the models take for random."""
    base = base_spans(text)
    taken = _Taken(base)
    more = [
        (m.start(), 3, m.end())
        for m in CANDIDATE.finditer(text)
        if taken.free(*m.span()) and model.score(m.group()) >= threshold
    ]
    return sorted(base + more)


def _redacted(text: str, spans: list[Span], put: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if end > at:
            if start >= at:
                out += [text[at:start], put]
            at = end
    return "".join(out) + text[at:]


def scan_secrets(
    docs: DataFrame,
    model: MarkovPair,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    redact: str | None = "[REDACTED]",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns named in keep (all by default) of every row, with n_assign, n_access, n_hex, base, spans and redacted.

    Spans are kind:start:end in code points of the whole text, end exclusive, by start and then kind; base holds those of the
    fixed patterns. redacted is the text with each run of overlapping spans replaced, where there are any and this is asked for,
    else NULL. NULL and empty texts have no spans. Columns of docs named like the results, in any case, are replaced by them.
    """
    names = FOUND.fieldNames()
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns: list[list] = [[] for _ in names]
            for text in batch.column(0).to_pylist():
                spans = all_spans(text or "", model, threshold)
                numbers = [k for _, k, _ in spans]
                shown = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
                row = [numbers.count(k) for k in range(3)]
                row += [[s for s, k in zip(shown, numbers) if k < 3], shown, _redacted(text, spans, redact) if spans and redact is not None else None]
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.list_(pa.string())] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, columns, kinds)], [*kept, *names])

    schema = T.StructType([docs.schema[c] for c in kept] + FOUND.fields)
    return docs.select(F.col(text_col).alias(unused(docs, "text")), *kept).mapInArrow(run, schema)
