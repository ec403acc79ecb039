"""License scans: MinHash bands over overlapping word windows retrieve license templates, exact shingle containment verifies them.

Native expressions and one join with the templates' bands. Shingles are five consecutive words (a shorter template is one shingle).

* Windows. A template of at most SHORT words is one window; a longer one gives windows of SHORT words every STEP words. A text
  gives windows of each of these lengths at every place, so whatever matches a template has a window that covers the same words.
  A text shorter than that is one window.
* Key words. The windows of each length have a few rare words such that a text without any of them lacks more than a fifth of the
  shingles of each, so cannot contain them by four fifths. Only windows that hold such a word, and then a shingle of some template's
  window, are hashed, which loses nothing: others have no minimum in common with one.
* Bands. ROWS of BANDS x ROWS minima make a band. Windows with similarity s share a band with probability 1 - (1 - s^ROWS)^BANDS:
  over 0.9999 for s = 0.8, and 1 for equal windows.
* Verification. Around a retrieved window the share of the template's shingles that the text contains, as whole strings. Templates that
  differ in a word or clause (a version, "lesser", the third clause) name the phrases that decide, and one of these must stand there too.

Long texts are cut into overlapping parts of BLOCK words, so that no row holds more than that many windows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.license_texts import TEMPLATES, Notice

SHINGLE = 5
SHORT = 16
STEP = 8
BANDS, ROWS = 10, 2
CONTAINED = 0.8
BLOCK = 2048

#: Words too common to make a search for them worthwhile.
_COMMON = frozenset("a all an and are as at be by copy file for form from in is it may of on or person program so that the this to use with you".split())


def normal_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def shingles_of(words: list[str]) -> list[str]:
    """Distinct runs of SHINGLE words, or of all if they are fewer, in order."""
    return list(dict.fromkeys(" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))) if words else []


@dataclass(frozen=True)
class Window:
    """A template's window: its words' place in the template and what it is compared by."""

    license: str
    template: int
    words: tuple[str, ...]


def windows_of(notices: list[tuple[str, Notice]]) -> list[Window]:
    found = []
    for number, (name, notice) in enumerate(notices):
        words = normal_words(notice.text)
        last = max(0, len(words) - SHORT)
        for at in sorted({*range(0, last + 1, STEP), last}):
            found.append(Window(name, number, tuple(words[at : at + SHORT])))
    return found


def key_words(windows: list[Window]) -> list[str]:
    """Words such that a window without all of them lacks over a fifth of its shingles; few words serve many windows."""
    keys: set[str] = set()

    def lacking(window: Window, words: set[str]) -> float:
        shingles = shingles_of(list(window.words))
        return sum(not words.isdisjoint(s.split(" ")) for s in shingles) / len(shingles)

    for window in windows:
        for word in sorted(set(window.words), key=lambda w: (w in _COMMON, -len(w), w)):
            if lacking(window, keys & set(window.words)) > 1 - CONTAINED + 1e-9:
                break
            keys.add(word)
    return sorted(keys)


def _any_word(words: list[str]) -> str:
    """A pattern that lower-case text with one of these words matches; what follows a letter is passed over at once."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        by_first.setdefault(word[0], []).append(word[1:])
    return "(?<![a-z])(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(by_first.items())) + ")"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _shingles(words: Column, size: Column) -> Column:
    """Runs of SHINGLE words, of size words if these are fewer."""
    width = F.least(F.lit(SHINGLE), size)
    return _bound(
        words, lambda own: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(own) - width + 1)), lambda i: F.array_join(F.slice(own, i, width), " "))
    )


def _signature(words: Column) -> Column:
    """Band hashes of a window's words."""

    def bands(hashes: Column) -> Column:
        minimum = lambda j: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(j))))
        return F.array(*[F.xxhash64(F.lit(b), *[minimum(b * ROWS + r) for r in range(ROWS)]) for b in range(BANDS)])

    return _bound(F.transform(_shingles(words, F.size(words)), lambda s: F.xxhash64(s)), bands)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, tuple[str | Notice, ...]] | None = None
) -> DataFrame:
    """(doc_id, license, first_word, containment): one row for each id and license that its text contains by four fifths or more.

    Words are runs of letters and digits in lower case; first_word is the place from 0 of the first window that matches, and
    containment the best share of a template's shingles found around one window. Where a template needs deciding phrases, a text
    that has none of them there does not match it. NULL and empty texts match nothing; rows that share an id are taken together; a
    NULL id is an id. Other columns are not read. Templates are a list held in the program and bounded by it, and so are their
    bands, which are read on the driver and sent to all executors.
    """
    spark = docs.sparkSession
    notices = [(name, t if isinstance(t, Notice) else Notice(t)) for name, texts in (TEMPLATES if templates is None else templates).items() for t in texts]
    windows = windows_of(notices)
    if not windows:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit("").alias("license"), F.lit(0).alias("first_word"), F.lit(0.0).alias("containment")).limit(0)
    sizes = [len(normal_words(n.text)) for _, n in notices]
    whole = [shingles_of(normal_words(n.text)) for _, n in notices]
    needs = [[[f" {way} " for way in need.split("|")] for need in n.needs] for _, n in notices]
    keys = {length: key_words([w for w in windows if len(w.words) == length]) for length in sorted({len(w.words) for w in windows})}
    shared = sorted({s for w in windows for s in shingles_of(list(w.words))})
    every_key = sorted({k for some in keys.values() for k in some})
    longest = max(sizes)

    known = spark.createDataFrame(
        [(w.license, sizes[w.template], whole[w.template], needs[w.template], list(w.words)) for w in windows],
        "license string, n int, whole array<string>, needs array<array<string>>, words array<string>",
    )
    signed = known.select("license", "n", "whole", "needs", F.size("words").alias("length"), _signature(F.col("words")).alias("their_bands"))
    bands = signed.select("*", F.explode("their_bands").alias("band"))
    some_band = [r["band"] for r in bands.select("band").distinct().collect()]

    held = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("text")).where(F.col("text").rlike(_any_word(every_key)))
    words = held.select("doc_id", F.array_remove(F.split("text", r"[^\p{L}\p{N}]+"), "").alias("words")).where(F.size("words") > 0)
    parts = F.transform(
        F.sequence(F.lit(0), F.size("words") - 1, F.lit(BLOCK)),
        lambda at: F.struct(
            at.alias("base"),
            F.least(at, F.lit(longest)).alias("lead"),
            F.slice("words", F.greatest(F.lit(0), at - longest) + 1, F.lit(BLOCK + 2 * longest + SHORT)).alias("words"),
        ),
    )
    # Explode's outer form is used as the other one is computed twice, once to see whether there are rows.
    cut = words.select("doc_id", F.size("words").alias("size"), F.explode_outer(parts).alias("part")).select("doc_id", "size", "part.*")
    marked = F.filter(F.transform("words", lambda w, i: F.when(w.isin(every_key), F.struct(i.alias("i"), w.alias("w")))), lambda m: m.isNotNull())
    placed = cut.withColumn("at", marked)

    def starts(length: int, some: list[str]) -> Column:
        """Windows of this length that begin in the part and hold a key word of that length."""
        near = F.flatten(F.transform(F.filter("at", lambda m: m["w"].isin(some)), lambda m: F.sequence(F.greatest(F.lit(0), m["i"] - length + 1), m["i"])))
        whole_text = (F.col("size") < length) & (F.lit(0) == F.col("base"))
        own = lambda s: (s >= F.col("lead")) & (s < F.col("lead") + BLOCK) & ((s + length <= F.size("words")) | (whole_text & (s == 0)))
        return F.transform(F.filter(F.array_distinct(near), own), lambda s: F.struct(F.lit(length).alias("length"), s.alias("start")))

    worth = lambda w: F.exists(_shingles(F.slice("words", w["start"] + 1, w["length"]), w["length"]), lambda s: s.isin(shared))
    found = F.transform(
        F.filter(F.concat(*[starts(n, some) for n, some in keys.items()]), worth),
        lambda w: F.struct(w["length"].alias("length"), w["start"].alias("start"), _signature(F.slice("words", w["start"] + 1, w["length"])).alias("bands")),
    )
    hits = F.transform(
        F.filter(found, lambda w: F.exists(w["bands"], lambda b: b.isin(some_band))),
        lambda w: F.struct(
            w["length"].alias("length"),
            (w["start"] - F.col("lead") + F.col("base")).alias("start"),
            w["bands"].alias("bands"),
            F.least(w["start"], F.lit(longest)).alias("before"),
            # Of the text only what a template around the window can cover goes on.
            F.slice("words", F.greatest(F.lit(0), w["start"] - longest) + 1, F.lit(2 * longest + SHORT)).alias("around"),
        ),
    )
    probes = placed.select("doc_id", F.explode_outer(hits).alias("w")).where("w IS NOT NULL").select("doc_id", "w.*")
    probes = probes.select("*", F.explode("bands").alias("band"))
    met = probes.join(F.broadcast(bands), ["length", "band"])  # bounded by the list of templates
    met = met.where(F.col("band") == F.element_at(F.array_intersect("bands", "their_bands"), 1))  # two windows meet once
    low = F.greatest(F.lit(0), F.col("before") - F.col("n"))
    region = F.slice("around", low + 1, F.col("before") - low + F.col("length") + F.col("n"))
    near = met.select("doc_id", "license", "start", "n", "whole", "needs", region.alias("region"))
    share = F.size(F.array_intersect("whole", _shingles(F.col("region"), F.col("n")))) / F.size("whole")
    line = F.concat(F.lit(" "), F.array_join("region", " "), F.lit(" "))
    decided = _bound(line, lambda t: F.forall("needs", lambda need: F.exists(need, lambda way: F.contains(t, way))))
    return (
        near.select("doc_id", "license", "start", share.alias("share"), decided.alias("decided"))
        .where((F.col("share") >= CONTAINED) & F.col("decided"))
        .groupBy("doc_id", "license")
        .agg(F.min("start").cast("int").alias("first_word"), F.max("share").alias("containment"))
    )
