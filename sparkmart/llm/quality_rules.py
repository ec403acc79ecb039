"""Line-first cleaning: lines that look like symbols, navigation or boilerplate go, then documents that lost too much go.

Native expressions only. Everything is computed within a document's row, so nothing is shuffled and no source, line or group
of copies can be hot.

A NULL or empty text has no words and no lines, is rejected by the base rule, and its clean text is empty. Repeated rows are
judged one by one. An empty table gives an empty table. Only the text is read; other columns are carried along, but those named
like a result are replaced by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Phrases that make a line boilerplate if most of its words belong to them, in lower case.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in",
    "privacy policy",
    "read more",
    "share this",
    "sign up",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)

#: Characters that part the entries of a navigation line, and those that count as punctuation noise in a line.
SEPARATORS = "|»›•·"
NOISE = SYMBOLS + "{}[]~^=_\\"
_SUSPECT = r"[#*$%&|<>{}\[\]~^=_\\»›•·]"


def _let(value: Column, body) -> Column:
    """body(value) with value evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, chars: str) -> Column:
    """The text without these characters; a pattern takes a tenth of the time of translate()."""
    return F.regexp_replace(text, "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]", "")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _paired(values: str, n: Column, gap: int) -> Column:
    """For each of the first n positions the hash of the value there and of the one gap further on."""
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(1 + gap), n), lambda a, b: F.xxhash64(a, b))


def _covered(hashes: Column) -> Column:
    """How many words lie in windows whose hash comes twice or more."""

    def repeated(pairs: Column) -> Column:
        same = lambda x, k: x["h"] == F.get(pairs, k)["h"]
        found = F.filter(pairs, lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False)))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    add = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last"))
    total = F.aggregate(_let(pairs, repeated), start, add)["n"]
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total)


def _solid(line: Column) -> Column:
    return F.length(_without(line, BLANK_CHARS))


def _mostly_phrases(line: Column) -> Column:
    """True if over half of the line's words, as runs of letters and digits, lie in phrases."""
    phrases = "|".join(sorted(BOILERPLATE, key=len, reverse=True))

    def judged(low: Column) -> Column:
        normal = F.regexp_replace(low, r"[^\p{L}\p{M}\p{N}]+", " ")
        rest = _let(normal, lambda t: F.size(words_of(t)) - 2 * F.size(words_of(F.regexp_replace(t, f"(?<![^ ])(?:{phrases})(?![^ ])", " "))))
        # A phrase cannot be there without its words, which most lines lack.
        words = [reduce(lambda a, b: a & b, [F.contains(low, F.lit(w)) for w in sorted(p.split(" "), key=len, reverse=True)]) for p in BOILERPLATE]
        return F.when(reduce(lambda a, b: a | b, words), rest > 0).otherwise(F.lit(False))

    return _let(F.lower(line), judged)


def line_fails(line: Column) -> Column:
    """True for a line of symbols, a navigation bar or one mostly of boilerplate phrases; blank lines pass."""
    n_words, bars = F.size(words_of(line)), F.length(line) - F.length(_without(line, SEPARATORS))
    punctuation = (F.length(line) - F.length(_without(line, NOISE))) * 10 > _solid(line) * 3
    navigation = (bars >= 3) & (n_words - bars <= 4 * (bars + 1))
    marks = F.when(line.rlike(_SUSPECT), punctuation | navigation).otherwise(F.lit(False))
    return marks | _mostly_phrases(line)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "lost_chars")


def quality_rules(
    docs: DataFrame, text_col: str = "text", min_words: int = 20, max_repeat_pct: int = 30, max_lost_pct: int = 50, keep: list[str] | None = None
) -> DataFrame:
    """The columns named in keep (all by default) of every row with clean_text, COUNTS, base_failed and kept.

    Words are runs of other characters than blank, tab and line ends. The base rule rejects texts of under min_words words and
    those in which over max_repeat_pct percent of the words lie in repeated 8-word windows. Then lines are judged; a document
    that loses over max_lost_pct percent of its word characters with its failed lines is rejected too.
    """
    names = ("clean_text", *COUNTS, "base_failed", "kept")
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    row = F.struct(*[F.col(c) for c in carried]).alias("_row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split("_text", "\n")
    empty = F.array().cast("array<bigint>")
    base = docs.select(row, text.alias("_text")).select(
        "_row",
        "_text",
        words_of(F.col("_text")).alias("_words"),
        F.filter(lines, lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != "").alias("_lines"),
        F.transform(lines, lambda x: F.struct(x.alias("line"), line_fails(x).alias("fails"))).alias("_judged"),
    )
    picked = lambda fails: F.transform(F.filter("_judged", lambda x: x["fails"] == F.lit(fails)), lambda x: x["line"])
    base = base.select("_row", "_text", "_words", "_lines", picked(True).alias("_failed"), picked(False).alias("_left"))
    n = F.size("_words")
    two = base.select(
        "_row",
        F.when(F.size("_failed") == 0, F.col("_text"))
        .otherwise(F.concat_ws("\n", "_left"))
        .alias("clean_text"),
        n.alias("_n"),
        F.length(F.array_join("_words", "")).alias("_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).alias("_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dups"),
        F.size("_lines").alias("_n_lines"),
        F.size("_failed").alias("_n_failed"),
        F.aggregate("_failed", F.lit(0), lambda acc, x: acc + _solid(x)).alias("_lost"),
        F.when(n >= WINDOW, _paired("_words", n - 1, 1)).otherwise(empty).alias("_w"),
    )
    four = two.withColumn("_w", F.when(F.col("_n") >= WINDOW, _paired("_w", F.col("_n") - 3, 2)).otherwise(empty))
    eight = four.withColumn("_w", F.when(F.col("_n") >= WINDOW, _paired("_w", F.col("_n") - 7, 4)).otherwise(empty))
    counts = {
        "n_words": F.col("_n"),
        "word_chars": F.col("_chars"),
        "n_symbols": F.col("_symbols"),
        "n_dup_lines": F.col("_dups"),
        "n_repeat_words": _covered(F.col("_w")),
        "n_lines": F.col("_n_lines"),
        "n_failed_lines": F.col("_n_failed"),
        "lost_chars": F.col("_lost"),
    }
    found = eight.select("_row", "clean_text", *[c.cast("long").alias(k) for k, c in counts.items()])
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    enough = F.col("lost_chars") * 100 <= F.col("word_chars") * max_lost_pct
    judged = F.struct("clean_text", *COUNTS, failed.alias("base_failed"), (~failed & enough).alias("kept"))
    # Through a generator, as a caller's filter on a result would else be pushed below and make Spark compute each array anew.
    return found.select("_row", F.inline(F.array(judged))).select("_row.*", *names)
