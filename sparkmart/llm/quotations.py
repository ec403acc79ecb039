"""Quotation linking: quoted passages are hashed and joined to the messages they come from, which puts replies in order.

Native expressions, aggregations and joins only. For each conversation and passage only the earliest message is kept before the
join, so a quote meets one row however often its words were said, and no two messages are paired but by a quote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of a conversation that are numbered in one go.
SPAN = 1_000
_MARKS = r"^((?:[ \t]*>)*)[ \t]?"
_ATTRIBUTION = r"^[ \t]*(?:On|Le|El|Am) .{1,200}(?:wrote|écrit|escribió|schrieb) ?:[ \t]*$"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def _normal(text: Column) -> Column:
    """Lower case, with runs of anything but letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _hashes(texts: Column) -> Column:
    """(hash, weight) of the normalised texts that have any letter or digit, each once; the weight is their number."""
    normal = F.filter(F.transform(texts, _normal), lambda t: t != "")
    weight = lambda t: F.length(F.replace(t, F.lit(" "), F.lit(""))).cast("long")
    return F.array_distinct(F.transform(normal, lambda t: F.struct(F.xxhash64(t).alias("hash"), weight(t).alias("weight"))))


def _runs(lines: Column) -> Column:
    """Consecutive lines of one level as (level, lines)."""

    def cut(held: Column) -> Column:
        differs = lambda i: F.get(held, i)["level"] != F.get(held, i - 1)["level"]
        at = F.filter(F.sequence(F.lit(0), F.size(held) - 1), lambda i: (i == 0) | F.coalesce(differs(i), F.lit(False)))

        def pieces(starts: Column) -> Column:
            until = lambda k: F.coalesce(F.get(starts, k + 1), F.size(held))
            part = lambda s, k: F.transform(F.slice(held, s + 1, until(k) - s), lambda x: x["body"])
            return F.transform(starts, lambda s, k: F.struct(F.get(held, s)["level"].alias("level"), part(s, k).alias("lines")))

        return F.transform(F.array(at), pieces)[0]

    return F.transform(F.array(lines), cut)[0]


def parse(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds own_text, max_level, own_hashes and quotes (level, hash, weight) to every row, as _own_text and so on.

    A line's level is the number of > before it. A line that announces a quote ("On ... wrote:") goes with it. Evidence are single
    lines and whole runs of lines of one level. Text without quotes stays as it is.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    shape = lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, _MARKS, "").alias("body"))
    lines = messages.withColumn("_lines", F.transform(F.split(text, "\n"), shape))
    lines = lines.withColumn("_quoted", F.exists("_lines", lambda x: x["level"] > 0))

    def announces(x: Column, i: Column) -> Column:
        return x["body"].rlike(_ATTRIBUTION) & (F.coalesce(F.get("_lines", i + 1)["level"], F.lit(0)) > x["level"])

    rest = F.filter("_lines", lambda x, i: ~announces(x, i))
    lines = lines.withColumn("_lines", F.when(F.col("_quoted"), rest).otherwise(F.col("_lines")))
    own = F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["body"])
    runs = lines.withColumn("_own", own).withColumn("_runs", F.when(F.col("_quoted"), _runs(F.col("_lines"))).otherwise(F.array(F.struct(F.lit(0).alias("level"), F.col("_own").alias("lines")))))
    evidence = lambda r: F.concat(r["lines"], F.array(F.concat_ws("\n", r["lines"])))
    quoted = F.filter("_runs", lambda r: r["level"] > 0)
    each = F.flatten(F.transform(quoted, lambda r: F.transform(_hashes(evidence(r)), lambda h: F.struct(r["level"].alias("level"), h["hash"].alias("hash"), h["weight"].alias("weight")))))
    return runs.select(
        *messages.columns,
        F.when(F.col("_quoted"), F.regexp_replace(F.concat_ws("\n", "_own"), r"^\s+|\s+$", "")).otherwise(text).alias("_own_text"),
        F.array_max(F.transform("_lines", lambda x: x["level"])).alias("_max_level"),
        F.transform(_hashes(F.flatten(F.transform(F.filter("_runs", lambda r: r["level"] == 0), evidence))), lambda h: h["hash"]).alias("_own_hashes"),
        F.array_distinct(each).alias("_quotes"),
    )


def _places(turns: DataFrame) -> DataFrame:
    """(conv, turn, position, before): the number of each distinct turn in its conversation from 0, and the turn before it.

    Turns are numbered within spans of SPAN distinct values at most, and spans by their counts, so a conversation of any length is
    spread over tasks.
    """
    spans = turns.withColumn("span", F.floor(F.col("turn") / SPAN))
    counts = spans.groupBy("conv", "span").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("last"))
    order = Window.partitionBy("conv").orderBy("span")
    earlier = counts.select(
        "conv", "span", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.lag("last").over(order).alias("last_before")
    )
    within = Window.partitionBy("conv", "span").orderBy("turn")
    numbered = spans.select("conv", "turn", "span", (F.row_number().over(within) - 1).alias("n"), F.lag("turn").over(within).alias("own_before"))
    return numbered.join(earlier, ["conv", "span"]).select("conv", "turn", (F.col("base") + F.col("n")).alias("position"), F.coalesce("own_before", "last_before").alias("before"))


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns named in keep (all by default) of every row, with position, reply_to, clean_text, max_level, n_quoted, n_linked.

    reply_to is the turn that a message answers: of the earlier turns that first said what it quotes, the one with most evidence at
    the least level, then the latest; without such a quote the turn before. Any passage with a letter or digit is evidence and
    weighs as many as it has, so a long passage outweighs short ones. position numbers a conversation's turns so that every
    answer follows what it answers. clean_text is the text without quotes; n_quoted counts the quoted passages that are
    evidence, n_linked those that an earlier turn has said.

    A NULL text is empty. Rows that share a turn share its place, and their words are those of that turn; rows without a
    conversation or turn are cleaned, but have no place and link to nothing. Turns are whole numbers. Columns named like the
    results are replaced.
    """
    names = ("position", "reply_to", "clean_text", "max_level", "n_quoted", "n_linked")
    kept = [c for c in (messages.columns if keep is None else keep) if c.lower() not in names]
    parsed = parse(messages.select(F.struct(*kept).alias("_row"), F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(text_col).alias("_body")), "_body")

    known = parsed.where("conv IS NOT NULL AND turn IS NOT NULL")
    said = known.select("conv", "turn", F.explode("_own_hashes").alias("hash")).groupBy("conv", "hash").agg(F.min("turn").alias("said_at"))
    quotes = known.where(F.size("_quotes") > 0).select("conv", "turn", F.explode("_quotes").alias("q")).select("conv", "turn", "q.*").distinct()
    found = quotes.join(said, ["conv", "hash"]).where("said_at < turn")
    votes = found.groupBy("conv", "turn", "level", "said_at").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("conv", "turn").agg(F.max(F.struct((-F.col("level")).alias("level"), "weight", "said_at")).alias("best"), F.sum("votes").alias("n_linked"))
    turns = known.select("conv", "turn").distinct()
    placed = _places(turns).join(best, ["conv", "turn"], "left").select("conv", "turn", "position", F.coalesce("best.said_at", "before").alias("reply_to"), "n_linked")
    return parsed.join(placed, ["conv", "turn"], "left").select(
        "_row.*",
        "position",
        "reply_to",
        F.col("_own_text").alias("clean_text"),
        F.col("_max_level").cast("long").alias("max_level"),
        F.size("_quotes").cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )
