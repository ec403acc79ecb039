"""Quoted files cut into records by many tasks.

Whether a line break ends a record depends on all that stands before it in the file, but only on one bit of it: whether a quoted field is
open. So each line is a map from that bit where it starts to that bit where it ends, and maps compose:

1. A line's map comes from its quotes, by a small state machine over the pieces between them.
2. Within a split of the file, the bit at each line follows from the last line that fixes it and the number of lines since that turn it
   over, for either bit at the split's start. A split gives one row: its map, its records and its first line that is one, for either bit.
3. These rows, a few bytes for each split, are composed over the file, which gives the bit at the start of every split.
4. A record of one line stands as it is. Lines of longer records are put together, those that cross splits included.

Spark's own functions only; each line is moved once, to the task that has its split. In a malformed field, where blanks and then text
follow a closing quote, the parser may keep one quote more than it does when it reads the file as a whole; records are cut alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: States between two quotes of a line: in plain text, where a field starts, in a quoted field, after a quote in one.
_PLAIN, _START, _QUOTED, _CLOSING = 0, 1, 2, 3


def line_end(line: Column, quoted: bool) -> Column:
    """1 if a quoted field is open after the line, else 0; ``quoted`` tells whether one is open before it.

    A quote opens a field only where the field starts. In a quoted field two quotes are one, and one before a comma, blanks or the end
    closes it; before anything else it was text all along, and so is the rest up to the comma.
    """
    pieces = F.split(line, '"')

    def step(state: Column, piece: Column) -> Column:
        # From the state before the piece to that after the quote which follows it.
        field = F.endswith(piece, F.lit(",")) | ((piece == "") & (state == _START))
        other = F.when(field, F.lit(_QUOTED)).otherwise(F.lit(_PLAIN))
        doubled = (state == _CLOSING) & (piece == "")
        return F.when(state == _QUOTED, F.lit(_CLOSING)).when(doubled, F.lit(_QUOTED)).otherwise(other)

    first = F.lit(_QUOTED if quoted else _START)
    last = F.aggregate(F.slice(pieces, F.lit(1), F.size(pieces) - 1), first, step)
    return F.when(F.contains(line, F.lit('"')), (last == _QUOTED).cast("int")).otherwise(F.lit(int(quoted)))


def _bit(entry: int, fixed: Column, turned: Column) -> Column:
    """The bit after lines of which the last fixing one left `fixed` (bit, turns by then), if any, with `turned` turns in all."""
    known = F.pmod(fixed["bit"] + turned - fixed["turned"], F.lit(2))
    return F.when(fixed.isNotNull(), known).otherwise(F.pmod(F.lit(entry) + turned, F.lit(2))).cast("int")


def _running(rows: DataFrame, by: list[str], at: str, zero: str, one: str, names: tuple[str, str]) -> DataFrame:
    """Adds the bit before each row, for either bit before the first, from the rows' maps (zero -> ., one -> .)."""
    before = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    turns = (F.col(zero) > F.col(one)).cast("long")
    counted = rows.withColumn("_turned", F.sum(turns).over(upto))
    fixes = F.when(F.col(zero) == F.col(one), F.struct(F.col(zero).alias("bit"), F.col("_turned").alias("turned")))
    passed = F.coalesce(F.lag("_turned").over(Window.partitionBy(*by).orderBy(at)), F.lit(0))
    placed = counted.withColumn("_fixed", F.last(fixes, ignorenulls=True).over(before)).withColumn("_passed", passed)
    out = placed
    for entry, name in enumerate(names):
        out = out.withColumn(name, _bit(entry, F.col("_fixed"), F.col("_passed")))
    return out.drop("_turned", "_fixed", "_passed")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record) for every record of the files but the first, their header, with the line break that ends it.

    Empty lines outside quotes are no records.
    """
    scan = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    place = [meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size")]
    lines = scan.select(*place, F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines = lines.select("*", line_end(F.col("line"), False).alias("zero"), line_end(F.col("line"), True).alias("one"))
    split = ["file", "block"]
    known = _running(lines, split, "at", "zero", "one", ("in0", "in1"))
    upto = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = {}
    for k in (0, 1):
        starts = F.col(f"in{k}") == 0
        known = known.withColumn(f"no{k}", F.sum(starts.cast("long")).over(upto))
        ends[k] = F.when(starts, F.col("zero")).otherwise(F.col("one"))

    each = []
    for k in (0, 1):
        each += [
            F.max_by(ends[k], "at").alias(f"end{k}"),
            F.max(f"no{k}").alias(f"n{k}"),
            F.min(F.when((F.col(f"in{k}") == 0) & (F.col("line") != ""), F.col("at"))).alias(f"head{k}"),
        ]
    each += [F.max("size").alias("size"), F.sum(F.octet_length("line") + 1).alias("bytes"), F.max("at").alias("last")]
    splits = _running(known.groupBy(*split).agg(*each), ["file"], "block", "end0", "end1", ("entry", "_unused"))
    own = lambda name: F.when(F.col("entry") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    splits = splits.select(*split, "entry", "size", "bytes", "last", own("n").alias("n"), own("head").alias("head"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_ = F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(earlier)
    whole = Window.partitionBy("file")
    header = F.min(F.when(F.col("head").isNotNull(), F.struct("block", "head"))).over(whole)
    # The file's last line, if no line break ends it.
    tail = F.when(F.sum("bytes").over(whole) > F.col("size"), F.max(F.struct("block", "last")).over(whole))
    splits = splits.select("*", open_.alias("open"), header.alias("header"), tail.alias("tail"))

    cut = known.join(splits.select(*split, "entry", "open", "header", "tail"), split)
    ended = F.when((F.col("tail.block") == F.col("block")) & (F.col("tail.last") == F.col("at")), F.col("line")).otherwise(F.concat("line", F.lit("\n")))
    bit, no = (F.when(F.col("entry") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("in", "no"))
    cut = cut.select(*split, "at", "line", ended.alias("ended"), "open", "header", bit.alias("bit"), no.alias("no"), F.when(bit == 0, F.col("zero")).otherwise(F.col("one")).alias("end"))
    begins = F.when(F.col("no") > 0, F.struct("block", F.col("no").alias("n"))).otherwise(F.col("open"))
    is_header = (F.col("header.block") == F.col("block")) & (F.col("header.head") == F.col("at"))
    alone = cut.where((F.col("bit") == 0) & (F.col("end") == 0) & (F.col("line") != "") & ~is_header).select(F.col("ended").alias("record"))
    parts = cut.where((F.col("bit") == 1) | (F.col("end") == 1)).select("file", begins.alias("begins"), "block", "at", "ended", is_header.alias("is_header"))
    gathered = parts.groupBy("file", "begins").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "ended"))).alias("lines"), F.max("is_header").alias("is_header")
    )
    joined = F.array_join(F.transform("lines", lambda x: x["ended"]), "")
    return alone.unionByName(gathered.where("NOT is_header").select(joined.alias("record")))


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file, from its listing."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.max("length").alias("n")).first()
    return found["n"] or 0
