"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most values and counters that Spark's frequency sketch takes.
_SKETCH_VALUES, _SKETCH_COUNTERS = 100_000, 1_000_000


def hot_values(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> dict[str, dict]:
    """Per column the values with more than a partition's fair share of the rows, and over how many tasks to spread each.

    With n partitions (the session's shuffle partitions unless given) a fair share is 1/n, so at most n values come back and
    their tasks are at most 3n. One scan with a fixed-size frequency sketch per column; no rows are shuffled. The sketch errs by
    less than a quarter of the share up to 30,000 partitions. The answer only steers which keys are split; it never changes a result.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values, counters = min(_SKETCH_VALUES, 2 * n), min(_SKETCH_COUNTERS, max(1024, 32 * n))
    sketches = [F.expr(f"approx_top_k({c}, {values}, {counters})").alias(c) for c in columns]
    found = df.agg(F.count("*").alias("_rows"), *sketches).first()
    share = max(1.0, found["_rows"] / n)
    return {
        c: {e["item"]: min(n, int(2 * e["count"] // share)) for e in found[c] if e["item"] is not None and e["count"] > share}
        for c in columns
    }


#: Most rows with unique keys that are sent to the tasks instead of dealing the other side by key.
SENT = 500_000


def lookup_join(left: DataFrame, right: DataFrame, on: str, how: str, hot: Mapping | Iterable, spread: Sequence[str]) -> DataFrame:
    """:func:`salted_join` where the right side has over ``SENT`` rows; with fewer it goes to the tasks and the left rows stay where they are.

    The right side should be narrow and cheap to count, as a written table is.
    """
    if right.count() <= SENT:
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, hot, spread)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    hot: Mapping | Iterable,
    spread: Sequence[str],
) -> DataFrame:
    """Join a big left side to a right side with unique keys, splitting hot and NULL keys.

    ``hot`` names keys and over how many salts each is spread (over as many as there are shuffle partitions where it only names
    them). Left rows of such a key take a salt by the hash of the ``spread`` columns; the one right row is copied to each. The
    result is the same whatever ``hot`` holds. ``how`` is ``inner`` or ``left``.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = dict(hot) if isinstance(hot, Mapping) else dict.fromkeys(hot, n)
    salts = {k: s for k, s in salts.items() if k is not None and s > 1}
    own = F.when(F.col(on).isNull(), F.lit(n))
    if salts:
        kind = T.StructType([T.StructField(on, left.schema[on].dataType), T.StructField("_salts", T.IntegerType())])
        # hot_values gives no more rows than there are partitions
        named = F.broadcast(left.sparkSession.createDataFrame(list(salts.items()), kind))
        left, right = left.join(named, on, "left"), right.join(named, on, "left")
        own = own.when(F.col("_salts").isNotNull(), F.col("_salts"))
        copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    else:
        copies = F.lit(0)
    hashed = F.pmod(F.xxhash64(*spread), F.coalesce(own, F.lit(1)).cast("long")).cast("int")
    salted_left = left.withColumn("_salt", F.when(own.isNull(), F.lit(0)).otherwise(hashed)).drop("_salts")
    salted_right = right.withColumn("_salt", copies).drop("_salts")
    return salted_left.join(salted_right, [on, "_salt"], how).drop("_salt")
