"""Delimited files to text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.plans.spec import EntitySpec
from sparkmart.sources.quoted import largest_file, records


def text_schema(columns: Sequence[str]) -> str:
    return ", ".join(f"{c} string" for c in columns)


def read_delimited(spark: SparkSession, path: str, spec: EntitySpec, separator: str | None = None) -> DataFrame:
    """One record per line, header skipped, quotes kept as they are, empty fields NULL."""
    return (
        spark.read.schema(text_schema(spec.columns))
        .option("header", True)
        .option("sep", separator or spec.separator)
        .option("quote", "")
        .option("lineSep", "\n")
        .option("encoding", "UTF-8")
        .csv(path)
    )


def flatten_fields(df: DataFrame) -> DataFrame:
    """Pipes and line breaks inside fields become blanks; fields are trimmed, empty ones NULL."""
    return df.select(
        *[F.nullif(F.trim(F.regexp_replace(c, r"[|\r\n]", " ")), F.lit("")).alias(c) for c in df.columns]
    )


_QUOTED = {"lineSep": "\n", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_quoted(spark: SparkSession, path: str, spec: EntitySpec, whole_below: int | None = None) -> DataFrame:
    """Comma-separated records whose quoted fields may hold commas, pipes and line breaks.

    A quote opens a field only where the field starts; elsewhere it is text. Records end at a line feed outside quotes, and the
    carriage return before it goes with the blanks around a field; inside quotes both stay and become one blank each. Whether a line
    break ends a record depends on everything before it. Files of at most whole_below bytes, one split by default, are read by
    one task each; if any is larger, all are cut into records split by split (see :mod:`sparkmart.sources.quoted`), with the same rows.
    """
    if whole_below is None:
        whole_below = int(str(spark.conf.get("spark.sql.files.maxPartitionBytes")).removesuffix("b"))
    schema = text_schema(spec.columns)
    if largest_file(spark, path) <= whole_below:
        rows = spark.read.schema(schema).options(header=True, multiLine=True, **_QUOTED).csv(path)
    else:
        rows = records(spark, path).select(F.from_csv("record", schema, _QUOTED).alias("r")).select("r.*")
    return flatten_fields(rows)
