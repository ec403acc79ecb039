"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A stage's rows
are written as Parquet and read again before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.decontaminate import decontaminate
from sparkmart.llm.near_copies import SHINGLE, near_copies
from sparkmart.llm.packing import pack_documents
from sparkmart.llm.quality_rules import quality_rules
from sparkmart.llm.queries import vocabulary
from sparkmart.llm.secrets import labelled, scan_secrets, train
from sparkmart.llm.simhash import simhash_groups
from sparkmart.llm.store import sent_if_small, ship, table, written

_ROW = "_docs"


def _carried(docs: DataFrame) -> DataFrame:
    """The text beside one column that holds the whole row, so that no column of docs can clash with an operator's."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(_ROW))


def _with_text(judged: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of docs, with the new text where it isn't NULL; n_chars, if there, follows a changed text."""
    old = {c: F.col(f"{_ROW}.`{c}`") for c in docs.columns}
    new = {"text": F.coalesce(text, old["text"])}
    if "n_chars" in old:
        changed = text.isNotNull() & ~text.eqNullSafe(old["text"])
        new["n_chars"] = F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(old["n_chars"])
    return judged.select(*[new.get(c, old[c]).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the others lose their failed lines. A NULL text is rejected."""
    judged = quality_rules(_carried(docs), keep=[_ROW]).where("kept")
    return _with_text(judged, docs, F.col("clean_text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id stays.

    Near-duplicates have SimHash fingerprints of their five-word shingles within op7's radius, or share four fifths of these shingles:
    the fingerprints alone miss most such pairs.
    Rows that share a doc_id are one document, of which the least row stays, compared as text. Rows without an id stay, one for
    each text. Columns may have any names and types.
    """
    ship(spark)
    close = written(simhash_groups(docs, shingle=SHINGLE), "close")
    groups = written(near_copies(docs, linked=close), "groups")
    removed = written(groups.where("doc_id <> component_id").select("doc_id").distinct(), "removed")
    named = docs.where(F.col("doc_id").isNotNull())
    kept = named.join(sent_if_small(removed), "doc_id", "left_anti").select(*[named[c] for c in docs.columns])
    nameless = docs.where(F.col("doc_id").isNull())

    def one(rows: DataFrame, key: str) -> DataFrame:
        order = F.struct(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
        return rows.groupBy(key).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias(_ROW)).select(f"{_ROW}.*")

    counts = groups.groupBy("doc_id").count()
    if not counts.where("doc_id IS NOT NULL AND count > 1").isEmpty():
        kept = one(kept, "doc_id")
    if counts.where("doc_id IS NULL").isEmpty():
        return kept
    return kept.unionByName(one(nameless, "text"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; documents that are nothing else go."""
    ship(spark)
    judged = decontaminate(_carried(docs), table(spark, sf_dir, "benchmark"), keep=[_ROW]).where("n_hit = 0 OR n_hit < n_words")
    return _with_text(judged, docs, F.col("clean_text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    ship(spark)
    scanned = scan_secrets(_carried(docs), train(labelled(docs)), keep=[_ROW])
    return _with_text(scanned, docs, F.col("redacted"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place; the ids are those of (doc_id, start, length)."""
    ship(spark)
    return pack_documents(docs, vocabulary(), with_ids=False)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scan", secrets),
    ("best-fit packing", packing),
]

#: SQL can't give token ids or model scores; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage but the last is written and read again."""
    rows = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        rows = stage(spark, rows, sf_dir)
        if number < len(STAGES):
            rows = written(rows, f"stage{number}")
    return rows
