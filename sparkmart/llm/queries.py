"""The registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import oracle
from sparkmart.llm.decontaminate import decontaminate
from sparkmart.llm.divergence import divergence
from sparkmart.llm.language import held_out, identify
from sparkmart.llm.language import train as learn_languages
from sparkmart.llm.licenses import scan_licenses
from sparkmart.llm.packing import pack_documents
from sparkmart.llm.quality_rules import quality_rules
from sparkmart.llm.quotations import link_quotations
from sparkmart.llm.repeats import repeated_passages
from sparkmart.llm.secrets import labelled, scan_secrets, train
from sparkmart.llm.simhash import simhash_groups
from sparkmart.llm.store import ship, table
from sparkmart.llm.token_machine import token_counts
from sparkmart.llm.url_filter import filter_urls
from sparkmart.llm.whitening import whiten

def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the vocabulary file lies; it comes with an installed package on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


#: The rules of op1_url_filter: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@_query(oracle.URL_FILTER)
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages"), URL_RULES, keep=["page_id"])


@_query()
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scanned = scan_secrets(docs, train(labelled(docs)), redact=None, keep=["doc_id"])
    digest = F.sha2(F.array_join("base", ","), 256).alias("base_sha256")
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", digest, F.array_join("spans", ",").alias("spans"))


@_query()
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), vocabulary(), with_ids=False)


@_query(oracle.REPEATED_PASSAGES)
def op4_repeated_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents")).drop("removed")


@_query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), vocabulary())


@_query(oracle.QUOTATIONS)
def op6_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return link_quotations(table(spark, folder, "conversations"), keep=["conv_id", "turn", "role"])


@_query()
def op7_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents"))


@_query(oracle.QUALITY_RULES)
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(table(spark, folder, "documents"), keep=["doc_id"])
    counts = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", "n_words", *counts, "base_failed", "kept")


@_query(oracle.DECONTAMINATION)
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    judged = decontaminate(docs, benchmark, clean=False, keep=["doc_id"])
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    n_items = F.size("items").cast("long").alias("n_items")
    return judged.select("doc_id", "n_words", "n_hit", n_items, digest, (F.col("n_hit") > 0).alias("contaminated"))


@_query()
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


@_query()
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


@_query()
def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = learn_languages(docs.where("NOT held_out"))
    return identify(docs, model, keep=["doc_id", "held_out"])


@_query(oracle.DIVERGENCE)
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(table(spark, folder, "documents"))
