"""Names that clash in any case, odd column types, and inputs that are long in one direction."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkmart.llm.decontaminate import decontaminate
from sparkmart.llm.language import identify, train
from sparkmart.llm.near_copies import near_copies
from sparkmart.llm.quality_rules import quality_rules
from sparkmart.llm.quotations import link_quotations
from sparkmart.llm.secrets import all_spans, base_spans, labelled, scan_secrets
from sparkmart.llm.secrets import train as train_secrets
from sparkmart.llm.url_filter import RuleIndex, filter_urls
from sparkmart.llm.words import WORD

PROSE = " ".join(f"word{i % 97} of{i % 13} things{i % 61}" for i in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PROSE, {"a": 1}, "x"), (1, PROSE + " more", {"b": 2}, "y"), (2, PROSE, None, "z"), (None, PROSE.upper(), {}, None), (None, None, {}, None), (3, "", {}, "")]
    names = ["N_HIT", "Kept", "REDACTED", "_text", "text_", "_docs", "_row", "Clean_Text", "Items", "spans", "LANG_PRED", "Rule", "_host", "component_ID", "x y"]
    out = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, lang string")
    for i, name in enumerate(names):
        out = out.withColumn(name, F.lit(i))
    return out


def test_operators_with_clashing_columns(spark, docs):
    items = spark.createDataFrame([(1, "word1 of1 things1")], "item_id long, text string")
    model, langs = train_secrets(labelled(docs)), train(docs)
    for out, own in (
        (decontaminate(docs, items), "n_hit"),
        (scan_secrets(docs, model), "redacted"),
        (quality_rules(docs), "kept"),
        (identify(docs, langs), "lang_pred"),
        (filter_urls(docs.withColumnRenamed("text", "url"), [("block", "net", "/")]), "rule"),
    ):
        assert own in out.columns and len({c.lower() for c in out.columns}) == len(out.columns)
        assert len(out.collect()) == 6 and "m" in out.columns and "x y" in out.columns
    turns = docs.selectExpr("doc_id AS conv_id", "doc_id AS turn", "lang AS role", "text", "1 AS REPLY_TO", "2 AS Max_Level")
    assert len(link_quotations(turns).collect()) == 6


def test_stages_with_clashing_and_map_columns(spark, docs, tmp_path):
    spark.createDataFrame([(1, "word1 of1 things1")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    expected = {"quality rules": 4, "simhash near-dedup": 4, "benchmark decontamination": 6, "secret scan": 6}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        assert len(rows) == expected[name], name
        assert all(r["N_HIT"] == 0 and r["Kept"] == 1 and r["x y"] == 14 for r in rows)
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(((r.doc_id or 0), r.lang or "") for r in kept if r.doc_id) == [(1, "x"), (3, "")]


def test_long_hosts(tmp_path):
    file = str(tmp_path / "rules")
    RuleIndex.write([("block", "b.example.com", "/x/"), ("allow", "com", "/")], file)
    index, began = RuleIndex(file), time.time()
    hosts = ["a." * 500_000 + "b.example.com", "a" * 1_000_000, "a." * 500_000, "xb.example.com", "b.example.com", "." * 100_000 + "com"]
    got = index.judge(hosts, ["/x/y"] * len(hosts))
    assert time.time() - began < 5
    assert [r for r, _ in got] == ["b.example.com/x/", None, None, "com/", "b.example.com/x/", "com/"]


def test_many_failing_lines(spark):
    began = time.time()
    lines = [f"### {i} ***" if i % 2 else f"plain line number {i}" for i in range(200_000)]
    row = quality_rules(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string"), min_words=1).first()
    assert row.n_failed_lines >= 90_000 and "plain line number 0" in row.clean_text and "###" not in row.clean_text
    assert time.time() - began < 30


def test_many_secrets(spark):
    model = train_secrets(spark.createDataFrame([("a1b2c3d4e5f6", True), ("hello_world", False)], "string string, secret boolean"))
    text = " ".join(f"{i:032x} Zq{i:030d}" for i in range(100_000))
    began = time.time()
    assert len(base_spans(text)) == 200_000 and len(all_spans(text, model)) >= 200_000
    assert time.time() - began < 20


def test_near_copies_of_a_very_long_text_and_hot_band_of_unlike_members(spark):
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(400_000))
    template = " ".join(f"t{i}" for i in range(200))
    rows = [(1, long), (2, long + " end")] + [(10 + i, template + " " + " ".join(f"u{i}_{k}" for k in range(90))) for i in range(120)]
    rows += [(500 + i, template + f" tail{i}") for i in range(60)]
    got = {r.doc_id: r.component_id for r in near_copies(spark.createDataFrame(rows, "doc_id int, text string").repartition(5), block=16).collect()}
    assert got[2] == 1 and {got[500 + i] for i in range(60)} == {500} and all(got[10 + i] == 10 + i for i in range(120))
    assert len(WORD.findall(long.encode())) == 400_000
