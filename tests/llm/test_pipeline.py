import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sparkmart.llm.secrets import base_spans
from sparkmart.llm.simhash import fingerprint
from sparkmart.llm.words import ALNUM, utf8

rng = random.Random(11)
SYLLABLES = ["ka", "lo", "mi", "ne", "ru", "sa", "ti", "vo", "be", "dun"]
WORDS = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(2500)]
KEY = "0123456789abcdef" * 2


def _prose(n):
    return "\n".join(" ".join(rng.choice(WORDS) for _ in range(12)) + "." for _ in range(n // 12))


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    place = str(tmp_path_factory.mktemp("corpus"))
    item = " ".join(rng.choice(WORDS) for _ in range(24))
    base = _prose(240)
    texts = {
        1: _prose(120), 2: base, 3: base, 4: base + " extra", 5: "too short", 6: None, 7: "spam word " * 50,
        8: _prose(120) + "\n" + item + "\n" + _prose(60), 9: _prose(120) + "\ntoken = " + KEY + "\n" + _prose(60),
        10: _prose(6000), 11: item, 12: _prose(240) + "\nHome | News | Shop | Sport | Help", 13: "",
    }
    docs = [(i, t, "en", f"s{i % 2}", len(t or ""), "extra") for i, t in texts.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, clean_text string").write.parquet(place + "/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(place + "/benchmark.parquet")
    return place, texts, item


def test_each_stage(spark, folder):
    place, texts, item = folder
    docs = spark.read.parquet(place + "/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "benchmark decontamination", "secret scan", "best-fit packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, place)
        assert out.columns == docs.columns
        path = f"{place}/{name.replace(' ', '_')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after[name] = {r.doc_id: r for r in docs.collect()}
    first = after["quality rules"]
    assert sorted(first) == [1, 2, 3, 4, 8, 9, 10, 11, 12]
    assert first[1].text == texts[1] and first[12].text == texts[12].rsplit("\n", 1)[0] and first[12].n_chars == len(first[12].text)
    second = after["simhash near-dedup"]
    near = (fingerprint(texts[2]) ^ fingerprint(texts[4])).bit_count() <= 2
    assert sorted(second) == [1, 2, *[4] * (not near), 8, 9, 10, 11, 12]
    third = after["benchmark decontamination"]
    assert sorted(set(second) - set(third)) == [11]
    assert item not in third[8].text and len(ALNUM.findall(utf8(third[8].text))) == len(texts[8].split()) - 24
    fourth = after["secret scan"]
    assert all(not base_spans(r.text) for r in fourth.values()) and "[REDACTED]" in fourth[9].text
    assert all(fourth[i].text == texts[i] for i in (1, 2, 10))
    packed = corpus_pipeline.packing(spark, docs, place).collect()
    ids = {r.doc_id: [*e.ids, 2] for r, e in zip(fourth.values(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode_batch([r.text for r in fourth.values()]))}
    by_sequence = defaultdict(list)
    for r in packed:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))
    for parts in by_sequence.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 1024


def test_run_gives_the_stages_result(spark, folder):
    place = folder[0]
    rows = corpus_pipeline.run(spark, place).collect()
    assert {r.doc_id for r in rows} >= {1, 2, 8, 9, 10, 12} and not {r.doc_id for r in rows} & {3, 5, 6, 7, 11, 13}


def test_repeated_rows_and_missing_ids_in_dedup(spark):
    a, b = _prose(120), _prose(120)
    rows = [(1, a, "x"), (1, a, "x"), (2, a, "x"), (None, b, "x"), (None, b, "y"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = sorted(((r.doc_id or 0), r.text, r.lang) for r in corpus_pipeline.near_dedup(spark, df, "").collect())
    assert [k[0] for k in kept] == [0, 1, 3]
    assert re.match("x", kept[0][2])
