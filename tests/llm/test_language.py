import random
import zlib

import numpy as np
import pytest

from sparkmart.llm.language import FEATURE_BITS, LONGEST, UNDETERMINED, LanguageModel, clustered, gram_counts, held_out, identify, train
from sparkmart.llm.queries import QUERIES
from pyspark.sql import functions as F

WORDS = {
    "en": "the of and house water with this that from have thing wheel shore".split(),
    "de": "der und das haus wasser mit nicht schön über größe zwischen straße".split(),
    "ru": "это вода дом который сегодня между большой дорога".split(),
}


def _text(lang, n, rng):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, _text(lang, rng.randint(5, 60), rng), lang) for i, lang in enumerate(list(WORDS) * 60)]
    rows += [(1000 + i, rows[0][1], "en") for i in range(400)] + [(2000, None, "xx"), (2001, "12 34", "yy"), (2002, "house", None)]
    return train(spark.createDataFrame(rows, "id long, text string, lang string").repartition(5))


def test_held_out_accuracy_on_the_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(folder + "/documents.parquet").collect()}
    rows = QUERIES["op12_language_id"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.99 * len(tested)


def test_cases(spark, model):
    assert sorted(set(model.langs)) == ["de", "en", "ru"]
    rng = random.Random(9)
    rows = [(1, _text("en", 8, rng)), (2, _text("de", 8, rng).upper()), (3, _text("ru", 8, rng)), (4, None), (5, ""), (6, "12 + 34 !"), (7, "漢字"), (8, _text("de", 200_000, rng)), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("LANG_PRED", F.lit("x")).withColumn("text_", F.lit("y"))
    out = identify(df, model)
    assert out.columns == ["doc_id", "text", "text_", "lang_pred", "score", "rejected"]
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in out.collect()]
    assert [g[1] for g in got[:6]] == ["en", "de", "ru", UNDETERMINED, UNDETERMINED, UNDETERMINED] and got[8][1] == UNDETERMINED
    assert got[6][1] in WORDS and got[6][2] and got[7][1:] == ("de", False)
    assert [r.lang_pred for r in identify(df, model, reject=True).collect()][6] == UNDETERMINED
    assert identify(df.limit(0), model).count() == 0
    nothing = train(df.limit(0).withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in identify(df, nothing).collect()} == {UNDETERMINED}


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abcÄß xyz.,\n é漢1") for _ in range(3000))
    whole = gram_counts(text)
    for chunk in (1, 2, 7, 1000):
        monkeypatch.setattr("sparkmart.llm.language._CHUNK", chunk)
        assert (gram_counts(text) == whole).all()
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    assert len(whole) == 1 << FEATURE_BITS
    assert whole.sum() == sum(max(0, len(w) + 2 * (n > 1) - n + 1) for w in words for n in range(1, LONGEST + 1))


def test_nearest_against_brute_force():
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(60, 1 << FEATURE_BITS))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centroids, own = clustered(x, 4)
    assert np.allclose(np.linalg.norm(centroids, axis=1), 1, atol=1e-5) and (own == (x @ centroids.T).argmax(axis=1)).all()
    model = LanguageModel(["a", "a", "b", "c"][: len(centroids)], centroids, np.zeros(len(centroids)), np.ones(1 << FEATURE_BITS))
    for text in ("one two three", "über alles", "x"):
        w = np.log(np.maximum(gram_counts(text), 1e-300)) + 1
        w = np.where(gram_counts(text) > 0, w, 0)
        best = (centroids @ (w / np.linalg.norm(w))).argmax()
        assert model.nearest(text)[0] == model.langs[best]


def test_ids_as_text(spark):
    rows = spark.createDataFrame([(1,), (None,), (77,)], "i long").select("i", held_out(F.col("i")).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(i or "").encode() if i else b"") % 3 == 1 for i in (1, None, 77)]
