import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkmart.llm import token_machine
from sparkmart.llm.token_machine import Machine, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def _texts():
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\t ", " \n", "　", "\xa0", "\x1c ", "\x85", "a", "the", "it's", "'ll", "don’t", "42", "!?", "é", "日本", "🙂", "Word"]
    parts += ["<|endoftext|>", "'", "''", "'r", "'re", "'v ", "'lé", "'s", "x'", "' s", "²", "ⅷ", "'ſ", "\n\n", "é", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(2500)]
    long = ["a" * 9000, "日本" * 3000, "ab " * 5000, " " * 5000, "\n " * 4000, "!?" * 4000, "'" * 4100, "-" * 700 + "x"]
    return [None, "", "   ", "<|endoftext|>", *texts, *long]


@pytest.mark.parametrize("chunk", [2048, 64, 7, 1])
def test_counts_are_those_of_the_library(monkeypatch, chunk):
    monkeypatch.setattr(token_machine, "CHUNK", chunk)
    texts = _texts() if chunk > 1 else _texts()[:600]
    assert Machine(PATH).count(texts)[1] == _library(texts)


def _without_fixed_places():
    rng = random.Random(8)
    signs = [chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(400)] + ["。", "，", "的", "的", "是", "あ", "の"]
    han = "".join(rng.choice(signs) for _ in range(30_000))
    return [han, "".join(rng.choice("abcde") for _ in range(20_000)), "a" * 30_001, "ab" * 9000, "=" * 20_000, "é" * 12_345, "的" * 9001, han[:5000] + " word. " + han[5000:9000]]


@pytest.mark.parametrize("chunk", [2048, 61])
def test_maps_compose_where_no_place_is_fixed(monkeypatch, chunk):
    monkeypatch.setattr(token_machine, "CHUNK", chunk)
    texts = _without_fixed_places()
    assert Machine(PATH).count(texts)[1] == _library(texts)


def test_chunks_are_read_in_few_rounds(monkeypatch):
    own, calls = Machine(PATH), []
    read = Machine.run
    monkeypatch.setattr(Machine, "run", lambda self, *args: calls.append(len(args[1])) or read(self, *args))
    texts = _without_fixed_places()[:1] * 3
    assert own.count(texts)[1] == _library(texts)
    assert len(calls) <= 8 < sum(len(t.encode()) for t in texts) // token_machine.CHUNK / 3


@pytest.mark.parametrize("width", [1, 2])
def test_maps_with_little_room(monkeypatch, width):
    monkeypatch.setattr(token_machine, "WIDTH", width)
    monkeypatch.setattr(token_machine, "CHUNK", 50)
    texts = [t[:3000] for t in _without_fixed_places()]
    assert Machine(PATH).count(texts)[1] == _library(texts)


def test_machine_that_is_emptied(monkeypatch):
    texts = _texts()
    own = Machine(PATH)
    own.LIMIT = 50
    for at in range(0, len(texts), 300):
        assert own.count(texts[at : at + 300])[1] == _library(texts[at : at + 300])


def test_rows(spark):
    rows = [(1, None, 5, "x"), (2, "", 6, "y"), (3, "héllo wörld", 7, "z"), (3, "héllo wörld", 7, "z"), (None, "x " * 1025, 1, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, n_bytes string")
    got = sorted(((r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, PATH).collect())
    n, m = _library(["héllo wörld", "x " * 1025])
    assert got == [(0, 2050, m, m > 1024), (1, 0, 0, False), (2, 0, 0, False), (3, 13, n, False), (3, 13, n, False)]
    assert token_counts(df.limit(0), PATH).count() == 0
