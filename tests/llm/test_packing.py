import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkmart.llm.packing import pack_documents, plan
from sparkmart.llm.piece_tokens import PieceTokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, task long, length string"


def _library(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(["" if t is None else t for t in texts], add_special_tokens=False)]


def _odd_texts():
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\t ", " \n", " ", "　 ", "\x1c ", "\x85", "a", "the", "it's", "'ll", "don’t", "42", "!?", "é", "日本", "<|endoftext|>", "🙂", "Word"]
    return [None, "", "   ", "<|endoftext|>"] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(1500)]


def test_ids_are_those_of_the_library():
    texts = _odd_texts()
    tokens = PieceTokenizer(PATH)
    want = _library(texts)
    for _ in range(2):  # cold and from the cache
        assert [np.frombuffer(b, "<u4").tolist() for b in tokens.encode(texts)] == want
    tokens.pieces.LIMIT = 5
    tokens.pieces.clear()
    assert [np.frombuffer(b, "<u4").tolist() for b in tokens.encode(texts)] == want


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 1024): rng.choice([1, 3, 50, 100_000]) for _ in range(rng.choice([3, 40, 700]))}
    patterns = plan(counts)
    used = Counter()
    for lengths, times in patterns:
        assert 0 < sum(lengths) <= 1024 and times > 0
        for n in lengths:
            used[n] += times
    assert used == Counter(counts)
    total = -(-sum(n * c for n, c in counts.items()) // 1024)
    large = sum(c for n, c in counts.items() if n > 512)
    assert sum(t for _, t in patterns) <= 1.25 * max(total, large) + 2


def test_plan_fills_exactly():
    assert sum(t for _, t in plan({1024: 7, 600: 5, 424: 5, 500: 4, 300: 4, 224: 4, 400: 2, 210: 2, 207: 4})) == 7 + 5 + 4 + 2
    assert plan({}) == []
    with pytest.raises(ValueError):
        plan({1025: 1})


def test_round_trip(spark):
    rng = random.Random(8)
    texts = _odd_texts()[:300] + [" ".join(rng.choice(["alpha", "beta", "γ", "x1"]) for _ in range(n)) for n in (400, 2000, 5000, 1023, 1022, 1024)]
    rows = [(i, t, 5, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None, "no id", 1, "y")], SCHEMA).repartition(3)
    got = pack_documents(df, PATH).collect()
    ids = {i: [*x, 2] for i, x in enumerate(_library(texts))} | {None: [*_library(["no id"])[0], 2]}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    assert by_doc.keys() == ids.keys()
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist() == ids[doc]
        assert [r.start for r in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        assert all(r.length == 1024 for r in parts[1:]) and (len(ids[doc]) > 1024 or len(parts) == 1)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        assert sum(r.length for r in parts) <= 1024


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "same text", 1, "a")] * 400 + [(2, None, None, None)], SCHEMA).repartition(5)
    got = pack_documents(df, PATH, with_ids=False).collect()
    assert len(got) == 401 and len({(r.sequence_id, r.offset) for r in got}) == 401 and len({r.sequence_id for r in got}) == 2
    assert pack_documents(df.limit(0), PATH).count() == 0
