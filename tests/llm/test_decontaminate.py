import random
import re

import numpy as np

from sparkmart.llm import decontaminate as module
from sparkmart.llm.decontaminate import decontaminate
from sparkmart.llm.fm_index import FMIndex, WaveletTree, suffix_order

DOCS = "doc_id long, text string, items string, n_words long"


def _words(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def _brute(text, items, width=10):
    words = _words(text)
    hit, found = set(), set()
    for item, body in items:
        w = _words(body)
        for at in range(max(1, len(w) - width + 1) if w else 0):
            window = w[at : at + width]
            for p in range(len(words) - len(window) + 1):
                if words[p : p + len(window)] == window:
                    hit |= set(range(p, p + len(window)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_suffix_order_and_ranks_against_sorting():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (50, 2), (400, 3), (300, 1), (500, 90)):
        text = np.append(rng.integers(1, top + 1, n), 0)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_order(text).tolist() == want
        tree = WaveletTree(text)
        at = rng.integers(0, n + 2, 60)
        symbols = rng.choice(text, 60)
        assert tree.rank(symbols, at).tolist() == [int((text[:a] == s).sum()) for a, s in zip(at, symbols)]
        got, rank = tree.access(np.arange(n + 1))
        assert got.tolist() == text.tolist()
        assert rank.tolist() == [int((text[:a] == text[a]).sum()) for a in range(n + 1)]


def test_search_and_locate_against_brute_force():
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, 4, n) for n in (0, 5, 90, 1, 60, 0)] + [np.ones(70, np.int64)] * 2
    index = FMIndex(docs, sample=7)
    patterns = rng.integers(1, 5, (200, 4))
    patterns[patterns == 4] = 0  # a word that no document has
    lengths = rng.integers(1, 5, 200)
    for row, n in zip(patterns, lengths):
        row[: 4 - n] = 0
    low, high = index.search(patterns, lengths)
    for row, n, a, b in zip(patterns, lengths, low, high):
        want = [s + i for s, d in zip(index.starts, docs) for i in range(len(d) - n + 1) if d[i : i + n].tolist() == row[4 - n :].tolist()]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def _case():
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(12)] + ["É", "x y", "9"]
    long_item = " ".join(f"q{i}" for i in range(25))
    items = [(10, long_item), (9, "Short Phrase, here"), (2, None), (3, " ,; "), (9, "w1 w2 w3 w4"), (None, "zz yy"), (10, long_item)]
    texts = [None, "", "Before " + long_item.upper() + " after", "q0 q1 q2 q3", "short phrase\nHERE!", "zz-yy", long_item + " " + long_item]
    texts += [" ".join(rng.choice(vocab) for _ in range(300)) for _ in range(12)]
    texts += [" ".join(["pad"] * 40 + long_item.split()[4:15] + ["pad"] * 40)]
    return texts, items


def test_hits_against_brute_force(spark, monkeypatch):
    texts, items = _case()
    docs = spark.createDataFrame([(i, t, "clash", 5) for i, t in enumerate(texts)] + [(2, texts[2], None, None)], DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = [_brute(t, [("" if i is None else i, b) for i, b in items]) for t in texts]
    for block in (1 << 20, 40):  # one block, several blocks
        got = {r.doc_id: r for r in decontaminate(docs, benchmark, block_bytes=block).collect()}
        assert [(got[i].n_words, got[i].n_hit, got[i]["items"]) for i in range(len(texts))] == want
    assert got[2].clean_text == "Before after" and got[4].clean_text == "!" and got[1].clean_text is None
    assert decontaminate(docs, benchmark).count() == len(texts) + 1
    assert decontaminate(docs.limit(0), benchmark).count() == 0
    assert {r.n_hit for r in decontaminate(docs, benchmark.limit(0)).collect()} == {0}


def test_small_shards_and_long_documents_in_pieces(monkeypatch):
    texts, items = _case()
    items = [("" if i is None else str(i), b) for i, b in items]
    monkeypatch.setattr(module, "SHARD_WORDS", 64)
    monkeypatch.setattr(module, "_LOCATED", 8)
    got = module._judge(texts, [module.Windows(items, 10)], 10, False)
    assert [r[:3] for r in got] == [_brute(t, items) for t in texts]
