import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkmart.llm import repeats
from sparkmart.llm.repeats import _slide, anchors, locate, repeated_passages

SCHEMA = "doc_id long, text string, n_words string, digest string"


def _brute(texts, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def _texts(rng):
    word = lambda: f"w{rng.randrange(400)}"
    prose = lambda n: [word() for _ in range(n)]
    shared, base = prose(60), prose(200)
    texts = [None, "", " \n", " ".join(prose(34)), "x " * 200, "x " * 36, "a b c " * 60, " ".join(base), " ".join(base), "\n".join(base)]
    texts += [" ".join(base[:90] + ["new"] + base[90:]), " ".join(base[:35]), " ".join(base[100:134])]
    texts += [" ".join(prose(rng.randrange(90)) + shared[rng.randrange(20) : 60 - rng.randrange(20)] + prose(40)) for _ in range(30)]
    one = prose(50)
    return texts + [" ".join(prose(20) + one + prose(30) + one + prose(5)), "É ö\xa0ß " * 40, " ".join(prose(3000))]


@pytest.mark.parametrize("hot", [2000, 3, 0])
def test_against_brute_force(spark, hot):
    texts = _texts(random.Random(hot))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeated_passages(df, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts, 35)


def test_repeated_rows_shared_ids_and_empty_table(spark):
    text = " ".join(map(str, range(50)))
    other = " ".join(map(str, range(100, 160)))
    rows = [(1, text, "x", "y"), (1, text, "x", "y"), (2, other, None, None), (2, other + " end", None, None), (None, "lone " + " ".join(map(str, range(500, 560))), None, None)]
    got = sorted(((r.doc_id or 0), r.n_words, r.n_removed) for r in repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 61, 0), (1, 50, 50), (1, 50, 50), (2, 60, 60), (2, 61, 60)]
    assert repeated_passages(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_equal_rows_are_one_suspect(spark, monkeypatch):
    text, lone = " ".join(map(str, range(60))), " ".join(map(str, range(20, 90)))
    rows = [(i, t, "x", "y") for i, t in [(1, text)] * 40 + [(None, text + " end")] * 30 + [(2, lone)]]
    sizes = {}

    def written(df, name, keep=repeats.written):
        out = keep(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(repeats, "written", written)
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())
    assert got == {(1, 60, 60): 40, (None, 61, 61): 30, (2, 70, 40): 1}
    assert sizes["representatives"] == sizes["suspects"] == 3


def test_automata_and_grams():
    rng = random.Random(1)
    passages = [[bytes([97 + rng.randrange(2)]) for _ in range(rng.randint(4, 40))] for _ in range(60)]
    seen = Counter(tuple(p[i : i + 5]) for p in passages for i in range(len(p) - 4))
    for p, runs in zip(passages, locate(passages, 5)):
        want = {k for i in range(len(p) - 4) if seen[tuple(p[i : i + 5])] > 1 for k in range(i, i + 5)}
        assert {k for a, b in runs for k in range(a, b)} == want
    values = np.random.default_rng(0).integers(0, 50, 90)
    for width in (1, 2, 5, 26):
        assert _slide(values, width, np.minimum).tolist() == [min(values[i : i + width]) for i in range(90 - width + 1)]
    words = [str(rng.randrange(5000)).encode() for _ in range(4000)]
    chosen = anchors(words)
    assert len(chosen) < 4000 * 0.11
    for at in range(0, 3900, 37):  # every window shares a gram with the document
        assert np.isin(anchors(words[at : at + 35]), chosen).any()
