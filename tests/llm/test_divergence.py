import random
import re
from collections import Counter, defaultdict

import pytest

from sparkmart.llm.divergence import divergence


def _brute(rows, min_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {k[0] for k in counts}:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        own = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(own.values(), Counter())

        def share(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // total for t in kept}

        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, last in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:last], 1)]
    return sorted(out)


def _rows():
    rng = random.Random(8)
    words = ["Alpha", "beta", "GAMMA", "öl", "Öl", "漢字", "d-e", "it's"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    rows = []
    for i in range(600):
        lang = rng.choice(["en", "en", "de", None])
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None, "Ä"])
        rows.append((" ".join(rng.choice(words[: rng.choice([20, 88])]) for _ in range(rng.randint(0, 40))), lang, source))
    rows += [(rows[0][0], "en", "hot")] * 50 + [(None, "fr", "a"), ("", "fr", "b"), ("1 2", "fr", "only"), (None, None, None), ("x" * 100_000 + " beta", "en", "a")]
    return rows


@pytest.mark.parametrize("options", [{}, {"bits": 3, "bucket": 20, "held": 50}, {"bits": 6, "bucket": 7, "sent": 0}])
def test_against_brute_force(spark, options):
    rows = _rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, rank int, ITEM string").repartition(6)
    got = sorted(tuple(r) for r in divergence(df, min_docs=25, top=8, **options).collect())
    assert got == _brute(rows, 25, 8)


def test_small_tables(spark):
    df = spark.createDataFrame([("a", "en", "x")], "text string, lang string, source string")
    assert divergence(df.limit(0)).count() == 0 and divergence(df).count() == 0
    one = [tuple(r) for r in divergence(df, min_docs=1).collect()]
    assert one == []  # the share of the only source is the language's
