import os
import random

import pytest

from sparkmart.llm.license_texts import TEMPLATES
from sparkmart.llm.licenses import CONTAINED, key_words, normal_words, scan_licenses, shingles_of, windows_of

SCHEMA = "doc_id long, text string, license string, words string"
FILLER = ["river", "stone", "lamp", "grün", "walks", "7", "under", "the", "of"]


def _prose(rng, n):
    return " ".join(rng.choice(FILLER) for _ in range(n))


NOTICES = [(name, notice) for name, notices in TEMPLATES.items() for notice in notices]
KNOWN = [(name, set(shingles_of(normal_words(n.text))), len(normal_words(n.text)), n.needs) for name, n in NOTICES]


def _brute(text):
    """Licenses with a template of which four fifths of the shingles, and its deciding phrases, lie within a stretch of three times its length."""
    words = normal_words(text or "")
    found, by_width = set(), {}
    for name, want, n, needs in KNOWN:
        k = min(5, n)
        if k not in by_width:
            by_width[k] = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        runs = by_width[k]
        for at in [i for i, r in enumerate(runs) if r in want]:
            low = max(0, at - n)
            have = set(runs[low : max(low, at + 2 * n - k + 1)])
            line = " " + " ".join(words[low : at + 2 * n]) + " "
            if len(want & have) / len(want) >= CONTAINED and all(any(f" {way} " in line for way in need.split("|")) for need in needs):
                found.add(name)
                break
    return found


def _found(spark, texts):
    df = spark.createDataFrame([(i, t, "c", "w") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {i: {} for i in range(len(texts))}
    for r in scan_licenses(df).collect():
        got[r.doc_id][r.license] = r.containment
        assert CONTAINED <= r.containment <= 1 and r.first_word >= 0
    return got


def test_every_window_needs_a_key_word():
    windows = windows_of(NOTICES)
    for length in {len(w.words) for w in windows}:
        some = [w for w in windows if len(w.words) == length]
        keys = set(key_words(some))
        for w in some:
            shingles = shingles_of(list(w.words))
            without = [s for s in shingles if keys.isdisjoint(s.split(" "))]
            assert len(without) / len(shingles) < CONTAINED


def test_deciding_words(spark):
    """Texts that share nearly all their words with a notice of another license, and texts shorter than the notice."""
    bsd3 = TEMPLATES["BSD-3-Clause"][0].text
    want = [
        (bsd3, {"BSD-3-Clause"}),
        (bsd3.replace("the copyright holder", "Acme Corp"), {"BSD-3-Clause"}),
        (TEMPLATES["BSD-2-Clause"][0].text, {"BSD-2-Clause"}),
        (TEMPLATES["BSD-4-Clause"][0].text, {"BSD-4-Clause"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", {"LGPL-3.0"}),
        ("Work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
        ("Licensed under CC BY-SA 4.0", {"CC-BY-SA-4.0"}),
        ("Licensed under CC BY-SA 3.0", set()),
        (TEMPLATES["MIT-0"][0].text, {"MIT-0"}),
        (TEMPLATES["0BSD"][0].text + " " + TEMPLATES["ISC"][0].text, {"0BSD", "ISC"}),
        *((notice.text, {name}) for name, notice in NOTICES),
    ]
    got = _found(spark, [t for t, _ in want])
    assert {i: set(g) for i, g in got.items()} == {i: w for i, (_, w) in enumerate(want)}


def test_published_texts(spark):
    """Texts as an operating system ships them; they may quote other notices in an appendix, but nothing of another family."""
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    files = [f for f in names if os.path.exists(f"/usr/share/common-licenses/{f}")]
    if not files:
        pytest.skip("no license texts on this machine")
    texts = []
    for file in files:
        with open(f"/usr/share/common-licenses/{file}", encoding="utf-8") as f:
            texts.append(f.read())
    got = _found(spark, texts)
    assert {f: set(got[i]) - {"all-rights-reserved"} for i, f in enumerate(files)} == {f: {names[f]} for f in files}


def test_long_texts_full_of_notices(spark):
    rng = random.Random(3)
    texts = [" ".join(["license software permission warranty redistribution"] * 2000)]
    texts += [(TEMPLATES["MIT"][1].text + " ") * 60, _prose(rng, 2040) + " " + TEMPLATES["GPL-2.0"][0].text + " " + _prose(rng, 5000)]
    assert {i: set(g) for i, g in _found(spark, texts).items()} == {0: set(), 1: {"MIT"}, 2: {"GPL-2.0"}}


def test_against_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", "license", _prose(rng, 300), "the software license is software", "no rights at all reserved", "All Rights\nReserved", " ".join(["software"] * 300)]
    for _, notice in NOTICES:
        texts.append(_prose(rng, rng.randrange(60)) + "\n" + notice.text.upper() + "\n" + _prose(rng, 40))
        words = notice.text.split(" ")
        words[len(words) // 2] = "changed"
        texts.append(_prose(rng, 30) + " " + " ".join(words) + " " + _prose(rng, 30))
        texts.append(_prose(rng, 10) + " " + " ".join(words[: len(words) // 2]))
        texts.append(" ".join(notice.text.split(" ")[1:]))
    both = TEMPLATES["MIT"][1].text + " " + _prose(rng, 8) + " " + TEMPLATES["Apache-2.0"][1].text
    texts += [both, _prose(rng, 20_000) + " " + both + " " + _prose(rng, 5_000)]
    got = _found(spark, texts)
    assert {i: set(g) for i, g in got.items()} == {i: _brute(t) for i, t in enumerate(texts)}


def test_repeated_rows_and_nothing(spark):
    notice = TEMPLATES["MIT"][0].text
    df = spark.createDataFrame([(1, notice, "a", "b"), (1, "x " + notice, None, None), (None, notice, None, None), (2, None, None, None)], SCHEMA)
    rows = sorted(((r.doc_id or 0), r.license, r.first_word, r.containment) for r in scan_licenses(df).collect())
    assert rows == [(0, "MIT", 0, 1.0), (1, "MIT", 0, 1.0)]
    assert scan_licenses(df.limit(0)).count() == 0 and scan_licenses(df, templates={}).count() == 0
