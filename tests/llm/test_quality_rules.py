import re
from collections import Counter

from sparkmart.llm.quality_rules import quality_rules

SCHEMA = "doc_id long, text string, _text string, kept string, _row string"
PROSE = "\n".join(f"Line {i} tells of harbour {i * 3} where boat {i * 7} waits for tide {i * 11} this evening." for i in range(6))


def _brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def _run(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in quality_rules(df).collect()}


def test_counts_against_brute_force(spark):
    texts = [
        None, "", " \t\n", "one", "a b c d e f g h", "a b c d e f g h " * 3, "x " * 100, PROSE, PROSE + "\n" + PROSE,
        "é\x85ü\xa0ö # $ <tag> | &", "same\nsame\n\nsame \nother", " ".join(str(i % 9) for i in range(400)),
        " ".join(str(i * i % 977) for i in range(30_000)),
    ]
    got = _run(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _brute(t), i


def test_line_rules_and_loss(spark):
    nav = "Home | News | Sport | Shop | Contact"
    noise = "## $$ %% && ** || << >>"
    got = _run(spark, [PROSE, PROSE + "\n" + nav, PROSE + "\nAll rights reserved.", "\n".join([nav.replace(" |", f"{i} |") for i in range(20)] + [PROSE[:80]]), PROSE + "\n" + noise])
    assert got[0].kept and got[0].n_failed_lines == 0 and got[0].clean_text == PROSE
    assert got[1].kept and got[1].n_failed_lines == 1 and got[1].clean_text == PROSE
    assert got[2].kept and got[2].clean_text == PROSE
    assert not got[3].kept and not got[3].base_failed and got[3].n_failed_lines == 20
    assert got[4].clean_text == PROSE and got[4].lost_chars == 16


def test_phrases_condemn_lines_that_are_mostly_phrases(spark):
    prose = ["the catalog includes forty plates", "We design upholstery", "she could not read more of the letter", "We log into it", "Terms of usefulness"]
    footers = ["All rights reserved.", "Log  in / Sign-up", "Privacy Policy, Terms of Use, Cookie Policy, Contact", " ".join(["Share this; read more!"] * 9)]
    got = _run(spark, [PROSE + "\n" + line for line in prose + footers])
    for i, line in enumerate(prose):
        assert got[i].n_failed_lines == 0 and got[i].clean_text == PROSE + "\n" + line, line
    for i, line in enumerate(footers, len(prose)):
        assert got[i].n_failed_lines == 1 and got[i].clean_text == PROSE, line


def test_null_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, PROSE, "x", "y", "z"), (1, PROSE, "x", "y", "z"), (1, PROSE, "x", "y", "z"), (2, None, None, None, None)], SCHEMA)
    rows = quality_rules(df).collect()
    assert len(rows) == 4 and sum(r.kept for r in rows) == 3
    assert [r.base_failed for r in rows if r.doc_id == 2] == [True]
    assert quality_rules(df.limit(0)).count() == 0
