"""The SQL of op6 and op8 against the operators, on rows that hold quotes and phrases, which the given tables lack."""

import random

import duckdb

from sparkmart.llm import oracle
from sparkmart.llm.quality_rules import BOILERPLATE, quality_rules
from sparkmart.llm.quotations import link_quotations

WORDS = "the log in sign up tide read more share this harbour boat rights all reserved waits".split()


def _sql(query, table, columns, rows, picked):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE {table} ({columns})")
    con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return sorted((tuple(r) for r in con.execute(f"SELECT {', '.join(picked)} FROM ({query})").fetchall()), key=repr)


def _spark(frame, picked):
    return sorted((tuple(r) for r in frame.select(*picked).collect()), key=repr)


def test_quality_rules_sql_has_the_phrase_rule(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        lines = []
        for _ in range(rng.randrange(2, 9)):
            phrases = [rng.choice([p.title(), p.replace(" ", "-"), p]) for p in rng.choices(BOILERPLATE, k=rng.randrange(4))]
            prose = [f"{rng.choice(WORDS)}{rng.choice(['', '', rng.randrange(99)])}" for _ in range(rng.randrange(12))]
            parts = phrases + prose
            rng.shuffle(parts)
            lines.append(rng.choice([" ", ", ", " | "]).join(parts))
        rows.append((i, "\n".join(lines)))
    rows += [(900, None), (901, ""), (902, "log in log in\n" * 12)]
    picked = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = _spark(quality_rules(spark.createDataFrame(rows, "doc_id long, text string")), picked)
    assert got == _sql(oracle.QUALITY_RULES, "documents", "doc_id BIGINT, text VARCHAR", rows, picked)
    assert len({r[-1] for r in got if not r[-2]}) == 2  # the line rules decide both ways


def test_quotations_sql_links_hidden_quotes(spark):
    rng = random.Random(5)
    said = ["ok", "yes!", "Sounds good", "我们明天见面。", *[" ".join(rng.choices(WORDS, k=rng.randrange(2, 9))) for _ in range(30)]]
    rows = []
    for conv in range(50):
        for turn in rng.sample(range(40), 12):
            lines = [f"{'>' * rng.choice([0, 0, 1, 1, 2])} {rng.choice([str.upper, str])(rng.choice(said))}" for _ in range(rng.randrange(1, 6))]
            if rng.random() < 0.4:
                lines.insert(rng.randrange(len(lines)), "On May 3 Ann wrote:")
            rows.append((conv, turn, "user", "\n".join(lines)))
    picked = ["conv_id", "turn", "role", "position", "reply_to", "clean_text", "max_level", "n_quoted", "n_linked"]
    got = _spark(link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), picked)
    assert got == _sql(oracle.QUOTATIONS, "conversations", "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", rows, picked)
    assert sum(r[-1] for r in got) > 100
