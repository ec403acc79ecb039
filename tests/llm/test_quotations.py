from sparkmart.llm.quotations import link_quotations

SCHEMA = "conv_id long, turn long, role string, text string, position string, hash string"


def _run(spark, rows):
    df = spark.createDataFrame([(c, t, "user", x, "p", "h") for c, t, x in rows], SCHEMA)
    return {(r.conv_id, r.turn): r for r in link_quotations(df).collect()}


def test_nested_quotes_are_linked_and_removed(spark):
    got = _run(
        spark,
        [
            (1, 0, "We should meet on Monday at noon.\nWho brings the maps?"),
            (1, 3, "Monday does not work for me at all."),
            (1, 5, "> We should meet on MONDAY,  at noon\n\nI can come then, with maps."),
            (1, 9, "On May 3 Ann wrote:\n> On May 2 Bob wrote:\n>> We should meet on Monday at noon.\n> I can come then, with maps.\nGood, so be it."),
            (1, 12, "> these words nobody ever said\nReally now, who?"),
            (2, 5, "> We should meet on Monday at noon.\nOther conversation."),
            (2, 7, "no quotes here"),
        ],
    )
    row = lambda c, t: (got[c, t].position, got[c, t].reply_to, got[c, t].max_level, got[c, t].n_quoted, got[c, t].n_linked)
    assert row(1, 0) == (0, None, 0, 0, 0)
    assert row(1, 3) == (1, 0, 0, 0, 0)
    assert row(1, 5) == (2, 0, 1, 1, 1)
    assert row(1, 9) == (3, 5, 2, 2, 2)
    assert row(1, 12) == (4, 9, 1, 1, 0)
    assert row(2, 5) == (0, None, 1, 1, 0)
    assert row(2, 7) == (1, 5, 0, 0, 0)
    assert got[1, 5].clean_text == "I can come then, with maps."
    assert got[1, 9].clean_text == "Good, so be it."
    assert got[2, 7].clean_text == "no quotes here"


def test_short_passages_are_evidence_and_long_ones_outweigh_them(spark):
    got = _run(
        spark,
        [
            (1, 0, "Sounds good"),
            (1, 1, "我们明天中午在车站见面。"),
            (1, 2, "Which trains would take all of us there in time?"),
            (1, 3, "ok\nyes\nno"),
            (1, 4, "> Sounds good!\nWhat does?"),
            (1, 5, "> 我们明天中午在车站见面\n好"),
            (1, 6, "> ok\nfirst\n> yes\nsecond\n> Which trains would take all of us there in time?\nThe early one."),
            (1, 7, "> ...\n> ???\nmarks only"),
        ],
    )
    row = lambda t: (got[1, t].reply_to, got[1, t].n_quoted, got[1, t].n_linked)
    assert [row(t) for t in (4, 5, 6, 7)] == [(0, 1, 1), (1, 1, 1), (2, 3, 3), (6, 0, 0)]


def test_places_in_long_conversations_with_gaps(spark):
    turns = [*range(0, 3000, 7), 10_000, 10_001, 999_999, -5]
    got = _run(spark, [(1, t, f"message number {t}") for t in turns] + [(1, 7, "message number 7")])
    want = sorted(set(turns))
    assert [got[1, t].position for t in want] == list(range(len(want)))
    assert [got[1, t].reply_to for t in want] == [None, *want[:-1]]


def test_nulls_ties_long_texts_and_empty_table(spark):
    rows = [(1, 0, None), (1, 0, "same turn, other words"), (1, 1, ""), (None, 1, "> a quoted line here\nrest"), (1, None, "> x y z\nown"), (1, 2, "> same turn other words\n" + "line\n" * 20_000)]
    df = spark.createDataFrame([(c, t, "user", x, "p", "h") for c, t, x in rows], SCHEMA)
    got = link_quotations(df).collect()
    assert len(got) == 6
    by_text = {(r.conv_id, r.turn): r for r in got}
    assert by_text[None, 1].clean_text == "rest" and by_text[None, 1].position is None and by_text[None, 1].reply_to is None
    assert by_text[1, None].clean_text == "own" and by_text[1, None].n_linked == 0
    assert by_text[1, 2].reply_to == 0 and by_text[1, 2].clean_text == ("line\n" * 20_000).strip()
    assert by_text[1, 1].position == 1 and by_text[1, 1].reply_to == 0
    assert link_quotations(df.limit(0)).count() == 0
