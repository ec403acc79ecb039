import itertools
import random

import pytest

import corpus_pipeline
from sparkmart.llm import near_copies as module
from sparkmart.llm.near_copies import near_copies, tiles
from sparkmart.llm.simhash import RADIUS, fingerprint


def _jaccard(a, b):
    sets = [{tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def _texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 200))) for _ in range(30)]
    for base in (rng.sample(words, 150), rng.sample(words, 60)):
        for i in range(40):
            copy = list(base)
            for k in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"new{i}_{k}"
            texts.append(" ".join(copy))
    return texts + [texts[40].upper(), "one two", "ONE  two", "one three", " ", ""]


def _brute(texts):
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if _jaccard(texts[i], texts[j]) >= 0.8 and label[i] != label[j]:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize("block", [256, 3])
def test_against_brute_force(spark, block):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_copies(df, block=block).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts)
    if block == 256:
        kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
        assert kept == set(_brute(texts))
        assert near_copies(df.limit(0)).count() == 0


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "A b c"), (None, "x"), (2, None), (3, "")]
    got = sorted(((r.doc_id or 0), r.component_id) for r in near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.component_id)
    assert got == [(0, 1), (1, 1), (1, 1), (2, 2), (3, 2)]


def test_small_tiles_lose_no_link(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies(df, block=16, tile=300).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts)


def test_tiles_hold_every_two_places():
    for sizes, limit in (([5] * 9, 20), ([50, 1, 1, 1], 10), ([3, 3], 1), ([1], 9), ([7] * 30, 7)):
        found = tiles(sizes, limit)
        assert {frozenset(p) for t in found for p in itertools.combinations(t, 2)} == {frozenset(p) for p in itertools.combinations(range(len(sizes)), 2)}
        assert all(sum(sizes[i] for i in t) - max(sizes[i] for i in t) <= limit for t in found if len(t) > 2)


def test_rows_grow_with_the_members_of_a_group(spark, monkeypatch):
    """Copies of one text with a changed word each: nearly all pairs are near, few are alike."""
    rng, sizes = random.Random(7), {}
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join([*base[:k], f"new{i}", *base[k + 1 :]]) for i, k in enumerate(rng.choices(range(4, 76), k=300))]
    kept = module.written

    def counted(df, name):
        out = kept(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(module, "written", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies(df).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts)
    assert max(sizes.values()) <= module.BANDS * len(texts)


def test_the_stage_counts_close_fingerprints(spark):
    """Texts of one repeated phrase with other endings share few shingles, but their fingerprints are equal."""
    phrase = "one two three four five six seven "
    texts = [phrase * 100 + " ".join(f"{end}{i}" for i in range(20)) for end in "ab"] + ["something else that stays as it is"]
    assert (fingerprint(texts[0], 5) ^ fingerprint(texts[1], 5)).bit_count() <= RADIUS and _jaccard(*texts[:2]) < 0.8
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [0, 2]
