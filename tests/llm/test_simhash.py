import itertools
import random
import re

import numpy as np
import xxhash

from sparkmart.llm.simhash import covering, fingerprint, links, simhash_groups

SCHEMA = "doc_id long, text string, fp string, component_id long"


def _brute_fingerprint(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_components(fps, radius=2):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [root(i) for i in range(len(fps))]


def test_tables_cover_every_pair_of_bits_at_every_level():
    level = [(0, list(range(64)))]
    for _ in range(3):
        for mask, left in level[:20]:
            tables = covering(mask, left)
            for pair in itertools.combinations(left, 2):
                assert any(set(pair) <= set(rest) for _, rest in tables)
            assert all(t[0] & mask == mask for t in tables)
        level = covering(*level[0])


def test_fingerprints_against_brute_force():
    texts = [None, "", "  ", "One", "one two", "A b C", "a b c d", "É b É b é ß \x85 x\xa0y " * 9, " ".join(map(str, range(70_000)))]
    assert [fingerprint(t) for t in texts] == [_brute_fingerprint(t) for t in texts]


def test_links_with_small_buckets_that_are_dealt_again(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    base = rng.getrandbits(64)
    fps |= {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 5)}
    fps |= {f ^ 3 for f in list(fps)[:30]}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "node long, fp long")
    want = _brute_components(fps)
    for bucket in (4, 1024):
        edges = [(r.a, r.b) for r in links(nodes, bucket).collect()]
        label = list(range(len(fps)))
        for _ in fps:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        assert label == want


def test_groups(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(300)]
    texts = [" ".join(base)] * 3 + [None, "", " ", "x"]
    for i in range(25):
        near = list(base)
        near[rng.randrange(300)] = f"new{i}"
        texts.append(" ".join(near))
    texts += [" ".join(rng.choice(words) for _ in range(120)) for _ in range(20)]
    rows = [(i + 10, t, "clash", 7) for i, t in enumerate(texts)]
    want = _brute_components([_brute_fingerprint(t) for t in texts])
    df = spark.createDataFrame([*rows, rows[0]], SCHEMA)
    got = simhash_groups(df, bucket=8).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: r.component_id for r in got} == {i + 10: w + 10 for i, w in enumerate(want)}
    assert {r.fingerprint for r in got if r.doc_id in (13, 14, 15)} == {"0" * 16}
    assert simhash_groups(df.limit(0)).count() == 0
