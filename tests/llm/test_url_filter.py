import random

import numpy as np
import pytest

from sparkmart.llm.url_filter import RuleIndex, filter_urls

SCHEMA = "page_id long, url string, host string, rule string"


def _parts(url):
    at = (url or "").find("://")
    rest = "" if at < 0 else url[at + 3 :]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _brute(url, rules, default="allow"):
    host, path = _parts(url)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], best[4]


RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "a.b.org", ""),
    ("allow", "b.org", "/abc"), ("block", "b.org", "/ab"), ("allow", "b.org", "/ab"), ("block", "xn--é.org", "/ü"),
]


def test_against_brute_force(spark):
    rng = random.Random(3)
    hosts = ["com", "example.com", "WWW.Example.com", "m.www.example.com", "x.net", "net", "a.b.org", "z.a.b.org", "b.org", "xn--é.org", "notexample.com", "", "a..com", "user@b.org:80"]
    paths = ["", "/", "/en/", "/en", "/EN/x", "/es/1", "/abc/d", "/ab", "/a", "/ü/x", "/en/?q=/es/", "#/en/", "?a://b.com/en/", "/%E9/" + "p" * 5000]
    urls = [None, "", "no scheme", "://", "http:/one.com/", "mailto:a@b.com", "http://a.com\n/x"]
    urls += [rng.choice(["http", "HTTPS", "", "a b"]) + "://" + rng.choice(hosts) + rng.choice(paths) for _ in range(800)]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(5, urls[5], None, None)], SCHEMA)
    rows = filter_urls(df, RULES).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(urls) + 1 and [got[i] for i in range(len(urls))] == [_brute(u, RULES) for u in urls]
    assert filter_urls(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in filter_urls(df, [], default="block").collect()} == {"block"}


def test_colliding_digests_are_told_apart_by_their_strings(tmp_path):
    few = lambda key: len(key) % 3  # noqa: E731  every digest is shared
    file = str(tmp_path / "rules")
    RuleIndex.write(RULES, file, few)
    index = RuleIndex(file)
    assert isinstance(index.digests, np.memmap) and (np.diff(index.digests.astype(int)) >= 0).all()
    keys = [(h + p).encode() for _, h, p in RULES] + [b"abc", b"", b"net/es"]
    places = index.find(keys, few)
    assert (places[: len(RULES)] >= 0).all() and (places[len(RULES) :] < 0).all()
    for key, place in zip(keys[: len(RULES)], places):
        assert index.strings[index.ends[place] : index.ends[place + 1]].tobytes() == key


def test_bad_rules():
    for rule in (("maybe", "a.com", "/"), ("block", "", "/"), ("block", "a.com/x", "/"), ("block", "a.com", "x")):
        with pytest.raises(ValueError):
            RuleIndex.write([rule], "/dev/null")
