"""URL filters over a sorted array of rule digests.

The rules lie in a file: their XXH64 digests in order, then the full strings they stand for. Each executor gets the file once and
its Python workers map it into memory, so they share its pages. A URL's candidates (its host and every parent domain, with the
starts of its path that have a length some rule's path has) are looked up together by binary search; a digest that is found counts
only if the stored string is the candidate.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.store import unused

#: Rules that one index takes; the driver builds it, so more must be dealt to several filters.
MAX_RULES = 20_000_000
VERDICTS = ("allow", "block")

Rule = tuple[str, str, str]  # verdict, host, path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first :// up to a slash, question mark or hash, with A-Z in lower case; empty if there is none."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), capitals, capitals.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


class RuleIndex:
    """Rules in a mapped file: counts, digests in order, string ends, verdicts, strings."""

    def __init__(self, file: str):
        with open(file, "rb") as f:
            count, lengths, longest = np.fromfile(f, np.int64, 3)
        at, self.longest = 24, int(longest)
        self.lengths = np.fromfile(file, np.int64, lengths, offset=at)
        at += 8 * int(lengths)
        self.digests = np.memmap(file, np.uint64, "r", at, (int(count),)) if count else np.zeros(0, np.uint64)
        at += 8 * int(count)
        self.ends = np.memmap(file, np.int64, "r", at, (int(count) + 1,))
        at += 8 * (int(count) + 1)
        self.verdicts = np.memmap(file, np.uint8, "r", at, (int(count),)) if count else np.zeros(0, np.uint8)
        at += int(count)
        size = os.path.getsize(file) - at
        self.strings = np.memmap(file, np.uint8, "r", at, (size,)) if size else np.zeros(0, np.uint8)

    @staticmethod
    def write(rules: list[Rule], file: str, digest=xxhash.xxh64_intdigest) -> None:
        """One entry for each host and path; if rules contradict each other, block wins."""
        if len(rules) > MAX_RULES:
            raise ValueError(f"at most {MAX_RULES} rules")
        verdicts: dict[bytes, int] = {}
        lengths = set()
        for verdict, host, path in rules:
            if verdict not in VERDICTS or not host or "/" in host or (path and path[0] != "/"):
                raise ValueError(f"not a rule: {(verdict, host, path)}")
            key = (host.lower() + path).encode()
            verdicts[key] = max(verdicts.get(key, 0), VERDICTS.index(verdict))
            lengths.add(len(path))
        entries = sorted((digest(k), k, v) for k, v in verdicts.items())
        with open(file, "wb") as f:
            np.array([len(entries), len(lengths), max((len(r[1].lower()) for r in rules), default=0)], np.int64).tofile(f)
            np.array(sorted(lengths), np.int64).tofile(f)
            np.array([d for d, _, _ in entries], np.uint64).tofile(f)
            np.cumsum([0, *(len(k) for _, k, _ in entries)]).astype(np.int64).tofile(f)
            np.array([v for _, _, v in entries], np.uint8).tofile(f)
            f.write(b"".join(k for _, k, _ in entries))

    def find(self, keys: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """The place of each key among the rules, or -1."""
        wanted = np.fromiter(map(digest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, wanted)
        found = np.full(len(keys), -1)
        open_ = np.arange(len(keys))
        while len(open_):
            open_ = open_[at[open_] < len(self.digests)]
            open_ = open_[self.digests[at[open_]] == wanted[open_]]
            for k in open_.tolist():  # equal digests: rare, and the string decides
                place = int(at[k])
                if self.strings[self.ends[place] : self.ends[place + 1]].tobytes() == keys[k]:
                    found[k] = place
            open_ = open_[found[open_] < 0]
            at[open_] += 1
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """(rule, its verdict) for each URL; the longest rule wins, of equal ones that with the longer host."""
        keys: list[bytes] = []
        owner: list[tuple[int, int]] = []
        lengths = self.lengths.tolist()
        for k, (host, path) in enumerate(zip(hosts, paths)):
            starts = [path[:n].encode("utf-8", "surrogatepass") for n in lengths if n <= len(path)]
            # A suffix longer than every rule's host fits none, so a host of any length costs little.
            domain = host if len(host) <= self.longest else host[-self.longest - 1 :].partition(".")[2]
            while domain:
                raw = domain.encode("utf-8", "surrogatepass")
                keys += [raw + s for s in starts]
                owner += [(k, len(raw))] * len(starts)
                domain = domain.partition(".")[2]
        places = self.find(keys)
        best: dict[int, tuple[int, int, int]] = {}
        for i in np.flatnonzero(places >= 0).tolist():
            k, width = owner[i]
            best[k] = max(best.get(k, (0, 0, 0)), (len(keys[i].decode("utf-8", "surrogatepass")), width, i))
        out: list[tuple[str | None, str | None]] = [(None, None)] * len(hosts)
        for k, (_, _, i) in best.items():
            out[k] = (keys[i].decode("utf-8", "surrogatepass"), VERDICTS[int(self.verdicts[places[i]])])
        return out


def filter_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow", keep: list[str] | None = None) -> DataFrame:
    """The columns named in keep (all by default) of every row, with host, path, rule and verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins. Without one, rule is NULL and the
    verdict is default: a list of rules only bars what it names. NULL and malformed URLs have empty hosts and paths and fit no rule.
    Columns named like the results, in any case, are replaced by them. Without rules every URL gets the default.
    """
    spark = pages.sparkSession
    stamp = hashlib.sha256(repr(rules).encode()).hexdigest()[:16]
    file = Path(tempfile.mkdtemp(prefix="url-rules-")) / f"url-rules-{stamp}-{os.urandom(4).hex()}.idx"
    RuleIndex.write(rules, str(file))
    spark.sparkContext.addFile(str(file))  # the driver serves it to each executor
    name = file.name
    names = ["host", "path", "rule", "verdict"]
    kept = [c for c in (pages.columns if keep is None else keep) if c.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(SparkFiles.get(name))
        for batch in batches:
            found = index.judge(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            rule = pa.array([r for r, _ in found], pa.string())
            verdict = pa.array([v or default for _, v in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *batch.columns[:2], rule, verdict], [*kept, *names])

    schema = T.StructType([pages.schema[c] for c in kept] + [T.StructField(n, T.StringType()) for n in names])
    url = F.col(url_col)
    return pages.select(host_of(url).alias(unused(pages, "_host")), path_of(url).alias(unused(pages, "_path")), *kept).mapInArrow(run, schema)
