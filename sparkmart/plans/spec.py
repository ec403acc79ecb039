"""What an entity is: its columns, how each is cleaned, its key, hash, order and rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import hashing, parse, text
from sparkmart.operators import quality
from sparkmart.operators.quality import Rule


@dataclass(frozen=True)
class Field:
    """One source column. ``parsed`` columns remember whether the source gave a value;
    ``guard`` narrows a parsed value further, with the value before it kept for the rules;
    ``store`` is applied when the row enters the cleansed table."""

    name: str
    clean: Callable[[Column], Column]
    parsed: bool = False
    guard: Callable[[Column], Column] | None = None
    store: Callable[[Column], Column] | None = None


def stripped(name: str, store: Callable[[Column], Column] | None = None) -> Field:
    return Field(name, text.strip_quotes, store=store)


def trimmed(name: str) -> Field:
    return Field(name, F.trim)


def normalised(name: str) -> Field:
    return Field(name, text.normalise_text)


def unquoted_normalised(name: str) -> Field:
    return Field(name, lambda c: text.normalise_text(F.replace(c, F.lit('"'), F.lit(""))))


def timestamp(name: str) -> Field:
    return Field(name, parse.to_timestamp, parsed=True)


def any_timestamp(name: str) -> Field:
    return Field(name, lambda c: parse.to_any_timestamp(text.strip_quotes(c)), parsed=True)


def decimal(name: str, precision: int = 10, scale: int = 2, quoted: bool = False) -> Field:
    def clean(c: Column) -> Column:
        return parse.to_decimal(text.strip_quotes(c) if quoted else c, precision, scale)

    return Field(name, clean, parsed=True)


def integer(name: str) -> Field:
    return Field(name, parse.to_int, parsed=True)


def tinyint(name: str) -> Field:
    return Field(name, lambda c: parse.to_tinyint(text.strip_quotes(c)), parsed=True)


def positive_integer(name: str) -> Field:
    return Field(name, parse.to_int, parsed=True, guard=parse.positive_or_null)


@dataclass(frozen=True)
class EntitySpec:
    name: str
    separator: str
    fields: Sequence[Field]
    keys: Sequence[str]
    hashed: Sequence[str]
    order: Sequence[tuple[str, str]]
    rules: Callable[[], Sequence[Rule]]
    admits: Callable[[], Sequence[Column]]
    quoted_source: bool = False
    surplus_issue: str | None = None
    hash_charset: str | None = None
    #: How many of ``admits``, from the first, read the key alone.
    key_tests: int = 0

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def key_label(self) -> str:
        return ", ".join(self.keys)

    @property
    def key_subject(self) -> str:
        return self.key_label if len(self.keys) == 1 else f"({self.key_label})"


def normalise(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Cleaned columns, the marks the rules need, and the row hash: a projection, nothing more."""
    marks: list[Column] = []
    values: list[Column] = []
    for f in spec.fields:
        value = f.clean(F.col(f.name))
        if f.parsed:
            marks.append(F.col(f.name).isNotNull().alias(f"{f.name}__given"))
        if f.guard is not None:
            marks.append(value.alias(f"{f.name}__parsed"))
            value = f.guard(value)
        values.append(value.alias(f.name))
    clean = raw.select(*values, *marks)
    return clean.withColumn(
        "row_hash", hashing.row_hash([F.col(c) for c in spec.hashed], spec.hash_charset)
    )


def issues(clean: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rule failures and duplicate classes of one normalised batch."""
    found = quality.run_rules(clean, spec.rules())
    if spec.surplus_issue:
        return found.unionByName(quality.surplus_rows(clean, spec.keys, spec.key_label, spec.surplus_issue))
    hash_has_order = all(c in spec.hashed for c, _ in spec.order)
    classes = quality.duplicate_classes(clean, spec.keys, spec.order, hash_has_order=hash_has_order)
    return found.unionByName(quality.duplicate_issues(classes, spec.key_label, spec.key_subject))


def _packed(clean: DataFrame, columns: Sequence[str], packed: Sequence[str]) -> DataFrame:
    return clean.select(*[text.packed_id(F.col(c)).alias(c) if c in packed else F.col(c) for c in columns])


def _with_good_keys(clean: DataFrame, spec: EntitySpec) -> DataFrame:
    for test in spec.admits()[: spec.key_tests]:
        clean = clean.where(test)
    return clean


def repeated(clean: DataFrame, spec: EntitySpec, packed: Sequence[str] = ()) -> list[int] | None:
    """Digests of the keys with several rows, for :func:`admit`; keys that fail the tests on the key alone do not count."""
    return quality.repeated_keys(_packed(_with_good_keys(clean, spec), spec.keys, packed), spec.keys)


def admit(
    clean: DataFrame,
    spec: EntitySpec,
    repeated: Sequence[int] | None = None,
    within: Sequence[str] = (),
    packed: Sequence[str] = (),
) -> DataFrame:
    """The first row of every key, if it passes the admission tests.

    Tests on the key alone come before the ranking, so bad keys are not shuffled. Nor are marks and hashes: rows that agree in all
    fields are the same row, and the hash of the kept one is taken again. With what :func:`repeated` found in these rows only keys with
    several rows are ranked; ``within`` as in :func:`quality.pick_first`. Ids named in ``packed`` are moved packed and stay so; those
    outside the key are sorted by their text.
    """
    rows = _packed(_with_good_keys(clean, spec), spec.columns, packed)
    shown = {c: text.unpacked_id(F.col(c)) for c in packed if c not in spec.keys}
    first = quality.pick_first(rows, spec.keys, spec.order, repeated, within, shown)
    first = first.withColumns({f"{c}__packed": F.col(c) for c in packed})
    first = first.withColumns({c: text.unpacked_id(F.col(c)) for c in packed})
    for test in spec.admits()[spec.key_tests :]:
        first = first.where(test)
    kept = {f.name: F.col(f"{f.name}__packed") if f.name in packed else f.store(F.col(f.name)) if f.store else F.col(f.name) for f in spec.fields}
    stored = [value.alias(name) for name, value in kept.items()]
    digest = hashing.row_hash([F.col(c) for c in spec.hashed], spec.hash_charset)
    return first.select(*stored, digest.alias("row_hash"))


def cleansed(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Raw batch to merge source in one step."""
    return admit(normalise(raw, spec), spec)
