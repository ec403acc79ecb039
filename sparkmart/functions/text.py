"""Text cleaning, pattern tests and code-to-label mapping."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accented capitals and the plain letters that replace them.
ACCENTED = "ÁÂÃÀÉÊÍÓÔÕÚÇÄËÜ"
PLAIN = "AAAAEEIOOOUCAEU"

# Java upper-cases the sharp s to two letters; the normaliser keeps it as it is, so in the
# texts that have one it travels through upper() as a private-use character.
_SHARP_S = "ß"
_PLACEHOLDER = "\ue000"


def strip_quotes(c: Column) -> Column:
    """Trim blanks, then drop every double quote (most values have none)."""
    trimmed = F.trim(c)
    return F.when(c.contains('"'), F.replace(trimmed, F.lit('"'), F.lit(""))).otherwise(trimmed)


def normalise_text(c: Column) -> Column:
    """Trimmed, upper-cased text without accents; NULL stays NULL."""
    text = F.trim(c)
    kept = F.translate(F.upper(F.translate(text, _SHARP_S, _PLACEHOLDER)), ACCENTED + _PLACEHOLDER, PLAIN + _SHARP_S)
    return F.when(text.contains(_SHARP_S), kept).otherwise(F.translate(F.upper(text), ACCENTED, PLAIN))


def is_blank(c: Column) -> Column:
    """Empty once trailing blanks are ignored."""
    return F.rtrim(c) == ""


def text_length(c: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(c))


def empty_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def contains_other_than(c: Column, char_class: str) -> Column:
    """True when the text holds a character outside the class, for example ``0-9a-f``."""
    return c.rlike(f"[^{char_class}]")


def is_code(c: Column, char_class: str, length: int) -> Column:
    """Exactly ``length`` characters, all inside the class."""
    return c.rlike(rf"\A[{char_class}]{{{length}}}\z")


#: What follows the bytes of a text that is no id of 32 lower-case hex digits, so that it is longer than a packed id.
_UNPACKED = bytes(17)


def packed_id(c: Column) -> Column:
    """An id of 32 lower-case hex digits as its 16 bytes, any other text as its own bytes and 17 more; different texts stay different."""
    return F.when(is_code(c, "0-9a-f", 32), F.unhex(c)).otherwise(F.concat(c.cast("binary"), F.lit(_UNPACKED)))


def unpacked_id(c: Column) -> Column:
    """The text of a packed id."""
    own = F.substring(c, F.lit(1), F.octet_length(c) - len(_UNPACKED))
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(own.cast("string"))


def packed_value(value: str) -> bytes:
    """One id as :func:`packed_id` packs it."""
    return bytes.fromhex(value) if re.fullmatch("[0-9a-f]{32}", value) else value.encode() + _UNPACKED


def packed(df: DataFrame, *ids: str) -> DataFrame:
    """Rows with these ids packed, which halves what they add to a shuffle; they may be packed already."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: packed_id(F.col(c)) for c in ids if kinds[c] != T.BinaryType()})


def packed_keys(hot: Mapping | Iterable) -> dict | list:
    """Heavy ids as :func:`packed` rows have them."""
    found = [k for k in hot if k is not None]
    return {packed_value(k): hot[k] for k in found} if isinstance(hot, Mapping) else [packed_value(k) for k in found]


def label_of(c: Column, labels: Mapping[str, str]) -> Column:
    """The label of a code, or the code itself when it has none."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def drop_file_name(path: Column, name: Column) -> Column:
    """The folder part of a path, given the file name at its end."""
    return F.left(path, F.length(path) - F.length(name))
