"""Row hash for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_text(columns: Sequence[Column], separator: str = "|") -> Column:
    """Columns rendered as text and joined; NULL counts as empty and keeps its separator."""
    parts: list[Column] = []
    for column in columns:
        if parts:
            parts.append(F.lit(separator))
        parts.append(F.coalesce(column.cast("string"), F.lit("")))
    return F.concat(*parts)


def row_hash(columns: Sequence[Column], charset: str | None = None) -> Column:
    """SHA-256 as 32 bytes. ``charset='UTF-16LE'`` hashes two-byte text instead of UTF-8."""
    text = hash_text(columns)
    data = F.encode(text, charset) if charset else text.cast("binary")
    return F.unhex(F.sha2(data, 256))
