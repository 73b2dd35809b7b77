"""Stable resource identifiers built from native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DELIMITER = "|"


def uuid_from_text(text: Column) -> Column:
    """A UUID of version-4 shape taken from the SHA-256 of ``text``."""
    return F.regexp_replace(
        F.sha2(text, 256),
        "^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$",
        "$1-$2-4$3-8$4-$5",
    )


def seed_parts(cols: Sequence[str | Column], delimiter: str = DELIMITER) -> Column:
    """Key parts joined by ``delimiter``; null reads as empty, a delimiter inside a part is escaped."""
    parts = []
    for c in cols:
        part = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        part = F.replace(F.replace(part, F.lit("\\"), F.lit("\\\\")), F.lit(delimiter), F.lit("\\" + delimiter))
        parts.append(part)
    return F.concat_ws(delimiter, *parts)


def escaped_parts(parts: Sequence[str], delimiter: str = DELIMITER) -> str:
    """``seed_parts`` of texts in a Python task."""
    joined = delimiter.join(parts)
    if "\\" not in joined and joined.count(delimiter) == len(parts) - 1:
        return joined
    return delimiter.join(p.replace("\\", "\\\\").replace(delimiter, "\\" + delimiter) for p in parts)


def seed_text(cols: Sequence[str | Column], salt: str = "", delimiter: str = DELIMITER) -> Column:
    return F.concat_ws(delimiter, seed_parts(cols, delimiter), F.lit(salt))


def surrogate_uri(base: str, cols: Sequence[str | Column], salt: str = "", delimiter: str = DELIMITER) -> Column:
    """The same key gives the same URI in every run."""
    return F.concat(F.lit(base), uuid_from_text(seed_text(cols, salt, delimiter)))


def uri_from_seed(base: str, seed: Column) -> Column:
    return F.concat(F.lit(base), uuid_from_text(seed))


def random_uri(base: str) -> Column:
    """Not repeatable: a retried task draws new values, so write the result once and read it back."""
    return F.concat(F.lit(base), F.uuid())
