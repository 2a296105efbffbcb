"""Normalised MD5 keys for the vault, plain MD5 keys for the presentation layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"
MISSING = "^^"


def _text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))


def _digest(parts: Sequence[Column]) -> Column:
    joined = F.concat_ws(SEPARATOR, *[F.coalesce(part, F.lit(MISSING)) for part in parts])
    return F.when(F.coalesce(*parts).isNotNull(), F.md5(joined))


def hash_key(columns: Sequence[str]) -> Column:
    """Case-insensitive key: trimmed, upper-cased, joined in the declared order."""
    return _digest([F.upper(_text(name)) for name in columns])


def hash_diff(columns: Sequence[str]) -> Column:
    """Change fingerprint of a payload; like a key, but case matters."""
    return _digest([_text(name) for name in columns])


def surrogate_key(name: str) -> Column:
    """Presentation key: MD5 of the value as it stands. Never joins to a vault key."""
    return F.md5(F.col(name).cast("string"))
