"""Surrogate keys (F22) and separator-safe key text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.functions.text import _col

# Unit separator between key parts, so that ("1", "23") and ("12", "3") differ.
KEY_SEPARATOR = "\x1f"


def key_text(*cols) -> Column:
    """Key parts joined by U+001F; null when any part is null (as ``||`` does)."""
    parts = [_col(c).cast("string") for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit(KEY_SEPARATOR), p)
    return out


def surrogate_key(*cols) -> Column:
    """Deterministic 64-bit key: the first 16 hex digits of MD5 of the key text, as a
    signed bigint.

    Null in gives null out. MD5 keeps the key reproducible in any SQL engine (the
    oracle computes the same value). A real key equals the default member's -1 with a
    chance of 2^-64, as any two keys do.
    """
    s = key_text(*cols)
    return F.when(s.isNotNull(), F.conv(F.substring(F.md5(s), 1, 16), 16, -10).cast("bigint"))
