"""Deterministic pseudo-random numbers from md5.

``uhash(key, salt)`` is the first 32 bits of md5("key|salt") as a non-negative
long. It is portable: DuckDB computes the same value with
``('0x' || substr(md5(k || '|' || salt), 1, 8))::UBIGINT``, so every generated
dataset has an exact SQL oracle, and a re-run after a lost executor yields the
same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPAN = 1 << 32


def _digest(key: Column | str, salt: str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{salt}")))


def uhash(key: Column | str, salt: str) -> Column:
    return F.conv(F.substring(_digest(key, salt), 1, 8), 16, 10).cast("long")


def bucket(key: Column | str, salt: str, n: int) -> Column:
    """Uniform integer in [0, n)."""
    return uhash(key, salt) % F.lit(n)


def chance(key: Column | str, salt: str, rate: float) -> Column:
    """``uhash(key, salt) < int(rate * HASH_SPAN)``, true for about ``rate`` of keys.
    Digits of one case and width sort as their numbers do, so the digest is compared
    as text with the least one that is not below; no number is made of it."""
    least = int(rate * HASH_SPAN)
    return _digest(key, salt) < F.lit(f"{max(least, 0):08x}" if least < HASH_SPAN else "g")


def sql_uhash(key_sql: str, salt: str) -> str:
    """Same number in DuckDB SQL (for oracle text)."""
    return f"CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{salt}'), 1, 8))::UBIGINT AS BIGINT)"


def sql_chance(key_sql: str, salt: str, rate: float) -> str:
    return f"({sql_uhash(key_sql, salt)} < {int(rate * HASH_SPAN)})"
