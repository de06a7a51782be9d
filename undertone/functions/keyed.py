"""Randomness as a function of string keys.

Every random choice is taken from md5(key), so it is the same in any engine,
on any number of partitions and after any retry.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPAN = float(1 << 60)


def key(*parts) -> Column:
    """``a:b:c`` of columns and literals; a null part is an empty string."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def hashed(k: Column) -> Column:
    """60 bits of md5(k) as a non-negative long."""
    return F.conv(F.substring(F.md5(k), 1, 15), 16, 10).cast("long")


def uniform(k: Column) -> Column:
    """A number in [0, 1)."""
    return hashed(k) / F.lit(SPAN)


def pick(k: Column, n: Column | int) -> Column:
    """An index in [0, n)."""
    return F.pmod(hashed(k), F.lit(n) if isinstance(n, int) else n)
