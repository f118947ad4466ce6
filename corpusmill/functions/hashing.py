"""Deterministic pseudo-random numbers as column expressions.

A draw is the first 32 bits of ``md5`` over its identifying parts, so the same
draw is reproducible by any engine with ``md5`` (the SQL oracles use it too)
and independent of partitioning or task retries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0
TWO_52 = 4503599627370496.0


def _part(p) -> Column:
    """Strings name columns; other Python values are literals (seeds)."""
    if isinstance(p, Column):
        return p
    return F.col(p) if isinstance(p, str) else F.lit(p)


def md5_bits(*parts) -> Column:
    cols = [_part(p) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols)), 1, 8), 16, 10).cast("bigint")


def md5_unit(*parts) -> Column:
    """Uniform in the open interval (0, 1)."""
    return (md5_bits(*parts) + F.lit(0.5)) / F.lit(TWO_32)


def md5_unit_fine(*parts) -> Column:
    """Uniform in the open interval (0, 1), of 52 bits."""
    digits = F.substring(F.md5(F.concat_ws(":", *[_part(p) for p in parts])), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(TWO_52)
