"""Repeatable pseudo-randomness: every draw is a function of a seed and the row's own key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HEX_DIGITS = 15


def seeded_digest(seed: int | str, *keys: Column | str) -> Column:
    """md5 of ``seed:key:key...`` as hex; sorting by it is a global shuffle."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def seeded_int(seed: int | str, *keys: Column | str) -> Column:
    """Uniform integer in [0, 16**15)."""
    return F.conv(F.substring(seeded_digest(seed, *keys), 1, HEX_DIGITS), 16, 10).cast("bigint")


def seeded_uniform(seed: int | str, *keys: Column | str) -> Column:
    """Uniform double in [0, 1)."""
    return seeded_int(seed, *keys) / F.lit(float(16**HEX_DIGITS))
