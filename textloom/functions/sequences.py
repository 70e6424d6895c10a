"""Fixed-length id sequences: padding, truncating, shifting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pad_sequence(
    ids: Column | str,
    length: int,
    padding: str = "pre",
    truncating: str = "pre",
    value: int = 0,
) -> Column:
    """Bring an integer array to ``length`` cells; ``pre`` / ``post`` say which end is padded or cut."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    if truncating == "pre":
        kept = F.slice(ids, F.greatest(F.size(ids) - length, F.lit(0)) + 1, F.lit(length))
    elif truncating == "post":
        kept = F.slice(ids, 1, length)
    else:
        raise ValueError(f"truncating must be 'pre' or 'post', not {truncating!r}")
    fill = F.array_repeat(F.lit(value).cast("bigint"), F.greatest(F.lit(length) - F.size(ids), F.lit(0)))
    kept = kept.cast("array<bigint>")
    if padding == "pre":
        return F.concat(fill, kept)
    if padding == "post":
        return F.concat(kept, fill)
    raise ValueError(f"padding must be 'pre' or 'post', not {padding!r}")


def drop_last(ids: Column | str) -> Column:
    """Decoder input: everything but the last cell."""
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))


def drop_first(ids: Column | str) -> Column:
    """Decoder target: everything but the first cell."""
    return F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))


def shift_left(ids: Column | str, fill: int = 0) -> Column:
    """Same length, moved one cell to the left, last cell filled."""
    return F.concat(drop_first(ids), F.array(F.lit(fill).cast("bigint")))


def render(ids: Column | str) -> Column:
    """Space-joined text form of an integer array."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(ids.cast("array<string>"), " ")
