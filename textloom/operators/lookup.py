"""Joins from many rows to a one-row-per-key table, with a bound on what is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.sources.scratch import materialize

MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024
HEAD_ROWS = 200_000
#: Text keys of up to this many bytes are looked up as they are, longer ones by their digest, which has 64.
SHORT_KEY = 32


def measure(table: DataFrame) -> tuple[int, int]:
    """Rows of a table and the volume of its texts, digests and arrays."""
    width = F.lit(8 * len(table.columns))
    for name, kind in table.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            width = width + F.coalesce(F.size(name), F.lit(0)) * 8
    rows, size = table.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows, size or 0


def fits_broadcast(table: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """True when both the rows of a table and their volume are within the bound."""
    rows, size = measure(table)
    return rows <= max_rows and size <= max_bytes


def keyed_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    weight: str,
    how: str = "inner",
    head: int = HEAD_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``table`` (unique ``key``) where few keys may own most of the rows.

    A table within the broadcast bound is broadcast whole. A larger one is split: the ``head``
    heaviest keys by ``weight``, or as many as the bound allows, are broadcast, so no hot key is ever shuffled; what is left
    is light per key and joins by shuffle. ``how`` is ``inner``, ``left`` or ``left_semi``.
    ``table`` should be a written table, since it is read more than once.
    """
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), key, how)
    count, size = measure(table)
    head = min(head, count * MAX_BYTES // max(size, 1))
    # Past the bound a long text key is looked up by its digest, so that every key is short; the two can't be equal, as their lengths differ.
    short = F.col(key)
    if dict(table.dtypes)[key] == "string":
        short = F.when(F.octet_length(key) <= SHORT_KEY, F.col(key)).otherwise(F.sha2(key, 256))
    keyed = rows.withColumn("_key", short)
    short_table = table.withColumn("_key", short).drop(key)
    heavy = materialize(short_table.orderBy(F.desc(weight), "_key").limit(head), "heavy-keys")
    hot_keys = F.broadcast(heavy.select("_key"))
    hot = keyed.join(F.broadcast(heavy), "_key", "left_semi" if how == "left_semi" else "inner").drop("_key")
    # The merge hint keeps this join a shuffled one: the table is known to be past the bound.
    cold = keyed.join(hot_keys, "_key", "left_anti").join(short_table.hint("merge"), "_key", how).drop("_key")
    return hot.unionByName(cold.select(*hot.columns))
