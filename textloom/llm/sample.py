"""Bounded training samples and held-out rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def bounded_sample(rows: DataFrame, max_rows: int, key: str) -> DataFrame:
    """At most ``max_rows`` rows, those of the smallest hashes of ``key``, so the same ones on any cluster.

    The rows are counted first; a threshold on the hash then lets about that many through, so that the others are
    neither sorted nor shuffled. Only those that are left are ordered and cut.
    """
    total = rows.count()
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 40))
    # A little more than is wanted, so that the cut below decides.
    share = min(1.0, 1.1 * max_rows / max(total, 1))
    return rows.filter(place < F.lit(int(share * (1 << 40)) + 1)).orderBy(place, key).limit(max_rows)
