"""Approximate distinct counts as HyperLogLog sketches: kept as a column, united later, counted when asked."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

LG_REGISTERS = 12


def sketch(df: DataFrame, keys: list[str], column: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """``keys`` and the ``sketch`` of the distinct values of ``column``: a few KB a group, whatever its rows; combined before the shuffle.

    Nulls are no value. Any table with such a column can be kept and united with those of other days or sources.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_registers).alias("sketch"))


def unite(sketches: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """One sketch per group of stored ones, as if its rows had been read together; ``more`` aggregates are added."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), *more)


def estimated(sketches: DataFrame) -> DataFrame:
    """The sketch column replaced by ``estimate``."""
    return sketches.withColumn("estimate", F.hll_sketch_estimate("sketch")).drop("sketch")


def relative_error(lg_registers: int = LG_REGISTERS) -> float:
    """One standard error of an estimate as a share of the true number."""
    return 1.04 / math.sqrt(1 << lg_registers)
