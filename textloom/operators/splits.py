"""Train / validation / test assignment as a column, stable under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.functions.hashing import seeded_int
from textloom.operators.ranking import hash_rank, kth_smallest


def three_way(df: DataFrame, id_col: str, seed: int = 42, train: int = 80, val: int = 10) -> DataFrame:
    """80/10/10 by a hash of the id: three disjoint parts without any join or shuffle."""
    bucket = seeded_int(seed, id_col) % 100
    return df.withColumn(
        "split",
        F.when(bucket < train, "train").when(bucket < train + val, "val").otherwise("test"),
    )


def stratified(
    df: DataFrame, id_col: str, stratum: str, seed: int = 42, tenths: int = 1
) -> DataFrame:
    """Hold out ``ceil(tenths/10 * n)`` rows of every stratum, half of them for validation."""
    ranked = hash_rank(df, seed, id_col, [stratum])
    held = F.floor((F.col("group_size") * tenths + 9) / 10)
    half = seeded_int(f"{seed}-half", id_col) % 2
    return ranked.select(
        *df.columns,
        F.when(F.col("rank") > held, "train").when(half == 0, "val").otherwise("test").alias("split"),
    )


def tail_holdout(df: DataFrame, id_col: str, tenths: int = 2) -> DataFrame:
    """The last rows in id order are held out, the first floor((1 - tenths/10) * n) train."""
    n = df.count()
    cut = kth_smallest(df, id_col, n * (10 - tenths) // 10)
    held = F.lit(True) if cut is None else F.col(id_col) > cut
    return df.withColumn("held_out", held)
