"""Exact ranks without sorting a whole table, or a whole class, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.functions.hashing import seeded_digest
from textloom.sources.scratch import materialize

BUCKET_DIGITS = 3


def hash_rank(
    df: DataFrame,
    seed: int | str,
    id_col: str,
    within: Sequence[str] = (),
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Rank rows 1..n by ``md5(seed:id)``, per group of ``within``; also adds the group size.

    The first hex digits of the digest split every group evenly into 16**digits buckets, so a
    group holding a third of all rows is still ranked by thousands of tasks. Offsets of the
    buckets come from a small count table. Columns added: ``rank``, ``group_size``.
    """
    keyed = df.withColumn("_h", seeded_digest(seed, id_col)).withColumn("_bucket", F.substring("_h", 1, digits))
    # Null classes form a group of their own; plain equality keeps the rows where the window put them.
    groups = [f"_g{i}" for i in range(len(within))]
    for name, column in zip(groups, within):
        keyed = keyed.withColumn(name, F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("null")))
    bucket_keys = [*groups, "_bucket"]
    group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*bucket_keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *bucket_keys,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(group).alias("group_size"),
        )
    )
    local = Window.partitionBy(*bucket_keys).orderBy("_h", id_col)
    ranked = keyed.withColumn("_local", F.row_number().over(local)).join(offsets, bucket_keys)
    return ranked.select(
        *df.columns,
        (F.col("_offset") + F.col("_local")).cast("bigint").alias("rank"),
        F.col("group_size").cast("bigint").alias("group_size"),
    )


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Rank all rows 1..n by ``order`` (which must be a total order).

    Rows are range-partitioned and written once with their partition number, so the partition
    borders are fixed; per-partition counts give the offsets.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    fixed = materialize(ranged, "rank")
    offsets = (
        fixed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_n").over(
                    Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_offset"),
        )
    )
    # At most one offset row per range partition.
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        fixed.withColumn("_local", local)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_part", "_offset", "_local")
    )


def kth_smallest(df: DataFrame, column: str, k: int, fanout: int = 4096) -> int | None:
    """The k-th smallest value (1-based) of an integer column, by narrowing a histogram.

    Each pass counts rows in at most ``fanout`` ranges and keeps the one holding rank k: no sort,
    no shuffle of rows, and duplicates or clustered values do no harm.
    """
    values = df.select(F.col(column).cast("bigint").alias("v")).filter(F.col("v").isNotNull())
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if k < 1 or k > n:
        return None
    while low < high:
        width = -(-(high - low + 1) // fanout)
        counts = (
            values.filter(F.col("v").between(low, high))
            .groupBy(F.expr(f"(v - {low}L) div {width}L").alias("b"))
            .count()
            .orderBy("b")
            .collect()
        )
        for bucket, count in counts:
            if k <= count:
                low, high = low + bucket * width, min(high, low + (bucket + 1) * width - 1)
                break
            k -= count
    return low


def first_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, n: int, seed: int, id_col: str) -> DataFrame:
    """n pseudo-random rows, the same ones on every run."""
    return df.orderBy(seeded_digest(seed, id_col), id_col).limit(n)


def shuffled_batches(df: DataFrame, seed: int, id_col: str, size: int) -> DataFrame:
    """Global shuffle cut into batches of ``size`` rows: adds ``batch_id`` and ``batch_pos``."""
    ranked = hash_rank(df, seed, id_col)
    zero_based = F.col("rank") - 1
    return ranked.select(
        *df.columns,
        F.floor(zero_based / size).cast("bigint").alias("batch_id"),
        (zero_based % size).cast("bigint").alias("batch_pos"),
    )
