"""Deduplication, group filters and profiles of text tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from textloom.operators.lookup import keyed_lookup
from textloom.operators.quantiles import quantiles, with_image
from textloom.sources.scratch import materialize

#: Distinct values of a measure up to which its quartiles come from one buffer.
BUFFERED = 10_000


def first_per_key(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """Keep the row with the lowest id of every key.

    Only a digest of the key and the lowest id are shuffled, combined map-side, so copies of one
    text collapse before they travel; the rows themselves are then picked by their unique id.
    """
    firsts = df.groupBy(F.sha2(F.col(key), 256).alias("_digest")).agg(F.min(id_col).alias(id_col))
    return df.join(firsts.select(id_col), id_col, "left_semi")


def keep_repeated_groups(df: DataFrame, key: str) -> DataFrame:
    """Keep the rows whose key occurs more than once."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    return keyed_lookup(df, materialize(counts, "groups"), key, "_rows", "left_semi")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def class_balance(df: DataFrame, column: str) -> DataFrame:
    """Number of classes and the largest and smallest class."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(column).alias("n_classes"), F.max("n").alias("max_n"), F.min("n").alias("min_n")
    )


def numeric_profile(df: DataFrame, columns: dict[str, Column], continuous: dict[str, Column] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per named expression; the quartiles are exact.

    Equal values of ``columns``, integer expressions, are counted first, and everything else follows from one row per distinct value. The doubles of
    ``continuous`` hardly repeat: their rows stay where they are. A measure with more than ``BUFFERED`` rows of either kind has its quartiles found by narrowing.
    """
    def stacked(exprs: dict[str, Column], kind: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("measure"), c.cast(kind).alias("value")) for n, c in exprs.items()])
        return df.select(F.explode(pairs).alias("p")).select("p.measure", "p.value").filter("value is not null")

    parts = []
    if columns:
        counted = stacked(columns, "bigint").groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select("measure", F.col("value").cast("double").alias("value"), "n", F.lit(True).alias("whole")))
    if continuous:
        parts.append(stacked(continuous, "double").select("measure", "value", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("whole")))
    histogram = materialize(with_image(reduce(DataFrame.unionByName, parts), "value"), "histogram")
    value, n = F.col("value"), F.col("n")
    sums = histogram.groupBy("measure").agg(
        F.sum("n").alias("count"), F.sum(value * n).alias("_s"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count(F.lit(1)).alias("_rows"), F.first("whole").alias("_whole"),
    )
    measured = sums.collect()  # one row per measure
    mean = F.col("_s") / F.col("count")
    # Squared distances to the mean in a second pass over the histogram: large values lose no digits.
    small = [r["measure"] for r in measured if r["_rows"] <= BUFFERED]
    means = sums.select(F.col("measure").alias("_m"), mean.alias("_mean"))
    around = histogram.join(F.broadcast(means), F.col("measure") == F.col("_m"))
    buffered = F.when(F.col("measure").isin(small), value) if small else F.lit(None).cast("double")
    squares = around.groupBy("_m").agg(
        F.sum((value - F.col("_mean")) * (value - F.col("_mean")) * n).alias("_ss"), F.percentile(buffered, [0.25, 0.5, 0.75], n).alias("_q")
    )
    large = {r["measure"]: r["count"] for r in measured if r["_rows"] > BUFFERED}
    narrowed = quantiles(histogram.filter(F.col("measure").isin(list(large))), large, [0.25, 0.5, 0.75]) if large else {}
    table = df.sparkSession.createDataFrame([(m, q) for m, q in narrowed.items()], "_n string, _narrowed array<double>")
    variance = F.col("_ss") / (F.col("count") - 1)
    joined = sums.join(F.broadcast(squares), F.col("measure") == F.col("_m")).join(F.broadcast(table), F.col("measure") == F.col("_n"), "left")
    q = F.coalesce("_narrowed", "_q")
    return joined.select(
        "measure", "count", mean.alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(variance)).alias("std"),
        "min", q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), "max",
    )


def object_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, unique, top and freq per string column; ties for top go to the smaller value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])
    stacked = df.select(F.explode(pairs).alias("p")).select("p.field", "p.value")
    counts = stacked.filter("value is not null").groupBy("field", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        counts.groupBy("field")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("best"),
        )
        .select(
            "field", "count", "unique", F.col("best.value").alias("top"), (-F.col("best.neg")).alias("freq")
        )
    )


def grouped_lists(
    df: DataFrame, key: str, id_col: str, value: str, chunk: int = 1000
) -> DataFrame:
    """Lists of values per key, in id order, cut into chunks of ``chunk`` consecutive ids.

    A list is never longer than ``chunk``, however large its group is.
    """
    return (
        df.groupBy(key, F.floor(F.col(id_col) / chunk).alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col(id_col), F.col(value)))).alias("_rows"))
        .select(key, "chunk", F.col(f"_rows.{value}").alias("items"))
    )
