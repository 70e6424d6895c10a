"""Class balancing: random over- and undersampling and SMOTE, with repeatable draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.hashing import seeded_int, seeded_uniform
from textloom.operators.nearest import nearest_k
from textloom.operators.ranking import hash_rank
from textloom.sources.scratch import materialize

SLOT_CHUNK = 1_000_000
DRAWS_PER_KEY = 10_000
SMOTE_NEIGHBOURS = 5


def class_sizes(df: DataFrame, class_col: str) -> DataFrame:
    sizes = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("max_n", sizes.agg(F.max("n")).scalar())


def draw_slots(sizes: DataFrame, class_col: str, wanted: Column, chunk: int = SLOT_CHUNK) -> DataFrame:
    """One row per draw, numbered 1..wanted within its class.

    Chunks are spread over tasks before they unfold, so a class short of billions of rows is
    not generated by one task.
    """
    chunks = (
        sizes.withColumn("_wanted", wanted)
        .filter("_wanted > 0")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("_wanted"), F.lit(chunk))).alias("_from"))
        .repartition(class_col, "_from")
    )
    last = F.least(F.col("_from") + chunk - 1, F.col("_wanted"))
    return chunks.select(
        *sizes.columns, F.explode(F.sequence(F.col("_from"), last)).alias("draw")
    )


def _take_drawn(slots: DataFrame, ranked: DataFrame, class_col: str) -> DataFrame:
    """Join draws to the rows of their class and rank, both sides by shuffle.

    A row of a small class is drawn ``max_n / n`` times. Draws of one row are dealt into parts of about ``DRAWS_PER_KEY``, and the
    row is copied to as many parts, so that no key holds more, even if a class has one row.
    """
    parts = F.ceil(F.col("max_n") / F.col("n") / DRAWS_PER_KEY).cast("int")
    dealt = slots.withColumn("_part", F.pmod(F.xxhash64("draw"), parts).cast("int")).drop("n", "max_n")
    copies = ranked.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n", "max_n")
    return dealt.hint("merge").join(copies.hint("merge"), [class_col, "rank", "_part"]).drop("_part")


def _ranked(df: DataFrame, seed: int, id_col: str, class_col: str, sizes: DataFrame) -> DataFrame:
    """Rows with their rank in the class, the class size ``n`` and the largest size ``max_n``."""
    ranked = hash_rank(df, seed, id_col, [class_col]).withColumnRenamed("group_size", "n")
    return ranked.withColumn("max_n", sizes.agg(F.max("n")).scalar())


def _draw_rows(df: DataFrame, id_col: str, class_col: str, seed: int, wanted: Column) -> DataFrame:
    sizes = class_sizes(df, class_col)
    slots = draw_slots(sizes, class_col, wanted)
    slots = slots.withColumn("rank", seeded_int(seed, class_col, "draw") % F.col("n") + 1)
    ranked = _ranked(df, seed, id_col, class_col, sizes)
    return _take_drawn(slots, ranked, class_col).select(*df.columns, "draw")


def oversample_all(df: DataFrame, id_col: str, class_col: str, seed: int = 42) -> DataFrame:
    """Draw every class, the largest too, with replacement up to the size of the largest."""
    return _draw_rows(df, id_col, class_col, seed, F.col("max_n"))


def oversample_minority(df: DataFrame, id_col: str, class_col: str, seed: int = 42) -> DataFrame:
    """Keep all rows (draw 0) and add draws to the smaller classes."""
    extra = _draw_rows(df, id_col, class_col, seed, F.col("max_n") - F.col("n"))
    return df.withColumn("draw", F.lit(0).cast("bigint")).unionByName(extra)


def undersample(df: DataFrame, id_col: str, class_col: str, seed: int = 42) -> DataFrame:
    """Keep as many rows of every class as the smallest class has."""
    sizes = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    ranked = hash_rank(df, seed, id_col, [class_col])
    return ranked.filter(F.col("rank") <= sizes.agg(F.min("n")).scalar()).select(*df.columns)


def smote(
    df: DataFrame,
    id_col: str,
    class_col: str,
    vector_col: str,
    seed: int = 42,
    neighbours: int = SMOTE_NEIGHBOURS,
) -> DataFrame:
    """Synthetic rows that lift every class to the largest: ``(class, draw, base, neighbour, vector)``.

    vector = base + u * (neighbour - base), the neighbour being one of the min(k, n - 1) nearest
    of the same class. A class of one row repeats that row.
    """
    sizes = class_sizes(df.select(id_col, class_col), class_col)
    slots = draw_slots(sizes, class_col, F.col("max_n") - F.col("n")).select(
        class_col,
        "draw",
        "n",
        "max_n",
        (seeded_int(f"{seed}-base", class_col, "draw") % F.col("n") + 1).alias("rank"),
        F.least(F.lit(neighbours), F.col("n") - 1).alias("k"),
    )
    slots = materialize(slots, "smote-draws")
    ranked = materialize(_ranked(df.select(id_col, class_col, vector_col), seed, id_col, class_col, sizes), "smote-rows")

    # Each row that is drawn carries its vector and its neighbours' into the one join with the draws.
    drawn = slots.select(class_col, "rank").distinct()
    seeds = ranked.join(drawn.hint("merge"), [class_col, "rank"], "left_semi")
    near = nearest_k(
        seeds.filter("n > 1").select(df.columns), df, id_col, vector_col, neighbours, metric="l2", scope=class_col, exclude_self=True
    )
    others = df.select(F.col(id_col).alias("match_id"), F.col(vector_col).alias("_v"))
    near = near.join(others.hint("merge"), "match_id").groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("match_id").alias("id"), F.col("_v").alias("v")))).alias("_near")
    )
    bundles = seeds.join(near.withColumnRenamed("query_id", id_col).hint("merge"), id_col, "left").select(
        class_col, "rank", "n", "max_n", F.col(id_col).alias("base"), F.col(vector_col).alias("_x"), "_near"
    )
    place = (seeded_int(f"{seed}-neighbour", class_col, "draw") % F.col("k") + 1).cast("int")
    taken = _take_drawn(slots, bundles, class_col).withColumn("_to", F.when(F.col("k") > 0, F.element_at("_near", place)))
    return (
        taken.withColumn("neighbour", F.coalesce("_to.id", "base"))
        .withColumn("_y", F.coalesce("_to.v", "_x"))
        .withColumn("step", seeded_uniform(f"{seed}-step", class_col, "draw"))
        .select(
            class_col,
            "draw",
            "base",
            "neighbour",
            F.zip_with(
                "_x",
                "_y",
                lambda x, y: x.cast("double") + F.col("step") * (y.cast("double") - x.cast("double")),
            ).alias("vector"),
        )
    )
