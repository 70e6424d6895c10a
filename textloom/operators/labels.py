"""Label vocabularies and encodings over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textloom.functions.labels import multi_hot
from textloom.operators.lookup import keyed_lookup
from textloom.operators.ranking import global_rank
from textloom.sources.scratch import materialize

UNKNOWN_LABEL = "[UNK]"


def label_counts(df: DataFrame, labels_col: str) -> DataFrame:
    return df.select(F.explode(labels_col).alias("label")).groupBy("label").agg(
        F.count(F.lit(1)).alias("n")
    )


def sorted_label_ids(counts: DataFrame) -> DataFrame:
    """``(label, n, label_id)`` with ids 0.. in label order."""
    ranked = global_rank(counts, [F.col("label")])
    return materialize(ranked.select("label", "n", (F.col("rank") - 1).alias("label_id")), "labels")


def frequent_label_ids(counts: DataFrame) -> DataFrame:
    """``(label, n, label_id)`` with the unknown label at 0 and the others by frequency, then name."""
    ranked = global_rank(counts, [F.desc("n"), F.col("label")])
    unknown = counts.sparkSession.range(1).select(
        F.lit(UNKNOWN_LABEL).alias("label"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("label_id"),
    )
    return materialize(
        unknown.unionByName(ranked.select("label", "n", F.col("rank").alias("label_id"))), "labels"
    )


def encode(
    df: DataFrame, id_col: str, labels_col: str, vocab: DataFrame, unknown_id: int | None = None
) -> DataFrame:
    """``(id, label_id)`` in long form; unknown labels are dropped or become ``unknown_id``."""
    long = df.select(id_col, F.explode(F.array_distinct(labels_col)).alias("label"))
    how = "inner" if unknown_id is None else "left"
    joined = keyed_lookup(long, vocab.select("label", "label_id", "n"), "label", "n", how)
    if unknown_id is not None:
        joined = joined.withColumn("label_id", F.coalesce("label_id", F.lit(unknown_id).cast("bigint")))
    return joined.select(id_col, "label_id").distinct()


def hot_rows(df: DataFrame, encoded: DataFrame, id_col: str, vocab: DataFrame) -> DataFrame:
    """Dense 0/1 row per id, one cell per label of the vocabulary."""
    width = vocab.agg(F.max("label_id") + 1).scalar()
    ids = encoded.groupBy(id_col).agg(F.collect_set("label_id").alias("_ids"))
    joined = df.select(id_col).join(ids, id_col, "left").withColumn("_width", width)
    return joined.select(
        id_col,
        multi_hot(F.coalesce("_ids", F.array().cast("array<bigint>")), F.col("_width")).alias("hot"),
    )


def decode(rows: DataFrame, id_col: str, hot_col: str, vocab: DataFrame) -> DataFrame:
    """Labels of the ones of every 0/1 row, in id order."""
    cells = rows.select(id_col, F.posexplode(hot_col).alias("pos", "hot")).filter("hot = 1")
    named = keyed_lookup(
        cells.select(id_col, F.col("pos").cast("bigint").alias("label_id")), vocab, "label_id", "n"
    )
    grouped = named.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("label_id", "label"))).alias("_l")
    )
    return rows.select(id_col).join(grouped, id_col, "left").select(
        id_col, F.coalesce(F.col("_l.label"), F.array().cast("array<string>")).alias("labels")
    )


def class_ids(df: DataFrame, class_col: str) -> tuple[DataFrame, DataFrame]:
    """Replace a single class column by its sorted id; returns the encoded rows and the classes."""
    counts = df.groupBy(F.col(class_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    vocab = sorted_label_ids(counts.filter("label is not null"))
    rows = keyed_lookup(df.withColumnRenamed(class_col, "label"), vocab, "label", "n", "inner")
    return rows.drop("n").withColumnRenamed("label", class_col), vocab


def scored_lists(scores: DataFrame, id_col: str) -> DataFrame:
    """All scored labels of a row as ``scored array<struct<label_id,label,prob>>``."""
    return scores.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("label_id", "label", F.col("p").alias("prob")))).alias(
            "scored"
        )
    )


def top_k_rows(scores: DataFrame, id_col: str, k: int) -> DataFrame:
    """Long form of the k best labels per row, with their place."""
    best = Window.partitionBy(id_col).orderBy(F.desc("p"), "label_id")
    return scores.withColumn("place", F.row_number().over(best).cast("bigint")).filter(
        F.col("place") <= k
    )
