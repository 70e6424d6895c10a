"""Sparse text vectors in long form ``(id, token_id, value)`` and the idf variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textloom.operators.lookup import keyed_lookup
from textloom.sources.scratch import materialize

UNKNOWN_ID = 0


def text_token_counts(tokens: DataFrame, id_col: str) -> DataFrame:
    """``(id, token, tf)`` of every text."""
    return tokens.groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("tf"))


def count_vectors(tokens: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """Occurrences per (text, token id); tokens outside the vocabulary fall on id 0."""
    return vectors_of_counts(text_token_counts(tokens, id_col), vocab, id_col)


def vectors_of_counts(per_token: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """``count_vectors`` from counts that are there already."""
    known = vocab.select("token", "token_id", "n")
    joined = keyed_lookup(per_token, known, "token", "n", "left")
    return joined.groupBy(
        id_col, F.coalesce("token_id", F.lit(UNKNOWN_ID).cast("bigint")).alias("token_id")
    ).agg(F.sum("tf").alias("n"))


def multi_hot_vectors(tokens: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """The ids present in each text."""
    return count_vectors(tokens, vocab, id_col).select(
        id_col, "token_id", F.lit(1).alias("hot")
    )


def tfidf_vectors(
    counts: DataFrame, vocab: DataFrame, n_docs: DataFrame, id_col: str
) -> DataFrame:
    """tf * ln(1 + N / (1 + df)); the unknown id weighs the mean idf of the vocabulary.

    ``counts`` is ``text_token_counts``, written once for the fit and for this; ``vocab`` carries ``df`` from the fit, ``n_docs`` is a
    one-row, one-column table with the number of texts.
    """
    idf = F.log1p(n_docs.scalar() / (F.lit(1.0) + F.col("df")))
    table = materialize(vocab.select("token", "token_id", "n", idf.alias("idf")), "idf")
    unknown = table.agg(F.avg("idf")).scalar()
    joined = keyed_lookup(counts, table, "token", "n", "left").select(
        id_col, F.coalesce("token_id", F.lit(UNKNOWN_ID).cast("bigint")).alias("token_id"), "tf", "idf"
    )
    # All rows of a token id have the same idf; only the unknown id has several rows in a text, and none of its own.
    cells = joined.repartition(F.col(id_col)).groupBy(id_col, "token_id").agg(F.sum("tf").alias("n"), F.max("idf").alias("idf"))
    weight = F.col("n") * F.when(F.col("token_id") == UNKNOWN_ID, unknown).otherwise(F.col("idf"))
    return cells.select(id_col, "token_id", weight.alias("weight"))


def smooth_idf(term_counts: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``(token, df, idf)`` with idf = ln((1 + N) / (1 + df)) + 1."""
    df = term_counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((n_docs.scalar() + F.lit(1.0)) / (F.col("df") + F.lit(1.0))) + F.lit(1.0)
    return materialize(df.withColumn("idf", idf), "idf")


def unit_tfidf(term_counts: DataFrame, idf: DataFrame, id_col: str) -> DataFrame:
    """tf * idf, each text scaled to length one: ``(id, token, weight)``."""
    raw = keyed_lookup(term_counts, idf, "token", "df").withColumn("w", F.col("tf") * F.col("idf"))
    # A text's terms lie together already; its length is one pass over them.
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "token", (F.col("w") / length).alias("weight"))


def frequent_terms(idf: DataFrame, n: int) -> DataFrame:
    """``(token, place)`` of the n tokens found in most texts, ties by token."""
    order = [F.desc("df"), F.col("token")]
    # The window sees n rows.
    return idf.orderBy(*order).limit(n).select(
        "token", F.row_number().over(Window.orderBy(*order)).alias("place")
    )


def wide_table(vectors: DataFrame, terms: DataFrame, width: int, id_col: str, value: str = "weight") -> DataFrame:
    """One column per listed term, ``term_1`` ... ``term_<width>``, for every text with a token.

    ``terms`` is the bounded list ``(token, place)``; the width of the table is fixed by the caller.
    """
    placed = vectors.join(F.broadcast(terms), "token", "left")
    columns = [
        F.coalesce(F.sum(F.when(F.col("place") == i, F.col(value))), F.lit(0.0)).alias(f"term_{i}")
        for i in range(1, width + 1)
    ]
    return placed.groupBy(id_col).agg(*columns)
