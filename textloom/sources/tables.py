"""Readers for the driver tables and the logical text tables built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.operators.ordered import blocked_window

PAIR_SHIFT = 32


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def faq_pairs(conversations: DataFrame) -> DataFrame:
    """Question = a user turn, answer = the assistant turn right after it."""
    following = blocked_window(
        conversations, ["conv_id"], "turn", nexts={"answer": "text", "answer_role": "role"}
    )
    return (
        following.filter((F.col("role") == "user") & (F.col("answer_role") == "assistant"))
        .select(
            (F.shiftleft("conv_id", PAIR_SHIFT) + F.col("turn")).alias("pair_id"),
            "conv_id",
            "turn",
            F.col("text").alias("question"),
            "answer",
        )
    )


def labelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with the multi-label column ``terms``: language, source, and the two flags when set."""
    flags = labels.select("doc_id", "quality", "toxic")
    return documents.join(flags, "doc_id", "left").withColumn(
        "terms",
        F.array_compact(
            F.array(
                F.col("lang"),
                F.col("source"),
                F.when(F.col("quality") == 1, F.lit("quality")),
                F.when(F.col("toxic") == 1, F.lit("toxic")),
            )
        ),
    )
