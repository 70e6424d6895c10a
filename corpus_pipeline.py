"""The corpus pipeline: stages over ``documents``, each written and read again before the next.

``toxicity`` rejects toxic documents, ``exact_dedup`` and ``near_dup`` leave one document of each group, ``mixing`` repeats the
documents of small sources up to the target weights (none is left out), ``byte_bpe`` encodes what is there and decodes it again.
All but the last return the columns of ``documents``.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows, empty tables and further columns as its operator's
docstring states: a null or empty text is not toxic, all of them are one group of exact copies, near to nothing, taken once by the mix and encoded to no ids. A later stage's result depends on trained weights, so there is no SQL form.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.llm import bpe, exact_dedup, mixing, near_dup, toxicity
from textloom.llm.queries import BYTE_RANKS
from textloom.llm.registry import query, ship_code
from textloom.llm.sample import fold
from textloom.sources.scratch import materialize
from textloom.sources.tables import load

MIX_TARGET = mixing.Target(repetition_limit=2.0)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; the model learns from the labels of four folds of five."""
    ship_code(spark)
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), F.coalesce(fold("doc_id", 5) != 0, F.lit(True)))
    return toxicity.clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    ship_code(spark)
    return exact_dedup.keep_winners(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    ship_code(spark)
    return near_dup.keep_first(docs, width=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least; those of small sources again, up to twice a source's tokens."""
    ship_code(spark)
    return mixing.mixed_documents(docs, MIX_TARGET)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, as written and as digests, and the digest of what they decode to."""
    ship_code(spark)
    ranks = bpe.share_file(spark, public_tokenizers.path(BYTE_RANKS))
    return bpe.digests(docs, ranks, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_bytes),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


query("pipeline", ORACLE_SQL)(run)
