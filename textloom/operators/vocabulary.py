"""Token rows, vocabularies, and the lookups between tokens and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.functions.text import with_bigrams
from textloom.operators.lookup import keyed_lookup
from textloom.operators.ranking import global_rank
from textloom.sources.scratch import materialize

OOV = "<UNK>"
#: Bytes of text in one partition of token rows: what a task keeps per token is many times that.
PART_BYTES = 8 * 1024 * 1024


def text_parts(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Partitions that hold ``part_bytes`` of the text of ``df`` each, and no fewer than tasks run side by side."""
    columns = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in df.dtypes if kind == "string"]
    size = df.agg(F.sum(sum(columns, F.lit(0).cast("bigint")))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // part_bytes))


def token_rows(
    df: DataFrame,
    id_col: str,
    tokens: Column,
    keep: tuple[str, ...] = (),
    bigrams: bool = False,
    spread: bool = True,
    length: str | None = None,
) -> DataFrame:
    """One row per token occurrence: ``(id, pos, token)``, pos from 0; ``length`` names a column for
    the number of tokens of the text.

    With ``spread`` the texts are partitioned by id first. That moves each text once, and every
    later step that groups by the id finds its rows in place and needs no shuffle of the much larger
    token table. The partitions are counted by the volume of the texts (``text_parts``, one pass over ``df``): the adaptive plan
    would size them by the compressed texts, of which the tokens are a great multiple. Steps that only group by token need no spreading.
    """
    if spread:
        df = df.repartition(text_parts(df), F.col(id_col))
    split = df.select(id_col, *keep, tokens.alias("_tokens"))
    if bigrams:
        split = split.select(id_col, *keep, with_bigrams("_tokens").alias("_tokens"))
    # A plain posexplode would add a non-empty check that tokenizes a second time before the shuffle.
    sized = [F.size("_tokens").alias(length)] if length else []
    rows = split.select(id_col, *keep, *sized, F.posexplode_outer("_tokens").alias("pos", "token"))
    return rows.filter(F.col("pos").isNotNull())


def token_counts(tokens: DataFrame) -> DataFrame:
    """``(token, n)``; counted map-side first."""
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def count_statistics(per_text: DataFrame) -> DataFrame:
    """``(token, n, df)`` from written counts ``(id, token, tf)``."""
    return per_text.groupBy("token").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))


def build_vocabulary(
    counts: DataFrame,
    first_id: int = 1,
    max_tokens: int | None = None,
    oov_token: str | None = None,
) -> DataFrame:
    """``(token, n, token_id)``: most frequent first, ties by token; ``df`` is kept when given.

    ``max_tokens`` bounds the ids, reserved ones included, as ``id < max_tokens``. With
    ``oov_token`` that token takes ``first_id`` and the others follow it.
    """
    start = first_id + (1 if oov_token else 0)
    order = [F.desc("n"), F.col("token")]
    if max_tokens is not None:
        capped = counts.orderBy(*order).limit(max(max_tokens - start, 0))
        # At most max_tokens rows reach this window.
        vocab = capped.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    else:
        vocab = global_rank(counts, order)
    extra = [c for c in counts.columns if c not in ("token", "n")]
    vocab = vocab.select("token", "n", *extra, (F.col("rank") + start - 1).alias("token_id"))
    if oov_token:
        oov = counts.sparkSession.range(1).select(
            F.lit(oov_token).alias("token"),
            F.lit(0).cast("bigint").alias("n"),
            F.lit(first_id).cast("bigint").alias("token_id"),
        )
        vocab = oov.unionByName(vocab, allowMissingColumns=True)
    return materialize(vocab, "vocab")


def joint_tokens(df: DataFrame, id_col: str, columns: list[str], tokenizer) -> DataFrame:
    """Token rows of several text columns together, to count one shared vocabulary."""
    stacked = df.select(id_col, F.explode(F.array(*columns)).alias("_text"))
    return token_rows(stacked, id_col, tokenizer("_text"), spread=False)


def tokens_to_ids(
    tokens: DataFrame, vocab: DataFrame, oov_id: int | None = None, num_words: int | None = None
) -> DataFrame:
    """Replace ``token`` by ``token_id``.

    Unknown tokens are dropped, or become ``oov_id`` when one is given; ids from ``num_words``
    upwards count as unknown.
    """
    known = vocab if num_words is None else vocab.filter(F.col("token_id") < num_words)
    known = known.select("token", "token_id", "n")
    how = "inner" if oov_id is None else "left"
    joined = keyed_lookup(tokens, known, "token", "n", how).drop("n", "token")
    if oov_id is not None:
        joined = joined.withColumn("token_id", F.coalesce("token_id", F.lit(oov_id).cast("bigint")))
    return joined


def sequences(ids: DataFrame, texts: DataFrame, id_col: str) -> DataFrame:
    """Ordered id array per text; a text without known tokens gets an empty array."""
    grouped = ids.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("_p")
    )
    return texts.select(id_col).join(grouped, id_col, "left").select(
        id_col,
        F.coalesce(F.col("_p.token_id"), F.array().cast("array<bigint>")).alias("ids"),
    )


def decode(ids: DataFrame, vocab: DataFrame, id_col: str, stop_token: str | None = None) -> DataFrame:
    """Id arrays back to text; padding and unknown ids are skipped, decoding ends before ``stop_token``."""
    cells = ids.select(id_col, "ids").repartition(F.col(id_col)).select(
        id_col, F.posexplode("ids").alias("pos", "token_id")
    )
    known = vocab.select("token_id", "token", "n")
    words = keyed_lookup(cells, known, "token_id", "n").drop("n")
    grouped = words.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("_p")
    )
    found = F.col("_p.token")
    if stop_token is not None:
        at = F.array_position(found, stop_token).cast("int")
        found = F.when(at > 0, F.slice(found, F.lit(1), F.greatest(at - 1, F.lit(0)))).otherwise(found)
    return ids.select(id_col).join(grouped, id_col, "left").select(
        id_col, F.coalesce(F.array_join(found, " "), F.lit("")).alias("text")
    )


def bounds_report(sequences_df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Largest id in use against the vocabulary size (padding included)."""
    size = vocab.agg((F.max("token_id") + 1).alias("vocab_size"))
    top = sequences_df.agg(F.max(F.array_max("ids")).alias("max_id"))
    # Two single-row aggregates.
    return top.select("max_id", size.scalar().alias("vocab_size")).withColumn(
        "in_range", F.col("max_id") < F.col("vocab_size")
    )
