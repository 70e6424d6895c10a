"""Best document per query without scoring all: postings in blocks, skipped by upper bounds. The answer is the exact one.

Postings lie in blocks of a few documents; a row is one token in one block, with the largest weight that the token has there. A query's
threshold comes from the documents that its rarest words weigh most in, scored in full. Its words are then taken by what they can add at most:
those whose contributions together stay below the threshold cannot make a document the best one, so only documents with one of the other, essential,
words are met. A block whose essential words and the rest together stay below the threshold is skipped unread; of the other blocks' documents the
ones that the block's own largest weights of the remaining words cannot lift over the threshold are left, and only what is then left is scored in full.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.operators.lookup import fits_broadcast, keyed_lookup
from textloom.sources.scratch import materialize

BLOCK_DOCS = 8
#: Words of a query whose best documents give its threshold.
SEED_WORDS = 16
RANK_DIGITS = 6
#: What rounding may add to a score.
ROUNDED = 1e-6
TERM_ROWS = 100_000
ROWS_PER_PART = 100_000


@dataclass
class Pruned:
    """``best (query_id, doc_id, score)``; ``work``, one row: postings of the queries' words, those scored, rows of blocks read."""

    best: DataFrame
    work: DataFrame


def posting_blocks(postings: DataFrame, n_docs: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Written rows ``(block, token, top, first, n, entries)``: a token's postings in one block of documents.

    ``top`` is the largest weight and ``first`` the lowest document that has it. A block holds about ``block_docs`` documents, by a hash of their id, so a
    frequent token is spread over as many rows as there are blocks.
    """
    blocks = max(1, -(-n_docs // block_docs))
    placed = postings.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    rows = placed.repartition("block").groupBy("block", "token").agg(
        F.max("weight").alias("top"),
        F.max(F.struct("weight", (-F.col("doc_id")).alias("neg"))).alias("_first"),
        F.count(F.lit(1)).alias("n"),
        F.collect_list(F.struct("doc_id", "weight")).alias("entries"),
    )
    return materialize(rows.withColumn("first", -F.col("_first.neg")).drop("_first"), "posting-blocks")


def _by_token(blocks: DataFrame, terms: DataFrame) -> DataFrame:
    """Block rows of the terms' tokens; many terms meet them in a shuffled join where a frequent token is dealt into parts by block."""
    if fits_broadcast(terms, TERM_ROWS):
        return blocks.join(F.broadcast(terms), "token")
    sizes = blocks.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_PART).cast("int").alias("_parts"))
    split = materialize(sizes.filter("_parts > 1").withColumn("_n", F.col("_parts")), "block-parts")
    parts = F.coalesce("_parts", F.lit(1))
    dealt = keyed_lookup(blocks, split, "token", "_n", "left").withColumn("_part", F.pmod(F.xxhash64("block"), parts).cast("int")).drop("_parts", "_n")
    asked = keyed_lookup(terms, split, "token", "_n", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts", "_n")
    return dealt.join(asked.hint("merge"), ["token", "_part"]).drop("_part")


def _weight_of(doc: str) -> Column:
    """Weight of a document in a block row; null if it lacks the token."""
    return F.get(F.filter("entries", lambda e: e["doc_id"] == F.col(doc)), F.lit(0))["weight"]


def best_match_pruned(postings: DataFrame, query_terms: DataFrame, n_docs: int, block_docs: int = BLOCK_DOCS) -> Pruned:
    """The best document of every query that shares a token, by the sum of products of weights; ties to the lowest id.

    ``postings (doc_id, token, weight)`` with weights of zero or more, ``query_terms (query_id, token, weight)``, each token once per document and query.
    """
    blocks = posting_blocks(postings, n_docs, block_docs)
    block_of = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-n_docs // block_docs))))
    impacts = blocks.groupBy("token").agg(
        F.max("top").alias("top"), F.sum("n").alias("df"), F.max(F.struct("top", (-F.col("first")).alias("neg"))).alias("_best")
    )
    impacts = materialize(impacts.select("token", "df", F.col("top").alias("most"), (-F.col("_best.neg")).alias("first")), "impacts")
    terms = keyed_lookup(query_terms.withColumnRenamed("weight", "qw"), impacts, "token", "df")
    terms = materialize(terms.withColumn("adds", F.greatest(F.col("qw") * F.col("most"), F.lit(0.0))), "query-impacts")

    # Thresholds: the documents in which a query's rarest words weigh most, in full.
    rarest = Window.partitionBy("query_id").orderBy("df", "token")
    seeds = terms.withColumn("_n", F.row_number().over(rarest)).filter(F.col("_n") <= SEED_WORDS)
    seeds = materialize(seeds.select("query_id", F.col("first").alias("doc_id")).distinct().withColumn("block", block_of), "seeds")
    near = blocks.join(F.broadcast(seeds) if fits_broadcast(seeds) else seeds.hint("merge"), "block")
    near = near.select("query_id", "doc_id", "token", _weight_of("doc_id").alias("weight")).filter("weight IS NOT NULL")
    scored = near.join(terms.select("query_id", "token", "qw"), ["query_id", "token"]).groupBy("query_id", "doc_id").agg(
        F.sum(F.col("weight") * F.col("qw")).alias("score")
    )
    thresholds = scored.groupBy("query_id").agg((F.round(F.max("score"), RANK_DIGITS) - ROUNDED).alias("least"))

    # The weakest words, as many as together stay below the threshold, are not essential.
    weakest = Window.partitionBy("query_id").orderBy("adds", "token").rowsBetween(Window.unboundedPreceding, 0)
    split = terms.join(thresholds, "query_id").withColumn("weak", F.sum("adds").over(weakest) < F.col("least"))
    rest = F.coalesce(F.sum(F.when(F.col("weak"), F.col("adds"))).over(Window.partitionBy("query_id")), F.lit(0.0))
    split = materialize(split.withColumn("rest", rest).select("query_id", "token", "qw", "df", "weak", "least", "rest"), "query-words")

    # Blocks by their essential words.
    essential = _by_token(blocks, split.filter("NOT weak").select("query_id", "token", "qw", "least", "rest"))
    met = essential.groupBy("query_id", "block").agg(
        F.first("least").alias("least"), F.first("rest").alias("rest"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.greatest(F.col("qw") * F.col("top"), F.lit(0.0))).alias("bound"),
        F.flatten(F.collect_list(F.transform("entries", lambda e: F.struct(e["doc_id"].alias("doc_id"), (e["weight"] * F.col("qw")).alias("adds"))))).alias("entries"),
    )
    met = materialize(
        met.withColumn("open", F.col("bound") + F.col("rest") >= F.col("least")).withColumn("entries", F.when(F.col("open"), F.col("entries"))), "met-blocks"
    )
    entry = met.filter("open").select("query_id", "block", "least", "rest", F.explode("entries").alias("e"))
    partly = entry.groupBy("query_id", "block", F.col("e.doc_id").alias("doc_id")).agg(
        F.sum("e.adds").alias("score"), F.count(F.lit(1)).alias("scored"), F.first("least").alias("least"), F.first("rest").alias("rest")
    )
    partly = materialize(partly, "partly-scored")
    likely = partly.filter(F.col("score") + F.col("rest") >= F.col("least"))

    # What the weak words add: at most the largest weights of the block, and then what they do add.
    weak = split.filter("weak").select("query_id", "token", "qw")
    wanted = likely.select("query_id", "block").distinct().join(weak, "query_id")
    found = wanted.join(blocks.select("block", "token", "top", "entries").hint("merge"), ["block", "token"])
    weakly = found.groupBy("query_id", "block").agg(
        F.sum(F.greatest(F.col("qw") * F.col("top"), F.lit(0.0))).alias("bound"), F.count(F.lit(1)).alias("rows"),
        F.flatten(F.collect_list(F.transform("entries", lambda e: F.struct(e["doc_id"].alias("doc_id"), (e["weight"] * F.col("qw")).alias("adds"))))).alias("entries"),
    )
    weakly = materialize(weakly, "weak-blocks")
    left = likely.join(weakly.drop("rows"), ["query_id", "block"], "left")
    left = left.filter(F.col("score") + F.coalesce("bound", F.lit(0.0)) >= F.col("least"))
    own = F.filter(F.coalesce("entries", F.array().cast("array<struct<doc_id:bigint,adds:double>>")), lambda e: e["doc_id"] == F.col("doc_id"))
    added = F.aggregate(own, F.lit(0.0), lambda total, e: total + e["adds"])
    full = materialize(
        left.select("query_id", "doc_id", F.round(F.col("score") + added, RANK_DIGITS).alias("score"), F.size(own).alias("scored")), "fully-scored"
    )
    best = full.groupBy("query_id").agg(F.max(F.struct("score", (-F.col("doc_id")).alias("neg"))).alias("b"))

    def total(df: DataFrame, value: str | Column) -> Column:
        return F.coalesce(df.agg(F.sum(value)).scalar(), F.lit(0)).cast("long")

    work = split.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("postings")).select(
        "postings",
        (total(partly, "scored") + total(full, "scored") + total(scored.agg(F.count(F.lit(1)).alias("n")), "n")).alias("scored"),
        (total(met, "rows") + total(weakly, "rows")).alias("block_rows"),
    )
    return Pruned(best.select("query_id", (-F.col("b.neg")).alias("doc_id"), F.col("b.score").alias("score")), work)
