"""Question answering over a bank of texts: BM25 and TF-IDF on postings, dense search on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.functions.text import word_tokens
from textloom.operators.lookup import fits_broadcast, keyed_lookup
from textloom.operators.nearest import nearest_k
from textloom.operators.pruned import Pruned, best_match_pruned
from textloom.operators.vectorize import smooth_idf, unit_tfidf
from textloom.operators.vocabulary import count_statistics, token_rows
from textloom.sources.scratch import materialize

# Okapi parameters.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
RANK_DIGITS = 6
QUERY_TERM_ROWS = 100_000
POSTINGS_PER_PART = 100_000
#: Pairs of a posting and a query that has its word, beyond which documents are skipped by upper bounds.
SCORED_ROWS = 200_000_000


def term_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, token, tf)``; stays partitioned by id."""
    tokens = token_rows(df, id_col, word_tokens(text_col))
    return tokens.groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("tf"))


def best_match(postings: DataFrame, query_terms: DataFrame) -> DataFrame:
    """``(query_id, doc_id, score)``: the best document of every query that shares a token.

    ``postings (doc_id, token, weight)`` are partitioned by document. ``query_terms (query_id, token, weight)`` are broadcast if their
    measured rows and bytes fit: scores are then summed where the document lies, and only the best of each task is shuffled.
    More query terms meet the postings by token in one shuffled join, where the postings of a frequent token are dealt
    into parts by document, so that no task gets all of them.
    """
    if fits_broadcast(query_terms, QUERY_TERM_ROWS):
        matched = postings.join(F.broadcast(query_terms.withColumnRenamed("weight", "_qw")), "token")
    else:
        postings = materialize(postings, "postings")
        sizes = postings.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / POSTINGS_PER_PART).cast("int").alias("_parts"))
        sizes = materialize(sizes, "posting-parts")
        # A word's number of parts is looked up on both sides; it is 1 for nearly all.
        split = sizes.filter("_parts > 1").withColumn("n", F.col("_parts"))
        dealt = keyed_lookup(postings, split, "token", "n", "left").withColumn(
            "_part", F.pmod(F.xxhash64("doc_id"), F.coalesce("_parts", F.lit(1))).cast("int")
        ).drop("_parts", "n")
        asked = keyed_lookup(query_terms, split, "token", "n", "left").withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
        ).drop("_parts", "n")
        matched = dealt.join(asked.withColumnRenamed("weight", "_qw").hint("merge"), ["token", "_part"])
    scored = matched.groupBy("doc_id", "query_id").agg(
        F.round(F.sum(F.col("weight") * F.col("_qw")), RANK_DIGITS).alias("score")
    )
    best = F.max(F.struct("score", (-F.col("doc_id")).alias("neg")))
    return scored.groupBy("query_id").agg(best.alias("b")).select(
        "query_id", (-F.col("b.neg")).alias("doc_id"), F.col("b.score").alias("score")
    )


def _with_default(best: DataFrame, queries: DataFrame, docs: DataFrame) -> DataFrame:
    """A query without any common token scores 0 everywhere and takes the first document."""
    first = docs.agg(F.min("doc_id")).scalar()
    return queries.select("query_id").join(best, "query_id", "left").select(
        "query_id",
        F.coalesce("doc_id", first).alias("doc_id"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def bm25_statistics(counts: DataFrame, n_docs) -> DataFrame:
    """``(token, n, df, idf)`` from counts ``(doc_id, token, tf)``, with negative idf replaced by a share of the mean idf."""
    raw_idf = F.log(n_docs - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    raw = materialize(count_statistics(counts).withColumn("raw", raw_idf), "idf")
    floor = raw.agg(F.avg("raw") * BM25_EPSILON).scalar()
    return raw.select("token", "n", "df", F.when(F.col("raw") < 0, floor).otherwise(F.col("raw")).alias("idf"))


def _best(postings: DataFrame, query_terms: DataFrame, dfs: DataFrame, n_docs: DataFrame, prune: bool | None) -> DataFrame:
    """Best documents, by the plan that the measured number of scored pairs asks for; both give the same."""
    if prune is None:
        prune = query_terms.count() * n_docs.first()[0] > SCORED_ROWS  # no word is in more documents than there are
        if prune:
            pairs = keyed_lookup(query_terms, dfs.select("token", "df"), "token", "df").agg(F.sum("df")).first()[0] or 0
            prune = pairs > SCORED_ROWS
    if not prune:
        return best_match(postings, query_terms)
    return best_match_pruned(postings, query_terms, n_docs.first()[0]).best


def _bm25_weights(docs: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings, query terms and document frequencies of BM25. The texts are read and split once."""
    tokens = token_rows(docs, "doc_id", word_tokens("text"), length="_dl")
    counts = materialize(
        tokens.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("tf"), F.first("_dl").alias("_dl")), "counts"
    )
    n_docs = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    idf = bm25_statistics(counts, docs.agg(F.count(F.lit(1))).scalar())
    mean_length = idf.agg(F.sum("n")).scalar() / n_docs
    damp = BM25_K1 * (1 - BM25_B + BM25_B * F.col("_dl") / mean_length)
    postings = counts.select(
        "doc_id", "token", (F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + damp)).alias("weight")
    )
    asked = term_counts(queries, "query_id", "text")
    query_terms = keyed_lookup(asked, idf.select("token", "df", "idf"), "token", "df").select(
        "query_id", "token", (F.col("tf") * F.col("idf")).alias("weight")
    )
    return postings, materialize(query_terms, "query-terms"), idf


def _tfidf_weights(docs: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings, query terms and document frequencies of TF-IDF; both sides have unit length, so the cosine is the dot product."""
    counts = materialize(term_counts(docs, "doc_id", "text"), "counts")
    idf = smooth_idf(counts, docs.agg(F.count(F.lit(1))))
    postings = unit_tfidf(counts, idf, "doc_id")
    query_terms = unit_tfidf(term_counts(queries, "query_id", "text"), idf, "query_id")
    return postings, materialize(query_terms, "query-terms"), idf


def _retrieve(weights, docs: DataFrame, queries: DataFrame, prune: bool | None) -> DataFrame:
    postings, query_terms, dfs = weights(docs, queries)
    return _with_default(_best(postings, query_terms, dfs, docs.agg(F.count(F.lit(1))), prune), queries, docs)


def retrieve_bm25(docs: DataFrame, queries: DataFrame, prune: bool | None = None) -> DataFrame:
    """Best document per query by Okapi BM25. ``docs (doc_id, text)``, ``queries (query_id, text)``.

    With ``prune`` documents that cannot be the best are skipped by upper bounds; by default if there would be more than ``SCORED_ROWS`` to score.
    """
    return _retrieve(_bm25_weights, docs, queries, prune)


def retrieve_tfidf(docs: DataFrame, queries: DataFrame, prune: bool | None = None) -> DataFrame:
    """Best document per query by cosine of TF-IDF vectors fitted on the documents; ``prune`` as for BM25."""
    return _retrieve(_tfidf_weights, docs, queries, prune)


def pruned_work(docs: DataFrame, queries: DataFrame, scheme: str = "bm25") -> tuple[Pruned, DataFrame]:
    """The pruned search with its measured work, and the full one's best matches."""
    postings, query_terms, _ = (_bm25_weights if scheme == "bm25" else _tfidf_weights)(docs, queries)
    postings = materialize(postings, "postings")
    return best_match_pruned(postings, query_terms, docs.count()), best_match(postings, query_terms)


def retrieve_dense(
    bank: DataFrame, queries: DataFrame, scope: str | None = None, k: int = 1
) -> DataFrame:
    """Best vectors per query by cosine; with ``scope`` only inside the query's category.

    Both sides have ``vec_id`` and ``embedding``.
    """
    return nearest_k(queries, bank, "vec_id", "embedding", k, scope=scope)
