"""Answers to questions: sparse and dense retrieval."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from textloom.functions.encoders import GramEncoder, share_encoder, text_encoder
from textloom.functions.text import word_tokens
from textloom.functions.vectors import cosine
from textloom.operators import retrieval
from textloom.operators.inverted import retrieve_inverted
from textloom.operators.lookup import keyed_lookup
from textloom.operators.ml import mean_vectors, retrieve_lsh, word_vectors
from textloom.operators.nearest import nearest_k
from textloom.plans.cleaning import pairs
from textloom.plans.registry import HASH, PAIRS, query
from textloom.plans.text import word_sql
from textloom.sources.scratch import materialize
from textloom.sources.tables import load


def _asked(spark, sf):
    return load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _answer_all(spark, sf, retrieve):
    """Write the FAQ bank once, find the best question for every query, and attach its answer."""
    bank = materialize(pairs(spark, sf).select("pair_id", "question", "answer"), "faq-bank")
    best = retrieve(
        bank.select(F.col("pair_id").alias("doc_id"), F.col("question").alias("text")), _asked(spark, sf)
    )
    return best.withColumnRenamed("doc_id", "pair_id").join(bank.select("pair_id", "answer"), "pair_id").select(
        "query_id", "pair_id", "score", "answer"
    )


SPARSE = f"""{PAIRS},
 dt AS (SELECT pair_id, token, count(*) AS tf FROM (SELECT pair_id, unnest({word_sql('question')}) AS token FROM pairs) GROUP BY ALL),
 qt AS (SELECT item_id, token, count(*) AS qf FROM (SELECT item_id, unnest({word_sql('text')}) AS token FROM benchmark) GROUP BY ALL),
 stat AS (SELECT count(*)::DOUBLE AS n, avg(len({word_sql('question')})) AS avgdl FROM pairs),
 df AS (SELECT token, count(*)::DOUBLE AS df FROM dt GROUP BY token)"""

PICK = """best AS (SELECT item_id, pair_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, pair_id) AS rn FROM scored),
 full_best AS (SELECT b.item_id AS query_id, coalesce(s.pair_id, (SELECT min(pair_id) FROM pairs)) AS pair_id,
                      coalesce(s.score, 0.0::DOUBLE) AS score
               FROM benchmark b LEFT JOIN (SELECT * FROM best WHERE rn = 1) s USING (item_id))
 SELECT query_id, pair_id, score, answer FROM full_best JOIN pairs USING (pair_id)"""


BM25_SQL = f"""WITH {SPARSE},
 raw AS (SELECT token, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM df, stat),
 idf AS (SELECT token, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM raw) ELSE idf END AS idf FROM raw),
 dl AS (SELECT pair_id, len({word_sql('question')}) AS dl FROM pairs),
 scored AS (SELECT item_id, pair_id, round(sum(qf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
            FROM qt JOIN dt USING (token) JOIN idf USING (token) JOIN dl USING (pair_id), stat GROUP BY ALL),
 {PICK}"""


@query("retrieve_bm25", BM25_SQL)
def retrieve_bm25(spark, sf):
    return _answer_all(spark, sf, retrieval.retrieve_bm25)


TFIDF_SQL = f"""WITH {SPARSE},
 idf AS (SELECT token, ln((1 + n) / (1 + df)) + 1 AS idf FROM df, stat),
 dw AS (SELECT pair_id, token, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY pair_id)) AS w FROM dt JOIN idf USING (token)),
 qw AS (SELECT item_id, token, qf * idf / sqrt(sum((qf * idf) ** 2) OVER (PARTITION BY item_id)) AS w FROM qt JOIN idf USING (token)),
 scored AS (SELECT item_id, pair_id, round(sum(qw.w * dw.w), 6) AS score FROM qw JOIN dw USING (token) GROUP BY ALL),
 {PICK}"""


@query("retrieve_tfidf", TFIDF_SQL)
def retrieve_tfidf(spark, sf):
    return _answer_all(spark, sf, retrieval.retrieve_tfidf)


@query("retrieve_bm25_pruned", BM25_SQL)
def retrieve_bm25_pruned(spark, sf):
    """As ``retrieve_bm25``, with blocks of documents skipped by upper bounds."""
    return _answer_all(spark, sf, lambda docs, queries: retrieval.retrieve_bm25(docs, queries, prune=True))


@query("retrieve_tfidf_pruned", TFIDF_SQL)
def retrieve_tfidf_pruned(spark, sf):
    """As ``retrieve_tfidf``, with blocks of documents skipped by upper bounds."""
    return _answer_all(spark, sf, lambda docs, queries: retrieval.retrieve_tfidf(docs, queries, prune=True))


@query(
    "retrieve_pruned_share",
    "SELECT scheme, true AS same, true AS skipped FROM (VALUES ('bm25'), ('tfidf')) v(scheme)",
)
def retrieve_pruned_share(spark, sf):
    """Pruned against full search: the same best matches and scores, with at most 0.7 of the postings of the queries' words scored."""
    bank = pairs(spark, sf).select(F.col("pair_id").alias("doc_id"), F.col("question").alias("text"))
    bank, asked = materialize(bank, "pruned-bank"), _asked(spark, sf)

    def measured(scheme: str) -> DataFrame:
        pruned, full = retrieval.pruned_work(bank, asked, scheme)
        wanted = full.select("query_id", F.col("doc_id").alias("wanted"), F.col("score").alias("wanted_score"))
        both = wanted.join(pruned.best, "query_id", "full").agg(
            F.min(F.coalesce((F.col("doc_id") == F.col("wanted")) & (F.abs(F.col("score") - F.col("wanted_score")) < 2e-6), F.lit(False))).alias("same")
        )
        return pruned.work.select(
            F.lit(scheme).alias("scheme"), both.scalar().alias("same"), (F.col("scored") <= 0.7 * F.col("postings")).alias("skipped")
        )

    return measured("bm25").unionByName(measured("tfidf"))


CENTROIDS = """cells AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
 cent AS (SELECT label, pos, avg(x) AS c FROM cells GROUP BY ALL),
 cnorm AS (SELECT label, sqrt(sum(c * c)) AS cn FROM cent GROUP BY label),
 vnorm AS (SELECT vec_id, sqrt(sum(x * x)) AS vn FROM cells GROUP BY vec_id),
 cosines AS (SELECT vec_id, cent.label, sum(x * c) / (any_value(vn) * any_value(cn)) AS cos
             FROM cells JOIN cent USING (pos) JOIN vnorm USING (vec_id) JOIN cnorm ON cnorm.label = cent.label
             GROUP BY vec_id, cent.label)"""


def centroids(spark, sf):
    """The mean vector of every label, used as one query per label."""
    means = mean_vectors(load(spark, sf, "embeddings"), "label", "embedding")
    return means.select(F.col("label").cast("bigint").alias("vec_id"), "label", "embedding")


@query("embed_mean", f"WITH {CENTROIDS} SELECT label, pos - 1 AS pos, round(c, 6) AS x FROM cent")
def embed_mean(spark, sf):
    means = centroids(spark, sf).select("label", F.posexplode("embedding").alias("pos", "x"))
    return means.select("label", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


@query(
    "retrieve_dense",
    f"""WITH {CENTROIDS}, ranked AS (SELECT label::BIGINT AS query_id, vec_id AS match_id, cos,
          row_number() OVER (PARTITION BY label ORDER BY round(cos, 9) DESC, vec_id) AS place FROM cosines)
        SELECT query_id, place, match_id, round(cos, 9) AS score FROM ranked WHERE place <= 3""",
)
def retrieve_dense(spark, sf):
    """The three bank vectors closest to every label mean, over the whole bank."""
    return retrieval.retrieve_dense(load(spark, sf, "embeddings"), centroids(spark, sf), k=3)


@query(
    "retrieve_category",
    f"""WITH {CENTROIDS}, ranked AS (SELECT c.label::BIGINT AS query_id, c.vec_id AS match_id, cos,
          row_number() OVER (PARTITION BY c.label ORDER BY round(cos, 9) DESC, c.vec_id) AS place
          FROM cosines c JOIN embeddings e ON e.vec_id = c.vec_id AND e.label = c.label)
        SELECT query_id, match_id, round(cos, 9) AS score,
               'user''s question: ' || query_id || ' description: ' || match_id AS prompt FROM ranked WHERE place = 1""",
)
def retrieve_category(spark, sf):
    """The most similar vector inside the category of the question, and the prompt text made of both."""
    best = retrieval.retrieve_dense(load(spark, sf, "embeddings"), centroids(spark, sf), scope="label")
    return best.select(
        "query_id",
        "match_id",
        "score",
        F.format_string("user's question: %s description: %s", "query_id", "match_id").alias("prompt"),
    )


@query(
    "retrieve_category_prompt",
    f"""WITH {CENTROIDS}, ranked AS (SELECT c.label::BIGINT AS query_id, c.vec_id AS match_id,
          row_number() OVER (PARTITION BY c.label ORDER BY round(cos, 9) DESC, c.vec_id) AS place
          FROM cosines c JOIN embeddings e ON e.vec_id = c.vec_id AND e.label = c.label
          JOIN documents d ON d.doc_id = c.vec_id)
        SELECT query_id, match_id, 'user''s question: ' || b.text || ' description: ' || d.text AS prompt
        FROM ranked JOIN documents d ON d.doc_id = match_id JOIN benchmark b ON b.item_id = query_id WHERE place = 1""",
)
def retrieve_category_prompt(spark, sf):
    """The question's text and the description of its best match inside the category, for vectors that stand for a document."""
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("match_id"), F.col("text").alias("description"))
    vectors = load(spark, sf, "embeddings")
    described = vectors.join(docs.select(F.col("match_id").alias("vec_id")), "vec_id", "left_semi")
    best = retrieval.retrieve_dense(described, centroids(spark, sf), scope="label")
    asked = load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    prompt = F.format_string("user's question: %s description: %s", "question", "description").alias("prompt")
    return best.join(docs, "match_id").join(asked, "query_id").select("query_id", "match_id", prompt)


@query(
    "cosine_pairs",
    f"""WITH {CENTROIDS} SELECT vec_id, label, round(cos, 6) AS cosine FROM cosines JOIN embeddings USING (vec_id, label)""",
)
def cosine_pairs(spark, sf):
    """Cosine of every vector with the mean of its own label."""
    means = centroids(spark, sf).select("label", F.col("embedding").alias("mean"))
    # Few labels may own most vectors: the means are broadcast if they fit, else looked up with a head of heavy labels.
    sizes = load(spark, sf, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    table = materialize(means.join(sizes, "label"), "label-means")
    rows = keyed_lookup(load(spark, sf, "embeddings"), table, "label", "n")
    return rows.select("vec_id", "label", F.round(cosine("embedding", "mean"), 6).alias("cosine"))


@query("retrieve_encoded")
def retrieve_encoded(spark, sf):
    """Dense retrieval over encoded texts: Word2Vec means of the FAQ questions and the queries."""
    bank = materialize(
        pairs(spark, sf).select(F.col("pair_id").alias("vec_id"), "answer", word_tokens("question").alias("tokens")),
        "faq-tokens",
    )
    model = word_vectors(bank, "tokens")

    def encode(df):
        return model.transform(df).withColumn("embedding", vector_to_array("embedding"))

    asked = load(spark, sf, "benchmark").select(F.col("item_id").alias("vec_id"), word_tokens("text").alias("tokens"))
    best = retrieval.retrieve_dense(encode(bank), encode(asked))
    answers = bank.select(F.col("vec_id").alias("match_id"), "answer")
    return best.join(answers, "match_id").select("query_id", "match_id", "score", "answer")


@query("retrieve_lsh")
def retrieve_lsh_query(spark, sf):
    return retrieve_lsh(load(spark, sf, "embeddings"), centroids(spark, sf))


def lsh_quality(answers: DataFrame, total: int) -> DataFrame:
    """One row over ``(query_id, wanted, match_id, compared, exact)``: number of queries, recall, mean share of the ``total`` bank vectors compared,
    share of the queries found by hash. A query answered by the exact search, or not at all, counts as the whole bank compared."""
    by_hash = F.coalesce(~F.col("exact"), F.lit(False))
    return answers.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.coalesce(F.col("match_id") == F.col("wanted"), F.lit(False)).cast("int")).alias("recall"),
        F.avg(F.when(by_hash, F.col("compared")).otherwise(total) / F.lit(float(total))).alias("compared"),
        F.avg(by_hash.cast("int")).alias("by_hash"),
    )


@query(
    "retrieve_lsh_recall",
    "SELECT count(*) AS n, true AS recalled, true AS pruned, true AS found_by_hash FROM embeddings WHERE vec_id % 10 = 0",
)
def retrieve_lsh_recall(spark, sf):
    """Approximate against exact, for every tenth vector without itself and for the label means: each at least 0.9 of the best matches,
    with under a fifth of the vectors compared (all of them by a query that falls back) and 0.9 of the queries found by hash."""
    bank = load(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    total = bank.filter("embedding IS NOT NULL").count()

    def against_exact(kind: str, asked: DataFrame, exclude_self: bool) -> DataFrame:
        asked = materialize(asked.select("vec_id", "embedding"), "lsh-asked")
        near = retrieve_lsh(bank, asked, exclude_self=exclude_self)
        exact = nearest_k(asked, bank, "vec_id", "embedding", exclude_self=exclude_self)
        wanted = exact.select("query_id", F.col("match_id").alias("wanted"))
        # A query that has a best match and no answer is not recalled, and not found.
        return lsh_quality(wanted.join(near, "query_id", "left"), total).withColumn("kind", F.lit(kind))

    rows = against_exact("rows", bank.filter("vec_id % 10 = 0"), True)
    both = materialize(rows.unionByName(against_exact("means", centroids(spark, sf), False)), "lsh-quality")
    return both.agg(
        F.max(F.when(F.col("kind") == "rows", F.col("n"))).alias("n"), F.min((F.col("recall") >= 0.9)).alias("recalled"),
        F.min(F.col("compared") < 0.2).alias("pruned"), F.min(F.col("by_hash") >= 0.9).alias("found_by_hash"),
    )


@query("retrieve_inverted")
def retrieve_inverted_query(spark, sf):
    """The best match of every label mean, from the lists of its nearest cells."""
    return retrieve_inverted(load(spark, sf, "embeddings"), centroids(spark, sf))


@query(
    "retrieve_inverted_recall",
    "SELECT kind, n, true AS recalled, true AS pruned FROM (SELECT 'rows' AS kind, count(*) AS n FROM embeddings WHERE vec_id % 100 = 0 "
    "UNION ALL SELECT 'means', count(DISTINCT label) FROM embeddings)",
)
def retrieve_inverted_recall(spark, sf):
    """Inverted files against the exact search, for every hundredth vector without itself and for the label means: at least 0.9 of the best matches
    found, with at most 0.15 of the bank met under any list that was read."""
    bank = load(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    total = bank.filter("embedding IS NOT NULL").count()

    def against_exact(kind: str, asked: DataFrame, exclude_self: bool) -> DataFrame:
        asked = materialize(asked.select("vec_id", "embedding"), "inverted-asked")
        near = retrieve_inverted(bank, asked, exclude_self=exclude_self).withColumnRenamed("match_id", "found")
        exact = nearest_k(asked, bank, "vec_id", "embedding", exclude_self=exclude_self)
        # A query without an answer is not recalled and counts as the whole bank met.
        both = exact.select("query_id", "match_id").join(near, "query_id", "left")
        return both.agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"),
            (F.avg((F.coalesce(F.col("found") == F.col("match_id"), F.lit(False))).cast("int")) >= 0.9).alias("recalled"),
            (F.avg(F.coalesce("met", F.lit(total)) / F.lit(float(total))) <= 0.15).alias("pruned"),
        )

    rows = against_exact("rows", bank.filter("vec_id % 100 = 0"), True)
    return rows.unionByName(against_exact("means", centroids(spark, sf), False))


@query(
    "encode_grams",
    f"""WITH grams AS (SELECT p_partkey, lower(p_name) AS t, unnest(range(1, length(p_name) - 1)) AS i FROM part)
        SELECT p_partkey, {HASH.format("'42:' || substr(t, i, 3)")} % 64 AS cell, count(*) AS n FROM grams GROUP BY ALL""",
)
def encode_grams(spark, sf):
    """Names as vectors of hashed three-letter runs, by an encoder that is shipped to the tasks; cells that are not zero."""
    encode = text_encoder(share_encoder(spark, GramEncoder()))
    vectors = load(spark, sf, "part").select("p_partkey", encode("p_name").alias("v"))
    cells = vectors.select("p_partkey", F.posexplode("v").alias("cell", "n")).filter("n > 0")
    return cells.select("p_partkey", F.col("cell").cast("bigint").alias("cell"), F.col("n").cast("bigint").alias("n"))
