"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.llm import (
    bpe, exact_dedup, fertility, filter_audit, html_text, lang_id, mixing, near_dup, packing, toxicity, url_filter, vector_dup, whitening,
)
from textloom.llm.sample import fold
from textloom.llm.registry import QUERIES, SQL, query  # noqa: F401
from textloom.sources.tables import load

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
"""


@query("op1_exact_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of texts that are equal without white space, the later half of the rows looked up in the history."""
    return exact_dedup.dedup(load(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts by a model of the labels of four folds of five."""
    documents, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = toxicity.train(documents, labels, ~held_out)
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    scored = toxicity.score(rows, model, ["doc_id", "held_out"])
    return scored.select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_offending"
    )


@query("op3_fertility")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, tokenizer measures and verdicts of all texts."""
    pieces, ranks = (bpe.share_file(spark, public_tokenizers.path(name)) for name in (PIECE_MODEL, BYTE_RANKS))
    return fertility.quality(load(spark, sf_dir, "documents").select("doc_id", "text"), pieces, ranks)


MIX_TARGET = mixing.Target(entropy_share=0.95, repetition_limit=4.0)


@query("op4_temperature_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all sources: a row each time a document is taken."""
    return mixing.mix(load(spark, sf_dir, "documents"), MIX_TARGET)


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text, and of what they decode to."""
    ranks = bpe.share_file(spark, public_tokenizers.path(BYTE_RANKS))
    return bpe.digests(load(spark, sf_dir, "documents"), ranks)


RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
#: Labels of hosts whose pages, as far as they are known, make up the list.
LISTED_LABELS = ["ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x"]

OP6_SQL = r"""
WITH r AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) AS query
  FROM r),
c AS (
  SELECT *, regexp_replace(regexp_replace(query, '(^|&)(utm_[a-z]+|ref)=[^&]*', '', 'g'), '^&', '') AS wanted,
         list_has_any(string_split(host, '.'), ['ads-track', 'free-bets', 'cheap-pills', 'spam-farm', 'casino-win', 'adult-x']) AS bad
  FROM p),
u AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '/+$', '')
                 || CASE WHEN wanted <> '' THEN '?' || wanted ELSE '' END END AS canonical
  FROM c),
rules AS (
  SELECT * FROM (VALUES ('allow', 'com', '/', 'com/'), ('block', 'example.com', '/en/', 'example.com/en/'),
                        ('allow', 'www.example.com', '/en/', 'www.example.com/en/'),
                        ('block', 'net', '/es/', 'net/es/'), ('block', 'net', '/fr/', 'net/fr/')) v(decision, h, p, rule)),
fit AS (
  SELECT u.page_id, rule, decision, row_number() OVER (PARTITION BY u.page_id ORDER BY length(rule) DESC) AS n
  FROM u JOIN rules ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, rules.p))
SELECT u.page_id, u.host, u.path, f.rule,
       CASE WHEN f.rule IS NOT NULL THEN f.decision
            WHEN u.canonical IN (SELECT canonical FROM u WHERE bad AND canonical IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM u LEFT JOIN fit f ON f.page_id = u.page_id AND f.n = 1
"""


@query("op6_url_filter", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls; pages on hosts with a listed label make up the list."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    host, _, _ = url_filter.url_parts(F.col("url"))
    labels = F.array(*[F.lit(label) for label in LISTED_LABELS])
    listed = pages.filter(F.arrays_overlap(F.split(host, r"\."), labels)).select("url")
    return url_filter.judge(pages, RULES, listed).select("page_id", "host", "path", "rule", "verdict")


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as rows of 2,048 ids, written and read back."""
    ranks = bpe.share_file(spark, public_tokenizers.path(BYTE_RANKS))
    encoded = bpe.encode(load(spark, sf_dir, "documents"), ranks, ["doc_id"])
    packed = packing.write_packed(packing.pack(encoded, bpe.load_vocabulary(ranks.value).size))
    return packed.select(
        "pack_id", "n_tokens", F.size("doc_ids").alias("n_segments"), "cu_seqlens", "doc_ids", "starts",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"),
    )


@query("op8_html_text")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    texts = html_text.extract(load(spark, sf_dir, "pages"), ["page_id", "url"])
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query("op9_hyperminhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their four-word shingles."""
    return near_dup.near_duplicates(load(spark, sf_dir, "documents"), width=4, similarity=0.8)


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all texts by a model of three folds of four."""
    documents = load(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = lang_id.train(documents, ~held_out)
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    return lang_id.predict(rows, model, ["doc_id", "held_out"])


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened coordinates of every sound vector."""
    white = whitening.whiten(load(spark, sf_dir, "embeddings"), components=16)
    return white.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@query("op12_vector_dup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at a cosine of 0.95, over all vectors whatever their label."""
    return vector_dup.near_vectors(load(spark, sf_dir, "embeddings"), cosine=0.95)


OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
f AS (
  SELECT part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS bad
  FROM w),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f GROUP BY ALL),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
ord AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
place AS (
  SELECT filter_order, s::INT AS step, bits[s] AS own, list_sum(bits[1:s])::BIGINT - bits[s] AS before
  FROM ord, (SELECT unnest(range(1, 6)) AS s)),
counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & own > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(bad) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS toxic_lost
  FROM cells, place GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""


@query("op13_filter_audit", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters for every source."""
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
