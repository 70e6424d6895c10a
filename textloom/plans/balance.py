"""Splits and class balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import balance, splits
from textloom.plans.cleaning import labelled
from textloom.plans.registry import HASH, HASH_RANGE, LABELLED, query
from textloom.sources.tables import load


def _bucket(key: str) -> str:
    return f"{HASH.format(key)} % 100"


SPLIT = f"""CASE WHEN {_bucket("'42:' || doc_id")} < 80 THEN 'train'
                 WHEN {_bucket("'42:' || doc_id")} < 90 THEN 'val' ELSE 'test' END"""


@query("split_3way", f"SELECT doc_id, {SPLIT} AS split FROM documents")
def split_3way(spark, sf):
    return splits.three_way(load(spark, sf, "documents").select("doc_id"), "doc_id")


@query("split_sizes", f"SELECT split, count(*) AS n FROM (SELECT {SPLIT} AS split FROM documents) GROUP BY split")
def split_sizes(spark, sf):
    parts = splits.three_way(load(spark, sf, "documents").select("doc_id"), "doc_id")
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_stratified",
    f"""WITH {LABELLED}, rows AS (SELECT doc_id, array_to_string(terms, '|') AS stratum FROM labelled),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || doc_id), doc_id) AS rk,
                          count(*) OVER (PARTITION BY stratum) AS n FROM rows)
        SELECT doc_id, stratum, CASE WHEN rk > ceil(n / 10.0) THEN 'train'
                 WHEN {HASH.format("'42-half:' || doc_id")} % 2 = 0 THEN 'val' ELSE 'test' END AS split
        FROM ranked WHERE n > 1""",
)
def split_stratified(spark, sf):
    """Strata are the label lists that occur more than once."""
    from textloom.operators.cleaning import keep_repeated_groups

    rows = labelled(spark, sf).select("doc_id", F.array_join("terms", "|").alias("stratum"))
    return splits.stratified(keep_repeated_groups(rows, "stratum"), "doc_id", "stratum").select(
        "doc_id", "stratum", "split"
    )


@query(
    "split_tail",
    """SELECT doc_id, row_number() OVER (ORDER BY doc_id) > floor((SELECT count(*) FROM documents) * 8 / 10) AS held_out
       FROM documents""",
)
def split_tail(spark, sf):
    return splits.tail_holdout(load(spark, sf, "documents").select("doc_id"), "doc_id")


DRAWN = f"""sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
 ranked AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rk FROM documents),
 slots AS (SELECT lang, n, unnest(range(1, {{wanted}} + 1)) AS draw FROM (
             SELECT lang, n, (SELECT max(n) FROM sizes) AS max_n FROM sizes)),
 drawn AS (SELECT s.lang, s.draw, r.doc_id FROM (
             SELECT *, {HASH.format("'42:' || lang || ':' || draw")} % n + 1 AS rk FROM slots) s
           JOIN ranked r ON r.lang = s.lang AND r.rk = s.rk)"""


@query(
    "oversample",
    f"""WITH {DRAWN.format(wanted='max_n')}
        SELECT lang, draw, doc_id, n_chars FROM drawn JOIN documents USING (doc_id, lang)""",
)
def oversample(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return balance.oversample_all(docs, "doc_id", "lang").select("lang", "draw", "doc_id", "n_chars")


@query(
    "oversample_minority",
    f"""WITH {DRAWN.format(wanted='max_n - n')} SELECT lang, draw, doc_id FROM drawn
        UNION ALL SELECT lang, 0, doc_id FROM documents""",
)
def oversample_minority(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    return balance.oversample_minority(docs, "doc_id", "lang").select("lang", "draw", "doc_id")


@query(
    "undersample",
    """SELECT doc_id, lang FROM (
         SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rk FROM documents)
       WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))""",
)
def undersample(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    return balance.undersample(docs, "doc_id", "lang").select("doc_id", "lang")


SMOTE = f"""e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
 sizes AS (SELECT label, count(*) AS n FROM e GROUP BY label),
 ranked AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS rk FROM e),
 slots AS (SELECT label, n, unnest(range(1, (SELECT max(n) FROM sizes) - n + 1)) AS draw FROM sizes),
 draws AS (SELECT s.label, s.draw, r.vec_id AS base, s.place, s.step FROM (
     SELECT label, draw, {HASH.format("'42-base:' || label || ':' || draw")} % n + 1 AS rk,
            {HASH.format("'42-neighbour:' || label || ':' || draw")} % least(5, n - 1) + 1 AS place,
            {HASH.format("'42-step:' || label || ':' || draw")} / {HASH_RANGE}::DOUBLE AS step FROM slots) s
   JOIN ranked r ON r.label = s.label AND r.rk = s.rk),
 near AS (SELECT a.vec_id AS base, b.vec_id AS neighbour, row_number() OVER (
            PARTITION BY a.vec_id ORDER BY round(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) ** 2)), 9),
            b.vec_id) AS place
          FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE a.vec_id IN (SELECT base FROM draws)),
 made AS (SELECT d.label, d.draw, d.base, n.neighbour, list_transform(list_zip(x.v, y.v),
            lambda p: round(p[1] + d.step * (p[2] - p[1]), 6)) AS vector
          FROM draws d JOIN near n USING (base, place) JOIN e x ON x.vec_id = d.base JOIN e y ON y.vec_id = n.neighbour)"""


@query(
    "smote",
    f"WITH {SMOTE} SELECT label, draw, base, neighbour, p AS pos, vector[p + 1] AS x "
    "FROM (SELECT *, unnest(range(0, len(vector))) AS p FROM made)",
)
def smote(spark, sf):
    made = balance.smote(load(spark, sf, "embeddings"), "vec_id", "label", "embedding")
    cells = made.select("label", "draw", "base", "neighbour", F.posexplode("vector").alias("pos", "x"))
    return cells.select(
        "label", "draw", "base", "neighbour", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x")
    )
