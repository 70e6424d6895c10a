"""Label parsing and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import labels as lab
from textloom.operators import labels as ops
from textloom.operators.splits import three_way
from textloom.plans.cleaning import labelled, pairs, printed_terms
from textloom.plans.registry import HASH, LABELLED, PAIRS, query

def _vocab_sql(order: str, offset: int) -> str:
    return f"""lcounts AS (SELECT label, count(*) AS n FROM (SELECT unnest(terms) AS label FROM labelled) GROUP BY label),
  lvocab AS (SELECT label, n, row_number() OVER (ORDER BY {order}) + {offset} AS label_id FROM lcounts)"""


SORTED = _vocab_sql("label", -1)
FREQUENT = _vocab_sql("n DESC, label", 0)


@query(
    "labels_parse",
    f"""WITH {LABELLED} SELECT doc_id, len(terms)::BIGINT AS n_labels, array_to_string(terms, '|') AS labels FROM labelled""",
)
def labels_parse(spark, sf):
    parsed = printed_terms(spark, sf).withColumn("terms", lab.parse_printed_list("terms"))
    return parsed.select(
        "doc_id", F.size("terms").cast("bigint").alias("n_labels"), F.array_join("terms", "|").alias("labels")
    )


@query(
    "labels_split",
    f"""WITH {LABELLED} SELECT doc_id, CASE WHEN quality IS NULL THEN 0 ELSE len(terms) END::BIGINT AS n_labels,
          CASE WHEN quality IS NULL THEN '' ELSE array_to_string(terms, '|') END AS labels
        FROM labelled WHERE text IS NOT NULL""",
)
def labels_split(spark, sf):
    """Comma lists, missing for unlabelled documents; a missing list becomes an empty one."""
    rows = labelled(spark, sf).withColumn(
        "flavor", F.when(F.col("quality").isNotNull(), F.array_join("terms", ","))
    )
    split = rows.withColumn("flavor", lab.split_labels("flavor")).na.drop(subset=["text", "flavor"])
    return split.select(
        "doc_id", F.size("flavor").cast("bigint").alias("n_labels"), F.array_join("flavor", "|").alias("labels")
    )


@query("label_vocab", f"WITH {LABELLED}, {FREQUENT} SELECT label, n, label_id FROM lvocab UNION ALL SELECT '[UNK]', 0, 0")
def label_vocab(spark, sf):
    return ops.frequent_label_ids(ops.label_counts(labelled(spark, sf), "terms")).select("label", "n", "label_id")


@query(
    "labels_multihot",
    f"""WITH {LABELLED}, {FREQUENT},
        ids AS (SELECT doc_id, list(label_id) AS ids FROM (SELECT doc_id, unnest(terms) AS label FROM labelled)
                JOIN lvocab USING (label) GROUP BY doc_id)
        SELECT doc_id, array_to_string(list_transform(range(0, (SELECT max(label_id) + 1 FROM lvocab)),
               lambda i: list_contains(ids, i)::INT), ' ') AS hot FROM ids""",
)
def labels_multihot(spark, sf):
    rows = labelled(spark, sf)
    vocab = ops.frequent_label_ids(ops.label_counts(rows, "terms"))
    encoded = ops.encode(rows, "doc_id", "terms", vocab, unknown_id=0)
    return ops.hot_rows(rows, encoded, "doc_id", vocab).select(
        "doc_id", F.array_join(F.col("hot").cast("array<string>"), " ").alias("hot")
    )


BINARIZED = f"""{LABELLED}, {SORTED},
 ids AS (SELECT doc_id, list(label_id) AS ids FROM (SELECT doc_id, unnest(terms) AS label FROM labelled)
         JOIN lvocab USING (label) GROUP BY doc_id)"""


def binarized(spark, sf):
    rows = labelled(spark, sf)
    vocab = ops.sorted_label_ids(ops.label_counts(rows, "terms"))
    return ops.hot_rows(rows, ops.encode(rows, "doc_id", "terms", vocab), "doc_id", vocab), vocab


@query(
    "labels_binarize",
    f"""WITH {BINARIZED} SELECT doc_id, array_to_string(list_transform(range(0, (SELECT count(*) FROM lvocab)),
          lambda i: list_contains(ids, i)::INT), ' ') AS hot FROM ids""",
)
def labels_binarize(spark, sf):
    rows, _ = binarized(spark, sf)
    return rows.select("doc_id", F.array_join(F.col("hot").cast("array<string>"), " ").alias("hot"))


@query(
    "labels_inverse",
    f"WITH {LABELLED} SELECT doc_id, array_to_string(list_sort(terms), '|') AS labels FROM labelled",
)
def labels_inverse(spark, sf):
    """Encode, then decode: the labels come back in vocabulary order."""
    rows, vocab = binarized(spark, sf)
    return ops.decode(rows, "doc_id", "hot", vocab).select("doc_id", F.array_join("labels", "|").alias("labels"))


@query(
    "label_index",
    f"""WITH {PAIRS} SELECT pair_id, dense_rank() OVER (ORDER BY answer) - 1 AS label_id, answer AS label FROM pairs""",
)
def label_index(spark, sf):
    """Every distinct answer as a class; ids in sorted order, then back to the class by its id."""
    rows, vocab = ops.class_ids(pairs(spark, sf).select("pair_id", "answer"), "answer")
    inverse = vocab.select("label_id", "label")
    return rows.select("pair_id", "label_id").join(inverse, "label_id").select("pair_id", "label_id", "label")


@query(
    "label_lookup",
    f"""WITH {PAIRS}, train AS (SELECT answer, count(*) AS n FROM pairs
          WHERE {HASH.format("'42:' || pair_id")} % 100 < 80 GROUP BY answer),
        vocab AS (SELECT answer, row_number() OVER (ORDER BY n DESC, answer) AS id FROM train)
        SELECT pair_id, coalesce(id, 0) AS label_id FROM pairs LEFT JOIN vocab USING (answer)""",
)
def label_lookup(spark, sf):
    """Single labels to ids of a vocabulary fitted on the train part; unseen labels fall on id 0."""
    rows = three_way(pairs(spark, sf).select("pair_id", F.array("answer").alias("labels")), "pair_id")
    vocab = ops.frequent_label_ids(ops.label_counts(rows.filter("split = 'train'"), "labels"))
    return ops.encode(rows, "pair_id", "labels", vocab, unknown_id=0)


@query(
    "label_onehot",
    """WITH c AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label_id FROM (SELECT DISTINCT lang FROM documents))
       SELECT doc_id, label_id, array_to_string(list_transform(range(0, (SELECT count(*) FROM c)),
              lambda i: (i = label_id)::INT), ' ') AS hot FROM documents JOIN c USING (lang)""",
)
def label_onehot(spark, sf):
    rows, vocab = ops.class_ids(labelled(spark, sf).select("doc_id", "lang"), "lang")
    width = vocab.agg(F.max("label_id") + 1).scalar()
    hot = lab.multi_hot(F.array("label_id"), F.col("width"))
    return rows.withColumn("width", width).select("doc_id", "label_id", F.array_join(hot.cast("array<string>"), " ").alias("hot"))


@query(
    "labels_map",
    f"""WITH {LABELLED} SELECT doc_id, array_to_string(list_transform(list_sort(terms), lambda t: t || '=1'), ',') AS cats
        FROM labelled""",
)
def labels_map(spark, sf):
    rows = labelled(spark, sf).select("doc_id", lab.label_map("terms").alias("cats"))
    shown = F.transform(
        F.array_sort(F.map_entries("cats")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return rows.select("doc_id", F.array_join(shown, ",").alias("cats"))
