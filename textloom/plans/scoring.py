"""Scored labels, top-k and threshold picks, metrics, and MLlib models.

Scores come from the vectors themselves: the logit of a label is the scaled cosine of a vector
with the mean vector of that label; the stored label is the truth.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import labels as lab
from textloom.functions.vectors import cosine, relu, sigmoid
from textloom.operators import labels as ops, metrics, ml
from textloom.operators.estimators import LabelBinarizer, LabelBinarizerModel, TextVectorizer, TextVectorizerModel
from textloom.operators.lookup import fits_broadcast
from textloom.operators.splits import three_way
from textloom.plans.balance import SPLIT
from textloom.plans.cleaning import labelled, pairs
from textloom.plans.registry import LABELLED, PAIRS, query
from textloom.plans.retrieval import CENTROIDS, centroids
from textloom.plans.text import word_sql
from textloom.sources.scratch import materialize, new_path
from textloom.sources.tables import load

SCALE, SHIFT = 10.0, 0.3
SALTS = 256

SCORES = f"""{CENTROIDS},
 scores AS (SELECT c.vec_id, c.label::BIGINT AS label_id, 'label_' || c.label AS label, (e.label = c.label)::INT AS y,
                   round({SCALE} * (cos - {SHIFT}), 6) AS logit,
                   round(1 / (1 + exp(-{SCALE} * (cos - {SHIFT}))), 6) AS p
            FROM cosines c JOIN embeddings e USING (vec_id))"""


def scores(spark, sf):
    """``(vec_id, label_id, label, y, logit, p)`` for every vector and label."""
    vectors = load(spark, sf, "embeddings").select("vec_id", F.col("label").alias("own"), "embedding")
    means = materialize(centroids(spark, sf).select("label", F.col("embedding").alias("mean")), "means")
    if fits_broadcast(means):
        # All means travel as one array; a vector meets each of them where it lies.
        every = means.agg(F.collect_list(F.struct("label", "mean"))).scalar()
        products = vectors.select("vec_id", "own", "embedding", F.explode(every).alias("m")).select("*", "m.*")
    else:
        # Past the bound, means and vectors meet on a part number: vectors are spread over it, means are copied to it.
        part = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("part")
        copies = means.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
        products = vectors.select("*", part).join(copies.hint("merge"), "part")
    cos = cosine("embedding", "mean")
    logit = F.lit(SCALE) * (cos - F.lit(SHIFT))
    return products.select(
        "vec_id",
        F.col("label").cast("bigint").alias("label_id"),
        F.concat(F.lit("label_"), F.col("label")).alias("label"),
        (F.col("own") == F.col("label")).cast("int").alias("y"),
        F.round(logit, 6).alias("logit"),
        F.round(sigmoid(logit), 6).alias("p"),
    )


@query(
    "labels_topk",
    f"""WITH {SCORES} SELECT vec_id, place, label, p FROM (
          SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, label_id) AS place FROM scores) WHERE place <= 3""",
)
def labels_topk(spark, sf):
    return ops.top_k_rows(scores(spark, sf), "vec_id", 3).select("vec_id", "place", "label", "p")


@query(
    "labels_topk_threshold",
    f"""WITH {SCORES}, best AS (
          SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, label_id) AS place FROM scores)
        SELECT vec_id, coalesce(string_agg(label, '|' ORDER BY place) FILTER (place <= 3 AND p >= 0.5), '') AS labels
        FROM best GROUP BY vec_id""",
)
def labels_topk_threshold(spark, sf):
    lists = ops.scored_lists(scores(spark, sf), "vec_id")
    kept = lab.keep_above(lab.top_k("scored", 3), 0.5, inclusive=True)
    return lists.select("vec_id", F.array_join(kept["label"], "|").alias("labels"))


@query(
    "labels_threshold",
    f"""WITH {SCORES} SELECT vec_id, coalesce(string_agg(label, '|' ORDER BY label_id) FILTER (p > 0.5), '') AS above,
          coalesce(string_agg(label, '|' ORDER BY label_id) FILTER (p >= 0.5), '') AS at_least FROM scores GROUP BY vec_id""",
)
def labels_threshold(spark, sf):
    lists = ops.scored_lists(scores(spark, sf), "vec_id")
    return lists.select(
        "vec_id",
        F.array_join(lab.keep_above("scored", 0.5)["label"], "|").alias("above"),
        F.array_join(lab.keep_above("scored", 0.5, inclusive=True)["label"], "|").alias("at_least"),
    )


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("metric_binary_acc", f"WITH {SCORES} SELECT round(avg(((p > 0.5) = (y = 1))::INT), 6) AS binary_accuracy FROM scores")
def metric_binary_acc(spark, sf):
    return rounded(metrics.binary_accuracy(scores(spark, sf)))


@query(
    "metric_cat_acc",
    f"""WITH {SCORES}, best AS (SELECT y, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, label_id) AS rn FROM scores)
        SELECT round(avg(y), 6) AS categorical_accuracy FROM best WHERE rn = 1""",
)
def metric_cat_acc(spark, sf):
    return rounded(metrics.categorical_accuracy(scores(spark, sf), "vec_id"))


CONFUSION = """count(*) FILTER (p > 0.5 AND y = 1) AS tp, count(*) FILTER (p > 0.5 AND y = 0) AS fp,
               count(*) FILTER (p <= 0.5 AND y = 1) AS fn"""
RATIOS = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6)::DOUBLE AS precision,
            round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6)::DOUBLE AS recall,
            round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6)::DOUBLE AS f1"""


@query("metric_micro_f1", f"WITH {SCORES}, c AS (SELECT {CONFUSION} FROM scores) SELECT tp, fp, fn, {RATIOS} FROM c")
def metric_micro_f1(spark, sf):
    return rounded(metrics.micro_scores(scores(spark, sf)))


@query(
    "metric_label_f1",
    f"WITH {SCORES}, c AS (SELECT label, {CONFUSION} FROM scores GROUP BY label) SELECT label, tp, fp, fn, {RATIOS} FROM c",
)
def metric_label_f1(spark, sf):
    return rounded(metrics.label_scores(scores(spark, sf)))


@query(
    "metric_macro_f1",
    f"""WITH {SCORES}, c AS (SELECT label, {CONFUSION} FROM scores GROUP BY label),
        r AS (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS a,
                     CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS b,
                     CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f FROM c)
        SELECT round(avg(a), 6) AS macro_precision, round(avg(b), 6) AS macro_recall, round(avg(f), 6) AS macro_f1 FROM r""",
)
def metric_macro_f1(spark, sf):
    return rounded(metrics.macro_scores(scores(spark, sf)))


@query("metric_label_recall", f"WITH {SCORES} SELECT round(avg((p >= 0.5)::INT), 6) AS label_recall FROM scores WHERE y = 1")
def metric_label_recall(spark, sf):
    return rounded(metrics.true_label_recall(scores(spark, sf)))


@query(
    "metric_bce",
    f"""WITH {SCORES}, c AS (SELECT y, greatest(least(p, 1 - 1e-7), 1e-7) AS q FROM scores)
        SELECT round(-avg(y * ln(q) + (1 - y) * ln(1 - q)), 6) AS bce FROM c""",
)
def metric_bce(spark, sf):
    return rounded(metrics.binary_cross_entropy(scores(spark, sf)))


@query("metric_mse", f"WITH {SCORES} SELECT round(avg((p - y) ** 2), 6) AS mse FROM scores")
def metric_mse(spark, sf):
    return rounded(metrics.mean_squared_error(scores(spark, sf)))


@query(
    "score_activations",
    f"""WITH {SCORES} SELECT vec_id, label_id, p AS sigmoid, greatest(logit, 0) AS relu,
          round(exp(logit - max(logit) OVER w) / sum(exp(logit)) OVER w * exp(max(logit) OVER w), 6) AS softmax
        FROM scores WINDOW w AS (PARTITION BY vec_id)""",
)
def score_activations(spark, sf):
    rows = metrics.softmax(scores(spark, sf), "vec_id", "logit")
    return rows.select(
        "vec_id", "label_id", F.col("p").alias("sigmoid"), relu("logit").alias("relu"),
        F.round("softmax", 6).alias("softmax"),
    )


@query("clf_multilabel")
def clf_multilabel(spark, sf):
    """One model per label trained on the train part; the three best labels of every test document."""
    rows = three_way(labelled(spark, sf).select("doc_id", "text", "terms"), "doc_id")
    train = rows.filter("split = 'train'")
    labels = [r.label for r in ops.label_counts(train, "terms").orderBy("label").collect()]  # one model each
    features, models = ml.fit_multilabel(train, "text", "terms", labels, max_iter=5)
    scored = ml.score_multilabel(features, models, rows.filter("split = 'test'"), "doc_id", "text")
    return ops.top_k_rows(scored, "doc_id", 3).select("doc_id", "place", "label", "p")


@query("clf_multiclass")
def clf_multiclass(spark, sf):
    """Language of a document from its text."""
    rows = three_way(load(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    model = ml.fit_classifier(rows.filter("split = 'train'"), ["text"], "lang")
    return ml.predict(model, rows.filter("split <> 'train'"), "doc_id")


def _pair_classes(spark, sf):
    """FAQ pairs with a class: the length band of the answer."""
    size = F.size(F.split(F.col("answer"), " "))
    band = F.when(size < 20, "short").when(size < 60, "medium").otherwise("long")
    return three_way(pairs(spark, sf).withColumn("band", band), "pair_id")


@query("clf_dual")
def clf_dual(spark, sf):
    """Two text inputs in training; a question-only model scores beside it, without the answer."""
    rows = _pair_classes(spark, sf)
    train, rest = rows.filter("split = 'train'"), rows.filter("split <> 'train'")
    dual = ml.predict(ml.fit_classifier(train, ["question", "answer"], "band"), rest, "pair_id")
    alone = ml.fit_classifier(train, ["question"], "band")
    single = ml.predict(alone, rest.select("pair_id", "question"), "pair_id")
    return dual.join(
        single.select("pair_id", F.col("predicted").alias("predicted_alone"), F.col("p").alias("p_alone")), "pair_id"
    )


@query(
    "clf_reload_match",
    f"""SELECT count(*) AS n, true AS all_close FROM documents""",
)
def clf_reload_match(spark, sf):
    """Predictions of a fitted pipeline and of the same pipeline saved and loaded again."""
    rows = load(spark, sf, "documents").select("doc_id", "text", "lang")
    model = ml.fit_classifier(rows, ["text"], "lang", max_iter=3)
    again = ml.save_and_reload(model, spark)
    return metrics.all_close(ml.predict(model, rows, "doc_id"), ml.predict(again, rows, "doc_id"), ["doc_id"], "p")


def _quality(scored, truth, id_col: str):
    """One row: held-out rows, whether each is answered once, whether predictions beat the most frequent class."""
    joined = truth.join(scored, id_col, "left")
    per_id = joined.groupBy(id_col, "truth").agg(F.count("predicted").alias("answers"), F.max("predicted").alias("predicted"))
    majority = truth.groupBy("truth").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).scalar()
    right = F.sum((F.col("predicted") == F.col("truth")).cast("int"))
    return per_id.agg(
        F.count(F.lit(1)).alias("n"), (F.min("answers") == 1).alias("answered"), F.max("answers").cast("bigint").alias("most_answers"),
        right.alias("right"),
    ).select("n", "answered", "most_answers", (F.col("right") > majority).alias("beats_majority"))


@query(
    "clf_multiclass_quality",
    f"SELECT count(*) AS n, true AS answered, 1::BIGINT AS most_answers, true AS beats_majority FROM documents WHERE {SPLIT} <> 'train'",
)
def clf_multiclass_quality(spark, sf):
    rows = three_way(load(spark, sf, "documents").select("doc_id", F.col("lang").alias("truth")), "doc_id")
    scored = materialize(clf_multiclass(spark, sf).select("doc_id", "predicted"), "predictions")
    return _quality(scored, rows.filter("split <> 'train'").select("doc_id", "truth"), "doc_id")


MARK = "CASE WHEN contains(lower(answer), ' la ') THEN 'la' WHEN contains(lower(answer), 'nicht') THEN 'nicht' ELSE 'none' END"


@query(
    "clf_dual_quality",
    f"""WITH {PAIRS}, held AS (SELECT pair_id, {MARK} AS mark FROM pairs WHERE {SPLIT.replace('doc_id', 'pair_id')} <> 'train')
        SELECT count(*) AS n, true AS answered, 1::BIGINT AS most_answers, true AS beats_majority, true AS alone_answered FROM held""",
)
def clf_dual_quality(spark, sf):
    """Question and answer together tell which words the answer holds; the model that is given the question only answers as well."""
    low = F.lower("answer")
    mark = F.when(low.contains(" la "), "la").when(low.contains("nicht"), "nicht").otherwise("none")
    rows = materialize(three_way(pairs(spark, sf).withColumn("mark", mark), "pair_id").select("pair_id", "question", "answer", "mark", "split"), "marked-pairs")
    train, rest = rows.filter("split = 'train'"), rows.filter("split <> 'train'")
    truth = rest.select("pair_id", F.col("mark").alias("truth"))
    dual = materialize(ml.predict(ml.fit_classifier(train, ["question", "answer"], "mark"), rest, "pair_id"), "dual-predictions")
    alone = ml.predict(ml.fit_classifier(train, ["question"], "mark"), rest.select("pair_id", "question"), "pair_id")
    counts = truth.join(alone, "pair_id", "left").groupBy("pair_id").agg(F.count("predicted").alias("c"))
    return _quality(dual, truth, "pair_id").withColumn("alone_answered", counts.agg(F.min("c") == 1).scalar())


@query(
    "clf_multilabel_quality",
    f"SELECT count(*) AS n, 3::BIGINT AS least_places, true AS languages_found FROM documents WHERE {SPLIT} = 'test'",
)
def clf_multilabel_quality(spark, sf):
    """Three labels for every test document, and its language among them for most."""
    best = materialize(clf_multilabel(spark, sf), "best-labels")
    rows = three_way(load(spark, sf, "documents").select("doc_id", "lang"), "doc_id").filter("split = 'test'")
    joined = rows.join(best, "doc_id", "left").groupBy("doc_id").agg(
        F.count("place").alias("places"), F.max((F.col("label") == F.col("lang")).cast("int")).alias("hit")
    )
    return joined.agg(
        F.count(F.lit(1)).alias("n"), F.min("places").alias("least_places"), (F.avg("hit") > 0.8).alias("languages_found")
    )


@query(
    "estimators_reload",
    f"""WITH {LABELLED}, lv AS (SELECT label, row_number() OVER (ORDER BY label) AS place FROM (SELECT DISTINCT unnest(terms) AS label FROM labelled)),
        tf AS (SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest({word_sql('text')}) AS token FROM documents) GROUP BY ALL),
        df AS (SELECT token, ln(1 + (SELECT count(*) FROM documents) / (1.0::DOUBLE + count(*))) AS idf FROM tf GROUP BY token),
        w AS (SELECT doc_id, sum(tf * idf) AS total, count(*) AS n FROM tf JOIN df USING (token) GROUP BY doc_id)
        SELECT l.doc_id, coalesce(n, 0)::INT AS n_terms, round(coalesce(total, 0), 4) AS total,
               (SELECT string_agg(list_contains(l.terms, label)::INT::VARCHAR, '' ORDER BY place) FROM lv) AS hot
        FROM labelled l LEFT JOIN w USING (doc_id)""",
)
def estimators_reload(spark, sf):
    """The vectorizer and the binarizer fitted, saved, loaded again and applied."""
    docs = materialize(labelled(spark, sf).select("doc_id", "text", "terms"), "labelled")
    vectorizer = TextVectorizer(inputCol="text", outputCol="vector", idCol="doc_id").fit(docs)
    binarizer = LabelBinarizer(inputCol="terms", outputCol="hot", idCol="doc_id").fit(docs)
    paths = [new_path(spark, "model"), new_path(spark, "model")]
    for model, path in zip((vectorizer, binarizer), paths):
        model.write().save(path)
    rows = TextVectorizerModel.load(paths[0]).transform(docs)
    hot = LabelBinarizerModel.load(paths[1]).transform(docs.select("doc_id", "terms")).select("doc_id", "hot")
    vector = F.coalesce("vector", F.array())
    total = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x["weight"])
    return rows.join(hot, "doc_id").select(
        "doc_id", F.size(vector).alias("n_terms"), F.round(total, 4).alias("total"), F.array_join(F.col("hot").cast("array<string>"), "").alias("hot")
    )
