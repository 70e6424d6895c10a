"""MLlib pipelines that take raw text in, so that a saved model needs no separate preprocessing."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    IDFModel,
    IndexToString,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
    Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.text import STRIP_PUNCTUATION
from textloom.operators.nearest import nearest_k
from textloom.operators.planes import Planes, search_by_planes
from textloom.operators.skipgram import sharded_word_vectors, word_counts
from textloom.sources.scratch import materialize, new_path

#: Width of the hashed term counts; no term is left out, terms that share a cell add up.
HASHED_TERMS = 1 << 16
#: Words that MLlib's Word2Vec may hold on the driver, with their codes and two vectors each.
DRIVER_WORDS = 100_000


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_stages(text_col: str, features: str, width: int = HASHED_TERMS, tf_idf: bool = True) -> list:
    """Lower, strip punctuation, split, count and weigh: all as JVM stages of a pipeline."""
    tokens = f"_{features}_tokens"
    counts = f"_{features}_counts" if tf_idf else features
    bare = f"translate(lower(coalesce({text_col}, '')), {_quoted(STRIP_PUNCTUATION)}, '')"
    tokenize = SQLTransformer(
        statement=f"SELECT *, filter(split({bare}, '\\\\s+'), t -> t <> '') AS {tokens} FROM __THIS__"
    )
    stages: list = [tokenize, HashingTF(inputCol=tokens, outputCol=counts, numFeatures=width)]
    if tf_idf:
        stages.append(IDF(inputCol=counts, outputCol=features))
    return stages


def fit_text_stages(stages: list, df: DataFrame, keep: list[str]) -> tuple[list, DataFrame]:
    """The stages of ``text_stages``, of any number of texts, fitted; and a written table of ``keep`` and their features.

    Texts are split once, for written counts, from which the weights are learnt and the features made.
    """
    counted, out = df, []
    for stage in stages:
        if isinstance(stage, IDF):
            out.append(stage.getOutputCol())
        else:
            counted = stage.transform(counted)
    counts = [stage.getInputCol() for stage in stages if isinstance(stage, IDF)]
    rows = materialize(counted.select(*keep, *counts), "term-counts")
    fitted = [stage.fit(rows) if isinstance(stage, IDF) else stage for stage in stages]
    for stage in fitted:
        if isinstance(stage, IDFModel):
            rows = stage.transform(rows)
    return fitted, materialize(rows.select(*keep, *out), "features")


def fit_multilabel(
    train: DataFrame, text_col: str, labels_col: str, labels: list[str], width: int = HASHED_TERMS, max_iter: int = 10
) -> tuple[PipelineModel, dict[str, LogisticRegression]]:
    """One logistic regression per label over one written feature table.

    Every label is a pass over the features. Columns are named by the label's place, so a label may be any text.
    The models come back saved and loaded, see ``without_summary``.
    """
    stages, table = fit_text_stages(text_stages(text_col, "features", width), train, [labels_col])
    features = PipelineModel(stages)
    models = {}
    for i, label in enumerate(labels):
        marked = table.withColumn("_y", F.array_contains(labels_col, label).cast("double"))
        models[label] = LogisticRegression(
            featuresCol="features", labelCol="_y", maxIter=max_iter, regParam=0.01,
            probabilityCol=f"_p_{i}", rawPredictionCol=f"_r_{i}", predictionCol=f"_c_{i}",
        ).fit(marked)
    if models:
        models = dict(zip(models, without_summary(PipelineModel(list(models.values())), train.sparkSession).stages))
    return features, models


def without_summary(model: PipelineModel, spark) -> PipelineModel:
    """The same stages without the summaries of their training.

    The summary of a model of two classes keeps the session, which goes to the executors with every prediction and cannot be
    sent once anything has been observed in it.
    """
    return save_and_reload(model, spark)


def _chance(column: str) -> Column:
    """Probability of class 1; 0 if the training rows had no such class."""
    return F.coalesce(F.try_element_at(vector_to_array(column), F.lit(2)), F.lit(0.0))


def score_multilabel(features: PipelineModel, models: dict, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Long table ``(id, label_id, label, p)`` of the probability of every label."""
    scored = features.transform(df.select(id_col, text_col))
    for model in models.values():
        scored = model.transform(scored)
    cells = [
        F.struct(
            F.lit(i).cast("bigint").alias("label_id"),
            F.lit(label).alias("label"),
            _chance(f"_p_{i}").alias("p"),
        )
        for i, label in enumerate(models)
    ]
    return scored.select(id_col, F.explode(F.array(*cells)).alias("c")).select(id_col, "c.*")


def classifier(
    text_cols: list[str], label_col: str, width: int = HASHED_TERMS, max_iter: int = 10
) -> Pipeline:
    """Multi-class pipeline from one or more raw text columns to ``predicted`` class names."""
    stages: list = [
        StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep")
    ]
    for i, text_col in enumerate(text_cols):
        stages += text_stages(text_col, f"_f{i}", width)
    stages.append(VectorAssembler(inputCols=[f"_f{i}" for i in range(len(text_cols))], outputCol="features"))
    stages.append(
        LogisticRegression(
            featuresCol="features", labelCol="_label", family="multinomial", maxIter=max_iter, regParam=0.01,
            probabilityCol="probability", predictionCol="_prediction",
        )
    )
    return Pipeline(stages=stages)


def fit_classifier(
    train: DataFrame, text_cols: list[str], label_col: str, width: int = HASHED_TERMS, max_iter: int = 10
) -> PipelineModel:
    """``classifier`` fitted stage by stage, so that the texts are split once."""
    indexer, *texts, assembler, regression = classifier(text_cols, label_col, width, max_iter).getStages()
    indexer = indexer.fit(train)
    texts, rows = fit_text_stages(texts, indexer.transform(train), ["_label"])
    model = PipelineModel([indexer, *texts, assembler, regression.fit(assembler.transform(rows))])
    return without_summary(model, train.sparkSession) if model.stages[-1].numClasses <= 2 else model


def predict(model: PipelineModel, df: DataFrame, id_col: str) -> DataFrame:
    """``(id, predicted, p)``: most probable class name and its probability."""
    labels = model.stages[0].labels
    names = IndexToString(inputCol="_prediction", outputCol="predicted", labels=[*labels, "unknown"])
    best = F.array_max(vector_to_array("probability"))
    return names.transform(model.transform(df)).select(id_col, "predicted", best.alias("p"))


def save_and_reload(model: PipelineModel, spark) -> PipelineModel:
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def word_vectors(
    df: DataFrame, tokens_col: str, size: int = 16, min_count: int = 1, partitions: int = 8, seed: int = 42, counts: DataFrame | None = None
):
    """Word2Vec; its transform averages the vectors of a text.

    Words under ``min_count`` have no vector; by default all have one. ``partitions`` is how many parts are trained side by side; more
    are faster and less exact. MLlib keeps the whole vocabulary on the driver: beyond ``DRIVER_WORDS`` words it stays in tables, and
    the number of parts follows the volume of the texts. ``counts`` are the ``word_counts`` of ``df`` from ``min_count`` on, if they are there already.
    """
    if counts is None:
        counts = word_counts(df, tokens_col, min_count)
    if counts.count() > DRIVER_WORDS:
        return sharded_word_vectors(df, tokens_col, counts, size, partitions, seed)
    return Word2Vec(
        vectorSize=size, minCount=min_count, seed=seed, inputCol=tokens_col, outputCol="embedding", maxIter=1,
        numPartitions=partitions,
    ).fit(df)


def mean_vectors(df: DataFrame, group_col: str, vector_col: str) -> DataFrame:
    """Mean vector per group, combined map-side cell by cell."""
    cells = df.select(group_col, F.posexplode(vector_col).alias("pos", "x"))
    means = cells.groupBy(group_col, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(group_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "x")))["x"].alias("embedding")
    )


def retrieve_lsh(
    bank: DataFrame, queries: DataFrame, planes: int = 12, tables: int = 64, probes: int = 3200, alike: float = 0.4, slack: float = 4.0, seed: int = 42,
    exclude_self: bool = False,
) -> DataFrame:
    """Approximate best match per query by cosine, with the number of compared vectors as ``compared``.

    In each table the signs of ``planes`` random projections, ANDed, are the key under which a vector is found. A query looks under its
    own key and under keys with up to three other signs: of those of all tables the ``probes`` that most likely hold a vector of cosine
    ``alike`` to it, judged by how far the query is from each plane. Of the vectors under any of these keys, those are compared whose signs
    agree with the query's on as many planes as the best one's, less ``slack`` standard errors; ``compared`` counts these. Queries
    without one are answered by the exact search, which compares the whole bank, so each gets a row. The planes are taken around the
    bank's mean, so that they cut it in the middle. Equal vectors of the bank are compared once, all counted, and answered by the lowest id;
    with ``exclude_self`` by the lowest but the query's own.
    """
    bank = bank.filter("embedding IS NOT NULL").select(F.col("vec_id").cast("long"), "embedding")
    queries = queries.filter("embedding IS NOT NULL").select(F.col("vec_id").cast("long"), "embedding")
    middle = bank.select(F.posexplode("embedding").alias("pos", "x")).groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    center = np.array([r.m for r in middle.orderBy("pos").collect()])  # one number per dimension
    signs = Planes(center, planes, tables, probes, alike, seed)
    # Two ids stand for all equal vectors: the second is for the query that is the first.
    lowest = materialize(bank.groupBy("embedding").agg(F.min("vec_id").alias("match_id"), F.count(F.lit(1)).alias("copies")), "lsh-lowest")
    others = bank.join(lowest.select(F.col("match_id").alias("vec_id")), "vec_id", "left_anti")
    second = others.groupBy("embedding").agg(F.min("vec_id").alias("second"))
    vectors = materialize(lowest.join(second, "embedding", "left"), "lsh-vectors")
    asked = queries.select(F.col("vec_id").alias("query_id"), "embedding")
    found = materialize(search_by_planes(asked, vectors, signs, exclude_self, slack), "lsh")
    missed = queries.join(found.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    exact = nearest_k(missed, bank, "vec_id", "embedding", exclude_self=exclude_self).select(
        "query_id", "match_id", F.round("score", 6).alias("score"), F.lit(bank.count()).cast("bigint").alias("compared")
    )
    return found.withColumn("exact", F.lit(False)).unionByName(exact.withColumn("exact", F.lit(True)))
