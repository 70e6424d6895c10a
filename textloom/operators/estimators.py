"""The vectorizer and the label binarizer as savable estimators and models of MLlib pipelines.

Both models keep their fitted table as a written table, never as a list on the driver; saving copies it beside the parameters.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, functions as F

from textloom.functions.text import word_tokens
from textloom.operators import labels, vectorize, vocabulary
from textloom.operators.labels import sorted_label_ids
from textloom.sources.scratch import materialize


class _Shared(HasInputCol, HasOutputCol):
    idCol = Param(Params._dummy(), "idCol", "column that names a row", TypeConverters.toString)
    nDocs = Param(Params._dummy(), "nDocs", "rows that the table was fitted on", TypeConverters.toInt)

    def getIdCol(self) -> str:
        return self.getOrDefault(self.idCol)


class _TableWriter(MLWriter):
    def __init__(self, instance: "_TableModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession.sparkContext)
        self.instance.table.write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "_TableModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession.sparkContext)
        model = self.kind(self.sparkSession.read.parquet(f"{path}/table"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _TableModel(Model, _Shared, MLReadable, MLWritable):
    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self.table = table

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class _TableEstimator(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, idCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)


class TextVectorizerModel(_TableModel):
    """Adds ``array<struct<token_id, weight>>`` by token id; words outside the vocabulary weigh as its mean."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key = self.getIdCol()
        tokens = vocabulary.token_rows(dataset, key, word_tokens(self.getInputCol()))
        n_docs = dataset.sparkSession.range(1).select(F.lit(self.getOrDefault(self.nDocs)).alias("n"))
        counts = materialize(vectorize.text_token_counts(tokens, key), "token-counts")
        weights = vectorize.tfidf_vectors(counts, self.table, n_docs, key)
        vectors = weights.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("token_id", "weight"))).alias(self.getOutputCol()))
        return dataset.join(vectors, key, "left")


class TextVectorizer(_TableEstimator):
    """Learns every word of the texts with its frequency: ids by frequency, weights ``tf * ln(1 + N / (1 + df))``."""

    def _fit(self, dataset: DataFrame) -> TextVectorizerModel:
        key = self.getIdCol()
        tokens = vocabulary.token_rows(dataset, key, word_tokens(self.getInputCol()))
        counts = materialize(vectorize.text_token_counts(tokens, key), "token-counts")
        model = TextVectorizerModel(vocabulary.build_vocabulary(vocabulary.count_statistics(counts)))
        model._set(nDocs=dataset.count())
        return self._copyValues(model)


class LabelBinarizerModel(_TableModel):
    """Adds the 0/1 row over all labels; labels that were not fitted have no cell."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key = self.getIdCol()
        encoded = labels.encode(dataset, key, self.getInputCol(), self.table)
        rows = labels.hot_rows(dataset, encoded, key, self.table).withColumnRenamed("hot", self.getOutputCol())
        return dataset.join(rows, key)


class LabelBinarizer(_TableEstimator):
    """Learns the labels of a list column, in their own order."""

    def _fit(self, dataset: DataFrame) -> LabelBinarizerModel:
        model = LabelBinarizerModel(sorted_label_ids(labels.label_counts(dataset, self.getInputCol())))
        return self._copyValues(model._set(nDocs=dataset.count()))
