"""Toxicity by multiple-instance learning: a document is a bag of sentences, and only documents carry labels.

A sentence's logit is a bias plus the weights of its hashed words and word beginnings; the document's probability is the noisy-or
of its sentences, ``1 - prod(1 - p)``. Weights are fitted by mini-batches of SGD with per-weight step sizes on the
log loss of document labels, on a bounded sample of labelled rows. A beginning is learnt as well as a word, so that
inflected forms of an insult count together. The fitted model then scores every sentence, which locates the offending ones.

Defined cases: null or empty text has no sentence and scores 0. Rows with the same id are scored alike; labels of an id that
are null are ignored; of several labels of one id any may be learnt from. Texts of any length are scored whole; a score of exactly one half counts as toxic. Empty
tables give no rows. Extra columns are ignored, or handed through by ``clean``. A table without labelled rows, or with one
class only, gives a model that scores by its bias.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from textloom.llm.sample import bounded_sample
from textloom.llm.scan import Hashes, byte_values, row_blocks, text_bytes, text_column

BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6, 7, 8)
FEATURES = 1 + len(BEGINNINGS)
NO_FEATURE = 0  # a bucket whose weight stays 0
#: Upper bound of the labelled rows that the model is fitted on.
MAX_TRAIN_ROWS = 6000
MIN_DOCUMENTS = 8
#: Features of a larger share of the documents labelled clean are stop words.
MAX_SHARE = 0.1
#: Documents looked at while fitting, in whole passes over the sample.
VISITS = 72_000
BATCH = 64
STEP = 3.0
START_SQUARES = 50.0
START_BIAS = -6.0
DECAY = 1e-5
OFFENDING = 0.5


@dataclass
class Model:
    weights: np.ndarray  # one per bucket
    bias: float


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words (letters, digits, all beyond ASCII) and bytes that end a sentence."""
    word, stop = np.zeros(256, bool), np.zeros(256, bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        word[low:high] = True
    stop[list(b".!?\n")] = True
    return word, stop


@dataclass
class Sentences:
    """Words of a block of texts that hold any, by sentence."""

    features: np.ndarray  # bucket of each feature, FEATURES per word
    first_word: np.ndarray  # of every sentence
    row: np.ndarray  # text of every sentence
    begin: np.ndarray  # first byte of its first word, within the block
    end: np.ndarray  # end of its last word


def sentences(data: np.ndarray, rows: np.ndarray) -> Sentences:
    word, stop = _classes()
    edge = np.diff(np.concatenate(([0], word[data].view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = Hashes(data, values=byte_values(True))
    columns = [hashes.of(begin, end)]
    for k in BEGINNINGS:  # only of longer words: a short word is no beginning of itself
        columns.append(np.where(end - begin > k, hashes.of(begin, np.minimum(begin + k, end)) + np.uint64(k), np.uint64(0)))
    features = (np.stack(columns, axis=1) >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)
    # A line feed ends every text, so a sentence never spans two.
    sentence = np.cumsum(stop[data], dtype=np.int64)[begin]
    first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1]))) if len(begin) else begin
    last = np.concatenate((first[1:], [len(begin)])) - 1 if len(begin) else begin
    return Sentences(features, first, np.searchsorted(rows, begin[first], side="right") - 1, begin[first], end[last])


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sentence_logits(model: Model, found: Sentences) -> np.ndarray:
    if not len(found.first_word):
        return np.zeros(0)
    return model.bias + np.add.reduceat(model.weights[found.features].sum(axis=1), found.first_word)


def document_scores(logits: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Noisy-or: one minus the product of the sentences' chances of being clean."""
    return -np.expm1(-np.bincount(row, _softplus(logits), n_rows))


def _blocks(column: pa.Array) -> Iterator[tuple[int, Sentences, np.ndarray]]:
    """First row, sentences and number of words of each, of every block of texts."""
    for start, stop in row_blocks(column):
        data, rows = text_bytes(column.slice(start, stop - start))
        found = sentences(data, rows)
        yield start, found, np.diff(np.concatenate((found.first_word, [len(found.features)])))


def fit(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> Model:
    """Weights from whole texts and their labels, in the order given. The texts are scanned twice, so that only features in use are held."""
    column = text_column(texts)
    documents, clean = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)  # that have each feature
    sentence_row = []
    for start, found, counts in _blocks(column):
        seen = np.unique(np.repeat(found.row, counts)[:, None] * BUCKETS + found.features)
        documents += np.bincount(seen % BUCKETS, minlength=BUCKETS)
        clean += np.bincount(seen[labels[start + seen // BUCKETS] == 0] % BUCKETS, minlength=BUCKETS)
        sentence_row.append((found.row + start).astype(np.int32))
    row_of = np.concatenate(sentence_row) if sentence_row else np.zeros(0, np.int32)
    if not len(row_of):
        return Model(np.zeros(BUCKETS), START_BIAS)
    # Features of too few documents say nothing about others.
    common = (documents >= MIN_DOCUMENTS) & (clean <= MAX_SHARE * (labels == 0).sum())
    common[NO_FEATURE] = False
    del documents, clean
    features, owners, n_sentences = [], [], 0
    for _, found, counts in _blocks(column):
        flat = found.features.ravel()
        kept = common[flat]
        word_sentence = np.repeat(np.arange(n_sentences, n_sentences + len(counts), dtype=np.int32), counts)
        features.append(flat[kept].astype(np.int32))
        owners.append(np.repeat(word_sentence, FEATURES)[kept])
        n_sentences += len(counts)
    feature, owner = np.concatenate(features), np.concatenate(owners)
    del features, owners

    n_rows = len(labels)
    sentence_ends = np.searchsorted(row_of, np.arange(n_rows + 1))
    feature_ends = np.searchsorted(owner, sentence_ends)
    weights, bias = np.zeros(BUCKETS), START_BIAS
    squares, bias_square = np.full(BUCKETS, START_SQUARES), 1e-3
    random = np.random.default_rng(seed)
    for _ in range(-(-VISITS // max(n_rows, 1))):
        order = random.permutation(n_rows)
        for at in range(0, n_rows, BATCH):
            docs = order[at : at + BATCH]
            s_counts = sentence_ends[docs + 1] - sentence_ends[docs]
            f_counts = feature_ends[docs + 1] - feature_ends[docs]
            total = int(s_counts.sum())
            if not total:
                continue
            own = np.concatenate([feature[feature_ends[d] : feature_ends[d + 1]] for d in docs])
            shift = np.cumsum(s_counts) - s_counts - sentence_ends[docs]
            place = np.concatenate([owner[feature_ends[d] : feature_ends[d + 1]] for d in docs]) + np.repeat(shift, f_counts)
            logits = bias + np.bincount(place, weights[own], total)
            doc_of = np.repeat(np.arange(len(docs)), s_counts)
            load = np.bincount(doc_of, _softplus(logits), len(docs))
            y = labels[docs]
            with np.errstate(over="ignore", divide="ignore"):
                slope = np.where(y == 1, -1 / np.maximum(np.expm1(load), 1e-6), 1.0)
            slope = np.clip(slope, -20, 1)
            grad = slope[doc_of] / (1 + np.exp(-np.maximum(logits, -500)))
            g = np.bincount(own, grad[place], BUCKETS)
            used = np.flatnonzero(g)
            g = g[used] + DECAY * weights[used]
            squares[used] += g * g
            weights[used] -= STEP * g / np.sqrt(squares[used])
            b = float(grad.sum()) / len(docs)
            bias_square += b * b
            bias -= 0.1 * b / bias_square**0.5
    return Model(weights, float(bias))


def train(documents: DataFrame, labels: DataFrame, train_rows: Column, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the documents of at most ``max_rows`` labels, the first by a hash among those whose id ``train_rows`` admits."""
    marked = labels.filter(train_rows).filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "toxic")
    chosen = bounded_sample(marked.dropDuplicates(["doc_id"]), max_rows, "doc_id").select(
        F.col("doc_id").alias("_id"), F.col("toxic").alias("_y")
    )
    # At most ``max_rows`` short rows are broadcast; of several texts of one id that with the lowest digest is learnt from.
    found = documents.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("_id", "_y").agg(
        F.min_by("text", F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("t"))).alias("text")
    )
    # In one order whatever the layout of the tables, as the fit goes through the rows by place.
    sample = found.orderBy(F.xxhash64(F.lit("order"), "_id"), "_id").select("text", "_y").toArrow()
    return fit(sample["text"], np.array(sample["_y"].to_pylist(), np.int64))


def score(rows: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` and ``n_offending`` (sentences of at least ``OFFENDING``) of every whole text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    fields = [rows.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("n_offending", T.LongType())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            column = text_column(batch.column(len(keep)))
            for start, stop in row_blocks(column):
                data, at = text_bytes(column.slice(start, stop - start))
                found = sentences(data, at)
                logits = sentence_logits(fitted, found)
                scores = document_scores(logits, found.row, stop - start)
                offending = np.bincount(found.row, logits >= np.log(OFFENDING / (1 - OFFENDING)), stop - start)
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(np.clip(scores, 0, 1)), pa.array(offending.astype(np.int64))],
                    names=[*keep, "score", "n_offending"],
                )

    narrow = rows.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_score_text"))
    return narrow.mapInArrow(run, T.StructType(fields))


def offending_sentences(rows: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = OFFENDING) -> DataFrame:
    """``(doc_id, start_byte, sentence, score)`` of every sentence that scores at least ``least``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    fields = [
        rows.schema[doc_id], T.StructField("start_byte", T.LongType()), T.StructField("sentence", T.StringType()), T.StructField("score", T.DoubleType())
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch.column(1))
            for start, stop in row_blocks(column):
                data, at = text_bytes(column.slice(start, stop - start))
                found = sentences(data, at)
                p = 1 / (1 + np.exp(-np.maximum(sentence_logits(shared.value, found), -500)))
                hit = np.flatnonzero(p >= least)
                strings = [data[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(found.begin[hit], found.end[hit])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(found.row[hit] + start)), pa.array(found.begin[hit] - at[found.row[hit]]), pa.array(strings, pa.string()), pa.array(p[hit])],
                    names=[doc_id, "start_byte", "sentence", "score"],
                )

    return rows.select(doc_id, F.col(text).cast("string").alias("_text")).mapInArrow(run, T.StructType(fields))


def clean(rows: DataFrame, model: Model) -> DataFrame:
    """Rows, with all their columns, whose text scores under one half."""
    packed = rows.select(F.struct(F.col("*")).alias("_row"), F.col("text").alias("_text"))
    return score(packed, model, ["_row"], "_text").filter("score < 0.5").select("_row.*")
