"""Language identification: averaged embeddings of hashed subwords, a linear softmax, and calibrated rejection.

Subwords are a text's words and all stretches of four bytes, with everything that is no letter folded into one sign. Each hashes
to a bucket with a small vector; a text is the mean of its subwords' vectors, and a linear layer with softmax names its
language. Both layers are trained by SGD on a bounded sample. On a part of the sample kept aside, a temperature is fitted that calibrates the
probabilities, and the least probability from which predictions are right often enough; below it a prediction counts as rejected.

As the layers are linear, scoring adds one small row per subword (the vector already multiplied by the linear layer).

Defined cases: null text, or one without a letter: ``und``, score 0, rejected. Null languages are not learnt from. Without any row to learn
from, every text is ``und``. Texts of any length are read whole. Of equally likely languages the first by name is predicted. Repeated rows are predicted
alike; an empty table gives no rows; extra columns are ignored.
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

UNKNOWN = "und"
BUCKETS = 1 << 15
DIMENSIONS = 16
GRAM = 4
#: Upper bound of the rows that the model is fitted on.
MAX_TRAIN_ROWS = 4000
EPOCHS = 6
BATCH = 32
STEP = 0.3
CALIBRATION_SHARE = 5
WANTED_ACCURACY = 0.99


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages: vectors times the linear layer
    bias: np.ndarray
    temperature: float
    least: float


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Bytes of letters, and a random value per byte: one for all others, A-Z those of a-z."""
    letter = np.zeros(256, bool)
    for low, high in ((65, 91), (97, 123), (128, 256)):
        letter[low:high] = True
    values = byte_values(True).copy()
    values[~letter] = values[32]
    return letter, values


def subwords(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords, and the text of each."""
    letter, values = _letters()
    hashes = Hashes(data, values=values)
    is_letter = letter[data]
    edge = np.diff(np.concatenate(([0], is_letter.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    grams = np.flatnonzero(is_letter[: max(len(data) - GRAM + 1, 0)])
    words = hashes.of(begin, end) + np.uint64(1)
    pieces = hashes.of(grams, grams + GRAM)
    bucket = (np.concatenate((words, pieces)) >> np.uint64(24)).astype(np.int64) & (BUCKETS - 1)
    text_of = np.searchsorted(rows, np.concatenate((begin, grams)), side="right") - 1
    return bucket, text_of


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def text_logits(model: Model, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    n = len(rows) - 1
    bucket, text_of = subwords(data, rows)
    size = np.maximum(np.bincount(text_of, minlength=n), 1)
    sums = [np.bincount(text_of, model.table[:, k][bucket], n) for k in range(len(model.languages))]
    return np.stack(sums, axis=1) / size[:, None] + model.bias


def fit(texts: pa.Array, languages: list[str], seed: int = 11) -> Model:
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    y = np.searchsorted(np.array(names), np.array(languages))
    column = text_column(texts)
    bags: list[tuple[np.ndarray, np.ndarray]] = []
    for start, stop in row_blocks(column):
        data, rows = text_bytes(column.slice(start, stop - start))
        bucket, text_of = subwords(data, rows)
        found, counts = np.unique(text_of * BUCKETS + bucket, return_counts=True)
        cuts = np.searchsorted(found, np.arange(stop - start + 1) * BUCKETS)
        for i, j in zip(cuts, cuts[1:]):
            total = counts[i:j].sum()
            bags.append(((found[i:j] % BUCKETS).astype(np.int32), counts[i:j] / max(total, 1)))
    usable = np.array([i for i, bag in enumerate(bags) if len(bag[0])], np.int64)
    aside = usable[usable % CALIBRATION_SHARE == 0]
    fitted = usable[usable % CALIBRATION_SHARE != 0] if len(usable) > len(aside) else usable
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, len(names))), np.zeros(len(names))
    layer += random.normal(0, 0.1, layer.shape)
    vector_squares, layer_squares = np.full(vectors.shape, 1e-4), np.full(layer.shape, 1e-4)
    for _ in range(EPOCHS):
        order = random.permutation(fitted)
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            bucket = np.concatenate([bags[d][0] for d in docs])
            share = np.concatenate([bags[d][1] for d in docs])
            sizes = np.array([len(bags[d][0]) for d in docs])
            mean = np.add.reduceat(vectors[bucket] * share[:, None], np.cumsum(sizes) - sizes)
            error = _softmax(mean @ layer + bias)
            error[np.arange(len(docs)), y[docs]] -= 1
            back = np.repeat(error @ layer.T, sizes, axis=0) * share[:, None]
            grad = mean.T @ error / len(docs)
            layer_squares += grad * grad
            layer -= STEP * grad / np.sqrt(layer_squares)
            bias -= STEP * error.mean(axis=0)
            touched, place = np.unique(bucket, return_inverse=True)
            step = np.stack([np.bincount(place, back[:, k], len(touched)) for k in range(DIMENSIONS)], axis=1)
            vector_squares[touched] += step * step
            vectors[touched] -= STEP * step / np.sqrt(vector_squares[touched])
    model = Model(names, vectors @ layer, bias, 1.0, 0.0)
    if len(aside):
        logits = np.stack([(model.table[bags[d][0]] * bags[d][1][:, None]).sum(axis=0) for d in aside]) + bias
        model.temperature, model.least = calibrate(logits, y[aside])
    return model


def calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Temperature of the least log loss, and the least probability from which predictions are right often enough."""
    def loss(t: float) -> float:
        return float(-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean())

    temperature = min((2.0 ** (k / 4) for k in range(-16, 17)), key=loss)
    p = _softmax(logits / temperature)
    order = np.argsort(-p.max(axis=1), kind="stable")
    right = np.cumsum(p.argmax(axis=1)[order] == y[order]) / np.arange(1, len(y) + 1)
    chance = p.max(axis=1)[order]
    last_of_equal = np.append(chance[1:] != chance[:-1], True)  # a threshold takes all of equal chance
    good = np.flatnonzero((right >= WANTED_ACCURACY) & last_of_equal)
    return temperature, float(chance[good[-1]]) if len(good) else 1.0


def train(documents: DataFrame, train_rows: Column, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    rows = documents.filter(train_rows).filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sample = bounded_sample(rows, max_rows, "doc_id").select("text", "lang").toArrow()
    return fit(sample["text"], sample["lang"].to_pylist())


def predict(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` and ``rejected`` of every whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    fields = [documents.schema[c] for c in keep] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        names = np.array([*fitted.languages, UNKNOWN], object)
        for batch in batches:
            column = text_column(batch.column(len(keep)))
            letters = batch.column(len(keep) + 1).to_numpy(zero_copy_only=False).astype(bool)
            for start, stop in row_blocks(column):
                known = letters[start:stop] & bool(fitted.languages)
                best, p = np.full(stop - start, len(fitted.languages)), np.zeros(stop - start)
                if fitted.languages:
                    data, at = text_bytes(column.slice(start, stop - start))
                    chances = _softmax(text_logits(fitted, data, at) / fitted.temperature)
                    best, p = np.where(known, chances.argmax(axis=1), best), np.where(known, chances.max(axis=1), 0.0)
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(names[best], pa.string()), pa.array(p), pa.array(~known | (p < fitted.least))],
                    names=[*keep, "lang_pred", "score", "rejected"],
                )

    source = F.col(text).cast("string")
    narrow = documents.select(
        *[F.col(c) for c in keep], source.alias("_lang_text"), F.coalesce(source.rlike(r"\p{L}"), F.lit(False)).alias("_letters")
    )
    return narrow.mapInArrow(run, T.StructType(fields))
