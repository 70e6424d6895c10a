"""Whitening of embeddings by a covariance from variances alone (polarisation).

A vector's entries become integers (``floor(scale * entry) + offset``), so everything up to the covariance is exact: with n distinct vectors
of per-dimension sums S, ``t = n * x - S`` is a centred integer, and for every dimension, and for the sum of every two, the squares of t are
summed without rounding. The covariance of two dimensions is half of what the variance of their sum exceeds their own variances by. The
matrix, one number per pair of dimensions, is assembled and decomposed on the driver (dims^2 / 2 exact sums get there, whatever the number
of rows: 2,080 for 64 dimensions); the rows are projected in tasks.

Sums are exact at any size: squares that do not fit 64 bits are summed by limbs in the tasks, and the tasks' sums travel as limbs of
``LIMB_BITS``.

Defined cases: rows whose vector is null or holds a null, NaN or infinite entry are dropped, and so are rows of another length than most
(of equally frequent lengths the longest). Entries beyond 2^53 in size after scaling count as 2^53, the last size at which every integer is a double. Repeated
vectors count once in the fit and all get rows. A component without variance (fewer distinct vectors than components, constant
dimensions; eigenvalue under ``RANK`` of the largest) has null ``whitened`` and is left out of ``identity_error``, which is null if no component has
variance; ``explained`` is then null too. An empty table gives no rows. Ids may be null or repeated; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from textloom.sources.scratch import materialize

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
RANK = 1e-10
LIMB_BITS = 40
_LARGEST = float(1 << 53)
#: Numbers held at once by a block of pair sums.
_CELLS = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with sums ``sums`` (of the integers without offset); components as columns of ``vectors``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    positive: np.ndarray


def quantised(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have ``dims`` finite entries, and these as integers without offset."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    entries = column.take(pa.array(rows)).flatten()
    cells = entries.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dims)  # a null becomes NaN
    fine = np.isfinite(cells).all(axis=1)
    whole = np.clip(np.floor(scale * cells[fine]), -_LARGEST, _LARGEST)
    return rows[fine], whole.astype(np.int64)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - S`` without rounding: 64-bit integers where they suffice, else Python's."""
    bound = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0)
    if bound < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def square_sums(t: np.ndarray) -> np.ndarray:
    """Exact column sums of the squares of integers, as Python integers.

    Numbers are cut into limbs narrow enough that a column of products of two limbs fits 64 bits.
    """
    if t.dtype == object:
        return (t * t).sum(axis=0) if len(t) else np.zeros(t.shape[1], object)
    width = (62 - len(t).bit_length()) // 2
    largest = int(np.abs(t).max(initial=0))
    limbs, rest = [], t
    while True:
        if largest < 1 << width:
            limbs.append(rest)
            break
        limbs.append(rest & ((1 << width) - 1))
        rest = rest >> width
        largest = (largest >> width) + 1
    total = np.zeros(t.shape[1], object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs[i:], i):
            total = total + (np.einsum("rc,rc->c", a, b).astype(object) << (width * (i + j) + (i != j)))
    return total


def _limb_rows(sums: dict[int, int]) -> pa.RecordBatch:
    """Exact sums by slot, as rows ``(slot, limb, part)`` whose parts Spark may add."""
    slots, limbs, parts = [], [], []
    for slot, value in sums.items():
        sign, value, limb = (-1 if value < 0 else 1), abs(int(value)), 0
        while value or not limb:
            slots.append(slot)
            limbs.append(limb)
            parts.append(sign * (value & ((1 << LIMB_BITS) - 1)))
            value >>= LIMB_BITS
            limb += 1
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(limbs, pa.int32()), pa.array(parts, pa.int64())], names=["slot", "limb", "part"])


def exact_sums(rows: DataFrame, of_batch, slots: int) -> list[int]:
    """Sums over all rows of the exact numbers, one per slot, that ``of_batch`` gives for a batch."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: defaultdict[int, int] = defaultdict(int)
        for batch in batches:
            for slot, value in enumerate(of_batch(batch)):
                total[slot] += int(value)
        yield _limb_rows(total)

    parts = rows.mapInArrow(run, "slot int, limb int, part long").groupBy("slot", "limb").agg(F.sum("part").alias("part")).toArrow()
    out = [0] * slots
    for slot, limb, part in zip(*(parts[c].to_pylist() for c in ("slot", "limb", "part"))):
        out[slot] += part << (LIMB_BITS * limb)
    return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _length(rows: DataFrame, vector: str) -> int:
    """The most frequent length of a vector, of equally frequent ones the largest; 0 if there is none."""
    best = rows.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(
        F.desc("c"), F.desc("d")
    ).first()
    return best.d if best else 0


def fit_list(rows: DataFrame, vector: str, dims: int, scale: int = SCALE) -> DataFrame:
    """The distinct integer vectors ``q`` (without offset), written."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = quantised(batch.column(0), dims, scale)
            yield pa.RecordBatch.from_arrays([_lists(x)], names=["q"])

    return materialize(rows.select(vector).mapInArrow(run, "q array<long>").distinct(), "whitening-fit")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def fit(listed: DataFrame, dims: int) -> Whitening | None:
    """Covariance of the distinct vectors by polarisation, decomposed; None for no vectors."""
    def plain(batch: pa.RecordBatch) -> list:
        x = _matrix(batch.column(0), dims)
        small = int(np.abs(x).max(initial=0)) * max(len(x), 1) < 1 << 62
        return [len(x), *(x if small else x.astype(object)).sum(axis=0).tolist()]

    n, *sums = exact_sums(listed, plain, dims + 1)
    if not n:
        return None
    sums = tuple(sums)
    left, right = np.triu_indices(dims, 1)

    def squares(batch: pa.RecordBatch) -> np.ndarray:
        t = centred(_matrix(batch.column(0), dims), n, sums)
        total = np.zeros(dims + len(left), object)
        step = max(1, _CELLS // max(1, dims + len(left)))
        for at in range(0, len(t), step):
            some = t[at : at + step]
            total = total + square_sums(np.concatenate([some, some[:, left] + some[:, right]], axis=1))
        return total

    found = exact_sums(listed, squares, dims + len(left))
    own, both = found[:dims], found[dims:]
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        covariance[i, i] = own[i] / n**3
    for i, j, square in zip(left.tolist(), right.tolist(), both):
        covariance[i, j] = covariance[j, i] = (square - own[i] - own[j]) / (2 * n**3)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    # Either sign would do; the largest entry is made positive, so that a fit is the same anywhere.
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(dims)])
    return Whitening(
        n, sums, values, vectors * np.where(sign == 0, 1, sign), sum(own) / n**3, values > RANK * max(float(values.max(initial=0)), 0)
    )


def project(x: np.ndarray, model: Whitening, k: int) -> np.ndarray:
    """Whitened coordinates of integer vectors on the first ``k`` components; NaN where a component has no variance."""
    mean = np.array([s / model.n for s in model.sums])
    with np.errstate(invalid="ignore", divide="ignore"):
        out = ((x - mean) @ model.vectors[:, :k]) / np.sqrt(np.where(model.positive[:k], model.values[:k], np.nan))
    return out


def identity_error(listed: DataFrame, model: Whitening, k: int) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, over components that have variance."""
    real = np.flatnonzero(model.positive[:k])
    if not len(real):
        return None
    dims = len(model.sums)

    def summed(of_block, size: int) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                total += of_block(project(_matrix(batch.column(0), dims), model, k)[:, real]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["slot", "part"])

        parts = listed.mapInArrow(run, "slot int, part double").groupBy("slot").agg(F.sum("part").alias("part")).toArrow()
        out = np.zeros(size)
        out[parts["slot"].to_numpy()] = parts["part"].to_numpy()
        return out / model.n

    mean = summed(lambda w: w.sum(axis=0), len(real))
    covariance = summed(lambda w: (w - mean).T @ (w - mean), len(real) ** 2).reshape(len(real), len(real))
    return float(np.abs(covariance - np.eye(len(real))).max())


def whiten(
    rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """``(row_id, component, n, deviation, whitened, explained, identity_error)``: one row per vector and component.

    ``deviation``, the sum of the squares of ``n * x - S``, is exact, as decimal digits in a string: it outgrows 64 bits for a few million vectors.
    """
    kind = rows.schema[row_id].dataType.simpleString()
    out = f"{row_id} {kind}, component int, n long, deviation string, whitened double, explained double, identity_error double"
    dims = _length(rows, vector)
    listed = fit_list(rows, vector, dims, scale) if dims else None
    model = fit(listed, dims) if dims else None
    if model is None:
        return rows.sparkSession.createDataFrame([], out)
    k = min(components, dims)
    error = identity_error(listed, model, k)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        explained = held.values[:k].clip(min=0) / held.trace if held.trace > 0 else np.full(k, np.nan)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                kept, x = quantised(part.column(1), dims, scale)
                t = centred(x, held.n, held.sums)
                if int(np.abs(t).max(initial=0)) ** 2 * dims >= 1 << 62:
                    t = t.astype(object)
                deviation = [str(d) for d in (t * t).sum(axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(kept, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(kept))),
                        pa.array(np.full(len(kept) * k, held.n)),
                        pa.array(deviation, pa.string()).take(pa.array(np.repeat(np.arange(len(kept)), k))),
                        pa.array(project(x, held, k).ravel(), from_pandas=True),
                        pa.array(np.tile(explained, len(kept)), from_pandas=True),
                        pa.array([error] * (len(kept) * k), pa.float64()),
                    ],
                    names=[row_id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select(row_id, vector).mapInArrow(run, out)
