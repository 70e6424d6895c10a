"""Exact k nearest vectors. Pairs are scored block by block inside tasks and never shuffled:
a task hands on only the k best of each of its queries.

Many queries are cut into cells around pivots. By the triangle inequality a vector of the bank can only be among the k nearest of a cell's queries if
it is no further from the pivot than twice the cell's radius and the distance of the pivot's own k-th nearest; it travels to those cells and to no
others. How many cells that are per vector is measured first: where cells do not part the vectors, every block meets every block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Window, functions as F

from textloom.operators.lookup import fits_broadcast, keyed_lookup
from textloom.sources.scratch import materialize

# The helpers travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

QUERY_ROWS = 4096
QUERY_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 4096
SCORE_DIGITS = 9
#: Cells of the queries, and the bank's rows that the pivots are picked from, per cell.
MOST_CELLS = 512
ROWS_PER_CELL = 16
#: Pairs of a scope and a cell that the bank's rows are tried against in every task.
PLAN_ROWS = 100_000
OUT = "query_id bigint, match_id bigint, score double"


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row becomes NaN and never matches."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _scores(queries: np.ndarray, bank: np.ndarray, metric: str) -> np.ndarray:
    """Higher is better: cosine, or the negated squared distance."""
    if metric == "cosine":
        raw = _unit(queries) @ _unit(bank).T
    else:
        raw = 2.0 * (queries @ bank.T)
        raw -= (queries * queries).sum(axis=1)[:, None]
        raw -= (bank * bank).sum(axis=1)[None, :]
    raw = np.round(raw, SCORE_DIGITS)
    raw[np.isnan(raw)] = -np.inf
    return raw


class _Best:
    """The k best matches per query seen so far in one task."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scopes: np.ndarray, k: int, metric: str, self_ok: bool):
        self.ids, self.vectors, self.scopes = ids, vectors, scopes
        self.k, self.metric, self.self_ok = k, metric, self_ok
        self.score = np.full((len(ids), k), -np.inf)
        self.match = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray, scopes: np.ndarray) -> None:
        if len(ids) == 0:
            return
        # In id order, so that the first of equal scores is the lowest id.
        by_id = np.argsort(ids, kind="stable")
        ids, vectors, scopes = ids[by_id], vectors[by_id], scopes[by_id]
        score = _scores(self.vectors, vectors, self.metric)
        score[self.scopes[:, None] != scopes[None, :]] = -np.inf
        if not self.self_ok:
            score[self.ids[:, None] == ids[None, :]] = -np.inf
        row = np.arange(len(self.ids))
        for _ in range(min(self.k, len(ids))):
            top = score.argmax(axis=1)
            self.score = np.column_stack([self.score, score[row, top]])
            self.match = np.column_stack([self.match, ids[top]])
            score[row, top] = -np.inf
        order = np.lexsort((self.match, -self.score), axis=1)[:, : self.k]
        self.score = np.take_along_axis(self.score, order, axis=1)
        self.match = np.take_along_axis(self.match, order, axis=1)

    def rows(self) -> pd.DataFrame:
        found = pd.DataFrame(
            {
                "query_id": np.repeat(self.ids, self.k),
                "match_id": self.match.ravel(),
                "score": self.score.ravel(),
            }
        )
        return found[np.isfinite(found["score"])]


def nearest_k(
    queries: DataFrame,
    bank: DataFrame,
    id_col: str,
    vector_col: str,
    k: int = 1,
    metric: str = "cosine",
    scope: str | None = None,
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    max_query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, place, match_id, score)``: the k best bank rows of every query, ties to the lower id.

    With ``scope`` only rows of the same scope value are compared. ``score`` is the cosine, or
    for ``metric='l2'`` the negated squared distance.
    """
    def narrow(df: DataFrame) -> DataFrame:
        # Scopes are compared by their 64-bit hash, one integer per row.
        scope_value = F.col(scope).cast("string") if scope else F.lit("")
        return df.select(
            F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.xxhash64(scope_value).alias("s")
        ).filter(F.col("v").isNotNull())

    queries, bank = narrow(queries), narrow(bank)
    if fits_broadcast(queries, max_query_rows, QUERY_BYTES):
        partial = _stream_bank(queries, bank, k, metric, not exclude_self, block_rows)
    else:
        routed = _by_cells(queries, bank, k + exclude_self, metric, block_rows)
        partial = _grid(*(routed or (queries, bank)), k, metric, not exclude_self, block_rows)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "match_id")
    return (
        partial.withColumn("place", F.row_number().over(best_first).cast("bigint"))
        .filter(F.col("place") <= k)
        .select("query_id", "place", "match_id", "score")
    )


def _stream_bank(
    queries: DataFrame, bank: DataFrame, k: int, metric: str, self_ok: bool, block_rows: int
) -> DataFrame:
    """Few queries (size already checked): they go to every task, the bank is read in place."""
    local = queries.toArrow()
    if local.num_rows == 0:
        return bank.sparkSession.createDataFrame([], OUT)
    shared = bank.sparkSession.sparkContext.broadcast(
        (local["id"].to_numpy(), _matrix(local["v"]), local["s"].to_numpy())
    )

    def score_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, scopes = shared.value
        best = _Best(ids, vectors, scopes, k, metric, self_ok)
        seen = False
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                best.add(part.column(0).to_numpy(), _matrix(part.column(1)), part.column(2).to_numpy())
                seen = True
        if seen:
            yield pa.RecordBatch.from_pandas(best.rows(), preserve_index=False)

    return bank.mapInArrow(score_partition, OUT)


def _points(column: pa.Array, metric: str) -> np.ndarray:
    """Vectors whose Euclidean distance ranks as the metric does."""
    rows = _matrix(column)
    return _unit(rows) if metric == "cosine" else rows


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows * rows).sum(axis=1)[:, None] - 2 * (rows @ pivots.T) + (pivots * pivots).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(squares, 0))


def _pivots(bank: DataFrame, count: int, metric: str, block_rows: int) -> np.ndarray | None:
    """Centres of a bounded sample of the bank, one for every block that it would fill; None for vectors of unlike length."""
    cells = int(min(max(2, -(-count // block_rows)), MOST_CELLS))
    wanted = cells * ROWS_PER_CELL
    place = F.pmod(F.xxhash64(F.lit("pivot"), "id"), F.lit(1 << 40))
    share = min(1.0, 1.1 * wanted / max(count, 1))
    sample = bank.filter(place < F.lit(int(share * (1 << 40)) + 1)).orderBy(place, "id").limit(wanted).toArrow()
    if not sample.num_rows or len(set(sample["v"].combine_chunks().value_lengths().to_pylist())) > 1:
        return None
    rows = _points(sample["v"], metric)
    rows = rows[np.isfinite(rows).all(axis=1)]
    if not len(rows):
        return None
    centres = rows[:: max(1, len(rows) // cells)][:cells].copy()
    for _ in range(5):
        near = _distances(rows, centres).argmin(axis=1)
        for c in np.unique(near).tolist():
            centres[c] = rows[near == c].mean(axis=0)
    return centres


def _by_cells(queries: DataFrame, bank: DataFrame, k: int, metric: str, block_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """Queries under their cell and the bank's rows under all cells that may need them, as scopes of their own; None where
    that would copy more rows than meeting every block does."""
    spark = bank.sparkSession
    count = bank.count()
    pivots = _pivots(bank, count, metric, block_rows)
    if pivots is None:
        return None
    shared = spark.sparkContext.broadcast(pivots)
    kind = "id bigint, v array<double>, s bigint, cell int, far double"

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                far = _distances(_points(part.column(1), metric), shared.value)
                fine = np.isfinite(far).all(axis=1)
                cell = np.where(fine, np.where(fine[:, None], far, 0).argmin(axis=1), 0)
                near = far[np.arange(len(far)), cell]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(pa.list_(pa.float64())), part.column(2), pa.array(cell.astype(np.int32)), pa.array(near)], names=["id", "v", "s", "cell", "far"]
                ).filter(pa.array(fine))

    placed = materialize(queries.mapInArrow(assigned, kind), "query-cells")
    cells = materialize(placed.groupBy("s", "cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")), "cells")
    if not fits_broadcast(cells, PLAN_ROWS):
        return None
    plan = cells.orderBy("s", "cell").toArrow()
    if not plan.num_rows:
        return None
    scopes, own, radius = plan["s"].to_numpy(), plan["cell"].to_numpy(), plan["radius"].to_numpy()
    wanted = spark.sparkContext.broadcast((scopes, own))

    def tried(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of one scope, the places in the plan that it has, and their distances."""
        known, cell = wanted.value
        scope = batch.column(2).to_numpy()
        far = _distances(_points(batch.column(1), metric), shared.value)
        fine = np.isfinite(far).all(axis=1)
        for s in np.unique(scope[fine]).tolist():
            low, high = np.searchsorted(known, s, "left"), np.searchsorted(known, s, "right")
            if low < high:
                rows = np.flatnonzero(fine & (scope == s))
                yield rows, np.arange(low, high), far[np.ix_(rows, cell[low:high])]

    def nearest_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                for rows, places, far in tried(batch.slice(at, block_rows)):
                    some = np.sort(np.partition(far, min(k, len(rows)) - 1, axis=0)[:k], axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(places, len(some)).astype(np.int32)), pa.array(some.ravel())], names=["place", "far"]
                    )

    nearest = bank.mapInArrow(nearest_pivots, "place int, far double").withColumn(
        "n", F.row_number().over(Window.partitionBy("place").orderBy("far"))
    )
    found = nearest.filter(F.col("n") == k).toArrow()  # one row per scope and cell
    kth = np.full(len(scopes), np.inf)  # fewer rows than asked for: all are needed
    kth[found["place"].to_numpy()] = found["far"].to_numpy()
    reach = spark.sparkContext.broadcast((2 * radius + kth) * (1 + 1e-9) + 1e-8)  # scores are rounded

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = sum(int((far <= reach.value[places]).sum()) for at in range(0, batch.num_rows, block_rows) for _, places, far in tried(batch.slice(at, block_rows)))
            yield pa.RecordBatch.from_arrays([pa.array([number])], names=["n"])

    routed = bank.mapInArrow(copies, "n bigint").agg(F.sum("n")).first()[0] or 0
    # Rows that meeting every block would copy: the bank's once for each block of queries of their scope.
    asked: dict[int, int] = {}
    for s, n in zip(scopes.tolist(), plan["n"].to_pylist()):
        asked[s] = asked.get(s, 0) + n
    blocks = sum(-(-n // block_rows) for n in asked.values()) / len(asked)
    if routed >= blocks * count:
        return None

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                for rows, places, far in tried(part):
                    row, place = np.nonzero(far <= reach.value[places])
                    for i in range(0, len(row), block_rows):
                        at_rows = pa.array(rows[row[i : i + block_rows]])
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(at_rows), part.column(1).take(at_rows).cast(pa.list_(pa.float64())), pa.array(places[place[i : i + block_rows]])], names=["id", "v", "s"]
                        )

    number = spark.createDataFrame(plan.select(["s", "cell"]).append_column("place", pa.array(np.arange(len(scopes)))))
    keyed = placed.join(F.broadcast(number), ["s", "cell"]).select("id", "v", F.col("place").alias("s"))
    return keyed, materialize(bank.mapInArrow(sent, "id bigint, v array<double>, s bigint"), "cell-rows")


def _grid(
    queries: DataFrame, bank: DataFrame, k: int, metric: str, self_ok: bool, block_rows: int
) -> DataFrame:
    """Many queries: both sides are cut into blocks per scope and every pair of blocks is one group.

    A group holds about ``block_rows`` rows of each side, whatever the size of the scope.
    """
    def blocks(df: DataFrame, out: str) -> DataFrame:
        size = F.ceil(F.count(F.lit(1)) / block_rows).cast("int")
        return df.groupBy("s").agg(size.alias(out))

    plan = materialize(blocks(queries, "_nq").join(blocks(bank, "_nb"), "s"), "grid")

    def place(df: DataFrame, own: str, other: str, own_out: str, other_out: str) -> DataFrame:
        joined = keyed_lookup(df, plan, "s", "_nb")
        own_block = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return joined.select("id", "v", "s", own_block.alias(own_out), every.alias(other_out))

    left = place(queries, "_nq", "_nb", "qb", "bb")
    right = place(bank, "_nb", "_nq", "bb", "qb")

    def score_cell(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(b) == 0:
            return pd.DataFrame({"query_id": [], "match_id": [], "score": []}).astype(
                {"query_id": "int64", "match_id": "int64", "score": "float64"}
            )
        best = _Best(q["id"].to_numpy(), np.stack(q["v"]).astype(np.float64), q["s"].to_numpy(), k, metric, self_ok)
        best.add(b["id"].to_numpy(), np.stack(b["v"]).astype(np.float64), b["s"].to_numpy())
        return best.rows()

    return (
        left.groupBy("s", "qb", "bb")
        .cogroup(right.groupBy("s", "qb", "bb"))
        .applyInPandas(score_cell, OUT)
    )
