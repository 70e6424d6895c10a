"""Packing of token ids into rows of fixed length by best-fit decreasing.

A document longer than a row is cut into whole rows and a rest, without loss. Rests and short documents of a block are taken
longest first, and each goes to the open row with the least room that still holds it. A segment tree over the possible rooms (how many open
rows have each) finds that room in a logarithmic number of steps.

Blocks are cut from each input split in the order of its rows, of about ``BLOCK_TOKENS`` tokens; no document is shuffled, a task
holds one block, and a lost task packs its split anew with the same outcome. Each packed row has its ids (padded), the cumulative lengths of its
segments, positions that start again at 0 with every segment, and the document and offset of every segment.

Defined cases: documents without tokens take no place. Repeated rows are packed as often as they come. A null id is kept as null. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from textloom.sources.scratch import materialize

ROW_TOKENS = 2048
BLOCK_TOKENS = 1 << 21

PACKED = T.StructType([
    T.StructField("pack_id", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("positions", T.BinaryType()),
    T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("starts", T.ArrayType(T.LongType())),
])


class Rooms:
    """Open rows by the room they have left; a segment tree over rooms finds the least that suffices."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)  # open rows under each node
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, change: int) -> None:
        at = room + self.leaves
        while at:
            self.tree[at] += change
            at >>= 1

    def open(self, row: int, room: int) -> None:
        heapq.heappush(self.rows[room], row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The first row among those with the least room of at least ``size``, and its room; it is no longer open."""
        at = size + self.leaves
        if not self.tree[at]:
            while at > 1 and not (at % 2 == 0 and self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not self.tree[at]:
                    at += 1
        room = at - self.leaves
        self._add(room, -1)
        return heapq.heappop(self.rows[room]), room


def best_fit_decreasing(sizes: list[int], row_tokens: int) -> list[list[int]]:
    """Items of each row; every size is at least 1 and at most ``row_tokens``."""
    rooms, packed = Rooms(row_tokens), []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        found = rooms.take(size)
        if found is None:
            row, room = len(packed), row_tokens
            packed.append([])
        else:
            row, room = found
        packed[row].append(item)
        if room > size:
            rooms.open(row, room - size)
    return packed


@dataclass
class _Block:
    """Segments of documents that wait to be packed."""

    row_tokens: int
    segments: list[tuple[int | None, int, np.ndarray]] = field(default_factory=list)
    tokens: int = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for start in range(0, len(ids), self.row_tokens):
            piece = ids[start : start + self.row_tokens]
            self.segments.append((doc_id, start, piece))
            self.tokens += len(piece)

    def rows(self) -> list[list[tuple[int | None, int, np.ndarray]]]:
        packed = best_fit_decreasing([len(s[2]) for s in self.segments], self.row_tokens)
        return [[self.segments[i] for i in row] for row in packed]


def _batch(rows: list, first: int, row_tokens: int, pad: int, kind: str) -> pa.RecordBatch:
    n = len(rows)
    ids = np.full((n, row_tokens), pad, kind)
    positions = np.zeros((n, row_tokens), kind)
    ramp = np.arange(row_tokens).astype(kind)
    ends, docs, starts = [], [], []
    for i, row in enumerate(rows):
        at, cuts = 0, [0]
        for _, _, piece in row:
            ids[i, at : at + len(piece)] = piece
            positions[i, at : at + len(piece)] = ramp[: len(piece)]
            at += len(piece)
            cuts.append(at)
        ends.append(cuts)
        docs.append([s[0] for s in row])
        starts.append([s[1] for s in row])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + n)),
            pa.array([c[-1] for c in ends], pa.int64()),
            pa.array([r.tobytes() for r in ids], pa.binary()),
            pa.array([r.tobytes() for r in positions], pa.binary()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array(docs, pa.list_(pa.int64())),
            pa.array(starts, pa.list_(pa.int64())),
        ],
        names=PACKED.names,
    )


def pack(
    encoded: DataFrame, vocabulary_size: int, row_tokens: int = ROW_TOKENS, pad: int | None = None, doc_id: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """Packed rows of documents given as ids in little-endian unsigned 32-bit integers.

    Ids and positions are written in 16 bits if vocabulary and row length allow, else in 32. ``pad`` is by default the first id beyond the
    vocabulary.
    """
    pad = vocabulary_size if pad is None else pad
    kind = "<u2" if max(pad, vocabulary_size, row_tokens) < 1 << 16 else "<u4"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        next_id = (context.partitionId() if context else 0) << 40
        block = _Block(row_tokens)

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, block
            rows = block.rows()
            block = _Block(row_tokens)
            for at in range(0, len(rows), 512):
                part = rows[at : at + 512]
                yield _batch(part, next_id, row_tokens, pad, kind)
                next_id += len(part)

        for batch in batches:
            names, cells = batch.column(0).to_pylist(), batch.column(1)
            for name, cell in zip(names, cells):
                raw = cell.as_py()
                if raw:
                    block.add(name, np.frombuffer(raw, "<u4"))
                    if block.tokens >= BLOCK_TOKENS:
                        yield from packed()
        yield from packed()

    return encoded.select(F.col(doc_id).cast("long"), ids).mapInArrow(run, PACKED)


def write_packed(packed: DataFrame, path: str | None = None) -> DataFrame:
    """Write the packed matrix, one row each, to ``path`` (by default a new scratch table) and read it back."""
    if path is None:
        return materialize(packed, "packed-ids")
    packed.write.parquet(path)
    return packed.sparkSession.read.schema(PACKED).parquet(path)


def unpack(packed: DataFrame, row_bytes: int = 2) -> DataFrame:
    """``(doc_id, start, ids)`` of every segment: the ids of a document in the order of ``start`` are what was packed."""
    size = F.col("cu_seqlens")
    segments = packed.select("ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "starts")).alias("n", "s"))
    begin, end = F.element_at(size, F.col("n") + 1), F.element_at(size, F.col("n") + 2)
    return segments.select(
        F.col("s.doc_ids").alias("doc_id"), F.col("s.starts").alias("start"),
        F.substring("ids", begin * row_bytes + 1, (end - begin) * row_bytes).alias("ids"),
    )
