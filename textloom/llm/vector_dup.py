"""Near duplicates among embeddings by p-stable hashing for the Euclidean distance, confirmed by exact cosines.

Hashing. A vector of length one is projected on ``k`` normal directions, shifted, and cut into steps of ``WIDTH``: the ``k`` step numbers are its
bucket in one table. Vectors of cosine c lie sqrt(2 - 2c) apart and share a step with a known chance, so ``k`` follows from the number of
vectors (strangers, taken as orthogonal, meet ``STRANGERS`` times a bucket) and the number of tables from the least cosine (a
pair at the very threshold is missed with chance ``MISS``, a closer one far less often). Both grow slowly with the table.

Comparison. Equal vectors are one class. Only classes that share a bucket travel with their vectors. A bucket is cut into blocks of about
``BLOCK`` classes and every two blocks meet in a tile of their own, so no task holds a bucket and a bucket of any size is compared
whole. A tile compares by matrix product in double precision and hands on, for every class, how many it is linked with, and the class
that stands for its part of the tile; linked pairs are never written out. A pair that meets in several tables is counted in the first
one only, which the tile sees from the classes' buckets.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component links with nothing: no links, its own
component, kept. Vectors of different length are never linked. Rows of equal vectors are linked with each other. A null id sorts after all
others; its component is the smallest id reached, null if there is none. Rows of the same id are rows of their own. Entries may be of any
finite size: vectors are scaled by a power of two first. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from textloom.llm.components import components
from textloom.llm.scan import mix
from textloom.llm.tables import checked_join
from textloom.sources.scratch import materialize

WIDTH = 2.0
STRANGERS = 0.05
MISS = 2e-3
BLOCK = 512
#: Groups up to this size are compared side by side, larger ones by matrix product.
SMALL = 12
SEED = 20240607

_U64 = np.uint64


def step_chance(distance: float, width: float = WIDTH) -> float:
    """Chance that two points this far apart fall into the same step of one projection."""
    if distance <= 0:
        return 1.0
    ratio = width / distance
    return math.erf(ratio / math.sqrt(2)) - math.sqrt(2 / math.pi) / ratio * (1 - math.exp(-ratio * ratio / 2))


def plan(count: int, cosine: float) -> tuple[int, int]:
    """Projections a table and number of tables for ``count`` vectors."""
    stranger, linked = step_chance(math.sqrt(2)), step_chance(math.sqrt(max(2 - 2 * cosine, 1e-6)))
    k = max(4, math.ceil(math.log(max(count, 1) / STRANGERS) / -math.log(stranger)))
    return k, max(1, math.ceil(math.log(MISS) / math.log1p(-(linked**k))))


def scaled(cells: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest entry is near one; cosines stay what they are, to the last bit."""
    _, exponent = np.frexp(np.abs(cells).max(axis=1, initial=0))
    return np.ldexp(cells, -exponent[:, None])


def _sound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, digest, vector)``; digest and vector (doubles, scaled) are null where nothing can be linked."""
    for batch in batches:
        column = batch.column(1)
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        digests: list[bytes | None] = [None] * len(column)
        vectors: list[bytes | None] = [None] * len(column)
        for dims in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == dims)
            cells = column.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dims)
            fine = np.isfinite(cells).all(axis=1) & (cells != 0).any(axis=1)
            cells = cells[fine] + 0.0  # no negative zeros
            whole = scaled(cells)
            for i, row in enumerate(rows[fine].tolist()):
                vectors[row] = whole[i].tobytes()
                digests[row] = hashlib.blake2b(cells[i].tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())], names=["id", "digest", "vector"])


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a binary column and their vectors, one length after another."""
    cells = column.to_pylist()
    lengths = np.array([len(c) for c in cells], np.int64)
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        yield rows, np.frombuffer(b"".join(cells[i] for i in rows.tolist()), np.float64).reshape(len(rows), size // 8)


def bucket_keys(vectors: np.ndarray, k: int, tables: int) -> np.ndarray:
    """One 32-bit bucket number per vector and table."""
    dims = vectors.shape[1]
    random = np.random.default_rng([SEED, dims])
    normals, shifts = random.normal(size=(dims, tables * k)), random.uniform(0, WIDTH, tables * k)
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    steps = np.floor((unit @ normals + shifts) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(vectors), tables, k)
    total = np.full(steps.shape[:2], _U64(dims))
    for i in range(k):
        total = mix(total * _U64(0xD6E8FEB86659FD93) + steps[:, :, i])
    return (total >> _U64(32)).astype(np.uint32)


def _keyed(k: int, tables: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cells: list[bytes | None] = [None] * part.num_rows
                for rows, vectors in _by_length(part.column(part.schema.names.index("vector"))):
                    for row, own in zip(rows.tolist(), bucket_keys(vectors, k, tables)):
                        cells[row] = own.tobytes()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, pa.binary())], names=[*part.schema.names, "buckets"])

    return run


def _band_rows(tables: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                if not part.num_rows:
                    continue
                own = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, tables).astype(np.int64)
                keys = (own + (np.arange(tables, dtype=np.int64) << 32)).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(part.column(0).to_numpy(), tables))], names=["key", "sid"])

    return run


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a @ b.T) / np.sqrt(np.outer((a * a).sum(axis=1), (b * b).sum(axis=1)))


class _Tile:
    """Rows of one group of batches, as arrays."""

    def __init__(self, table: pa.Table, tables: int):
        column = {name: table[name] for name in table.column_names}
        self.sid, self.copies = column["sid"].to_numpy(), column["copies"].to_numpy()
        self.key, self.low, self.high = (column[c].to_numpy() for c in ("key", "low", "high"))
        self.block = column["block"].to_numpy()
        self.buckets = np.frombuffer(b"".join(column["buckets"].to_pylist()), np.uint32).reshape(-1, tables)
        cells = column["vector"].to_pylist()
        self.size = np.array([len(c) for c in cells], np.int64)
        self.vector = np.zeros((len(cells), int(self.size.max(initial=0)) // 8))
        for rows, vectors in _by_length(column["vector"].combine_chunks()):
            self.vector[rows, : vectors.shape[1]] = vectors
        edge = (np.diff(self.key) != 0) | (np.diff(self.low) != 0) | (np.diff(self.high) != 0)
        self.start = np.concatenate(([0], np.flatnonzero(edge) + 1))
        self.stop = np.concatenate((self.start[1:], [len(self.key)]))
        self.group = np.repeat(np.arange(len(self.start)), self.stop - self.start)

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a tile is there for a pair: two blocks meet crosswise, one block with itself. Only vectors of one length are comparable."""
        return ((self.low[a] == self.high[a]) | (self.block[a] != self.block[b])) & (self.size[a] == self.size[b]) & (self.sid[a] != self.sid[b])

    def is_first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the table of this tile is the first one in which a pair meets."""
        table = (self.key[a] >> 32).astype(np.int64)
        return (self.buckets[a] == self.buckets[b]).argmax(axis=1) == table

    def links(self, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that are linked, by groups of a bounded size."""
        size = self.stop - self.start
        small = np.flatnonzero(size[self.group] <= SMALL)
        length = np.sqrt((self.vector * self.vector).sum(axis=1))
        for apart in range(1, SMALL):
            a = small[: max(0, len(small) - apart)]
            b = small[apart:]
            together = self.group[a] == self.group[b]
            a, b = a[together], b[together]
            for at in range(0, len(a), 4096):
                x, y = a[at : at + 4096], b[at : at + 4096]
                found = np.einsum("rd,rd->r", self.vector[x], self.vector[y]) / (length[x] * length[y]) >= cosine
                found &= self.may_link(x, y)
                yield x[found], y[found]
        for g in np.flatnonzero(size > SMALL).tolist():
            own = np.arange(self.start[g], self.stop[g])
            for at in range(0, len(own), BLOCK):
                some = own[at : at + BLOCK]
                x, y = np.nonzero(_cosines(self.vector[some], self.vector[own]) >= cosine)
                x, y = some[x], own[y]
                once = x < y
                x, y = x[once], y[once]
                fits = self.may_link(x, y)
                yield x[fits], y[fits]


def _tile_rows(cosine: float, tables: int):
    """``(a, b, links)``: with ``b`` null the number of rows linked with class ``a``; else two classes that are connected."""
    def found_in(table: pa.Table) -> pa.RecordBatch:
        tile = _Tile(table, tables)
        number = np.zeros(len(tile.sid), np.int64)
        stands = np.arange(len(tile.sid))
        for x, y in tile.links(cosine):
            for at in range(0, len(x), 1 << 14):
                a, b = x[at : at + (1 << 14)], y[at : at + (1 << 14)]
                first = tile.is_first(a, b)
                np.add.at(number, a[first], tile.copies[b[first]])
                np.add.at(number, b[first], tile.copies[a[first]])
            # Rows are joined by their lowest row, until every link has one on both sides.
            while len(x):
                low = np.minimum(stands[x], stands[y])
                np.minimum.at(stands, stands[x], low)
                np.minimum.at(stands, stands[y], low)
                while (stands[stands] != stands).any():
                    stands = stands[stands]
                open_ = stands[x] != stands[y]
                x, y = x[open_], y[open_]
        counted, joined = np.flatnonzero(number), np.flatnonzero(stands != np.arange(len(stands)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([tile.sid[counted], tile.sid[joined]])),
                pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(tile.sid[stands[joined]])]),
                pa.array(np.concatenate([number[counted], np.zeros(len(joined), np.int64)])),
            ],
            names=["a", "b", "links"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if waiting is not None:
                table = pa.concat_tables([waiting, table])
            last = table.slice(table.num_rows - 1)
            open_ = np.ones(table.num_rows, bool)
            for name in ("key", "low", "high"):
                open_ &= table[name].to_numpy() == last[name][0].as_py()
            cut = int(np.flatnonzero(~open_)[-1]) + 1 if not open_.all() else 0
            waiting = table.slice(cut)
            if cut:
                yield found_in(table.slice(0, cut))
        if waiting is not None:
            yield found_in(waiting)

    return run


def near_vectors(rows: DataFrame, cosine: float = 0.95, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(row_id, n_links, component_id, kept)`` of every row."""
    kind = rows.schema[row_id].dataType.simpleString()
    sound = rows.select(row_id, vector).mapInArrow(_sound, f"id {kind}, digest binary, vector binary")
    k, tables = plan(rows.count(), cosine)
    classes = sound.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.first("vector").alias("vector")
    )
    numbered = classes.withColumn("sid", F.monotonically_increasing_id()).select("sid", "digest", "copies", "id", "vector")
    classes = materialize(
        numbered.mapInArrow(_keyed(k, tables), f"sid long, digest binary, copies long, id {kind}, vector binary, buckets binary"), "vector-classes"
    )

    bands = classes.select("sid", "buckets").mapInArrow(_band_rows(tables), "key long, sid long")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = shared.select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    met = bands.join(blocks.hint("merge"), "key")
    block = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    placed = met.select("key", "sid", "blocks", block.alias("block"))
    # Block i meets every block j in the tile (least, greatest).
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiled = placed.select("key", "sid", "block", other.alias("other")).select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "sid"
    )
    full = materialize(tiled, "vector-tiles").join(classes.select("sid", "copies", "vector", "buckets").hint("merge"), "sid")
    dealt = full.select("key", "low", "high", "block", "sid", "copies", "vector", "buckets").repartition("key", "low", "high")
    dealt = dealt.sortWithinPartitions("key", "low", "high")
    found = materialize(dealt.mapInArrow(_tile_rows(cosine, tables), "a long, b long, links long"), "vector-links")

    reached = materialize(components(found.filter("b IS NOT NULL").select("a", "b").distinct()), "vector-components")
    counted = found.filter("b IS NULL").groupBy(F.col("a").alias("sid")).agg(F.sum("links").alias("links"))
    named = classes.select("sid", "digest", "copies", "id").join(counted.hint("merge"), "sid", "left").join(
        reached.select(F.col("node").alias("sid"), F.col("component").alias("comp")).hint("merge"), "sid", "left"
    )
    known = named.select("digest", "copies", "id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("comp", "sid").alias("comp"))
    known = materialize(known, "vector-known")
    lowest = known.groupBy("comp").agg(F.min("id").alias("component"))
    table = materialize(
        known.join(lowest.hint("merge"), "comp").select("digest", "component", (F.col("links") + F.col("copies") - 1).alias("n_links")), "vector-named"
    )
    judged = checked_join(sound.select("id", "digest"), table, ["digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component"))
    return judged.select(
        F.col("id").alias(row_id), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
