"""Near duplicates by HyperMinHash sketches, confirmed on full shingle sets.

Sketch. The hashes of a document's distinct shingles are dealt into buckets by their first bits; of the smallest
remainder of each bucket only the number of leading zeros and the next bits (the mantissa) are kept, 16 bits a register.
Documents of any length have ``REGISTERS`` registers: one sketch of 128 buckets for a long one, more sketches of fewer buckets
under different permutations for a shorter one, so that a bucket is hardly ever empty. The split depends on a size class; documents
near the edge of a class (within the similarity) are sketched in both, so any two that can be linked meet in one.

Candidates. Bands of ``BAND`` neighbouring registers are the keys of buckets of distinct sets.
 1. In every bucket each set is paired with the bucket's first one (by a hash, another one in each band). Pairs whose
    collision-corrected estimate is far below the similarity are dropped, the rest is confirmed on full sets, and
    components of the confirmed links are formed. Copies of one text never get here: equal sets are one row.
 2. All pairs of step 1 that passed the estimate, confirmed or not, join sets into clusters. In a cluster with several components every set outside
    the largest is compared with all sets of the cluster, exactly, by blocks of a bounded number of shingles.
 3. In every bucket that holds several clusters, all pairs across clusters are estimated, by blocks of the bucket; what passes is
    confirmed as well. So neither one task nor one row list ever holds a whole bucket or cluster.
A pair within one component needs no check: the result is components. The chance that linked sets share no band is
(1 - 0.8^4)^32 < 1e-7 at the very threshold and smaller above it; estimates are dropped ``SLACK_SIGMAS`` standard
errors below the threshold. Shingle sets are compared by 64-bit hashes, sets by 128 bits.

Defined cases: null or empty text, or white space only: no shingles, its own component, kept. Fewer words than a shingle: the
whole sequence is the one shingle. Rows with the same id are one document each; a null id sorts after all others, its component is the
smallest id reached, null if there is none. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from textloom.llm.bpe import ragged
from textloom.llm.components import components
from textloom.llm.scan import Hashes, mix, row_blocks, text_bytes, text_column, windows, word_spans
from textloom.llm.tables import BlockedFilter, build_filter, checked_join, written
from textloom.sources.scratch import materialize

REGISTERS = 128
MANTISSA_BITS = 10
MIN_OCCUPANCY = 4
BAND = 4
SLACK_SIGMAS = 4.5
BLOCK_SETS = 256
BLOCK_SHINGLES = 100_000

_MAX_CLASS = REGISTERS.bit_length() - 1
_U64 = np.uint64


def size_class(n: np.ndarray) -> np.ndarray:
    """Bits of the number of buckets per sketch of a set of ``n``."""
    return np.clip(np.floor(np.log2(np.maximum(n, 1) / MIN_OCCUPANCY)), 0, _MAX_CLASS).astype(np.int64)


def bit_length(x: np.ndarray) -> np.ndarray:
    x, n = x.copy(), np.zeros(len(x), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        big = x >> _U64(step) != 0
        n[big] += step
        x[big] >>= _U64(step)
    return n + (x != 0)


def sketches(hashes: np.ndarray, owner: np.ndarray, n_owners: int, bits: int) -> np.ndarray:
    """Compressed registers, one row per owner, of sets given as flat hashes, for one size class."""
    buckets = 1 << bits
    lowest = np.full(n_owners * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for turn in range(REGISTERS // buckets):
        dealt = mix(hashes, 1000 + turn)
        place = owner * REGISTERS + turn * buckets
        if bits:
            place = place + (dealt >> _U64(64 - bits)).astype(np.int64)
        np.minimum.at(lowest, place, dealt << _U64(bits))
    length = bit_length(lowest)
    zeros = np.minimum(64 - length, 63)
    shifted = lowest << np.minimum(zeros + 1, 63).astype(_U64)
    mantissa = (shifted >> _U64(64 - MANTISSA_BITS)).astype(np.int64)
    register = (zeros << MANTISSA_BITS) | mantissa
    register[lowest == np.iinfo(np.uint64).max] = 0xFFFF  # empty
    return register.astype("<u2").reshape(n_owners, REGISTERS)


def band_keys(registers: np.ndarray, bits: int) -> np.ndarray:
    """One key per band, one row per set."""
    bands = np.ascontiguousarray(registers).view("<u8").astype(np.uint64)
    salt = np.arange(bands.shape[1], dtype=np.uint64) + _U64(100 * bits + 7)
    return mix(mix(bands) + salt * _U64(0x9E3779B97F4A7C15))


def accidental(n_a: np.ndarray, n_b: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Share of registers at which two disjoint sets agree by chance: same leading zeros, same mantissa."""
    share_a, share_b = (n_a / buckets)[:, None], (n_b / buckets)[:, None]
    upper = 0.5 ** np.arange(0, 64)[None, :]
    lower = upper / 2

    def level(share: np.ndarray) -> np.ndarray:  # the bucket's smallest value lies in [lower, upper)
        return np.exp(-share * lower) - np.exp(-share * upper)

    return (level(share_a) * level(share_b)).sum(axis=1) / 2**MANTISSA_BITS


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the registers of two sets, corrected for accidental collisions."""
    filled = (a != 0xFFFF) | (b != 0xFFFF)
    same = ((a == b) & filled).sum(axis=1)
    chance = accidental(n_a, n_b, 2.0**bits)
    share = same / np.maximum(filled.sum(axis=1), 1)
    return (share - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    return similarity - SLACK_SIGMAS * math.sqrt(similarity * (1 - similarity) / REGISTERS)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row of the column and sorted distinct shingle hashes of its text, for every row."""
    for start, stop in row_blocks(column):
        data, rows = text_bytes(column.slice(start, stop - start))
        begin, end = word_spans(data)
        hashes = Hashes(data, fold_case=True).of(begin, end)
        runs = windows(hashes, width)
        cuts = np.searchsorted(begin, rows).tolist()
        for row in range(start, stop):
            i, j = cuts[row - start], cuts[row - start + 1]
            if j - i >= width:
                yield row, np.unique(runs[i : j - width + 1])
            elif j > i:
                yield row, mix(windows(hashes[i:j], j - i), 77 + j - i)
            else:
                yield row, hashes[:0]


def _sketch_batches(width: int, similarity: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch.column(1))
            for at in range(0, len(column), 1024):
                part = column.slice(at, 1024)
                sets = [s for _, s in shingle_sets(part, width)]
                n = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
                ends = np.cumsum(n)
                digests = []
                for salt in (1, 2):
                    sums = np.concatenate(([_U64(0)], np.cumsum(mix(flat, salt), dtype=np.uint64)))
                    digests.append((sums[ends] - sums[ends - n]).view(np.int64))
                owner = np.repeat(np.arange(len(sets)), n)
                columns = []
                own = size_class(n)
                next_class = size_class(np.floor(n / similarity))
                for classes, wanted in ((own, n > 0), (next_class, (n > 0) & (next_class != own))):
                    cells: list[bytes | None] = [None] * len(sets)
                    for bits in np.unique(classes[wanted]).tolist():
                        rows = np.flatnonzero(wanted & (classes == bits))
                        number = np.full(len(sets), -1)
                        number[rows] = np.arange(len(rows))
                        mine = number[owner] >= 0
                        found = sketches(flat[mine], number[owner[mine]], len(rows), bits)
                        for i, row in enumerate(rows.tolist()):
                            cells[row] = found[i].tobytes()
                    columns.append(pa.array(cells, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1024), batch.column(2).slice(at, 1024), pa.array(n), *map(pa.array, digests), *columns],
                    names=["id", "k", "n", "d1", "d2", "own", "next"],
                )

    return run


def _registers(column: pa.Array) -> np.ndarray:
    """Registers of a binary column without nulls, one row per cell."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), REGISTERS)


def _band_rows(similarity: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, n = batch.column(0), batch.column(1).to_numpy()
            for name, classes in (("own", size_class(n)), ("next", size_class(np.floor(n / similarity)))):
                column = batch.column(batch.schema.names.index(name))
                has = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                for bits in np.unique(classes[has]).tolist():
                    rows = has[classes[has] == bits]
                    keys = band_keys(_registers(column.take(pa.array(rows))), bits)
                    ids = np.repeat(sid.to_numpy()[rows], keys.shape[1])
                    flat = keys.ravel().view(np.int64)
                    for at in range(0, len(flat), 65536):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(flat[at : at + 65536]), pa.array(ids[at : at + 65536])], names=["key", "sid"]
                        )

    return run


def _common_class(n_a: np.ndarray, n_b: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size class in which both sets are sketched, and whether it is each one's second; -1 if there is none."""
    own_a, own_b = size_class(n_a), size_class(n_b)
    next_a, next_b = size_class(np.floor(n_a / similarity)), size_class(np.floor(n_b / similarity))
    bits = np.where(own_a == own_b, own_a, np.where(next_a == own_b, own_b, np.where(next_b == own_a, own_a, -1)))
    return bits, (bits >= 0) & (bits != own_a), (bits >= 0) & (bits != own_b)


def _estimated(similarity: float):
    """Drop pairs whose sizes or estimates rule out the similarity."""
    least = least_estimate(similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            n_a, n_b = get["n_a"].to_numpy(), get["n_b"].to_numpy()
            bits, second_a, second_b = _common_class(n_a, n_b, similarity)
            fits = (bits >= 0) & (np.minimum(n_a, n_b) >= similarity * np.maximum(n_a, n_b) - 1e-9)
            rows = np.flatnonzero(fits)
            if not len(rows):
                continue
            own_a, next_a, own_b, next_b = (get[c].to_pylist() for c in ("own_a", "next_a", "own_b", "next_b"))
            a = np.frombuffer(b"".join(next_a[i] if second_a[i] else own_a[i] for i in rows.tolist()), "<u2")
            b = np.frombuffer(b"".join(next_b[i] if second_b[i] else own_b[i] for i in rows.tolist()), "<u2")
            found = estimate(a.reshape(-1, REGISTERS), b.reshape(-1, REGISTERS), n_a[rows], n_b[rows], bits[rows])
            rows = pa.array(rows[found >= least])
            yield pa.RecordBatch.from_arrays([get["a"].take(rows), get["b"].take(rows)], names=["a", "b"])

    return run


def _set_batches(width: int, words: Broadcast):
    """Full sets of the texts whose key the filter holds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = BlockedFilter(words.value)
        for batch in batches:
            batch = batch.filter(pa.array(held.holds(batch.column(0).to_numpy())))
            column = text_column(batch.column(1))
            for at in range(0, len(column), 512):
                part = column.slice(at, 512)
                sets = [s for _, s in shingle_sets(part, width)]
                digests = [
                    np.array([mix(s, salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for salt in (1, 2)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, digests), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["d1", "d2", "shingles"],
                )

    return run


def _confirmed(similarity: float):
    hundredths = round(100 * similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            last, last_bytes = None, None
            for i in range(batch.num_rows):
                cell = left[i].as_py()
                if cell != last_bytes:
                    last, last_bytes = np.frombuffer(cell, np.uint64), cell
                other = np.frombuffer(right[i].as_py(), np.uint64)
                at = np.minimum(np.searchsorted(last, other), len(last) - 1)
                common = int((last[at] == other).sum())
                if 100 * common >= hundredths * (len(last) + len(other) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose full sets are similar enough; the sets travel by join, hot sides are split by the adaptive join."""
    left = pairs.join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("sa")).hint("merge"), "a")
    both = left.join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("sb")).hint("merge"), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(_confirmed(similarity), "a long, b long")


def _across(similarity: float):
    """Pairs across components within groups ``(key, block)`` of rows sorted by it: visitors against residents."""
    least = least_estimate(similarity)

    def group_pairs(rows: dict[str, np.ndarray], registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        residents = np.flatnonzero(~rows["visitor"])
        out_a, out_b = [], []
        for v in np.flatnonzero(rows["visitor"]).tolist():
            near = residents[(rows["comp"][residents] != rows["comp"][v]) & (rows["sid"][residents] != rows["sid"][v])]
            sizes = rows["n"][near], rows["n"][v]
            near = near[np.minimum(*sizes) >= similarity * np.maximum(*sizes) - 1e-9]
            if not len(near):
                continue
            bits = np.full(len(near), rows["bits"][v])
            found = estimate(registers[near], registers[v][None, :], rows["n"][near], np.full(len(near), rows["n"][v]), bits)
            near = near[found >= least]
            out_a.append(np.minimum(rows["sid"][near], rows["sid"][v]))
            out_b.append(np.maximum(rows["sid"][near], rows["sid"][v]))
        if not out_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_a), np.concatenate(out_b)

    names = ["key", "block", "sid", "comp", "n", "bits", "visitor"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None

        def pairs_of(table: pa.Table) -> pa.RecordBatch:
            rows = {c: table[c].to_numpy() for c in names}
            rows["visitor"] = rows["visitor"].astype(bool)
            registers = _registers(table["registers"].combine_chunks())
            edge = np.flatnonzero((np.diff(rows["key"]) != 0) | (np.diff(rows["block"]) != 0)) + 1
            cuts = [0, *edge.tolist(), table.num_rows]
            found = [
                group_pairs({c: x[i:j] for c, x in rows.items()}, registers[i:j]) for i, j in zip(cuts, cuts[1:])
            ]
            a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            both = np.unique(np.stack([a, b]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if waiting is not None:
                table = pa.concat_tables([waiting, table])
            last = (table["key"][-1].as_py(), table["block"][-1].as_py()) if table.num_rows else None
            if last is None:
                continue
            same = (table["key"].to_numpy() == last[0]) & (table["block"].to_numpy() == last[1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            waiting = table.slice(cut)
            if cut:
                yield pairs_of(table.slice(0, cut))
        if waiting is not None and waiting.num_rows:
            yield pairs_of(waiting)

    return run


def _likely(pairs: DataFrame, sketch_of: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs ``(a, b)`` whose sizes and estimates do not rule out the similarity, written."""
    def side(name: str) -> DataFrame:
        return sketch_of.select(F.col("sid").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "own", "next")])

    distinct = pairs.select(F.least("sid", "first").alias("a"), F.greatest("sid", "first").alias("b")).distinct()
    return materialize(distinct.join(side("a"), "a").join(side("b"), "b").mapInArrow(_estimated(similarity), "a long, b long"), "pairs")


def first_document():
    """Ordering by which the first document of a set or a component stays: the smallest id, null last."""
    return F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("k").alias("c"))


def set_components(docs: DataFrame, width: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Documents with the digest of their set, ``(id, k, n, d1, d2)``, and the component of every distinct set of some
    shingles: ``(d1, d2, sid, id, k, comp)``, where ``comp`` is the smallest ``sid`` reached, and id and ``k``, a hash of the text, name
    the set's first document."""
    narrow = docs.select("id", "text", F.xxhash64("text").alias("k"))
    sketched = materialize(
        narrow.mapInArrow(
            _sketch_batches(width, similarity),
            f"id {docs.schema['id'].dataType.simpleString()}, k long, n long, d1 long, d2 long, own binary, next binary",
        ),
        "sketches",
    )
    distinct = sketched.filter("n > 0").groupBy("d1", "d2").agg(
        F.min_by(F.struct("id", "k"), first_document()).alias("w"), F.first("n").alias("n"), F.first("own").alias("own"), F.first("next").alias("next")
    )
    distinct = distinct.select("d1", "d2", "w.id", "w.k", "n", "own", "next")
    classes = materialize(distinct.withColumn("sid", F.monotonically_increasing_id()), "sets")
    bands = classes.select("sid", "n", "own", "next").mapInArrow(_band_rows(similarity), "key long, sid long")
    per_key = bands.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min_by("sid", F.xxhash64("key", "sid")).alias("first")
    ).filter("members > 1")
    members = materialize(bands.join(per_key.hint("merge"), "key"), "buckets")

    sketch_of = classes.select("sid", "n", "own", "next")

    # Full sets of the sets that share a bucket, taken from the text of one document of each.
    wanted = members.select("sid").distinct().join(classes.select("sid", "id", "d1", "d2"), "sid")
    wanted, seen = written(wanted.withColumn("key", F.xxhash64("id")), "wanted")
    near = build_filter(wanted, "key", seen["rows"])
    keyed = docs.select(F.xxhash64("id").alias("key"), "text")
    full = keyed.mapInArrow(_set_batches(width, near), "d1 long, d2 long, shingles binary")
    sets = full.join(wanted.select("sid", "d1", "d2"), ["d1", "d2"]).groupBy("sid").agg(F.first("shingles").alias("shingles"))
    sets = materialize(sets, "full-sets")

    likely = _likely(members.filter("sid <> first").select("sid", "first"), sketch_of, similarity)
    links = materialize(_confirm(likely, sets, similarity), "confirmed")
    # Components of the confirmed links and of all likely pairs, in one go: two graphs side by side.
    beside = [F.col(c) * 2 + 1 for c in ("a", "b")]
    both = links.select((F.col("a") * 2).alias("a"), (F.col("b") * 2).alias("b")).unionByName(likely.select(beside[0].alias("a"), beside[1].alias("b")))
    both = materialize(components(both), "components").select(
        F.shiftright("node", 1).alias("sid"), F.shiftright("component", 1).alias("comp"), F.col("node") % 2 == 1
    ).toDF("sid", "comp", "likely")
    linked = both.filter("NOT likely").drop("likely")
    clusters = both.filter("likely").drop("likely").withColumnRenamed("comp", "cluster")

    # Within clusters of likely pairs: every set outside the cluster's largest component against all sets, exactly.
    inside = clusters.join(linked.hint("merge"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    inside = materialize(inside.join(classes.select("sid", "n").hint("merge"), "sid"), "cluster-rows")
    tallies = inside.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    per_cluster = tallies.groupBy("cluster").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("n").alias("n")
    ).filter("comps > 1")
    per_cluster = per_cluster.select("cluster", "main", F.ceil(F.col("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    more = []
    per_cluster, seen = written(per_cluster, "open-clusters")
    if seen["rows"]:
        rows = inside.drop("n").join(per_cluster.hint("merge"), "cluster")
        own_block = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
        residents = rows.select("cluster", own_block.alias("block"), F.lit(False).alias("visitor"), "sid", "comp")
        visitors = rows.filter("comp <> main").select(
            "cluster", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("visitor"), "sid", "comp"
        )
        order = ["cluster", "block", "visitor"]
        dealt = residents.unionByName(visitors).join(sets.hint("merge"), "sid").select(*order, "sid", "comp", "shingles")
        dealt = dealt.repartition("cluster", "block").sortWithinPartitions(*order)
        found, seen = written(dealt.mapInArrow(_exact_across(similarity), "a long, b long"), "confirmed")
        more += [found] * bool(seen["rows"])

    # Across clusters: what shares a bucket.
    placed = members.select("key", "sid").join(clusters.withColumnRenamed("cluster", "comp").hint("merge"), "sid", "left")
    placed = materialize(placed.withColumn("comp", F.coalesce("comp", "sid")), "placed")
    tallies = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    per_key = tallies.groupBy("key").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("c").alias("members"),
        (F.sum("c") - F.max("c")).alias("outside"),
    ).filter("comps > 1")
    # Residents and visitors are both cut into blocks, so a task holds one block of each.
    blocks_of = [F.greatest(F.ceil(n / BLOCK_SETS), F.lit(1)).cast("int").alias(c) for c, n in (("blocks", F.col("members")), ("turns", F.col("outside")))]
    per_key, seen = written(per_key.select("key", "main", *blocks_of), "open-buckets")
    if seen["rows"]:
        rows = placed.join(per_key.hint("merge"), "key")
        own_block = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int").alias("block")
        own_turn = F.pmod(F.xxhash64("sid", F.lit(1)), F.col("turns")).cast("int").alias("turn")
        residents = rows.select("key", "sid", "comp", F.lit(False).alias("visitor"), own_block, F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"))
        visitors = rows.filter("comp <> main").select(
            "key", "sid", "comp", F.lit(True).alias("visitor"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), own_turn
        )
        # A tile is one block against one turn of visitors, numbered together.
        tile = (F.col("turn").cast("long") * F.lit(1 << 31) + F.col("block")).alias("block")
        dealt = residents.unionByName(visitors).select("key", "sid", "comp", "visitor", tile)
        # A bucket's key belongs to one size class; each row brings the registers of that class.
        with_sketch = dealt.join(sketch_of.hint("merge"), "sid")
        grouped = with_sketch.mapInArrow(
            _class_registers(similarity), "key long, block long, sid long, comp long, n long, bits int, visitor boolean, registers binary"
        )
        grouped = grouped.repartition("key", "block").sortWithinPartitions("key", "block")
        pairs, seen = written(grouped.mapInArrow(_across(similarity), "a long, b long").distinct(), "pairs")
        if seen["rows"]:
            found, seen = written(_confirm(pairs, sets, similarity), "confirmed")
            more += [found] * bool(seen["rows"])

    comp = classes.select("sid", "id", "k", "d1", "d2").join(linked.hint("merge"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    if more:  # links between components: their own components, over what is one already
        named = materialize(comp.select("sid", "comp"), "components")
        between = reduce(DataFrame.unionByName, more).join(named.select(F.col("sid").alias("a"), F.col("comp").alias("x")).hint("merge"), "a")
        between = between.join(named.select(F.col("sid").alias("b"), F.col("comp").alias("y")).hint("merge"), "b").select("x", "y")
        reached = materialize(components(between, "x", "y"), "components").select(F.col("node").alias("comp"), F.col("component").alias("_lowest"))
        comp = comp.join(reached.hint("merge"), "comp", "left").withColumn("comp", F.coalesce("_lowest", "comp")).drop("_lowest")
    return sketched.select("id", "k", "n", "d1", "d2"), comp


def _exact_across(similarity: float):
    """Links across components within groups ``(cluster, block)`` of rows sorted by it, residents before visitors.

    Only the residents' shingles are held, sorted with their owners; visitors pass one by one. Of several residents of one
    component that a visitor is linked with, one link is given.
    """
    hundredths = round(100 * similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, index = None, None
        sids: list[int] = []
        comps: list[int] = []
        held: list[np.ndarray] = []
        for batch in batches:
            out_a, out_b = [], []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for cluster, block, visitor, sid, comp, cell in zip(*columns):
                if (cluster, block) != group:
                    group, index, sids, comps, held = (cluster, block), None, [], [], []
                shingles = np.frombuffer(cell, np.uint64)
                if not visitor:
                    sids.append(sid)
                    comps.append(comp)
                    held.append(shingles)
                    continue
                if not held:
                    continue
                if index is None:
                    flat = np.concatenate(held)
                    owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
                    by_hash = np.argsort(flat, kind="stable")
                    index = flat[by_hash], owner[by_hash], np.array([len(h) for h in held])
                flat, owner, sizes = index
                low = np.searchsorted(flat, shingles, "left")
                common = np.bincount(
                    owner[ragged(low, np.searchsorted(flat, shingles, "right") - low)], minlength=len(sizes)
                )
                found = 100 * common >= hundredths * (sizes + len(shingles) - common)
                seen = {comp}
                for i in np.flatnonzero(found).tolist():
                    if comps[i] not in seen:
                        seen.add(comps[i])
                        out_a.append(min(sid, sids[i]))
                        out_b.append(max(sid, sids[i]))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return run


def _class_registers(similarity: float):
    """Registers of the class to which the row's bucket belongs, found by recomputing the keys of its bands."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            get = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            n, key = get["n"].to_numpy(), get["key"].to_numpy().view(np.uint64)
            own, second = get["own"].to_pylist(), get["next"].to_pylist()
            own_bits, next_bits = size_class(n), size_class(np.floor(n / similarity))
            cells, bits = list(own), own_bits.copy()
            unsure = [i for i, cell in enumerate(second) if cell is not None]
            for i in unsure:
                registers = np.frombuffer(second[i], "<u2").reshape(1, REGISTERS)
                if key[i] in band_keys(registers, int(next_bits[i]))[0]:
                    cells[i], bits[i] = second[i], next_bits[i]
            yield pa.RecordBatch.from_arrays(
                [get["key"], get["block"], get["sid"], get["comp"], get["n"], pa.array(bits, pa.int32()), get["visitor"], pa.array(cells, pa.binary())],
                names=["key", "block", "sid", "comp", "n", "bits", "visitor", "registers"],
            )

    return run


def near_duplicates(
    docs: DataFrame, width: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    documents, sets = set_components(rows, width, similarity)
    lowest = sets.groupBy("comp").agg(F.min("id").alias("component"))
    known = materialize(sets.join(lowest, "comp").select("d1", "d2", "component"), "set-components")
    empty = documents.filter("n = 0").select("id", "n", F.col("id").alias("component"))
    full = checked_join(documents.filter("n > 0"), known, ["d1", "d2"], "inner").select("id", "n", "component")
    return full.unionByName(empty).select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def keep_first(docs: DataFrame, width: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component, with all its columns: the smallest id. Texts without words all stay."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    documents, sets = set_components(rows, width, similarity)
    winners = sets.groupBy("comp").agg(F.min_by(F.struct("id", "k"), first_document()).alias("w"))
    known = materialize(sets.join(winners, "comp").select("d1", "d2", F.col("w.id").alias("w_id"), F.col("w.k").alias("w_k")), "set-winners")
    judged = checked_join(documents.filter("n > 0"), known, ["d1", "d2"], "inner")
    wins = F.col("id").eqNullSafe(F.col("w_id")) & (F.col("k") == F.col("w_k"))
    counted = judged.groupBy("id", "k").agg(F.min(wins.cast("int")).alias("wins"), F.count(F.lit(1)).alias("rows"))
    marks = materialize(
        counted.filter("wins = 0 OR rows > 1").select(F.col("id").alias("_m_id"), F.col("k").alias("_m_k"), "wins"), "losers"
    )
    keyed = docs.select(
        F.struct(F.col("*")).alias("_row"), F.col(doc_id).alias("_id"), F.xxhash64(F.col(text).cast("string")).alias("_k")
    )
    marked = checked_join(keyed, marks, F.col("_id").eqNullSafe(F.col("_m_id")) & (F.col("_k") == F.col("_m_k")), "left")
    kept = marked.filter("wins IS NULL OR wins = 1")
    if marks.filter("wins = 1").isEmpty():
        return kept.select("_row.*")
    # Rows equal in id and text: one of them.
    one = kept.filter("wins = 1").withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_k").orderBy(F.xxhash64("_row"))))
    return kept.filter("wins IS NULL").select("_row.*").unionByName(one.filter("_n = 1").select("_row.*"))
