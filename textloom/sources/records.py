"""Large JSON arrays, and CSV files with line breaks inside their texts, each file read by as many tasks as it has splits.

Spark's text source cuts a file at any separator, wherever that stands: at closing braces or at line ends, also inside quoted texts. What a split starts
with, a text or a record, depends on everything before it. So the file is read twice: once to see what every split does to the state, for either
way it may start; the states are then carried along each file, one small row a split; the second time each split knows how it starts and gives
its records. A record that goes on into further splits is given in pieces, which are joined by the split that it began in.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# The helpers travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

SUMMARY = "file string, block long, odd int, turned array<int>, deep array<long>, low array<long>"
PIECE = "file string, owner long, block long, whole boolean, first boolean, value string"


@dataclass(frozen=True)
class Form:
    """How records are told: ``json`` elements of the outermost array, or ``csv`` lines that do not end inside quotes."""

    name: str
    separator: str


JSON = Form("json", "}")
CSV = Form("csv", "\n")


@dataclass
class _Scan:
    """A stretch of a split: where texts are, how deep it is nested, and where records may end and begin, if it starts outside (0) or inside a text."""

    data: np.ndarray
    inside: np.ndarray

    @classmethod
    def of(cls, form: Form, data: np.ndarray, odd: int) -> _Scan:
        quote = data == 0x22
        if form.name == "json":
            place = np.arange(len(data))
            plain = np.maximum.accumulate(np.where(data != 0x5C, place, -1))
            before = np.concatenate(([-1], plain[:-1]))
            quote &= (place - 1 - before) % 2 == 0  # not after an odd number of backslashes
        count = np.cumsum(quote, dtype=np.int64)
        return cls(data, ((count - quote + odd) & 1).astype(bool))

    def depth(self, start: int) -> np.ndarray:
        outside = ~self.inside
        opens = ((self.data == 0x7B) | (self.data == 0x5B)) & outside
        closes = ((self.data == 0x7D) | (self.data == 0x5D)) & outside
        return start + np.cumsum(opens.astype(np.int64) - closes)


def _stretches(batches: Iterable[pa.RecordBatch], separator: bytes) -> Iterator[tuple[str, int, np.ndarray]]:
    """File, split and bytes of one stretch after another; a stretch lies in one split and holds whole chunks with their separators."""
    for batch in batches:
        files, blocks = batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
        chunks = batch.column(0).cast(pa.binary()).to_pylist()
        start = 0
        for stop in range(1, len(chunks) + 1):
            if stop == len(chunks) or blocks[stop] != blocks[start] or files[stop] != files[start]:
                yield files[start], int(blocks[start]), np.frombuffer(separator.join(chunks[start:stop]) + separator, np.uint8)
                start = stop


def _summaries(form: Form):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # file, block, and for either start: inside a text, depth, least depth (csv: 0 if a record ended)

        def row() -> pa.RecordBatch:
            file, block, states = held
            cells = [[file], [block], [states[0][0]], [[s[0] for s in states]], [[s[1] for s in states]], [[s[2] for s in states]]]
            types = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=["file", "block", "odd", "turned", "deep", "low"])

        for file, block, data in _stretches(batches, form.separator.encode()):
            if held and (file, block) != (held[0], held[1]):
                yield row()
                held = []
            if not held:
                held = [file, block, [[0, 0, 0 if form.name == "json" else 1], [1, 0, 0 if form.name == "json" else 1]]]
            for state in held[2]:
                scan = _Scan.of(form, data, state[0])
                if form.name == "json":
                    depth = scan.depth(state[1])
                    state[1], state[2] = int(depth[-1]), min(state[2], int(depth.min()))
                elif (~scan.inside & (data == 0x0A)).any():
                    state[2] = 0
                state[0] = int(scan.inside[-1])  # the last byte is a separator
        if held:
            yield row()

    return run


def carried(rows: list, form: Form) -> dict[tuple[str, int], tuple[int, int, int]]:
    """How every split starts: inside a text, how deep, and the split in which the record began that it starts in."""
    out: dict[tuple[str, int], tuple[int, int, int]] = {}
    last = None
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != last:
            last, odd, depth, owner = r["file"], 0, 0, r["block"]
        out[r["file"], r["block"]] = (odd, depth, owner)
        low, deep, turned = r["low"][odd], r["deep"][odd], r["turned"][odd]
        began = depth + low <= 1 if form.name == "json" else odd == 0 or low == 0
        if began:  # the record that is open at the end, if any, began in this split
            owner = r["block"]
        odd, depth = turned, depth + deep
    return out


def _borders(form: Form, scan: _Scan, depth: int, opened: bool) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the records that begin in a stretch, and last bytes of those that end in it."""
    if form.name == "json":
        level = scan.depth(depth)
        before = np.concatenate(([depth], level[:-1]))
        return np.flatnonzero((level == 2) & (before == 1)), np.flatnonzero((level == 1) & (before == 2))
    ends = np.flatnonzero(~scan.inside & (scan.data == 0x0A))
    begins = np.concatenate(([] if opened else [0], ends + 1)).astype(np.int64)
    return begins[begins < len(scan.data)], ends


def _records(form: Form, starts):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = starts.value
        at: tuple | None = None
        odd, depth, owner = 0, 0, 0
        opened, began, first = False, False, False  # in a record; that began in this split; no record of the file was given yet
        parts: list[bytes] = []  # of the open record
        out: list[tuple] = []

        def give(value: bytes, whole: bool) -> None:
            nonlocal first
            out.append((at[0], owner, at[1], whole, first, value.decode("utf-8", "replace")))
            first = False

        def rows() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["file", "owner", "block", "whole", "first", "value"]
            )
            out.clear()
            return batch

        for file, block, data in _stretches(batches, form.separator.encode()):
            if (file, block) != at:
                if opened and parts:
                    give(b"".join(parts), False)
                at, parts, began = (file, block), [], False
                odd, depth, owner = known[at]
                opened = depth >= 2 if form.name == "json" else bool(odd)
                first = block == 0
            scan = _Scan.of(form, data, odd)
            begins, ends = _borders(form, scan, depth, opened)
            raw = data.tobytes()
            if opened:
                parts.append(raw[: int(ends[0]) + 1] if len(ends) else raw)
                if len(ends):
                    give(b"".join(parts), began)
                    opened, parts, ends = False, [], ends[1:]
            if not opened:
                owner = block
                for begin, end in zip(begins.tolist(), ends.tolist()):
                    give(raw[begin : end + 1], True)
                if len(begins) > len(ends):
                    opened, began, parts = True, True, [raw[int(begins[len(ends)]) :]]
            if form.name == "json":
                depth = int(scan.depth(depth)[-1])
            odd = int(scan.inside[-1])  # the last byte is a separator
            if len(out) >= 512:
                yield rows()
        if opened and parts:
            give(b"".join(parts), False)
        if out:
            yield rows()

    return run


def records(spark: SparkSession, path: str, form: Form) -> DataFrame:
    """``(value, first)``: every record of the files under ``path`` as text, and whether it is the first of a CSV file."""
    raw = spark.read.option("lineSep", form.separator).text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    seen = raw.mapInArrow(_summaries(form), SUMMARY).collect()  # one row a split
    starts = spark.sparkContext.broadcast(carried(seen, form))
    pieces = raw.mapInArrow(_records(form, starts), PIECE)
    parts = pieces.filter("NOT whole").groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", "value"))).alias("p"), F.max("first").alias("first")
    )
    joined = parts.select(F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"), "first")
    return pieces.filter("whole").select("value", "first").unionByName(joined)


def read_json_array(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Files that hold one JSON array of objects each, of any size; one row per object, empty ones are left out.

    Brackets, braces and line breaks may stand in texts. Elements that are no objects are left out. Rows come in no order.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = records(spark, path, JSON).select(F.from_json("value", wanted).alias("r")).select("r.*")
    return rows.dropna("all", subset=wanted.names)


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The columns of ``schema`` of CSV files whose quoted texts may hold line breaks, found by their names in the header that each file has.

    A quote stands only around a field, or doubled within one; lines end in LF or CRLF. An empty field is missing. Rows come in no order.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    header = spark.read.options(header="true", **options).csv(path).columns
    missing = [f.name for f in wanted if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header has {', '.join(header)}")
    layout = ", ".join(f"`{c}` string" for c in header)
    body = records(spark, path, CSV).filter("NOT first").select(F.regexp_replace("value", r"\r?\n$", "").alias("value")).filter("value <> ''")
    rows = body.select(F.from_csv("value", layout, options).alias("r"))
    return rows.select(*[F.col(f"r.`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])
