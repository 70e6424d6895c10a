"""How quality filters overlap, and what each removes at every place of every order.

Every document fails some of five filters. All that an audit asks for follows from how many documents of a part fail which of them: a
contingency tensor of 2 x 2 x 2 x 2 x 2 counts per part, one axis a filter (0 passes, 1 fails), one each for all documents, those marked
good and those marked toxic. A question about a step of an order is a contraction of that tensor: on the axis of every filter it selects
who passes, who fails, or all.

Texts are read once, by built-in functions; what is left of a document is its part, four flags and a digest of its text. Copies are
summed by digest and part before they meet, so that a group of copies, however large, is one row per part and label.

Defined cases: null text: empty (fails A, by its length; B, C and D pass: nothing is compared with nothing). A null part is the empty
string, and one part with it. A row without an id has no smaller id and no label, so it passes E. Rows of the same id are documents
each; none of them fails E by the other. Several labels of one document: good or toxic if any says so. Texts of any length are read
whole. Parts without documents, and empty tables, give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textloom.sources.scratch import materialize

FILTERS = "ABCDE"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
_AXES = "abcde"
_CONTRACTION = f"pv{_AXES},{','.join(_AXES)}->pv"

OUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails A (short), B (repetitive), C (capitals) and D (symbols)."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals.cast("long") > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def _marked(flags: Iterable[Column], start: int = 0) -> Column:
    """Flags as bits of one number; the first is the lowest."""
    total = F.lit(0)
    for i, flag in enumerate(flags, start):
        total = total + F.when(flag, 1 << i).otherwise(0)
    return total


def failure_counts(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of a part by the set of filters they fail, as bits from A upwards."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    read = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("t"))
    narrow = read.select("id", "part", _marked(text_failures(F.col("t"))).alias("mask"), F.unhex(F.sha2("t", 256)).alias("digest"))
    rows = narrow.groupBy("id", "digest", "mask", "part").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.select(F.col("doc_id").alias("id"), "quality", "toxic").groupBy("id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    told = rows.join(marks.filter("id IS NOT NULL"), "id", "left").select(
        *rows.columns, F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad")
    )
    # A text's first id passes E, all larger ones fail: per text and part it is enough to keep the smallest id and its rows.
    has_id = F.col("id").isNotNull()
    copies = told.groupBy("digest", "mask", "part", "good", "bad").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~has_id, F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(has_id, F.struct("id", "n"))).alias("least"),
    )
    copies = materialize(
        copies.select("digest", "mask", "part", "good", "bad", "n", "nameless", F.col("least.id").alias("id"), F.col("least.n").alias("of_id")),
        "audit-copies",
    )
    first = copies.groupBy("digest").agg(F.min("id").alias("first"))
    met = copies.join(first.hint("merge"), "digest")
    passing = F.col("nameless") + F.when(F.col("id") == F.col("first"), F.col("of_id")).otherwise(0)
    sides = F.array(
        F.struct(F.col("mask").alias("mask"), passing.alias("n")),
        F.struct((F.col("mask") + F.lit(1 << 4)).alias("mask"), (F.col("n") - passing).alias("n")),
    )
    split = met.select("part", "good", "bad", F.explode(sides).alias("s")).select("part", "good", "bad", "s.*").filter("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("bad")).alias("toxic")
    )


def contract(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """Every step of every order for each part, from ``tensors`` of shape (parts, 3, 2, 2, 2, 2, 2): all, good, toxic.

    Each value is an array (parts, orders, steps).
    """
    known: dict[tuple, np.ndarray] = {}

    def count(selectors: list[tuple[int, int]]) -> np.ndarray:
        key = tuple(selectors)
        if key not in known:
            known[key] = np.einsum(_CONTRACTION, tensors, *[np.array(s, np.int64) for s in selectors])
        return known[key]

    n, k = len(tensors), len(FILTERS)
    orders = list(permutations(range(k)))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    out = {name: np.zeros((n, len(orders), k), np.int64) for name in names}
    by_filter = np.zeros((n, k), np.int64)
    for o, order in enumerate(orders):
        for step, f in enumerate(order):
            before = [PASS if g in order[:step] else ALL for g in range(k)]
            passing = before[:f] + [PASS] + before[f + 1 :]
            failing = before[:f] + [FAIL] + before[f + 1 :]
            lost = count(failing)
            out["kept"][:, o, step] = count(passing)[:, 0]
            out["removed"][:, o, step] = lost[:, 0]
            out["redundant"][:, o, step] = count([FAIL if g == f else ALL for g in range(k)])[:, 0] - lost[:, 0]
            out["unique_fails"][:, o, step] = count([FAIL if g == f else PASS for g in range(k)])[:, 0]
            out["good_lost"][:, o, step] = lost[:, 1]
            out["toxic_lost"][:, o, step] = lost[:, 2]
            by_filter[:, f] += lost[:, 0]
    for o, order in enumerate(orders):
        out["shapley"][:, o, :] = by_filter[:, list(order)]
    return out


def _audited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders = ["".join(FILTERS[f] for f in order) for order in permutations(range(len(FILTERS)))]
    steps = len(FILTERS)
    each = len(orders) * steps
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            tensors = np.zeros((some.num_rows, 3, 1 << steps), np.int64)
            for row, cells in enumerate(some.column(1).to_pylist()):
                for cell in cells:
                    tensors[row, :, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
            # The first axis of a reshaped number is its highest bit, so the axes are turned round.
            tensors = tensors.reshape(-1, 3, *[2] * steps).transpose(0, 1, *range(1 + steps, 1, -1))
            found = contract(tensors)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(some.column(0).to_pylist(), object), each), pa.string()),
                    pa.array(np.tile(np.repeat(np.array(orders, object), steps), some.num_rows), pa.string()),
                    pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders) * some.num_rows)),
                    *[pa.array(values.ravel()) for values in found.values()],
                ],
                names=["part", "filter_order", "step", *found],
            )


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step; see ``OUT``."""
    counts = failure_counts(docs, labels, doc_id, text, part)
    # At most 32 cells a part.
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(_audited, OUT)
