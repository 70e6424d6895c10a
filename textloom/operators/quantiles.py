"""Exact quantiles of many measures at once, by narrowing; no task and no buffer ever holds a measure's values.

Every double has an image among the 64-bit integers that keeps the order. All wanted ranks of all measures are narrowed together: a pass counts, per measure,
the rows under each of at most 2^BITS next digits of the image, and every rank goes on under the digit it falls into. Counts are combined before the
shuffle, and the driver holds one interval per measure and rank.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

# The helpers travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

BITS = 12
_SIGN = np.int64(2**63 - 1)


def image(values: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles; the two zeros are one, NaN comes last."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ _SIGN, bits)


def value_of(key: int) -> float:
    bits = np.array([key], np.int64)
    return float(np.where(bits < 0, bits ^ _SIGN, bits).view(np.float64)[0])


def with_image(rows: DataFrame, value: str, out: str = "key") -> DataFrame:
    """``rows`` with the image of the double column ``value``; rows without a value are left out."""
    at = rows.columns.index(value)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(at)))
            keys = image(batch.column(at).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, LongType())]))


def ranked_values(rows: DataFrame, ranks: dict[str, list[int]], measure: str = "measure", key: str = "key", weight: str = "n") -> dict[str, dict[int, float]]:
    """The values at the given ranks (from 0) of every measure. ``rows`` is a written table, read once per pass."""
    spark = rows.sparkSession
    # Of every rank: the digits found so far, and its rank among the rows that share them.
    state = {(m, r): (0, r) for m, rs in ranks.items() for r in rs}
    done = 0
    while state and done < 64:
        bits = min(BITS, 64 - done)
        prefixes = sorted({(m, p) for (m, _), (p, _) in state.items()})
        below = F.shiftright(key, 64 - done) if done else F.lit(0).cast("long")
        found = rows.select(measure, below.alias("_p"), F.shiftright(key, 64 - done - bits).alias("_d"), weight)
        if done:
            wanted = spark.createDataFrame(prefixes, "_m string, _p long")
            found = found.join(F.broadcast(wanted), (F.col(measure) == F.col("_m")) & found["_p"].eqNullSafe(wanted["_p"])).drop(wanted["_p"])
        counts: defaultdict[tuple, list] = defaultdict(list)
        for r in found.groupBy(measure, "_p", "_d").agg(F.sum(weight).alias("n")).collect():  # at most 2^BITS rows per wanted prefix
            counts[r[measure], r["_p"]].append((r["_d"], r["n"]))
        for held in counts.values():
            held.sort()
        for place, (prefix, rank) in list(state.items()):
            for digits, n in counts.get((place[0], prefix), ()):
                if rank < n:
                    state[place] = (digits, rank)
                    break
                rank -= n
            else:
                del state[place]  # a rank past the end
        done += bits
    out: dict[str, dict[int, float]] = {m: {} for m in ranks}
    for (m, r), (k, _) in state.items():
        out[m][r] = value_of(k)
    return out


def quantiles(rows: DataFrame, counts: dict[str, int], shares: list[float], measure: str = "measure", key: str = "key", weight: str = "n") -> dict[str, list[float | None]]:
    """Quantiles of every measure, interpolated between neighbouring ranks. ``counts`` has the number of rows of each measure."""
    places = {m: [s * (n - 1) for s in shares] for m, n in counts.items() if n}
    ranks = {m: sorted({r for p in ps for r in (math.floor(p), math.ceil(p))}) for m, ps in places.items()}
    found = ranked_values(rows, ranks, measure, key, weight)

    def between(m: str, place: float) -> float:
        low, high = found[m][math.floor(place)], found[m][math.ceil(place)]
        part = place - math.floor(place)
        return low if low == high else low * (1 - part) + high * part

    return {m: [between(m, p) for p in places[m]] if m in places else [None] * len(shares) for m in counts}
