"""Table helpers: joins that stand hot keys, and a filter of bounded size for keys that may match."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation, functions as F

from textloom.llm.scan import mix
from textloom.operators.lookup import fits_broadcast
from textloom.sources.scratch import new_path

#: A key is hot if it owns at least this share of the rows; so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.001
#: Upper bound of a filter that is sent to every executor; beyond it the filter lets more through, nothing is lost.
FILTER_BYTES = 32 << 20
BITS_PER_KEY = 16
BLOCK_WORDS = 8
PROBES = 6


def written(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``df``, written once and read back, and what was measured of it on the way: its number of ``rows``, and the given aggregates."""
    path, seen = new_path(df.sparkSession, name), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def checked_join(rows: DataFrame, table: DataFrame, on: list[str] | Column, how: str) -> DataFrame:
    """Join to a written table: broadcast after its size has been measured, else by shuffle."""
    side = F.broadcast(table) if fits_broadcast(table) else table.hint("merge")
    return rows.join(side, on, how)


def lookup_hot(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of written ``rows`` to a written ``table`` with one row per key and its number of rows as ``weight``.

    The hot keys (at most ``1 / HOT_SHARE`` by their definition) are broadcast, all others join by shuffle, so that no
    task gets the rows of a hot key.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = table.filter(F.col(weight) >= max(2, total * HOT_SHARE))
    cold = table.filter(F.col(weight) < max(2, total * HOT_SHARE))
    first = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold.hint("merge"), key)
    return first.unionByName(rest)


def _blocks_and_bits(keys: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block of every key, and the word and the bit of each of its probes within the block."""
    hashed = mix(keys.astype(np.uint64), 11)
    block = ((hashed >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)
    again = mix(keys.astype(np.uint64), 12)
    probes = [(again >> np.uint64(9 * k)) & np.uint64(511) for k in range(PROBES)]
    spots = np.stack(probes)
    return block.astype(np.int64), (spots >> np.uint64(6)).astype(np.int64), spots & np.uint64(63)


class BlockedFilter:
    """Bloom filter whose probes of one key all fall into one block of 512 bits. Members are never missed."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, keys: np.ndarray) -> np.ndarray:
        block, word, bit = _blocks_and_bits(keys, len(self.words) // BLOCK_WORDS)
        found = np.ones(len(keys), bool)
        for k in range(PROBES):
            found &= (self.words[block * BLOCK_WORDS + word[k]] >> bit[k]) & np.uint64(1) == 1
        return found


def build_filter(table: DataFrame, key: str, count: int, max_bytes: int = FILTER_BYTES) -> Broadcast:
    """A ``BlockedFilter`` of the long column ``key`` on every executor, of at most ``max_bytes``.

    Each task sets its keys' bits and returns the words that it touched; equal words are joined by ``bit_or`` before
    and after the shuffle, so the driver gets one row per word of the filter, however many keys there are.
    """
    spark = table.sparkSession
    n_blocks = int(min(max(1, -(-count * BITS_PER_KEY // 512)), max_bytes // 64))

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            block, word, bit = _blocks_and_bits(keys, n_blocks)
            at = (block * BLOCK_WORDS + word).ravel()
            value = np.left_shift(np.uint64(1), bit.ravel())
            order = np.argsort(at, kind="stable")
            at, value = at[order], value[order]
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
            joined = np.bitwise_or.reduceat(value, first) if len(at) else value
            yield pa.RecordBatch.from_arrays([pa.array(at[first], pa.int64()), pa.array(joined.view(np.int64), pa.int64())], names=["at", "word"])

    parts = table.select(key).mapInArrow(words, "at long, word long")
    joined = parts.groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(n_blocks * BLOCK_WORDS, np.uint64)
    if joined.num_rows:
        out[joined["at"].to_numpy()] = joined["word"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(out)


def filter_rows(rows: DataFrame, key: str, words: Broadcast) -> DataFrame:
    """Rows whose long ``key`` the filter holds: all members, and a few others."""
    place = rows.columns.index(key)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = BlockedFilter(words.value)
        for batch in batches:
            keys = pc.fill_null(batch.column(place), 0).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(held.holds(keys)))

    return rows.mapInArrow(run, rows.schema)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
