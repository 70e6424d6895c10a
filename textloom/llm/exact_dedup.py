"""Exact dedup against a history of digests held in minimal perfect hashes.

Texts are equal if they are equal without white space; a text is known by the SHA-256 of what is left. The history, one row
per distinct digest with its group's size and the locator of its winner, is dealt by digest into shards of a bounded
number of digests. Each shard becomes a minimal perfect hash: in a cascade of bit arrays a key takes the first level at
which its position is its own; the number of bits set before it is its slot. Slots hold the full digest and the locator,
so a lookup is right only if all 32 bytes agree: any other digest also finds some slot, and is told apart there.

A new instalment is first grouped by digest (so a hot text is one row), each group is looked up in its shard, hits join the
history's group and non-members are groups of their own. The winner of a group is the text with the most code points, then
the smallest id.

Defined cases: null text counts as empty; empty texts are equal to each other. A null id sorts after all others. Of rows that are equal in
text and id exactly one is kept. Texts of any length are hashed whole. An empty table, or half of one, gives no groups. Extra columns are ignored by ``dedup`` and handed through by ``keep_winners``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.llm.scan import SPACES, mix
from textloom.llm.tables import checked_join, lookup_hot
from textloom.sources.scratch import materialize

DIGEST_BYTES = 32
SHARD_DIGESTS = 200_000
GAMMA = 2
MAX_LEVELS = 64

LOCATOR = "chars long, doc_id long, uid long, size long"


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES.decode(), "")


def digest_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(uid, doc_id, digest, chars)`` of every row, written once so that the row number ``uid`` stays what it is."""
    source = F.col(text).cast("string")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.unhex(F.sha2(normalized(source), 256)).alias("digest"),
        F.coalesce(F.char_length(source), F.lit(0)).cast("long").alias("chars"),
    )
    return materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "digests")


def better_first() -> Column:
    """Ordering of a group's rows: smallest for the one that stays."""
    return F.struct((-F.col("chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("uid").alias("d"))


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: size and locator of the winner; combined before the shuffle."""
    return rows.groupBy("digest").agg(
        F.min_by(F.struct("chars", "doc_id", "uid"), better_first()).alias("w"), F.sum("size").alias("size")
    ).select("digest", "w.chars", "w.doc_id", "w.uid", "size")


def shard_of(digest: Column, shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 6)), 16, 10).cast("long"), F.lit(shards)).cast("int")


class PerfectHash:
    """Minimal perfect hash of distinct digests; ``slots`` is right for members and arbitrary for others."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        bits = [np.unpackbits(level.view(np.uint8), bitorder="little").astype(np.int64) for level in levels]
        totals = np.concatenate(([0], np.cumsum([b.sum() for b in bits]))).astype(np.int64)
        self._ranks = [np.cumsum(b) - b + t for b, t in zip(bits, totals)]
        self._bits = [b.astype(bool) for b in bits]

    @staticmethod
    def _spread(digests: np.ndarray) -> np.ndarray:
        """A 64-bit value of each 32-byte digest, from its middle; the first bytes choose the shard."""
        return np.ascontiguousarray(digests[:, 8:16]).view(np.uint64).ravel() ^ mix(
            np.ascontiguousarray(digests[:, 16:24]).view(np.uint64).ravel()
        )

    @classmethod
    def build(cls, digests: np.ndarray) -> "PerfectHash":
        left, levels = cls._spread(digests), []
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("digests are not distinct")
            size = -(-GAMMA * len(left) // 64) * 64
            at = (mix(left, 100 + len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        keys = self._spread(digests)
        out = np.full(len(keys), -1, np.int64)
        for k, (bits, ranks) in enumerate(zip(self._bits, self._ranks)):
            open_rows = np.flatnonzero(out < 0)
            if not len(open_rows):
                break
            at = (mix(keys[open_rows], 100 + k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_rows[hit]] = ranks[at[hit]]
        return out


def _digest_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, DIGEST_BYTES)


def _cells(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()


def build_history(groups: DataFrame, shards: int) -> DataFrame:
    """Minimal perfect hashes of written ``groups``: a row per shard with its levels and its slots."""
    names = ["chars", "doc_id", "uid", "size"]

    def build(key: tuple, table: pa.Table) -> pa.Table:
        digests = _digest_matrix(table["digest"])
        index = PerfectHash.build(digests)
        slots = index.slots(digests)
        held = np.zeros_like(digests)
        held[slots] = digests
        locators = np.zeros((len(slots), len(names)), np.int64)
        for i, name in enumerate(names):
            locators[slots, i] = _cells(table[name])
        lengths = np.array([len(level) for level in index.levels], np.int64)
        levels = np.concatenate(index.levels) if index.levels else np.zeros(0, np.uint64)
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "lengths": pa.array([lengths.tobytes()], pa.binary()),
            "levels": pa.array([levels.tobytes()], pa.binary()),
            "digests": pa.array([held.tobytes()], pa.binary()),
            "locators": pa.array([locators.tobytes()], pa.binary()),
        })

    sharded = groups.withColumn("shard", shard_of(F.col("digest"), shards))
    built = sharded.groupBy("shard").applyInArrow(
        build, "shard int, lengths binary, levels binary, digests binary, locators binary"
    )
    return materialize(built, "history")


def look_up(history: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` with ``found`` and, as ``h_*``, the locator in the slot whose digest agrees in all bytes."""
    names = ["chars", "doc_id", "uid", "size"]

    def look(key: tuple, index_rows: pa.Table, asked: pa.Table) -> pa.Table:
        n = asked.num_rows
        found, at, locators = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros((1, len(names)), np.int64)
        if n and index_rows.num_rows:
            row = {c: index_rows[c][0].as_py() for c in ("lengths", "levels", "digests", "locators")}
            lengths = np.frombuffer(row["lengths"], np.int64)
            levels = np.split(np.frombuffer(row["levels"], np.uint64), np.cumsum(lengths)[:-1])
            held = np.frombuffer(row["digests"], np.uint8).reshape(-1, DIGEST_BYTES)
            locators = np.frombuffer(row["locators"], np.int64).reshape(-1, len(names))
            digests = _digest_matrix(asked["digest"])
            slots = PerfectHash(levels).slots(digests)
            at = np.maximum(slots, 0)
            found = (slots >= 0) & (held[at] == digests).all(axis=1)
        out = {c: asked[c] for c in ("digest", *names)}
        out["found"] = pa.array(found)
        for i, name in enumerate(names):
            values = locators[at, i]
            empty = ~found | (values == np.iinfo(np.int64).min)
            out[f"h_{name}"] = pa.array(np.where(empty, 0, values), pa.int64(), mask=empty)
        return pa.table(out)

    found = ", ".join(f"h_{x}" for x in LOCATOR.split(", "))
    asked = groups.withColumn("shard", shard_of(F.col("digest"), shards))
    return history.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(
        look, f"digest binary, {LOCATOR}, found boolean, {found}"
    )


def all_groups(rows: DataFrame, instalment: Column) -> DataFrame:
    """Groups of written ``rows``, taken in as a history and a later instalment that is looked up in it."""
    sized = rows.withColumn("size", F.lit(1).cast("long"))
    history = materialize(groups_of(sized.filter(~instalment)), "history-groups")
    later = materialize(groups_of(sized.filter(instalment)), "later-groups")
    # Enough shards for the larger side, so that a large instalment is not looked up in few tasks.
    shards = max(1, -(-max(history.count(), later.count()) // SHARD_DIGESTS))
    index = build_history(history, shards)
    looked = materialize(look_up(index, later, shards), "looked-up")
    members, others = looked.filter("found"), looked.filter("NOT found")
    locator = ["digest", "chars", "doc_id", "uid", "size"]
    hits = members.select("digest", *[F.col(f"h_{c}").alias(c) for c in locator[1:]])
    joined = hits.unionByName(members.select(locator))  # two rows per digest: the slot's winner and the new one's
    untouched = history.join(members.select("digest").hint("merge"), "digest", "left_anti").select(locator)
    return materialize(untouched.unionByName(groups_of(joined)).unionByName(others.select(locator)), "groups")


def later_half() -> Column:
    """The half of the rows, by a hash of the id, that counts as the later instalment."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row."""
    rows = digest_rows(docs, doc_id, text)
    groups = all_groups(rows, later_half())
    winners = groups.select("digest", F.col("doc_id").alias("keep_id"), F.col("uid").alias("keep_uid"), "size")
    return lookup_hot(rows, winners, "digest", "size").select(
        F.col("doc_id").alias(doc_id),
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("uid") == F.col("keep_uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_winners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group, with all its columns."""
    rows = digest_rows(docs, doc_id, text)
    groups = all_groups(rows, later_half()).filter("size > 1")
    winners = groups.select(
        F.col("digest").alias("_digest"), F.col("chars").alias("_w_chars"), F.col("doc_id").alias("_w_id")
    )
    # Rows of one group that tie in length and id: told apart only here, for the few groups that have them.
    same = (F.col("digest") == F.col("_digest")) & (F.col("chars") == F.col("_w_chars")) & F.col("doc_id").eqNullSafe(F.col("_w_id"))
    ties = rows.join(winners.hint("merge"), same).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    winners = winners.join(ties.select(F.col("digest").alias("_digest"), F.lit(True).alias("_tied")), "_digest", "left")
    winners = materialize(winners.withColumn("_tied", F.coalesce("_tied", F.lit(False))), "winners")

    source = F.col(text).cast("string")
    keyed = docs.select(
        F.struct(F.col("*")).alias("_row"),
        F.unhex(F.sha2(normalized(source), 256)).alias("_digest"),
        F.coalesce(F.char_length(source), F.lit(0)).cast("long").alias("_chars"),
        F.col(doc_id).cast("long").alias("_id"),
    )
    marked = checked_join(keyed, winners, ["_digest"], "left")
    wins = F.col("_tied").isNull() | ((F.col("_chars") == F.col("_w_chars")) & F.col("_id").eqNullSafe(F.col("_w_id")))
    kept = marked.filter(wins)
    if winners.filter("_tied").isEmpty():
        return kept.select("_row.*")
    tied = F.coalesce("_tied", F.lit(False))
    first = Window.partitionBy("_digest").orderBy(F.xxhash64("_row"))
    one = kept.filter(tied).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return kept.filter(~tied).select("_row.*").unionByName(one.select("_row.*"))
