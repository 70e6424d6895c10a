"""Byte-level BPE by replaying the merges over all words of a block at once.

Texts are cut into pieces (``scan.pieces``); merges never cross a piece, so equal pieces have equal ids. Per task, the
distinct pieces of a block lie one after another in one array of symbols. An inverted index leads from a token pair,
by the rank of its merge, to the positions where it stands. Merges are taken in rank order; each touches only its own
positions and their two neighbours, whose new pairs enter the index. A pair that comes up with a rank below the one
at work is taken first, as the reference encoders do. Ids of pieces seen before are kept (bounded) between blocks.

The corpus is spread by its input splits: no shuffle, and a lost task is replayed from its split alone.

Null text counts as empty and has no ids. Texts of any length are encoded whole, a long one as a block of its own. Repeated rows are encoded alike, each one
a row of the result; an empty table gives no rows. Extra columns are left out, those to ``keep`` are handed through. An id that the vocabulary lacks
makes decoding fail.
"""

from __future__ import annotations

import base64
import functools
import heapq
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from textloom.llm.scan import pieces, row_blocks, text_column

MAX_VOCABULARY_BYTES = 64 << 20
BLOCK_BYTES = 2 << 20
#: Pieces whose ids a task keeps between blocks; beyond it the store starts anew.
KEPT_PIECES = 400_000

_NEVER = 1 << 40


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the stretches ``starts[i] .. starts[i] + lengths[i]``, one stretch after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def binary_column(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary cells cut out of one array of bytes; ``ends`` starts with 0."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )


class Vocabulary:
    """Ranks of a byte-level vocabulary, the merges they allow, and the ids of pieces met so far."""

    def __init__(self, rank_file: bytes):
        ranks = {}
        for line in rank_file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.size = max(ranks.values()) + 1
        self.step = self.size + 1  # the id ``size`` stands between pieces
        self.tokens = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.step + right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.token_lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self._slots: dict[bytes, int] = {}
        self._ids = np.zeros(1 << 16, np.int32)
        self._ends = np.zeros(1 << 16, np.int64)

    def _merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each neighbouring pair; ``_NEVER`` where there is none."""
        keys = left * self.step + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one word after another, and the number of ids of each."""
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        # Symbols with one separator before every word and one at the end.
        word = np.repeat(np.arange(1, len(words) + 1), lengths)
        at = np.arange(len(raw)) + word
        size = len(raw) + len(words) + 1
        token = np.full(size, self.size, np.int64)
        token[at] = self.byte_ids[raw]
        word_of = np.zeros(size, np.int64)
        word_of[at] = word
        rank = np.full(size, _NEVER, np.int64)
        rank[at] = self._merge_ranks(token[at], token[at + 1])
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)

        index: dict[int, list[np.ndarray]] = {}
        agenda: list[int] = []

        def enter(positions: np.ndarray) -> None:
            """Put positions into the index under the rank of the pair that starts there."""
            ranks = rank[positions]
            positions = positions[np.argsort(ranks, kind="stable")]
            ranks = rank[positions]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(positions)]
            for r, i, j in zip(ranks[starts[:-1]].tolist(), starts, starts[1:]):
                if r in index:
                    index[r].append(positions[i:j])
                else:
                    index[r] = [positions[i:j]]
                    heapq.heappush(agenda, r)

        live = at[rank[at] != _NEVER]
        if len(live):
            enter(live)
        while agenda:
            now = heapq.heappop(agenda)
            found = index.pop(now)
            p = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            p = p[rank[p] == now]
            if not len(p):
                continue
            if len(p) > 1:
                # Of overlapping pairs (a run of one symbol) every second one is merged, from the left.
                chained = np.concatenate(([False], p[1:] == after[p[:-1]]))
                if chained.any():
                    place = np.arange(len(p))
                    run = np.maximum.accumulate(np.where(chained, -1, place))
                    p = p[(place - run) % 2 == 0]
                words_here = word_of[p]
                again = words_here[1:] == words_here[:-1]
                if again.any():
                    # Where a merge brings up a pair of a lower rank, its word goes on with that one first.
                    left, right = before[p], after[after[p]]
                    left_token = token[left]
                    left_token[1:][right[:-1] == p[1:]] = now
                    here = np.full(len(p), now)
                    brought = np.minimum(self._merge_ranks(here, token[right]), self._merge_ranks(left_token, here))
                    early = words_here[brought < now]
                    if len(early):
                        wait = np.isin(words_here, early) & np.concatenate(([False], again))
                        index[now] = [p[wait]]
                        heapq.heappush(agenda, now)
                        p = p[~wait]
            gone = after[p]
            right, left = after[gone], before[p]
            token[p] = now
            token[gone] = -1
            rank[gone] = _NEVER
            after[p] = right
            before[right] = p
            here = np.full(len(p), now)
            rank[p] = self._merge_ranks(here, token[right])
            rank[left] = self._merge_ranks(token[left], here)
            touched = np.concatenate((left, p))
            touched = touched[rank[touched] != _NEVER]
            if len(touched):
                enter(touched)
        out = token[token >= 0]
        counts = np.diff(np.flatnonzero(out == self.size)) - 1
        return out[out < self.size].astype(np.int32), counts

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another, and the number of ids of each."""
        flat, piece_counts = pieces(column)
        if not len(flat):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self._slots]
        if len(self._slots) + len(new) > KEPT_PIECES:
            self.forget()
            new = words
        slots = self._slots
        if new:
            ids, counts = self.replay(new)
            n, used = len(slots), int(self._ends[len(slots)])
            for i, w in enumerate(new):
                slots[w] = n + i
            while len(self._ends) < n + len(new) + 1:
                self._ends = np.concatenate((self._ends, np.zeros_like(self._ends)))
            while len(self._ids) < used + len(ids):
                self._ids = np.concatenate((self._ids, np.zeros_like(self._ids)))
            self._ids[used : used + len(ids)] = ids
            self._ends[n + 1 : n + 1 + len(new)] = used + np.cumsum(counts)
        slot = np.array([slots[w] for w in words], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self._ends[slot + 1] - self._ends[slot]
        ids = self._ids[ragged(self._ends[slot], lengths)]
        id_ends = np.concatenate(([0], np.cumsum(lengths)))
        text_ends = id_ends[np.concatenate(([0], np.cumsum(piece_counts)))]
        return ids, np.diff(text_ends)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for."""
        return self.token_bytes[ragged(self.token_starts[ids], self.token_lengths[ids])]


@functools.lru_cache(maxsize=2)
def load_vocabulary(rank_file: bytes) -> Vocabulary:
    """The vocabulary of a rank file, built once per process."""
    return Vocabulary(rank_file)


def share_file(spark: SparkSession, path: str) -> Broadcast:
    """Send a vocabulary file, whose size is checked, to the executors; they need not hold the file."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is over {MAX_VOCABULARY_BYTES} bytes")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _kept_fields(df: DataFrame, keep: list[str]) -> list[T.StructField]:
    return [df.schema[name] for name in keep]


def encode(
    docs: DataFrame, ranks: Broadcast, keep: list[str], text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``keep`` columns and the ids of every whole text, as little-endian unsigned 32-bit integers in a binary column.

    With ``decoded`` the ids are decoded again in the same task, into a binary column of that name.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(ranks.value)
        for batch in batches:
            column = text_column(batch.column(len(keep)))
            for start, stop in row_blocks(column, BLOCK_BYTES):
                found, counts = vocabulary.encode(column.slice(start, stop - start))
                ends = np.concatenate(([0], np.cumsum(counts)))
                cells = [binary_column(found.astype("<u4").view(np.uint8), 4 * ends)]
                if decoded:
                    byte_ends = np.concatenate(([0], np.cumsum(vocabulary.token_lengths[found])))
                    cells.append(binary_column(vocabulary.decode(found), byte_ends[ends]))
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *[c.cast(pa.binary()) for c in cells]], names=[*keep, *outputs])

    outputs = [ids, decoded] if decoded else [ids]
    narrow = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_encode_text"))
    return narrow.mapInArrow(run, T.StructType([*_kept_fields(docs, keep), *[T.StructField(c, T.BinaryType()) for c in outputs]]))


def decode(encoded: DataFrame, ranks: Broadcast, keep: list[str], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``keep`` columns and the bytes that the ids of every row stand for; null ids count as none."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(ranks.value)
        for batch in batches:
            column = batch.column(len(keep)).cast(pa.large_binary()).fill_null(b"")
            for start, stop in row_blocks(column, BLOCK_BYTES):
                part = column.slice(start, stop - start)
                ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
                data = part.buffers()[2]
                raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
                numbers = raw.view("<u4").astype(np.int64)
                lengths = np.concatenate(([0], np.cumsum(vocabulary.token_lengths[numbers])))
                cells = binary_column(vocabulary.decode(numbers), lengths[(ends - ends[0]) // 4])
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, cells.cast(pa.binary())], names=[*keep, out])

    narrow = encoded.select(*[F.col(c) for c in keep], F.col(ids).alias("_decode_ids"))
    return narrow.mapInArrow(run, T.StructType([*_kept_fields(encoded, keep), T.StructField(out, T.BinaryType())]))


def digests(docs: DataFrame, ranks: Broadcast, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids again, and return both digests (and the ids, if asked for) per document."""
    return encode(docs, ranks, [doc_id], text, decoded="decoded").select(
        doc_id,
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if keep_ids else []),
    )
