"""Quality rules on how tokenizers take a text: characters per token, byte-fallback share and token entropy.

Words of a block are counted once each and taken through the public vocabularies once each; texts add up what their words give.
A piece vocabulary (with byte fallback) gives all three measures, a byte-level one, by the pattern that belongs to it, a second rate of characters
per token. A word is taken as it stands after a space.
Texts of a script that stray from the others' values are rejected: per script, a measure's band reaches ``FENCE``
quartile ranges beyond its quartiles, taken over all texts that pass the base rules; a range counts as ``LEAST_RANGE`` at least, so that a measure that
nearly all texts share does not reject by a hair. Bands may also be stated.

Base rules: under 50 words, or over half of the words within three-word runs that occur twice or more.

Defined cases: null, empty or white text: no words, fails the base rules. A text of words without any token cannot occur. A script without
texts that pass the base rules has no band and rejects nothing. Texts of any length are measured whole. Rows of one id, repeated rows and
texts with equal measures are judged alike; a value on the edge of a band is kept. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from textloom.llm.bpe import ragged
from textloom.llm.scan import Hashes, mix, row_blocks, text_bytes, text_column, windows, word_spans
from textloom.sources.scratch import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
SYMBOLS = b"#*$%&|<>"
FENCE = 3.0
#: Least quartile range of each measure.
LEAST_RANGE = {"chars_per_piece": 0.1, "chars_per_byte_token": 0.1, "fallback_share": 0.02, "token_entropy": 0.25}
#: Accuracy of the quartiles: ranks are right within 1 / ACCURACY.
ACCURACY = 10_000
#: Words whose tokens a task keeps between blocks; beyond it the store starts anew.
KEPT_WORDS = 200_000

MEASURES = ["chars_per_piece", "chars_per_byte_token", "fallback_share", "token_entropy"]
#: Scripts by the first byte of their letters in UTF-8; the last one that a byte reaches counts.
SCRIPTS = {
    "latin": 0x41, "greek": 0xCD, "cyrillic": 0xD0, "armenian": 0xD5, "semitic": 0xD7, "south_asian": 0xE0, "other": 0xE1, "east_asian": 0xE3,
    "supplementary": 0xF0,
}


@functools.cache
def _script_of_byte() -> np.ndarray:
    """Number of the script of every byte; one more than there are for bytes that say nothing."""
    table = np.full(256, len(SCRIPTS), np.uint8)
    for number, first in enumerate(SCRIPTS.values()):
        table[first:] = number
    table[0x5B:0x61] = table[0x7B:0xC3] = len(SCRIPTS)
    return table


class Tokens:
    """Tokens of words under both vocabularies, kept by the word's hash."""

    def __init__(self, pieces: bytes, ranks: bytes):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.n_pieces = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.n_pieces)])
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        self.bytes = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint16)
        self.ends = np.zeros(1 << 16, np.int64)
        self.byte_counts = np.zeros(1 << 16, np.int64)

    def of(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Slot of every word, after new ones have been taken in."""
        found, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.slots) + len(found) > KEPT_WORDS:
            self.forget()
        known = found.tolist()
        new = [i for i, h in enumerate(known) if h not in self.slots]
        if new:
            words = [data[begin[w] : end[w]].tobytes().decode("utf-8", "replace") for w in first[new].tolist()]
            ids = self.pieces.encode(words, num_threads=1)
            n, used = len(self.slots), int(self.ends[len(self.slots)])
            counts = np.array([len(x) for x in ids], np.int64)
            while len(self.ends) < n + len(new) + 1:
                self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
                self.byte_counts = np.concatenate((self.byte_counts, np.zeros_like(self.byte_counts)))
            while len(self.ids) < used + counts.sum():
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            self.ids[used : used + counts.sum()] = np.concatenate([np.array(x, np.uint16) for x in ids])
            self.ends[n + 1 : n + 1 + len(new)] = used + np.cumsum(counts)
            self.byte_counts[n : n + len(new)] = [len(self.bytes.encode_ordinary(" " + w)) for w in words]
            for k, i in enumerate(new):
                self.slots[known[i]] = n + k
        return np.array([self.slots[h] for h in known], np.int64)[place]


@functools.lru_cache(maxsize=1)
def _tokens(pieces: bytes, ranks: bytes) -> Tokens:
    return Tokens(pieces, ranks)


def _measure_block(column: pa.Array, tokens: Tokens) -> dict[str, np.ndarray]:
    data, rows = text_bytes(column)
    n = len(column)
    begin, end = word_spans(data)
    row = np.searchsorted(rows, begin, side="right") - 1
    # np.add.reduceat cannot take empty stretches: differences of running sums can.
    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[rows[1:]] - sums[rows[:-1]]

    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[begin] = 1
    in_word[end] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    points = (data & 0xC0) != 0x80
    symbol = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))
    out = {"n_words": np.bincount(row, minlength=n), "word_chars": per_row(points & in_word), "n_symbols": per_row(symbol)}

    hashes = Hashes(data)
    feed = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], feed[:-1] + 1))
    has_word = np.searchsorted(begin, feed) > np.searchsorted(begin, starts)
    line_row = np.searchsorted(rows, starts[has_word], side="right") - 1
    lines = mix(hashes.of(starts[has_word], feed[has_word]) + mix(line_row.astype(np.uint64), 3))
    _, first = np.unique(lines, return_index=True)
    out["n_dup_lines"] = np.bincount(line_row, minlength=n) - np.bincount(line_row[first], minlength=n)

    words = hashes.of(begin, end)
    runs = windows(words, REPEAT_WINDOW)
    repeated = np.zeros(len(words), np.int64)
    if len(runs):
        whole = row[: len(runs)] == row[REPEAT_WINDOW - 1 :]
        at = np.flatnonzero(whole)
        _, place, counts = np.unique(mix(runs[at] + mix(row[at].astype(np.uint64), 4)), return_inverse=True, return_counts=True)
        again = at[counts[place] > 1]
        for k in range(REPEAT_WINDOW):
            repeated[again + k] = 1
    out["n_repeat_words"] = np.bincount(row, repeated, n).astype(np.int64)

    slot = tokens.of(words, data, begin, end)
    lengths = tokens.ends[slot + 1] - tokens.ends[slot]
    ids = tokens.ids[ragged(tokens.ends[slot], lengths)].astype(np.int64)
    token_row = np.repeat(row, lengths)
    n_tokens = np.bincount(token_row, minlength=n)
    n_byte_tokens = np.bincount(row, tokens.byte_counts[slot], n)
    chars = out["word_chars"]
    keys, counts = np.unique(token_row * tokens.n_pieces + ids, return_counts=True)
    key_row = keys // tokens.n_pieces
    share = counts / np.maximum(n_tokens[key_row], 1)
    out["chars_per_piece"] = chars / np.maximum(n_tokens, 1)
    out["chars_per_byte_token"] = chars / np.maximum(n_byte_tokens, 1)
    out["fallback_share"] = np.bincount(token_row, tokens.is_byte[ids], n) / np.maximum(n_tokens, 1)
    out["token_entropy"] = np.bincount(key_row, -share * np.log2(share), n)
    script = _script_of_byte()[data].astype(np.int64)
    byte_row = np.repeat(np.arange(n), np.diff(rows))
    spread = np.bincount(byte_row * (len(SCRIPTS) + 1) + script, minlength=n * (len(SCRIPTS) + 1)).reshape(n, -1)[:, :-1]
    # Accented Latin letters start with bytes below Greek's; marks and digits say nothing.
    out["script"] = np.where(spread.any(axis=1), spread.argmax(axis=1), -1)
    return out


LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(docs: DataFrame, pieces: Broadcast, ranks: Broadcast, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, tokenizer measures and script of every whole text."""
    names = np.array([*SCRIPTS, "none"], object)
    fields = [docs.schema[doc_id], *[T.StructField(c, T.LongType()) for c in LONGS], *[T.StructField(c, T.DoubleType()) for c in MEASURES]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(pieces.value, ranks.value)
        for batch in batches:
            column = text_column(batch.column(1))
            for start, stop in row_blocks(column):
                found = _measure_block(column.slice(start, stop - start), tokens)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        *[pa.array(found[c].astype(np.int64)) for c in LONGS],
                        *[pa.array(found[c].astype(np.float64)) for c in MEASURES],
                        pa.array(names[found["script"]], pa.string()),
                    ],
                    names=[doc_id, *LONGS, *MEASURES, "script"],
                )

    narrow = docs.select(F.col(doc_id), F.col(text).cast("string").alias("_text"))
    return narrow.mapInArrow(run, T.StructType([*fields, T.StructField("script", T.StringType())]))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bands(measured: DataFrame, fence: float = FENCE) -> DataFrame:
    """``script`` and, for each measure, ``low_*`` and ``high_*``: one row per script."""
    passing = measured.filter(~base_failed())
    quartiles = passing.groupBy("script").agg(*[F.percentile_approx(m, [0.25, 0.75], ACCURACY).alias(m) for m in MEASURES])
    ends = []
    for m in MEASURES:
        low, high = F.col(m)[0], F.col(m)[1]
        reach = fence * F.greatest(high - low, F.lit(LEAST_RANGE[m]))
        ends += [(low - reach).alias(f"low_{m}"), (high + reach).alias(f"high_{m}")]
    return quartiles.select("script", *ends)


def judge(measured: DataFrame, script_bands: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``; there are no more bands than ``SCRIPTS`` and one, so they are broadcast."""
    joined = measured.join(F.broadcast(script_bands), "script", "left")
    strays = F.lit(False)
    for m in MEASURES:
        strays = strays | F.coalesce((F.col(m) < F.col(f"low_{m}")) | (F.col(m) > F.col(f"high_{m}")), F.lit(False))
    failed = base_failed()
    return joined.select(*measured.columns, failed.alias("base_failed"), (~failed & ~strays).alias("kept"))


def quality(docs: DataFrame, pieces: Broadcast, ranks: Broadcast, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    measured = materialize(measures(docs, pieces, ranks, doc_id, text), "fertility")
    return judge(measured, materialize(bands(measured), "bands"))
