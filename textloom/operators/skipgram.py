"""Skip-gram word vectors (hierarchical softmax, one pass, as MLlib's Word2Vec) of vocabularies that no single process holds.

Sentences are dealt into parts of a bounded volume. A part gets the ranks of its own words only, is trained by one task, and a word's vector is the
mean over the parts that moved it. Codes need no tree in memory: the lengths of a Huffman code follow from how many words there are of each count,
and in its canonical form a word's code follows from its rank and a start per length. The inner nodes start at zero in the one
pass, so only those on the paths of a part's words are ever made, and they end with their part.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from textloom.operators.lookup import keyed_lookup
from textloom.operators.vocabulary import build_vocabulary
from textloom.sources.scratch import materialize

# The trainer travels with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

#: Bytes of words in one part, and words in one sentence; longer texts are several sentences, as in MLlib.
PART_BYTES = 8 * 1024 * 1024
SENTENCE = 1000
WINDOW = 5
RATE = 0.025
#: No step is made for a score beyond this, as in MLlib.
MAX_SCORE = 6.0
#: Centres whose steps are taken together, centres of one reach and like code length in one product, and most pairs that add up to the step of one row.
BATCH = 512
SLICE = 64
MAX_PAIRS = 64


def word_counts(df: DataFrame, tokens_col: str, min_count: int = 1) -> DataFrame:
    """``(token, n)`` of the words that occur ``min_count`` times or more; written."""
    words = df.select(F.explode(tokens_col).alias("token")).filter(F.col("token").isNotNull())
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.filter(F.col("n") >= min_count), "word-counts")


def code_lengths(words_of_count: dict[int, int]) -> list[int]:
    """Number of words per length, from 0, of a Huffman code; ``words_of_count`` says how many words have each count.

    Words of one weight are merged together, so the work follows the number of different counts.
    """
    groups = [(weight, i, many) for i, (weight, many) in enumerate(sorted(words_of_count.items()))]
    leaves, merged_into = len(groups), [[] for _ in groups]
    heapify(groups)

    def merge(weight: int, many: int, *parts: tuple[int, int]) -> None:
        for child, share in parts:
            merged_into[child].append((len(merged_into), share))
        heappush(groups, (weight, len(merged_into), many))
        merged_into.append([])

    while groups:
        weight, group, many = heappop(groups)
        if many > 1:
            merge(2 * weight, many // 2, (group, 2))
            if many % 2:
                heappush(groups, (weight, group, 1))
        elif groups:
            other, partner, rest = heappop(groups)
            if rest > 1:
                heappush(groups, (other, partner, rest - 1))
            merge(weight + other, 1, (group, 1), (partner, 1))
    # From the root down: how many nodes of each group lie at each depth.
    depths: list[Counter] = [Counter() for _ in merged_into]
    for group in reversed(range(len(merged_into))):
        if not merged_into[group]:
            depths[group][0] = 1
        for parent, share in merged_into[group]:
            for depth, many in depths[parent].items():
                depths[group][depth + 1] += share * many
    total = sum(depths[:leaves], Counter())
    return [total[length] for length in range(max(total, default=-1) + 1)]


def code_starts(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """First rank and first code of every length in the canonical code; ranks from 0, by falling count."""
    codes, code = [], 0
    for length, many in enumerate(lengths):
        codes.append(code)
        code = (code + many) << 1
    return np.cumsum([0, *lengths[:-1]]), np.array(codes, np.int64)


def paths(ranks: np.ndarray, starts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Code length, inner nodes and bits of every word, a row each, and how many nodes there are; the nodes are numbered within the part,
    and their number stands for none."""
    first_rank, first_code = starts
    length = np.searchsorted(first_rank, ranks, side="right") - 1
    code = first_code[length] + ranks - first_rank[length]
    depth = np.arange(length.max(initial=0))
    on_path = depth < length[:, None]
    left = np.where(on_path, length[:, None] - depth, 0)
    # A node is the beginning of a code, told apart from shorter ones by a one in front.
    prefix = (code[:, None] >> left) | (np.int64(1) << depth)
    bits = (code[:, None] >> np.maximum(left - 1, 0)) & 1
    known, number = np.unique(prefix[on_path], return_inverse=True)
    nodes = np.full(on_path.shape, len(known), np.int32)
    nodes[on_path] = number
    return length, nodes, bits.astype(np.float32), len(known)


def first_vectors(hashes: np.ndarray, size: int) -> np.ndarray:
    """Uniform within half a unit by ``size`` around zero, the same for a word in every part."""
    x = hashes.astype(np.int64).view(np.uint64)[:, None] + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (((x >> np.uint64(11)).astype(np.float64) / 2**53 - 0.5) / size).astype(np.float32)


def _add(table: np.ndarray, rows: np.ndarray, steps: np.ndarray, pairs: np.ndarray, rate: float) -> None:
    """Add the steps to their rows, which rise; a row that many pairs move at once goes as far as ``MAX_PAIRS`` of them, by their mean."""
    if not len(rows):
        return
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    scale = rate * np.minimum(1, MAX_PAIRS / np.maximum(np.add.reduceat(pairs, first), 1))
    rows = rows[first]
    # Two cells are added as one complex number, which is faster.
    steps = np.add.reduceat(steps.view(np.complex64) if steps.shape[1] % 2 == 0 else steps, first).view(np.float32)
    steps *= scale.astype(np.float32)[:, None]
    steps += table.take(rows, 0)
    table[rows] = steps


def train(words: np.ndarray, sentence: np.ndarray, vectors: np.ndarray, ranks: np.ndarray, starts: tuple[np.ndarray, np.ndarray], seed: int):
    """Vectors after one pass over the text ``words`` (row numbers, with the number of their sentence), and which were moved."""
    length, nodes, bits, n_nodes = paths(ranks, starts)
    wanted = 1 - bits
    n, (n_words, size) = len(words), vectors.shape
    # The last rows stand for no word and no node: they are zeros, and no step is added to them.
    outer = np.vstack([vectors, np.zeros((1, size), np.float32)])
    inner = np.zeros((n_nodes + 1, size), np.float32)
    moved = np.zeros(n_words + 1, bool)
    # Before and after every sentence the text has as many places without a word as a window reaches.
    begin = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]][:n])
    many = np.diff(np.r_[begin, n])
    place = np.arange(n) + WINDOW * (1 + np.repeat(np.arange(len(many)), many))
    text = np.full(n + WINDOW * (len(many) + 1), n_words)
    text[place] = words
    rank = ranks[words]
    rng = np.random.default_rng(seed)
    order, reach = rng.permutation(n), rng.integers(1, WINDOW + 1, n)
    before = np.arange(n) - np.repeat(begin, many)
    pairs_of = np.minimum(before, reach) + np.minimum(np.repeat(many, many) - 1 - before, reach)
    windows = [np.r_[-r:0, 1 : r + 1] for r in range(1, WINDOW + 1)]
    for start in range(0, n, BATCH):
        # By rank, the codes rise in length, and the nodes of every depth rise too.
        at = order[start : start + BATCH]
        at = at[np.argsort(rank[at], kind="stable")]
        rate = RATE * max(1 - start / (n + 1), 1e-4)
        centre, middle, far = words[at], place[at], reach[at]
        code = length[centre]
        node, want = nodes.take(centre, 0)[:, : code[-1]], wanted.take(centre, 0)[:, : code[-1]]
        inner_steps = np.empty((code[-1], len(at), size), np.float32)
        contexts, outer_steps = [], []
        for around in windows:
            alike = np.flatnonzero(far == around[-1])
            for low in range(0, len(alike), SLICE):
                some = alike[low : low + SLICE]
                longest = code[some[-1]]
                context = text.take(middle[some][:, None] + around)
                # Places without a word or a node meet a row of zeros, so they move nothing else.
                h, v = outer.take(context, 0), inner.take(node.take(some, 0)[:, :longest], 0)
                score = h @ v.transpose(0, 2, 1)
                step = np.exp(-score)
                step += 1
                np.reciprocal(step, out=step)
                np.subtract(want.take(some, 0)[:, None, :longest], step, out=step)
                if max(score.max(initial=0), -score.min(initial=0)) >= MAX_SCORE:
                    step[np.abs(score) >= MAX_SCORE] = 0
                contexts.append(context.ravel())
                outer_steps.append((step @ v).reshape(-1, size))
                inner_steps[:longest, some] = (step.transpose(0, 2, 1) @ h).transpose(1, 0, 2)
        context = np.concatenate(contexts)
        by_word = np.argsort(context)
        by_word = by_word[: len(context) - np.count_nonzero(context == n_words)]
        context = context[by_word]
        moved[context] = True
        _add(outer, context, np.concatenate(outer_steps).take(by_word, 0), np.ones(len(context), np.int64), rate)
        on_path = np.flatnonzero(np.arange(code[-1])[:, None] < code)
        _add(inner, node.T.ravel()[on_path], inner_steps.reshape(-1, size).take(on_path, 0), pairs_of[at].take(on_path % len(at)), rate)
    return outer[:-1], moved[:-1]


def _trainer(starts: tuple[np.ndarray, np.ndarray], size: int, seed: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def train_part(key: tuple, sentences: pa.Table, known: pa.Table) -> pa.Table:
        tokens = sentences["tokens"].combine_chunks()
        sentence = np.repeat(np.arange(len(tokens)), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
        words = pc.fill_null(pc.index_in(tokens.flatten(), value_set=known["token"].combine_chunks()), -1).to_numpy(zero_copy_only=False)
        kept = words >= 0
        vectors, moved = train(
            words[kept], sentence[kept], first_vectors(known["hash"].to_numpy(), size), known["token_id"].to_numpy(), starts,
            seed + key[0].as_py(),
        )
        flat = pa.array(vectors.ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32)), flat)
        return pa.table({"word": known["token"], "n": known["n"], "vector": lists, "moved": pa.array(moved)})

    return train_part


def sharded_word_vectors(
    df: DataFrame, tokens_col: str, counts: DataFrame, size: int = 16, partitions: int = 8, seed: int = 42
) -> "WordVectors":
    """Word vectors of ``df``, trained in at least ``partitions`` parts; ``counts`` is its ``word_counts``.

    A row's part is drawn by its place in the table. The driver gets one row per different count (their number grows with the root of the text) and no word.
    """
    volume = counts.agg(F.sum(F.col("n") * (F.octet_length("token") + 1))).first()[0] or 0
    parts = max(partitions, -(-volume // PART_BYTES))
    begins = F.sequence(F.lit(1), F.size(tokens_col), F.lit(SENTENCE))
    pieces = F.transform(begins, lambda begin: F.slice(tokens_col, begin, SENTENCE))
    sentences = df.filter(F.size(tokens_col) > 0).select(F.explode(pieces).alias("tokens"))
    drawn = F.floor(F.rand(seed) * parts).cast("int")
    dealt = materialize(sentences.withColumn("part", drawn), "sentences").repartitionById(parts, F.col("part"))
    vocab = build_vocabulary(counts, first_id=0)
    histogram = {n: many for n, many in vocab.groupBy("n").agg(F.count(F.lit(1))).collect()}
    starts = code_starts(code_lengths(histogram))
    # A partition is a part, so its words lie together already; the texts are shuffled once for their words and for the training (a plain
    # explode would add a non-empty check before that shuffle, which then is another one).
    own = dealt.select("part", F.explode_outer("tokens").alias("token")).distinct()
    known = keyed_lookup(own, vocab, "token", "n").withColumnRenamed("part", "own_part").repartitionById(parts, F.col("own_part"))
    known = known.withColumn("hash", F.xxhash64("token", F.lit(seed)))
    trained = dealt.groupBy("part").cogroup(known.groupBy("own_part")).applyInArrow(
        _trainer(starts, size, seed), "word string, n bigint, vector array<float>, moved boolean"
    )
    # A word without a neighbour keeps its first vector.
    cells = [
        F.coalesce(F.avg(F.when(F.col("moved"), F.col("vector")[i])), F.max(F.col("vector")[i])).cast("float") for i in range(size)
    ]
    # Moved before they are combined: sums are several times as wide as vectors, and a part has a word once.
    means = trained.repartition(F.col("word")).groupBy("word").agg(F.max("n").alias("n"), F.array(*cells).alias("vector"))
    return WordVectors(materialize(means, "word-vectors"), tokens_col, size)


class WordVectors:
    """Word vectors as a written table ``(word, n, vector)``; used as MLlib's ``Word2VecModel`` is."""

    def __init__(self, words: DataFrame, tokens_col: str, size: int):
        self.words, self.tokens_col, self.size = words, tokens_col, size

    def getVectorSize(self) -> int:
        return self.size

    def getVectors(self) -> DataFrame:
        return self.words.select("word", array_to_vector("vector").alias("vector"))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean of its words' vectors as ``embedding``; zero without words. Rows may repeat: each is numbered and written once."""
        length = F.greatest(F.size(self.tokens_col), F.lit(1))
        rows = materialize(df.withColumns({"_row": F.monotonically_increasing_id(), "_length": length}), "word-vector-rows")
        tokens = rows.select("_row", F.explode(self.tokens_col).alias("word"))
        found = keyed_lookup(tokens, self.words, "word", "n")
        sums = found.groupBy("_row").agg(
            *[F.sum(F.col("vector")[i].cast("double")).alias(f"_s{i}") for i in range(self.size)]
        )
        cells = F.array(*[F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) / F.col("_length") for i in range(self.size)])
        return rows.join(sums, "_row", "left").select(*df.columns, array_to_vector(cells).alias("embedding"))
