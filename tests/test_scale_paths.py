"""The ways taken for large or skewed input give what the plain ways give."""

from __future__ import annotations

import contextlib
import heapq
import io
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

import __spark_entry__ as entry
from textloom.operators import balance, lookup, ml, nearest, ranking, retrieval, skipgram, vectorize, vocabulary
from textloom.operators.ordered import blocked_window
from textloom.plans import cleaning
from textloom.sources.scratch import new_path


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """One key owns most rows; order values have gaps and some values are null."""
    rng = random.Random(7)
    rows = []
    for key, n in (("hot", 400), ("warm", 30), ("cold", 1)):
        for order in sorted(rng.sample(range(2000), n)):
            rows.append((key, order, rng.choice([None, "a", "b", "c"]), rng.randint(0, 3)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, o bigint, v string, x bigint")


@pytest.mark.parametrize("span", [1, 7, 100, 5000])
def test_blocked_window_equals_plain_window(skewed, span):
    w = Window.partitionBy("k").orderBy("o")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select(
        "k", "o", F.sum("x").over(upto).alias("s"), F.last("v", True).over(upto).alias("l"),
        F.lead("v").over(w).alias("n"), F.lag("x").over(w).alias("p"),
    )
    for measure in (True, False):
        blocked = blocked_window(
            skewed, ["k"], "o", sums={"s": "x"}, lasts={"l": "v"}, nexts={"n": "v"}, prevs={"p": "x"},
            span=span, measure=measure,
        ).select("k", "o", "s", "l", "n", "p")
        assert sorted(map(str, blocked.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_rank_is_dense_per_group(skewed, digits):
    rows = skewed.withColumn("id", F.concat_ws("-", "k", "o"))
    ranked = ranking.hash_rank(rows, 1, "id", ["k"], digits=digits)
    plain = Window.partitionBy("k").orderBy(F.md5(F.concat_ws(":", F.lit("1"), "id")), "id")
    wrong = ranked.withColumn("_w", F.row_number().over(plain)).filter("rank <> _w")
    assert wrong.count() == 0
    assert rows_of(ranked.groupBy("k").agg(F.max("rank"), F.max("group_size"))) == [
        ("cold", 1, 1), ("hot", 400, 400), ("warm", 30, 30),
    ]


def test_hash_rank_takes_null_as_a_group(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id bigint, c string")
    got = ranking.hash_rank(rows, 1, "id", ["c"]).select("c", "rank", "group_size")
    assert sorted(map(str, got.collect())) == sorted(
        ["Row(c=None, rank=1, group_size=2)", "Row(c=None, rank=2, group_size=2)", "Row(c='a', rank=1, group_size=1)"]
    )


def test_global_rank(skewed):
    ranked = ranking.global_rank(skewed.select("k", "o"), [F.desc("k"), F.col("o")])
    got = [tuple(r) for r in ranked.orderBy("rank").select("k", "o", "rank").collect()]
    want = sorted(((r.k, r.o) for r in skewed.collect()), key=lambda r: ([-ord(c) for c in r[0]], r[1]))
    assert [g[2] for g in got] == list(range(1, 432))
    assert [(g[0]) for g in got] == [w[0] for w in want]
    assert [g[1] for g in got if g[0] == "hot"] == [w[1] for w in want if w[0] == "hot"]


@pytest.mark.parametrize("values", [[5], [3, 3, 3, 9], list(range(-50, 1000, 7)), [0, 10**12, 5, 5, -(10**12)]])
def test_kth_smallest(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for k in range(1, len(values) + 1, max(1, len(values) // 5)):
        assert ranking.kth_smallest(df, "v", k, fanout=4) == sorted(values)[k - 1]
    assert ranking.kth_smallest(df, "v", len(values) + 1) is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_keyed_lookup_head_and_tail(spark, monkeypatch, how):
    rows = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["the"] * 50 + ["of"] * 9 + ["rare", "odd", "gone"])], "i bigint, token string"
    )
    table = spark.createDataFrame(
        [("the", 1, 50), ("of", 2, 9), ("rare", 3, 1), ("odd", 4, 1)], "token string, token_id bigint, n bigint"
    )
    whole = lookup.keyed_lookup(rows, table, "token", "n", how)
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a, **k: False)
    split = lookup.keyed_lookup(rows, table, "token", "n", how, head=1)
    assert sorted(map(str, split.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    # Grouping the two parts again must not rely on their partitioning.
    assert split.groupBy("token").count().count() == whole.select("token").distinct().count()


def _vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, dim)).round(3)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("scope", [None, "c"])
def test_nearest_grid_and_stream_equal_brute_force(spark, metric, scope):
    v = _vectors(60, 5, 3)
    v[7] = v[3]  # a tie
    cats = [0 if i % 3 else 1 for i in range(60)]
    df = spark.createDataFrame(
        [(i, [float(x) for x in v[i]], cats[i]) for i in range(60)], "id bigint, v array<float>, c int"
    )
    v = v.astype(np.float32).astype(np.float64)
    want = []
    for i in range(60):
        scored = []
        for j in range(60):
            if i == j or (scope and cats[i] != cats[j]):
                continue
            s = v[i] @ v[j] / math.sqrt((v[i] @ v[i]) * (v[j] @ v[j])) if metric == "cosine" else -((v[i] - v[j]) @ (v[i] - v[j]))
            scored.append((-round(s, 9), j))
        want += [(i, place, j) for place, (_, j) in enumerate(sorted(scored)[:3], start=1)]
    for bound in (4096, 1):
        got = nearest.nearest_k(
            df, df, "id", "v", 3, metric=metric, scope=scope, exclude_self=True, block_rows=8, max_query_rows=bound
        ).select("query_id", "place", "match_id")
        assert rows_of(got) == want


def test_zero_vectors_never_match(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "id bigint, v array<double>")
    got = nearest.nearest_k(df, df, "id", "v", 1).select("query_id", "match_id")
    assert rows_of(got) == [(2, 2)]


DOCS = [
    "How do I reset my password", "Where is my card", "card lost or stolen card", "opening hours of the branch",
    "the the the", "", "How do I reset my PIN of the card",
]
ASKED = ["lost card", "reset password password", "nothing known", "of the"]


def _words(text):
    import re

    return re.findall(r"\w{2,}", text.lower())


def _brute_bm25():
    docs = [_words(d) for d in DOCS]
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = {t: sum(t in d for d in docs) for d in docs for t in d}
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if x < 0 else x for t, x in idf.items()}
    out = []
    for qi, q in enumerate(ASKED):
        scores = []
        for d in docs:
            s = 0.0
            for t in _words(q):
                f = d.count(t)
                s += idf.get(t, 0.0) * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * len(d) / avgdl))
            scores.append(round(s, 6))
        best = max(range(n), key=lambda i: (scores[i], -i))
        out.append((qi, best, scores[best]))
    return out


def _brute_tfidf():
    docs = [_words(d) for d in DOCS]
    n = len(docs)
    df = {t: sum(t in d for d in docs) for d in docs for t in d}
    idf = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in df.items()}

    def unit(words):
        w = {t: words.count(t) * idf[t] for t in set(words) if t in idf}
        size = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / size for t, x in w.items()} if size else {}

    out = []
    for qi, q in enumerate(ASKED):
        a = unit(_words(q))
        scores = [round(sum(x * unit(d).get(t, 0.0) for t, x in a.items()), 6) for d in docs]
        best = max(range(n), key=lambda i: (scores[i], -i))
        out.append((qi, best, scores[best]))
    return out


@pytest.mark.parametrize("blocks", [False, True])
@pytest.mark.parametrize("method, brute", [("retrieve_bm25", _brute_bm25), ("retrieve_tfidf", _brute_tfidf)])
def test_sparse_retrieval_equals_brute_force(spark, monkeypatch, method, brute, blocks):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id bigint, text string")
    asked = spark.createDataFrame(list(enumerate(ASKED)), "query_id bigint, text string")
    if blocks:
        monkeypatch.setattr(retrieval, "QUERY_TERM_ROWS", 3)
        monkeypatch.setattr(retrieval, "POSTINGS_PER_PART", 2)
    got = getattr(retrieval, method)(docs, asked).select("query_id", "doc_id", "score")
    assert rows_of(got) == brute()


def test_draw_slots_unfold_in_chunks(spark):
    sizes = spark.createDataFrame([("a", 3, 10), ("b", 10, 10)], "c string, n bigint, max_n bigint")
    slots = balance.draw_slots(sizes, "c", F.col("max_n") - F.col("n") + 1, chunk=3)
    assert rows_of(slots.select("c", "draw")) == [("a", i) for i in range(1, 9)] + [("b", 1)]


def test_one_row_class_is_drawn_without_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(balance, "DRAWS_PER_KEY", 1000)
    rows = spark.range(20_000).select("id", F.when(F.col("id") == 7, "rare").otherwise("common").alias("c"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50kb")
    try:
        drawn = balance.oversample_all(rows, "id", "c")
        assert rows_of(drawn.groupBy("c").count()) == [("common", 19_999), ("rare", 19_999)]
        tree = drawn._jdf.queryExecution().toString()
        assert "BroadcastExchange" not in tree or "Generate" not in tree.split("BroadcastExchange", 1)[1].split("Exchange hash", 1)[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_std_of_large_values(spark):
    from textloom.operators.cleaning import numeric_profile

    base = 3_000_000_000
    got = numeric_profile(spark.createDataFrame([(base + i,) for i in (0, 1, 2)], "x bigint"), {"x": F.col("x")}).first()
    assert got["std"] == 1.0 and got["mean"] == base + 1


@pytest.mark.parametrize("name", ["oversample", "split_stratified", "smote", "retrieve_bm25", "sessions", "vocab_keras"])
def test_same_result_under_any_partitioning(spark, sf, name):
    import __spark_entry__ as entry

    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = sorted(map(str, entry.queries()[name](spark, sf).collect()))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert sorted(map(str, entry.queries()[name](spark, sf).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_token_rows_are_dealt_by_the_volume_of_their_texts(spark):
    df = spark.createDataFrame([(i, "word " * 40) for i in range(100)], "id bigint, text string")  # 20,000 bytes
    assert vocabulary.text_parts(df, part_bytes=100) == 200
    assert vocabulary.text_parts(df) == spark.sparkContext.defaultParallelism


def test_keyed_lookup_of_short_and_long_texts(spark, monkeypatch):
    words = ["a", "b" * 31, "c" * 32, "d" * 33, "e" * 500, None, "gone"]
    rows = spark.createDataFrame(list(enumerate(words)), "i bigint, token string")
    table = spark.createDataFrame([(w, i, i + 1) for i, w in enumerate(words[:5])], "token string, token_id bigint, n bigint")
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a, **k: False)
    found = {r.i: r.token_id for r in lookup.keyed_lookup(rows, table, "token", "n", "left", head=2).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: None, 6: None}
    monkeypatch.setattr(lookup, "MAX_BYTES", 150)  # the heaviest keys that are broadcast keep to the bound
    heavy = []
    monkeypatch.setattr(lookup, "materialize", lambda df, name: heavy.append(df) or df)
    assert lookup.keyed_lookup(rows, table, "token", "n").count() == 5 and heavy[0].count() < 5


def test_tfidf_looks_a_word_up_once(spark, monkeypatch):
    counts = spark.createDataFrame([(1, "a", 2), (1, "x", 1), (1, "y", 3), (2, "b", 1)], "id bigint, token string, tf bigint")
    vocab = spark.createDataFrame([("a", 2, 1, 1), ("b", 1, 1, 2)], "token string, n bigint, df bigint, token_id bigint")
    looked = []
    monkeypatch.setattr(vectorize, "keyed_lookup", lambda *a: looked.append(a[2]) or lookup.keyed_lookup(*a))
    n_docs = spark.range(1).selectExpr("2 AS n")
    weights = {(r.id, r.token_id): r.weight for r in vectorize.tfidf_vectors(counts, vocab, n_docs, "id").collect()}
    idf = math.log(2)
    assert looked == ["token"]
    assert weights == pytest.approx({(1, 1): 2 * idf, (1, 0): 4 * idf, (2, 2): idf})


def test_word_vectors_are_compared_whole(spark, sf):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        entry.queries()["embed_w2v_is_mean"](spark, sf).explain()
    assert "posexplode" not in text.getvalue()


def _huffman(counts):
    """Words per code length, and the cost, by merging word by word."""
    heap = [(n, i, {0: 1}) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (n, i, a), (m, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (n + m, i, {d + 1: a.get(d, 0) + b.get(d, 0) for d in {*a, *b}}))
        yield n + m


@pytest.mark.parametrize("counts", [[5], [1, 1], [1] * 13, [1, 1, 2, 3, 5, 8, 13, 21], [9, 9, 9, 4, 4, 1, 1, 1, 1, 1], [7, 3, 3, 2, 2, 2, 1] * 5])
def test_code_of_many_words_from_a_histogram(counts):
    lengths = skipgram.code_lengths(Counter(counts))
    ordered = [length for length, many in enumerate(lengths) for _ in range(many)]
    assert len(ordered) == len(counts)
    assert sum(n * length for n, length in zip(sorted(counts, reverse=True), ordered)) == sum(_huffman(counts))
    length, nodes, bits, n_nodes = skipgram.paths(np.arange(len(counts)), skipgram.code_starts(lengths))
    assert length.tolist() == ordered and n_nodes == len(counts) - 1
    codes = ["".join(str(int(b)) for b in row[:k]) for row, k in zip(bits, length)]
    assert not any(a != b and b.startswith(a) for a in codes for b in codes) and len(set(codes)) == len(counts)
    assert all((row[k:] == n_nodes).all() for row, k in zip(nodes, length))


def test_words_past_the_bound_never_meet_on_the_driver(spark, monkeypatch):
    rng = random.Random(1)
    topics = [[f"{t}{i}" for i in range(12)] for t in "ab"]
    texts = [[rng.choice(topics[i % 2]) for _ in range(30)] for i in range(1200)]
    texts += [["a1"] * 2500, ["alone"], [], None, ["a1", "b1"]]
    rows = [(i // 2 if i else None, t) for i, t in enumerate(texts)]  # ids repeat, one is null
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    monkeypatch.setattr(ml, "DRIVER_WORDS", 0)
    monkeypatch.setattr(ml, "Word2Vec", None)  # MLlib's, which holds all words
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(skipgram, "PART_BYTES", 20_000)
    model = ml.word_vectors(df, "tokens")
    vectors = {r.word: np.array(r.vector.toArray()) for r in model.getVectors().collect()}
    assert set(vectors) == {"alone", *topics[0], *topics[1]} and model.getVectorSize() == 16
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items()}
    a, b = (np.array([unit[w] for w in topic if w not in ("a1", "b1")]) for topic in topics)
    assert (a @ a.T).mean() > (a @ b.T).mean() + 0.5 and (b @ b.T).mean() > (a @ b.T).mean() + 0.5
    out = model.transform(df.withColumn("rest", F.lit(1)))
    assert out.columns == ["id", "tokens", "rest", "embedding"]
    found = [(r.id, r.tokens, r.embedding.toArray()) for r in out.collect()]
    assert sorted(map(repr, rows)) == sorted(repr((i, t)) for i, t, _ in found)
    for _, tokens, mean in found:
        assert np.allclose(mean, np.mean([vectors[t] for t in tokens], axis=0) if tokens else np.zeros(16), atol=1e-6)
    frequent = ml.word_vectors(df, "tokens", min_count=2000).getVectors()
    assert [r.word for r in frequent.collect()] == ["a1"]


def test_means_of_words_past_the_bound(spark, sf, monkeypatch):
    monkeypatch.setattr(ml, "DRIVER_WORDS", 0)
    monkeypatch.setattr(ml, "Word2Vec", None)
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert [tuple(r) for r in entry.queries()["embed_w2v_is_mean"](spark, sf).collect()] == [(n, True)]
    assert entry.queries()["embed_w2v"](spark, sf).dtypes == [("doc_id", "bigint"), ("lang", "string"), ("embedding", "vector")]


def test_splits_grow_with_their_files(spark, monkeypatch):
    path = new_path(spark, "splits")
    spark.range(5000).selectExpr("repeat('x', 99) AS value").coalesce(2).write.text(path)
    assert cleaning.split_bytes(spark, path) == cleaning.SPLIT_BYTES
    monkeypatch.setattr(cleaning, "SPLITS", 10)
    assert cleaning.split_bytes(spark, path) == 50_000


def test_training_sorts_no_codes_and_handles_ends_of_texts():
    rng = np.random.default_rng(3)
    starts = skipgram.code_starts(skipgram.code_lengths(Counter({1: 40, 2: 20, 5: 9, 90: 2})))
    ranks = rng.permutation(71)
    words = rng.choice(71, 900, p=(1 / (1 + ranks)) / (1 / (1 + ranks)).sum())
    sentence = np.repeat(np.arange(260), rng.multinomial(900, [1 / 260] * 260))  # many of one to four words, some of none
    first = skipgram.first_vectors(np.arange(71) * 99991, 6)
    seen = []
    add = skipgram._add

    def rising(table, rows, steps, pairs, rate):
        assert (np.diff(rows) >= 0).all() and (rows < len(table) - 1).all()
        seen.append((len(table), int(pairs.sum())))
        add(table, rows, steps, pairs, rate)

    def by_pair(batch):
        """Pair by pair, with all steps of a batch taken at its end."""
        length, nodes, bits, n_nodes = skipgram.paths(ranks, starts)
        outer, inner, moved = first.astype(float), np.zeros((n_nodes, 6)), set()
        draw = np.random.default_rng(7)
        order, reach = draw.permutation(900), draw.integers(1, skipgram.WINDOW + 1, 900)
        for start in range(0, 900, batch):
            out, inn, many = np.zeros_like(outer), np.zeros_like(inner), [np.zeros(71), np.zeros(n_nodes)]
            for i in order[start : start + batch]:
                for j in range(max(0, i - reach[i]), min(900, i + reach[i] + 1)):
                    if j == i or sentence[i] != sentence[j]:
                        continue
                    c, w = words[j], words[i]
                    path, bit = nodes[w, : length[w]], bits[w, : length[w]]
                    step = 1 - bit - 1 / (1 + np.exp(-inner[path] @ outer[c]))
                    out[c] += step @ inner[path]
                    inn[path] += step[:, None] * outer[c]
                    many[0][c] += 1
                    many[1][path] += 1
                    moved.add(c)
            rate = skipgram.RATE * max(1 - start / 901, 1e-4)
            for table, steps, n in ((outer, out, many[0]), (inner, inn, many[1])):
                table += rate * steps * np.minimum(1, skipgram.MAX_PAIRS / np.maximum(n, 1))[:, None]
        return outer, moved

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(skipgram, "_add", rising)
        patch.setattr(skipgram, "BATCH", 100)
        patch.setattr(skipgram, "SLICE", 7)
        vectors, moved = skipgram.train(words, sentence, first, ranks, starts, 7)
    wanted, wanted_moved = by_pair(100)
    assert np.allclose(vectors, wanted, atol=1e-6) and not np.allclose(vectors, first, atol=1e-6)
    assert set(np.flatnonzero(moved)) == wanted_moved and len(seen) == 18
    none, moved = skipgram.train(words[:0], sentence[:0], first, ranks, starts, 7)
    assert (none == first).all() and not moved.any()


def test_words_are_counted_once_for_the_check_of_means(spark, sf, monkeypatch):
    written = []
    for module in (ml, skipgram, lookup, entry.queries()["embed_w2v_is_mean"].__globals__):
        names = module if isinstance(module, dict) else vars(module)
        if "materialize" in names:
            own = names["materialize"]
            monkeypatch.setitem(names, "materialize", lambda df, name, own=own: written.append((name, df.columns)) or own(df, name))
    monkeypatch.setattr(ml, "DRIVER_WORDS", 0)
    row, = entry.queries()["embed_w2v_is_mean"](spark, sf).collect()
    assert row.all_close
    assert [name for name, _ in written].count("word-counts") == 1
    # No table of the words of every text.
    assert not any({"doc_id", "word"} <= set(columns) for _, columns in written)
