"""Pruned search, inverted files, exact quantiles, sketches and rules as a table."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import cleaning, inverted, pruned, quantiles, retrieval, rules, sketches
from textloom.operators.chat import INTENT_RULES, intent
from textloom.operators.nearest import nearest_k
from textloom.plans.cleaning import pairs
from textloom.plans.retrieval import _asked, centroids
from textloom.sources.tables import load


def weighted(spark, seed=0, docs=60, words=30):
    random = np.random.default_rng(seed)
    rows = [(d, f"w{w}", float(random.integers(1, 9)) / 4) for d in range(docs) for w in np.unique(random.zipf(1.4, 8) % words)]
    asked = [(q, f"w{w}", float(random.integers(1, 9)) / 4) for q in range(25) for w in np.unique(random.zipf(1.3, 6) % (words + 5))]
    return rows, asked, spark.createDataFrame(rows, "doc_id long, token string, weight double"), spark.createDataFrame(asked, "query_id long, token string, weight double")


@pytest.mark.parametrize("block_docs", [1, 4, 100])
@pytest.mark.parametrize("term_rows", [0, 100_000])
def test_pruned_search_is_exact(spark, monkeypatch, block_docs, term_rows):
    monkeypatch.setattr(pruned, "TERM_ROWS", term_rows)
    monkeypatch.setattr(pruned, "ROWS_PER_PART", 5)
    rows, asked, postings, terms = weighted(spark, block_docs)
    found = pruned.best_match_pruned(postings, terms, 60, block_docs)
    weight = {(d, w): x for d, w, x in rows}
    wanted = {}
    for q in {q for q, _, _ in asked}:
        scores = {}
        for d in range(60):
            shared = [x * weight[d, w] for k, w, x in asked if k == q and (d, w) in weight]
            if shared:
                scores[d] = round(sum(shared), 6)
        if scores:
            wanted[q] = (min(d for d, s in scores.items() if s == max(scores.values())), max(scores.values()))
    assert {r.query_id: (r.doc_id, r.score) for r in found.best.collect()} == wanted
    work = found.work.first()
    assert work.postings == sum(1 for _, w, _ in asked for d in range(60) if (d, w) in weight)


def test_pruned_plans_answer_as_the_full_ones(spark, sf, monkeypatch):
    bank = pairs(spark, sf).select(F.col("pair_id").alias("doc_id"), F.col("question").alias("text"))
    asked = _asked(spark, sf).unionByName(spark.createDataFrame([(-1, "zzzz qqqq"), (-2, "")], "query_id long, text string"))
    for retrieve in (retrieval.retrieve_bm25, retrieval.retrieve_tfidf):
        full, skipped = ({r.query_id: (r.doc_id, r.score) for r in retrieve(bank, asked, prune=p).collect()} for p in (False, True))
        assert full == skipped and full[-1][1] == 0.0
    # The plan is picked by the measured number of pairs.
    chosen = []
    monkeypatch.setattr(retrieval, "best_match_pruned", lambda *a, best=retrieval.best_match_pruned: chosen.append(1) or best(*a))
    for bound, pruned_plans in ((10**9, 0), (10, 1)):
        monkeypatch.setattr(retrieval, "SCORED_ROWS", bound)
        assert {r.query_id: (r.doc_id, r.score) for r in retrieval.retrieve_tfidf(bank, asked).collect()} == full
        assert len(chosen) == pruned_plans


def test_pruned_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, token string, weight double")
    terms = spark.createDataFrame([(1, "a", 1.0)], "query_id long, token string, weight double")
    found = pruned.best_match_pruned(none, terms, 0)
    assert found.best.count() == 0 and tuple(found.work.first()) == (0, 0, 0)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_inverted_files_find_and_prune(spark, sf_dir):
    bank = load(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    total = bank.count()
    for asked, exclude_self in ((centroids(spark, sf_dir), False), (bank.filter("vec_id % 10 = 0"), True)):
        got = {r.query_id: r for r in inverted.retrieve_inverted(bank, asked, exclude_self=exclude_self).collect()}
        exact = {r.query_id: r.match_id for r in nearest_k(asked, bank, "vec_id", "embedding", exclude_self=exclude_self).collect()}
        assert got.keys() == exact.keys()
        assert sum(got[q].match_id == m for q, m in exact.items()) >= 0.9 * len(exact)
        assert sum(r.met for r in got.values()) <= 0.15 * total * len(got)
        assert all(r.compared <= r.met for r in got.values())


def test_inverted_files_with_equal_odd_and_no_vectors(spark, monkeypatch):
    monkeypatch.setattr(inverted, "LIST_ROWS", 16)
    monkeypatch.setattr(inverted, "QUERY_ROWS", 8)
    rows = [(i, [1.0, 0.1 * (i % 3), 0.2]) for i in range(5, 300)] + [(400, [0.0, 1.0, 0.0]), (401, None), (402, [0.0, 0.0, 0.0])]
    bank = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.query_id: r for r in inverted.retrieve_inverted(bank, bank, exclude_self=True, share=1.0).collect()}
    exact = {r.query_id: r.match_id for r in nearest_k(bank, bank, "vec_id", "embedding", exclude_self=True).collect() if math.isfinite(r.score)}
    assert {q: r.match_id for q, r in got.items()} == {q: m for q, m in exact.items() if q != 402}
    assert got[5].compared >= 98  # copies count
    # Of several probed lists that hold a vector it is met once.
    assert max(r.met for r in got.values()) <= 5
    none = bank.filter("vec_id < 0")
    assert inverted.retrieve_inverted(none, bank).count() == 0 and inverted.retrieve_inverted(bank, none).count() == 0


def test_images_keep_the_order():
    values = np.array([-np.inf, -1e300, -2.5, -1e-320, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 7e200, np.inf, np.nan])
    keys = quantiles.image(values)
    assert (np.diff(keys) >= 0).all() and keys[4] == keys[5] and len(np.unique(keys)) == 11
    assert all(quantiles.value_of(int(k)) == v or math.isnan(v) for k, v in zip(keys, values))


def test_quantiles_by_narrowing(spark, monkeypatch):
    random = np.random.default_rng(2)
    cells = {"even": random.uniform(-1, 1, 700), "tail": np.exp(30 * random.normal(size=501)), "same": np.full(300, 2.5), "two": np.array([1.0, 4.0]), "one": np.array([7.0])}
    rows = [(m, float(v)) for m, vs in cells.items() for v in vs]
    table = quantiles.with_image(spark.createDataFrame([*rows, ("even", None)], "measure string, value double").withColumn("n", F.lit(1)), "value")
    got = quantiles.quantiles(table, {**{m: len(v) for m, v in cells.items()}, "none": 0}, [0.0, 0.25, 0.5, 0.9, 1.0])
    for m, values in cells.items():
        assert got[m] == pytest.approx(np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]).tolist(), rel=1e-12)
    assert got["none"] == [None] * 5
    # A profile gives the same by one buffer and by narrowing.
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(cells["even"])], "i int, v double")
    profiles = []
    for bound in (10_000, 5):
        monkeypatch.setattr(cleaning, "BUFFERED", bound)
        profiles.append({r.measure: r for r in cleaning.numeric_profile(df, {"i": F.col("i") % 20}, {"v": F.col("v"), "none": F.lit(None)}).collect()})
    for name in ("i", "v"):
        assert tuple(profiles[0][name]) == pytest.approx(tuple(profiles[1][name]), rel=1e-12) if name == "none" else profiles[0][name][1:] == pytest.approx(profiles[1][name][1:])


def test_sketches_unite(spark):
    df = spark.range(30_000).select((F.col("id") % 7).alias("part"), (F.col("id") % 9000).alias("user")).unionByName(
        spark.createDataFrame([(0, None)], "part long, user long")
    )
    stored = sketches.sketch(df, ["part"], "user")
    row, = sketches.estimated(sketches.unite(stored, [], F.count(F.lit(1)).alias("parts"))).collect()
    assert row.parts == 7 and abs(row.estimate - 9000) <= 4 * sketches.relative_error() * 9000
    assert sketches.estimated(sketches.sketch(df.filter("user IS NULL"), ["part"], "user")).first().estimate == 0


def test_rules_as_a_table_find_what_the_patterns_find(spark, sf):
    texts = load(spark, sf, "conversations").select("text").unionByName(
        spark.createDataFrame([("This is odd",), ("hi",), ("I'M HAPPY",), ("noſe ſure",), ("K no_ no",), ("Straße nO",), ("",), (None,), ("é hi é",), ("éhié",)], "text string")
    )
    table = rules.rules_table(spark, INTENT_RULES)
    for mode in ("search", "word"):
        got = rules.classify(texts, table, mode=mode).withColumn("wanted", intent("text", mode=mode))
        assert got.filter("NOT intent <=> wanted").collect() == []


def test_thousands_of_rules_leave_the_plan_as_it_is(spark):
    few, many = (rules.rules_table(spark, {f"i{n}": [f"word{n}x", f"other {n}."] for n in range(k)}) for k in (2, 5000))
    texts = spark.createDataFrame([("a WORD4999X and word17x",), ("none",), ("Other 3000. word3001x",)], "text string")
    plans = [rules.classify(texts, table)._jdf.queryExecution().optimizedPlan().toString() for table in (few, many)]
    assert len(plans[0]) == pytest.approx(len(plans[1]), abs=50)
    assert [r.intent for r in rules.classify(texts, many).collect()] == ["i17", "fallback", "i3000"]


def test_odd_rules(spark):
    texts = spark.createDataFrame([("abc",), ("",), (None,)], "text string")
    table = spark.createDataFrame([(5, "late", "b"), (1, "first", "bc"), (1, "second", "bc"), (None, "x", "a"), (0, None, "a"), (0, "y", None)], "place long, intent string, pattern string")
    assert [r.intent for r in rules.classify(texts, table).collect()] == ["first", "fallback", "fallback"]
    everything = table.unionByName(spark.createDataFrame([(9, "any", "")], table.schema))
    assert [r.intent for r in rules.classify(texts, everything).collect()] == ["first", "any", "fallback"]
    assert [r.intent for r in rules.classify(texts, table.limit(0)).collect()] == ["fallback"] * 3
