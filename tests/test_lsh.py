"""Approximate neighbours find what the exact search finds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import ml, planes
from textloom.operators.ml import retrieve_lsh
from textloom.operators.nearest import nearest_k
from textloom.plans import retrieval
from textloom.plans.retrieval import centroids
from textloom.sources.scratch import materialize
from textloom.sources.tables import load

DIRS = [f"/root/testdata/{sf}" for sf in ("sf0.001", "sf0.01", "sf0.1")]


def measured(bank, asked, exclude_self):
    """Recall, mean share of the bank compared, and share of the queries found by hash."""
    near = {r.query_id: r for r in retrieve_lsh(bank, asked, exclude_self=exclude_self).collect()}
    exact = {r.query_id: r.match_id for r in nearest_k(asked, bank, "vec_id", "embedding", exclude_self=exclude_self).collect()}
    assert near.keys() == exact.keys()
    n, total = len(near), bank.count()
    return (
        sum(near[q].match_id == m for q, m in exact.items()) / n, sum(r.compared for r in near.values()) / n / total,
        sum(not r.exact for r in near.values()) / n,
    )


@pytest.mark.parametrize("sf_dir", DIRS)
def test_recall_of_label_means_and_of_rows_without_themselves(spark, sf_dir):
    bank = load(spark, sf_dir, "embeddings")
    for asked, exclude_self in ((centroids(spark, sf_dir), False), (bank.filter("vec_id % 100 = 0"), True)):
        recall, compared, by_hash = measured(bank, asked, exclude_self)
        assert recall >= 0.9 and by_hash >= 0.9 and compared < 0.2


def test_equal_vectors_and_the_exact_search(spark):
    bank = spark.createDataFrame([(i, [1.0, 0.0, 0.2]) for i in range(5, 300)] + [(400, [0.0, 1.0, 0.0]), (401, None)], "vec_id long, embedding array<float>")
    asked = bank.filter("vec_id IN (5, 6, 400)")
    got = {r.query_id: r for r in retrieve_lsh(bank, asked, exclude_self=True).collect()}
    assert got[5].match_id == 6 and got[6].match_id == 5 and got[400].match_id == 5
    got = {r.query_id: r for r in retrieve_lsh(bank, asked).collect()}
    assert [got[i].match_id for i in (5, 6, 400)] == [5, 5, 400]
    # No key in common: the whole bank is compared, and counted.
    lone = bank.filter("vec_id = 400").withColumn("embedding", F.transform("embedding", lambda x: -x))
    row, = retrieve_lsh(bank, lone, planes=8, tables=1, probes=1).collect()
    assert row.exact and row.compared == 296


def test_quality_counts_fallbacks_and_lost_queries(spark):
    rows = [(1, 5, 5, 10, False), (2, 6, 6, None, True), (3, 7, 8, 100, True), (4, 9, None, None, None)]
    answers = spark.createDataFrame(rows, "query_id long, wanted long, match_id long, compared long, exact boolean")
    row, = retrieval.lsh_quality(answers, 100).collect()
    assert (row.n, row.recall, row.compared, row.by_hash) == (4, 0.5, (0.1 + 3) / 4, 0.25)


def test_the_recall_query_sees_a_search_with_too_few_keys(spark, sf, monkeypatch):
    row, = retrieval.retrieve_lsh_recall(spark, sf).collect()
    assert row.recalled and row.pruned and row.found_by_hash
    few = lambda bank, asked, **kw: retrieve_lsh(bank, asked, planes=8, tables=20, probes=20, **kw)
    monkeypatch.setattr(retrieval, "retrieve_lsh", few)
    row, = retrieval.retrieve_lsh_recall(spark, sf).collect()
    assert not row.recalled


def test_pairs_of_queries_and_vectors_are_never_written(spark, sf, monkeypatch):
    bank = load(spark, sf, "embeddings")
    written = []
    monkeypatch.setattr(ml, "materialize", lambda df, name: written.append(materialize(df, name)) or written[-1])
    assert retrieve_lsh(bank, bank.filter("vec_id % 10 = 0"), exclude_self=True).count() == 50
    assert written and max(table.count() for table in written) <= bank.count()


@pytest.mark.parametrize("exclude_self", [False, True])
def test_blocks_and_ids_that_repeat(spark, monkeypatch, exclude_self):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 6)).round(2)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(i + 300, vectors[i].tolist()) for i in range(0, 300, 20)]  # equal vectors
    rows += [(i, rng.normal(size=6).tolist()) for i in range(0, 300, 30)] + rows[:10]  # ids that repeat, and whole rows
    rows += [(900, [0.0] * 6), (901, [1.0, None, 1.0, 0.0, 0.0, 0.0]), (902, None)]
    bank = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = bank.filter("vec_id % 3 = 0 OR vec_id >= 900")

    def answers():
        found = retrieve_lsh(bank, asked, planes=4, tables=16, probes=80, exclude_self=exclude_self)
        return sorted(map(tuple, found.collect()))

    whole = answers()
    monkeypatch.setattr(planes, "BANK_ROWS", 40)
    monkeypatch.setattr(planes, "QUERY_ROWS", 25)
    assert answers() == whole
    # Brute force over the queries that are one row of an id of its own.
    got = {row[0]: row for row in whole}
    usable = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if v and None not in v and any(v)]
    once = [i for i, n in zip(*np.unique([i for i, _ in rows], return_counts=True)) if n == 1 and i in got and i < 900]
    hits = 0
    for i in once:
        q = dict(usable)[i]
        scores = [(round(float(q @ v), 6), -m) for m, v in usable if not (exclude_self and m == i)]
        hits += max(scores)[0] == pytest.approx(got[i][2], abs=2e-6)
        assert any(-m == got[i][1] and s == pytest.approx(got[i][2], abs=2e-6) for s, m in scores)
    assert hits >= 0.9 * len(once) and len(once) > 50
    assert {901, 900, 902}.isdisjoint(got) and not any(row[4] for row in whole if row[0] in once)
