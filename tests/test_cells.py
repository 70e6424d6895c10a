"""Exact neighbours by cells: the same answers, with few copies where the vectors have clusters."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import nearest


def clustered(seed, clusters=12, each=30, dims=6):
    random = np.random.default_rng(seed)
    centres = 40 * random.normal(size=(clusters, dims))
    return np.concatenate([c + random.normal(size=(each, dims)) for c in centres])


def brute(rows, k, metric, scope):
    points = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True)) if metric == "cosine" else rows
    wanted = {}
    for i in range(len(rows)):
        score = points @ points[i] if metric == "cosine" else -((points - points[i]) ** 2).sum(axis=1)
        order = sorted((-round(float(s), 9), j) for j, s in enumerate(score) if j != i and scope(i) == scope(j))
        wanted[i] = [j for _, j in order[:k]]
    return wanted


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("scoped", [False, True])
def test_neighbours_by_cells(spark, metric, scoped):
    rows = clustered(1)
    table = [(i, v.tolist(), str(i % 2)) for i, v in enumerate(rows)] + [(900, None, "0")] + ([(901, [0.0] * 6, "1")] if metric == "cosine" else [])
    df = spark.createDataFrame(table, "id long, v array<double>, c string")
    got = {}
    for r in nearest.nearest_k(df, df, "id", "v", 3, metric=metric, scope="c" if scoped else None, exclude_self=True, block_rows=16, max_query_rows=1).collect():
        got.setdefault(r.query_id, []).append((r.place, r.match_id))
    wanted = brute(rows, 3, metric, (lambda i: i % 2) if scoped else (lambda i: 0))
    assert {q: [m for _, m in sorted(ms)] for q, ms in got.items()} == wanted


def test_vectors_travel_to_few_cells(spark):
    rows = clustered(2, clusters=20, each=40)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, v array<double>").withColumn("s", F.lit(7).cast("long"))
    queries, bank = nearest._by_cells(df, df, 4, "l2", 32)
    assert queries.count() == len(rows) and bank.count() < 6 * len(rows)  # of 25 blocks
    assert bank.select("id").distinct().count() == len(rows)
    # Without clusters every vector would travel to every cell: the blocks meet instead.
    even = np.random.default_rng(3).normal(size=(400, 64))
    flat = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(even)], "id long, v array<double>").withColumn("s", F.lit(7).cast("long"))
    assert nearest._by_cells(flat, flat, 4, "cosine", 200) is None


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], str(i % 3)) for i in range(7)], "id long, v array<double>, c string")
    got = nearest.nearest_k(df, df, "id", "v", 5, metric="l2", scope="c", exclude_self=True, block_rows=2, max_query_rows=1).collect()
    assert sorted((r.query_id, r.match_id) for r in got) == sorted((i, j) for i in range(7) for j in range(7) if i != j and i % 3 == j % 3)
