"""Whitening and near duplicates of embeddings against brute force."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from textloom.llm import vector_dup, whitening
from textloom.llm.queries import QUERIES
from textloom.sources.tables import load

SCHEMA = "vec_id long, embedding array<double>"


def table(spark, rows, schema=SCHEMA):
    clashing = ["component", "n", "id", "digest", "sid", "key", "copies"]
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows]
    return spark.createDataFrame([(*r, *[1] * len(clashing)) for r in rows], f"{schema}, {', '.join(f'{c} int' for c in clashing)}")


def random_rows(n, dims, seed=0):
    return np.random.default_rng(seed).normal(size=(n, dims))


def check_whitening(rows, got, components, dims):
    """All columns from the definition, the covariance in exact fractions."""
    sound = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    listed = sorted({tuple(x) for _, x in sound})
    n, sums = len(listed), [sum(c) for c in zip(*listed)]
    centred = [[n * a - s for a, s in zip(x, sums)] for x in listed]
    exact = [[Fraction(sum(t[i] * t[j] for t in centred), n**3) for j in range(dims)] for i in range(dims)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in exact]))
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, dims)
    wanted = {}
    for i, x in sound:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ vectors[:, :k]
        for c in range(k):
            wanted.setdefault((i, c + 1), []).append((n, deviation, w[c], values[c]))
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted((i is None, i or 0, c) for (i, c), rs in wanted.items() for _ in rs)
    trace = float(sum(exact[i][i] for i in range(dims)))
    signs = {}
    for r in got:
        fits = [(n_, d, w, e) for n_, d, w, e in wanted[r.vec_id, r.component] if d == int(r.deviation) and n_ == r.n]
        assert fits
        _, _, w, e = fits[0]
        if e <= 1e-10 * values[0]:
            assert r.whitened is None
            continue
        assert r.explained == pytest.approx(e / trace, rel=1e-4) and r.identity_error <= 1e-4
        close = [x for _, _, x, _ in fits if abs(abs(r.whitened) - abs(x) / math.sqrt(e)) < 1e-6]
        assert close
        if len(fits) == 1 and abs(w) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * w > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_odd_rows(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(random_rows(300, 6) * [5, 3, 2, 1, 0.5, 0.2])]
    rows += [(400 + i, rows[3][1]) for i in range(80)]  # copies count once
    rows += [(500, None), (501, [1.0, None, 0, 0, 0, 0.0]), (502, [math.nan] * 6), (503, [math.inf, 0, 0, 0, 0, 0.0]), (504, [1.0, 2.0]), (505, [])]
    rows += [(None, [0.5] * 6), (3, [-0.1] * 6), (3, [-0.1] * 6), (506, [-0.0] * 6), (507, [0.001] * 6)]
    got = whitening.whiten(table(spark, rows), components=4).collect()
    check_whitening(rows, got, 4, 6)
    assert {r.n for r in got} == {303}


def test_whitening_without_variance_and_without_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    one = whitening.whiten(table(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == "0" and r.n == 1 for r in one)
    rows = [(i, [float(i), 7.0, -float(i)]) for i in range(20)]  # rank one
    got = whitening.whiten(table(spark, rows)).collect()
    check_whitening(rows, got, 16, 3)
    assert sorted({r.component for r in got if r.whitened is not None}) == [1]


def test_sums_stay_exact_at_any_size(spark):
    random = np.random.default_rng(3)
    for bits in (5, 20, 33, 58):
        t = random.integers(-(1 << bits), 1 << bits, (300, 7))
        assert whitening.square_sums(t).tolist() == [sum(int(v) ** 2 for v in column) for column in t.T]
    x = random.integers(-(1 << 52), 1 << 52, (5, 2))
    sums = tuple(int(s) for s in x.sum(axis=0))
    t = whitening.centred(x, 10**9, sums)
    assert t.tolist() == [[10**9 * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert whitening.square_sums(t).tolist() == [sum(int(v) ** 2 for v in column) for column in t.T]
    rows = spark.range(0, 1000, 1, 7)
    assert whitening.exact_sums(rows, lambda b: [sum(3**70 * (-1) ** i for i in b.column(0).to_pylist()), 7**60 * b.num_rows], 2) == [0, 7**60 * 1000]
    # Very large entries, past 64 bits when centred and squared.
    rows = [(i, (v * 1e12).tolist()) for i, v in enumerate(random_rows(40, 3))] + [(90, [1e300, 0, 0])]
    got = whitening.whiten(table(spark, rows[:-1]), components=3).collect()
    check_whitening(rows[:-1], got, 3, 3)
    assert whitening.whiten(table(spark, rows)).count() == 41 * 3


def linked_components(rows, cosine=0.95):
    vectors = [None if v is None or not v or any(c is None or not math.isfinite(c) for c in v) or not any(v) else np.array(v) for _, v in rows]
    vectors = [None if v is None else v / np.abs(v).max() for v in vectors]
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i + 1, n):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                parent[find(j)] = find(i)
    ids = {}
    for i in range(n):
        ids.setdefault(find(i), []).append(rows[i][0])
    first = {root: min((x for x in xs if x is not None), default=None) for root, xs in ids.items()}
    return [(rows[i][0], links[i], first[find(i)]) for i in range(n)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_links_of_odd_vectors(spark):
    base = random_rows(40, 16, 5)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 10] + 0.08 * e).tolist()) for i, e in enumerate(random_rows(60, 16, 6))]
    rows += [(200 + i, base[0].tolist()) for i in range(30)] + [(300, (7 * base[1]).tolist()), (301, (1e200 * base[2]).tolist()), (302, (1e-200 * base[2]).tolist())]
    rows += [(400, None), (401, [0.0] * 16), (402, [math.nan] * 16), (403, [None] * 16), (404, []), (405, (-base[0]).tolist()), (405, (-base[0]).tolist())]
    rows += [(406, base[0][:8].tolist()), (407, base[0][:8].tolist()), (None, base[3].tolist()), (408, [-0.0] * 16), (None, [math.inf] * 16)]
    got = vector_dup.near_vectors(table(spark, rows)).collect()
    assert ordered((r.vec_id, r.n_links, r.component_id) for r in got) == ordered(linked_components(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_threshold_itself_is_linked(spark):
    rows = [(1, [1.0, 0, 0, 0, 0]), (2, [19.0, 6, 1, 1, 1]), (3, [18.999999, 6, 1, 1, 1])]  # cosine of 1 and 2: 19 / 20
    got = {r.vec_id: r.n_links for r in vector_dup.near_vectors(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_a_hot_group_is_compared_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(vector_dup, "BLOCK", 20)
    centre = random_rows(1, 24, 8)[0]
    rows = [(i, (centre + 0.1 * e).tolist()) for i, e in enumerate(random_rows(150, 24, 9))]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(random_rows(300, 24, 10))]
    got = vector_dup.near_vectors(table(spark, rows)).collect()
    assert ordered((r.vec_id, r.n_links, r.component_id) for r in got) == ordered(linked_components(rows))


def test_no_vectors(spark):
    assert vector_dup.near_vectors(table(spark, [])).count() == 0
    row, = vector_dup.near_vectors(table(spark, [(5, None)])).collect()
    assert tuple(row) == (5, 0, 5, True)


def test_plan_misses_little():
    for count in (1, 1000, 10**6, 10**9):
        k, tables = vector_dup.plan(count, 0.95)
        near = vector_dup.step_chance(math.sqrt(0.1)) ** k
        assert (1 - near) ** tables <= vector_dup.MISS
        assert count * vector_dup.step_chance(math.sqrt(2)) ** k <= vector_dup.STRANGERS


def test_queries_on_the_given_vectors(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in load(spark, sf, "embeddings").collect()]
    got = QUERIES["op11_whitening"](spark, sf)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check_whitening(rows, got.collect(), 16, 64)
    got = QUERIES["op12_vector_dup"](spark, sf).collect()
    assert ordered((r.vec_id, r.n_links, r.component_id) for r in got) == ordered(linked_components(rows))
