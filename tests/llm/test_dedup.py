from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import ODD_ROWS, documents, prose, shingles, similar_components
from textloom.llm import exact_dedup, near_dup, tables
from textloom.llm.components import components
from textloom.llm.queries import QUERIES
from textloom.sources.scratch import materialize
from textloom.sources.tables import load


def key(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def test_perfect_hash_is_minimal_and_checks_bytes():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(3000)), np.uint8).reshape(-1, 32)
    index = exact_dedup.PerfectHash.build(digests[:2000])
    slots = index.slots(digests[:2000])
    assert sorted(slots.tolist()) == list(range(2000))
    held = np.zeros((2000, 32), np.uint8)
    held[slots] = digests[:2000]
    other = np.maximum(index.slots(digests[2000:]), 0)
    assert not (held[other] == digests[2000:]).all(axis=1).any()
    with pytest.raises(ValueError):
        exact_dedup.PerfectHash.build(np.repeat(digests[:1], 2, axis=0))


def exact_rows(spark):
    rows = [*ODD_ROWS, (20, "x y z"), (21, "x  y\nz"), (19, "xyz"), (22, "x  y z\t"), (23, "x  y z\t")]
    rows += [(100 + i, "the hot text") for i in range(60)]
    return rows, documents(spark, rows).withColumns({"digest": F.lit(1), "uid": F.lit("u"), "size": F.lit(0)})


def test_exact_groups(spark):
    rows, docs = exact_rows(spark)
    got = exact_dedup.dedup(docs).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(key(t), []).append((-len(t or ""), i is None, i or 0, i))
    for r in got:
        group = groups[r.text_sha256]
        assert (r.keep_id, r.group_size) == (min(group)[3], len(group))
        assert not r.kept or r.doc_id == r.keep_id
    for digest in groups:
        assert sum(r.kept for r in got if r.text_sha256 == digest) == 1


def test_exact_stage_keeps_one_row_of_each(spark):
    rows, docs = exact_rows(spark)
    kept = exact_dedup.keep_winners(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, key(r.text)) for r in kept.collect()]
    assert len(got) == len(set(k for _, k in got)) == len({key(t) for _, t, *_ in rows})
    assert (22, key("xyz")) in got and (100, key("the hot text")) in got


def test_exact_on_empty_tables(spark):
    docs = documents(spark, [])
    assert exact_dedup.dedup(docs).count() == 0 and exact_dedup.keep_winners(docs).count() == 0


def test_shuffled_ways_give_the_same(spark, monkeypatch):
    rows, docs = exact_rows(spark)
    wanted = sorted(map(str, exact_dedup.keep_winners(docs).collect()))
    monkeypatch.setattr(tables, "fits_broadcast", lambda table: False)
    assert sorted(map(str, exact_dedup.keep_winners(docs).collect())) == wanted


def near_rows():
    rows = [r for r in ODD_ROWS if r[0] not in (None, 6)]
    n = 1000
    for seed, size in ((3, 7), (4, 40), (5, 300), (6, 2500)):
        base = prose(seed, size).split()
        for edits in range(0, 14):
            words = list(base)
            for k in range(edits):
                words[(k * 37 + edits * 11) % size] = f"edit{edits}x{k}"
            rows.append((n, " ".join(words).upper() if edits % 3 else " ".join(words)))
            n += 1
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_near_components_match_all_pairs(spark, width):
    rows = near_rows()
    docs = documents(spark, rows).withColumns({"n": F.lit(1), "id": F.lit("i"), "key": F.lit(2.0)})
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs, width, 0.8).collect()}
    wanted = similar_components(rows, width, 0.8)
    assert {i: r.component_id for i, r in got.items()} == wanted
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t, width)) for i, t, *_ in rows}
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    assert len(set(wanted.values())) < len(rows) - 10


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SETS", 2)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 60)
    rows = near_rows()
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(documents(spark, rows), 4, 0.8).collect()}
    assert got == similar_components(rows, 4, 0.8)


def test_near_stage_and_odd_rows(spark):
    rows = [*ODD_ROWS, (30, prose(9, 60)), (31, prose(9, 60) + " more"), (31, prose(9, 60) + " more"), (29, prose(9, 60).upper())]
    docs = documents(spark, rows).withColumn("comp", F.lit(1))
    kept = near_dup.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, None, 5, 6, 7, 8, 29], key=str)
    found = near_dup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {(r.component_id, r.n_shingles) for r in found if r.doc_id in (1, 2, 3)} == {(1, 0), (2, 0), (3, 0)}


def test_near_on_an_empty_table(spark):
    docs = documents(spark, [])
    assert near_dup.near_duplicates(docs).count() == 0 and near_dup.keep_first(docs).count() == 0


def test_estimate_is_close_and_corrected():
    rng = np.random.default_rng(5)
    pool = rng.integers(1, 2**63, 4000, dtype=np.uint64)
    for n, common in ((1500, 1200), (1500, 300), (60, 50), (12, 10)):
        a, b = np.unique(pool[:n]), np.unique(np.concatenate((pool[:common], pool[2000 : 2000 + n - common])))
        bits = int(near_dup.size_class(np.array([n]))[0])
        owner = np.repeat([0, 1], [len(a), len(b)])
        both = near_dup.sketches(np.concatenate((a, b)), owner, 2, bits)
        size = np.array([n])
        found = near_dup.estimate(both[:1], both[1:], size, size, np.array([bits]))[0]
        assert abs(found - common / (2 * n - common)) < 0.16


def test_components_of_a_chain_a_star_and_a_pair(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == wanted


def test_blocked_filter_misses_no_member(spark):
    members = spark.range(0, 5000).select(F.xxhash64("id").alias("key"))
    words = tables.build_filter(members, "key", 5000)
    assert tables.filter_rows(members, "key", words).count() == 5000
    others = spark.range(5000, 25000).select(F.xxhash64("id").alias("key"))
    assert tables.filter_rows(others, "key", words).count() < 400
    tight = tables.build_filter(members, "key", 5000, max_bytes=64)
    assert tables.filter_rows(members, "key", tight).count() == 5000


def test_hot_lookup(spark):
    rows = materialize(spark.range(4000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("key"), "id"), "rows")
    table = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "sizes")
    got = tables.lookup_hot(rows, table, "key", "size")
    assert got.count() == 4000 and got.filter("key = 0 AND size = 2000").count() == 2000


def test_near_query_matches_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in load(spark, sf, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: r.component_id for r in QUERIES["op9_hyperminhash"](spark, sf).collect()}
    assert got == similar_components(rows, 4, 0.8)
