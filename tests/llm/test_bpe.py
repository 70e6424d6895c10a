from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import ODD_ROWS, documents
from textloom.llm import bpe, packing
from textloom.llm.queries import BYTE_RANKS, QUERIES
from textloom.llm.scan import text_column
from textloom.sources.tables import load

PATH = public_tokenizers.path(BYTE_RANKS)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return bpe.load_vocabulary(file.read())


PIECES = ["a", "aa", "'s", "'re", "'ll", "'", " ", "  ", "\n", "\t", "\r\n", "1", "½", "é", "漢", "😀", "the", "ing", ".", "!", "　", "\x1c", "Z"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), min_size=1, max_size=8))
def test_ids_are_the_librarys(texts):
    with open(PATH, "rb") as file:
        data = file.read()
    vocabulary = bpe.load_vocabulary(data)
    library = _library()
    ids, counts = vocabulary.encode(text_column(pa.array(texts, pa.string())))
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends):
        assert ids[end - n : end].tolist() == library.encode_ordinary(text)
    assert vocabulary.decode(ids).tobytes() == "".join(texts).encode()


_kept = []


def _library():
    if not _kept:
        with open(PATH, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _kept.append(tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _kept[0]


def expected(library, text):
    ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_digests_of_odd_rows(spark, library):
    docs = documents(spark, ODD_ROWS).withColumns({"ids": F.lit("x"), "decoded": F.lit(1)})
    got = bpe.digests(docs, bpe.share_file(spark, PATH)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *expected(library, t)) for i, t, *_ in ODD_ROWS), key=str)


def test_query_matches_the_library(spark, sf, library):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_byte_bpe"](spark, sf).collect()}
    rows = load(spark, sf, "documents").select("doc_id", "text").collect()
    assert got == {r.doc_id: expected(library, r.text) for r in rows}


def test_empty_table(spark):
    docs = documents(spark, [])
    ranks = bpe.share_file(spark, PATH)
    assert bpe.digests(docs, ranks).count() == 0
    assert packing.pack(bpe.encode(docs, ranks, ["doc_id"]), 50256).count() == 0


def test_store_of_pieces_starts_anew(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 5)
    for text in ("some words that go beyond it", "and some more words of it", "some words"):
        ids, _ = vocabulary.encode(text_column(pa.array([text])))
        assert ids.tolist() == library.encode_ordinary(text)


def test_packing_loses_nothing(spark, library):
    rows = [r for r in ODD_ROWS if r[0] is not None and r[0] != 6]
    encoded = bpe.encode(documents(spark, rows).coalesce(1), bpe.share_file(spark, PATH), ["doc_id"])
    packed = packing.write_packed(packing.pack(encoded, 50256, row_tokens=128))
    parts = {}
    for r in packing.unpack(packed).collect():
        parts.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u2").tolist()))
    got = {i: sum((ids for _, ids in sorted(p)), []) for i, p in parts.items()}
    assert got == {i: ids for i, t, *_ in rows if (ids := library.encode_ordinary(t or ""))}
    for r in packed.collect():
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(positions) == 128 and r.cu_seqlens[-1] == r.n_tokens <= 128
        assert (ids[r.n_tokens :] == 50256).all()
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert b > a and positions[a:b].tolist() == list(range(b - a))
    assert packed.select("pack_id").distinct().count() == packed.count()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_best_fit_decreasing_is_the_plain_one(sizes):
    rows: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        rooms = [(16 - sum(sizes[i] for i in row), n) for n, row in enumerate(rows)]
        fits = [(room, n) for room, n in rooms if room >= sizes[item]]
        if fits:
            rows[min(fits)[1]].append(item)
        else:
            rows.append([item])
    assert packing.best_fit_decreasing(sizes, 16) == rows


def test_wide_vocabulary_takes_four_bytes(spark):
    encoded = spark.createDataFrame([(1, bytearray(np.array([70_000, 3], "<u4").tobytes()))], "doc_id long, ids binary")
    row = packing.pack(encoded, 100_000, row_tokens=4).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == [70_000, 3, 100_000, 100_000]


def test_packing_query_holds_every_token(spark, sf, library):
    got = QUERIES["op7_packing"](spark, sf).agg(F.sum("n_tokens"), F.sum(F.size("doc_ids"))).first()
    texts = [r.text or "" for r in load(spark, sf, "documents").select("text").collect()]
    sizes = [len(library.encode_ordinary(t)) for t in texts]
    assert tuple(got) == (sum(sizes), sum(-(-n // packing.ROW_TOKENS) for n in sizes))
