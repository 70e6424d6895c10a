from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.cases import ODD_ROWS, documents, prose
from textloom.llm import lang_id, sample, toxicity
from textloom.llm.queries import QUERIES
from textloom.llm.scan import text_bytes, text_column
from textloom.sources.tables import load


def bags(n: int) -> tuple[list[str], np.ndarray]:
    texts, labels = [], []
    for i in range(n):
        sentences = [prose(1000 + 7 * i + k, 8) + "." for k in range(6)]
        if i % 4 == 0:
            sentences[i % 6] = f"{prose(i, 3)} grumblix{'abcdefgh'[i % 8]} {prose(i + 1, 3)}."
        texts.append(" ".join(sentences))
        labels.append(int(i % 4 == 0))
    return texts, np.array(labels)


def test_sentences_are_found_from_document_labels(spark):
    texts, labels = bags(400)
    model = toxicity.fit(pa.array(texts), labels)
    fresh, wanted = bags(440)
    docs = documents(spark, list(enumerate(fresh[400:])))
    scored = {r.doc_id: r for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert all((scored[i].score >= 0.5) == bool(y) for i, y in enumerate(wanted[400:]))
    found = toxicity.offending_sentences(docs, model).collect()
    assert found and all("grumblix" in r.sentence for r in found)
    assert {r.doc_id for r in found} == {i for i, y in enumerate(wanted[400:]) if y}
    for r in found:
        assert fresh[400 + r.doc_id].encode()[r.start_byte :].startswith(r.sentence.encode())


def test_noisy_or():
    scores = toxicity.document_scores(np.log([1.0, 1 / 3, 1.0]), np.array([0, 0, 2]), 4)
    assert np.allclose(scores, [1 - 0.5 * 0.75, 0, 0.5, 0])


def test_toxicity_of_odd_rows(spark):
    model = toxicity.fit(pa.array([], pa.string()), np.zeros(0, np.int64))
    docs = documents(spark, ODD_ROWS).withColumns({"score": F.lit("x"), "_row": F.lit(1)})
    got = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id <> 7 OR doc_id IS NULL").count() == len(ODD_ROWS) - 1


def test_toxicity_without_labels(spark):
    docs = documents(spark, ODD_ROWS)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    assert not model.weights.any()
    assert toxicity.score(documents(spark, []), model, ["doc_id"]).count() == 0


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op2_toxicity"](spark, sf)
    docs = load(spark, sf, "documents")
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
    marked = got.join(load(spark, sf, "labels"), "doc_id")
    right, n = marked.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.count(F.lit(1))).first()
    assert n > 300 and right > 0.9


def test_sample_is_bounded_and_stable(spark):
    rows = spark.range(10_000).withColumnRenamed("id", "doc_id")
    first = {r.doc_id for r in sample.bounded_sample(rows, 500, "doc_id").collect()}
    again = {r.doc_id for r in sample.bounded_sample(rows.repartition(7), 500, "doc_id").collect()}
    assert first == again and len(first) == 500
    assert sample.bounded_sample(rows.limit(0), 500, "doc_id").count() == 0


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_language_id"](spark, sf)
    rows = got.join(load(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == load(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    sure = [r for r in held if not r.rejected]
    assert sum(r.lang == r.lang_pred for r in sure) / len(sure) > 0.98


def test_language_of_odd_rows(spark):
    model = lang_id.fit(pa.array([prose(i, 30) if i % 2 else "der die das und " * 9 for i in range(60)]), ["xx" if i % 2 else "de" for i in range(60)])
    rows = [*ODD_ROWS, (11, "123 !? --"), (12, "der und die")]
    docs = documents(spark, rows).withColumns({"lang_pred": F.lit(1), "score": F.lit("s")})
    got = {r.doc_id: r for r in lang_id.predict(docs, model, ["doc_id"]).collect()}
    for i in (1, 2, 3, 11):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[12].lang_pred == "de" and all(0 <= r.score <= 1 for r in got.values())
    nothing = lang_id.fit(pa.array([], pa.string()), [])
    assert {r.lang_pred for r in lang_id.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert lang_id.predict(documents(spark, []), model, ["doc_id"]).count() == 0


def test_folded_table_is_the_mean_of_vectors():
    model = lang_id.Model(["a", "b"], np.random.default_rng(1).normal(size=(lang_id.BUCKETS, 2)), np.array([0.1, -0.1]), 1.0, 0.0)
    data, rows = text_bytes(text_column(pa.array(["eine kleine Katze", "", "x"])))
    bucket, text_of = lang_id.subwords(data, rows)
    logits = lang_id.text_logits(model, data, rows)
    for i in range(3):
        mine = model.table[bucket[text_of == i]]
        assert np.allclose(logits[i], (mine.mean(axis=0) if len(mine) else 0) + model.bias)


def test_calibration_finds_the_temperature():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 4000)
    sharp = np.where(rng.random(4000) < 0.8, y, 1 - y)
    logits = np.zeros((4000, 2))
    logits[np.arange(4000), sharp] = 8 * np.log(4)
    temperature, least = lang_id.calibrate(logits, y)
    assert 6 < temperature < 11 and least == 1.0  # right in 80 % only: everything is rejected
