from __future__ import annotations

from itertools import permutations

import numpy as np

from tests.llm.cases import ODD_ROWS, WORD, documents, prose
from textloom.llm import filter_audit


def failures(rows):
    """Letters that each row ``(id, text, ...)`` fails."""
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            failed.add("C")
        if set(text) & set("#$%&*|"):
            failed.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows):
            failed.add("E")
        out.append(failed)
    return out


def walked(rows, good, bad):
    """Every order applied from left to right, document by document."""
    out, failed = {}, failures(rows)
    parts = [(r[3] if len(r) > 3 else "a") or "" for r in rows]
    for part in set(parts):
        mine = [(failed[n], r[0]) for n, r in enumerate(rows) if parts[n] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[0] for d in mine) - len(gone), sum(d[0] == {f} for d in mine),
                    sum(d[1] in good for d in gone), sum(d[1] in bad for d in gone), f,
                ]
        for key, values in out.items():
            if key[0] == part:
                values[-1] = removed_by[values[-1]]
    return out


def test_audit_against_walking_every_order(spark):
    long = prose(3, 400)
    rows = [*ODD_ROWS, (10, long, "en", "a"), (11, long, "en", "b"), (12, long + " $", "en", "b"), (9, long, "en", "b")]
    rows += [(20, "ABC " * 300, "en", "a"), (21, "Same word " * 300, "en", None), (22, "Same word " * 300, "en", ""), (None, long, "en", "b")]
    rows += [(100 + i, "the hot text & more", "en", "b" if i % 3 else "hot") for i in range(60)]
    labels = spark.createDataFrame(
        [(10, 1, 0), (11, 1, 1), (11, 0, 0), (12, None, 1), (101, 1, None), (102, 1, 0), (9, 1, 0), (999, 1, 1), (None, 1, 1), (6, 1, 1), (6, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    docs = documents(spark, rows)
    clashing = docs.withColumns({"part": docs.lang, "mask": docs.n_chars, "n": docs.n_chars, "digest": docs.text, "id": docs.doc_id, "t": docs.text})
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.audit(clashing, labels.withColumn("id", labels.doc_id)).collect()}
    assert got == walked(rows, {10, 11, 101, 102, 9, 6}, {11, 12, 6})


def test_contraction_counts_zeros_and_empty_tables(spark):
    tensors = np.zeros((1, 3, 2, 2, 2, 2, 2), np.int64)
    tensors[0, 0, 0, 0, 0, 0, 1] = 7  # fails the last filter only
    found = filter_audit.contract(tensors)
    assert found["kept"].shape == (1, 120, 5)
    assert set(found["shapley"].ravel().tolist()) == {0, 7 * 120} and found["unique_fails"].max() == 7
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), labels).count() == 0
    assert filter_audit.audit(documents(spark, [(1, None)]), labels).count() == 600
