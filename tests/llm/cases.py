"""Small tables for the operators' tests."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` as a documents table."""
    full = [(i, t, *(rest or ("en", "a")), None if t is None else len(t)) for i, t, *rest in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int) -> str:
    """Text of made-up words, another one for each seed."""
    state, out = seed * 7919 + 1, []
    for _ in range(words):
        state = (state * 1103515245 + 12345) % 2**31
        out.append("w" + format(state >> 11, "x"))
    return " ".join(out)


ODD_ROWS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", None),
    (None, "a text without an id", "en", "b"),
    (5, "one", "en", "b"),
    (6, "Ünïcödé 漢字 😀 it's we'll x", "de", "b"),
    (6, "Ünïcödé 漢字 😀 it's we'll x", "de", "b"),
    (7, prose(1, 20_000), "en", "c"),
    (8, "aaaa" * 500 + "\n" * 50 + "====", "en", "c"),
]


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def similar_components(rows: list[tuple], width: int, similarity: float) -> dict[int, int]:
    """Smallest id reachable over links, by comparing every pair."""
    sets = {i: shingles(t, width) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= round(100 * similarity) * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}
