"""Label columns: parsing, multi-hot rows, inverse, thresholds and top-k over scored labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_printed_list(text: Column | str) -> Column:
    """``['a', "it's"]`` printed as text, to an array of strings; malformed text gives null.

    Either quote may enclose an entry, and either may be escaped inside it.
    """
    return F.from_json(text, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})


def split_labels(text: Column | str) -> Column:
    """Comma-separated labels; a missing value becomes an empty list. Parts are not trimmed."""
    return F.coalesce(F.split(text, ","), F.array().cast("array<string>"))


def multi_hot(ids: Column | str, size: Column | int) -> Column:
    """0/1 row of ``size`` cells with ones at the given ids."""
    size = F.lit(size) if isinstance(size, int) else size
    ids = _col(ids)
    return F.transform(
        F.sequence(F.lit(0), size.cast("int") - 1),
        lambda i: F.array_contains(ids, i.cast("bigint")).cast("int"),
    )


def hot_positions(row: Column | str) -> Column:
    """Indices of the ones of a 0/1 row."""
    marked = F.transform(_col(row), lambda v, i: F.when(v == 1, i.cast("bigint")))
    return F.array_compact(marked)


def label_map(labels: Column | str) -> Column:
    """``{label: 1}`` for every distinct label."""
    unique = F.array_distinct(_col(labels))
    return F.map_from_arrays(unique, F.array_repeat(F.lit(1), F.size(unique)))


def keep_above(scored: Column | str, threshold: float, inclusive: bool = False) -> Column:
    """Entries of array<struct<label,prob>> above a threshold; empty labels are never kept."""
    def passes(x: Column) -> Column:
        reached = x["prob"] >= threshold if inclusive else x["prob"] > threshold
        return reached & (x["label"] != "")

    return F.filter(_col(scored), passes)


def top_k(scored: Column | str, k: int) -> Column:
    """The k best entries of array<struct<label_id,label,prob>>; ties keep the lower label id."""
    ordered = F.array_sort(
        F.transform(
            _col(scored),
            lambda x: F.struct((-x["prob"]).alias("neg"), x["label_id"].alias("label_id"), x["label"].alias("label")),
        )
    )
    return F.transform(
        F.slice(ordered, 1, k),
        lambda x: F.struct(x["label"].alias("label"), (-x["neg"]).alias("prob")),
    )
