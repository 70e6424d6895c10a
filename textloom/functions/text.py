"""Tokenizers and text shaping as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Filter and punctuation characters the vectorizers of the reference work with.
KERAS_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
KERAS_FILTERS_KEEP_MARKERS = '!"#$%&()*+,-./:;=?@[\\]^_`{|}~\t\n'
STRIP_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
PAD_TOKEN = "<pad>"


def _non_empty(tokens: Column) -> Column:
    return F.array_remove(tokens, "")


def sequence_tokens(text: Column | str, filters: str = KERAS_FILTERS) -> Column:
    """Lower-case, turn every filter character into a space, split on spaces, drop empties."""
    spaced = F.translate(F.lower(text), filters, " " * len(filters))
    return _non_empty(F.split(spaced, " "))


def stripped_tokens(text: Column | str) -> Column:
    """Lower-case, delete punctuation, split on whitespace."""
    bare = F.translate(F.lower(text), STRIP_PUNCTUATION, "")
    return _non_empty(F.split(bare, r"\s+"))


def word_tokens(text: Column | str) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def whitespace_tokens(text: Column | str) -> Column:
    return _non_empty(F.split(F.lower(text), r"\s+"))


def space_word_count(text: Column | str) -> Column:
    """Number of pieces between single spaces; two spaces in a row make an empty piece."""
    return F.size(F.split(text, " "))


def with_bigrams(tokens: Column | str) -> Column:
    """Unigrams followed by space-joined bigrams.

    Give it a column that already holds the token array: the array is read three times.
    """
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    rest = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    pairs = F.zip_with(tokens, rest, lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
    return F.concat(tokens, F.array_compact(pairs))


def wrap(text: Column | str, start: str | None = "<start>", end: str | None = "<end>") -> Column:
    """Put marker tokens around a text; pass None to leave one side bare."""
    body = F.col(text) if isinstance(text, str) else text
    parts = [F.lit(f"{start} ")] if start else []
    parts.append(body)
    if end:
        parts.append(F.lit(f" {end}"))
    return F.concat(*parts)


def combine(*texts: Column | str) -> Column:
    """Join columns with one space; null when any part is null."""
    cols = [F.col(t) if isinstance(t, str) else t for t in texts]
    parts: list[Column] = [cols[0]]
    for col in cols[1:]:
        parts += [F.lit(" "), col]
    return F.concat(*parts)


def unify_length(text: Column | str, length: int = 150, pad: str = PAD_TOKEN) -> Column:
    """Cut to ``length`` space tokens, or append pad markers glued on without spaces."""
    words = F.split(text, " ")
    missing = F.lit(length) - F.size(words)
    body = F.col(text) if isinstance(text, str) else text
    return F.when(missing > 0, F.concat(body, F.repeat(F.lit(pad), missing))).otherwise(
        F.array_join(F.slice(words, 1, length), " ")
    )
