"""Intent rules kept as a table: any number of literal patterns, found by one automaton.

A rule is a row ``(place, intent, pattern)``; of the patterns found in a message the one with the lowest place names the intent. All patterns of all
rules make up one Aho-Corasick automaton, so a message is read once, however many rules there are, and the plan holds none of them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from textloom.operators.lookup import fits_broadcast
from textloom.sources.scratch import new_path

# The helpers travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

FALLBACK = "fallback"
RULE_ROWS = 200_000
RULE_BYTES = 32 << 20


class _Folding(dict):
    """Case folding character by character, as a pattern search without case does it; a text keeps its length."""

    def __missing__(self, point: int) -> str:
        upper = chr(point).upper()
        lower = (upper if len(upper) == 1 else chr(point)).lower()
        self[point] = lower if len(lower) == 1 else chr(point)
        return self[point]


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


class Matcher:
    """The lowest place of all patterns found in a text; ``word`` wants no letter, digit or underscore beside a match."""

    def __init__(self, rules: list[tuple[int, str, str]], mode: str = "search"):
        self.fold, self.mode = _Folding(), mode
        self.intents = [intent for _, intent, _ in sorted(rules)]
        self.automaton = ahocorasick.Automaton()
        # An empty pattern is found in every text.
        self.always = len(rules)
        first: dict[str, int] = {}
        for place, (_, _, pattern) in enumerate(sorted(rules)):
            folded = pattern.translate(self.fold)
            if not folded:
                self.always = min(self.always, place)
            else:
                first.setdefault(folded, place)
        for pattern, place in first.items():
            self.automaton.add_word(pattern, (place, len(pattern)))
        if first:
            self.automaton.make_automaton()
        self.empty = not first

    def __call__(self, text: str) -> str:
        best = self.always
        if not self.empty and text:
            folded = text.translate(self.fold)
            for end, (place, length) in self.automaton.iter(folded):
                if place < best and (self.mode != "word" or self._alone(folded, end + 1 - length, end + 1)):
                    best = place
        return self.intents[best] if best < len(self.intents) else FALLBACK

    @staticmethod
    def _alone(text: str, start: int, end: int) -> bool:
        return not (start and _word(text[start - 1])) and not (end < len(text) and _word(text[end]))


def rules_table(spark: SparkSession, rules: dict[str, list[str]]) -> DataFrame:
    """A rules table from intents in order of precedence."""
    rows = [(place, intent, pattern) for place, (intent, pattern) in enumerate((i, p) for i, ps in rules.items() for p in ps)]
    return spark.createDataFrame(rows, "place long, intent string, pattern string")


def classify(messages: DataFrame, rules: DataFrame, text: str = "text", out: str = "intent", mode: str = "search") -> DataFrame:
    """``messages`` with the intent of every text by the rules as they are now; a null text, or one that no rule fits, is ``fallback``.

    Rules without a place, intent or pattern are left out; of rules of one place the lower intent and pattern comes first. The rules are
    sent to the tasks after they have been measured.
    """
    rules = rules.select("place", "intent", "pattern").dropna()
    if not fits_broadcast(rules, RULE_ROWS, RULE_BYTES):
        raise ValueError(f"more than {RULE_ROWS} rules, or {RULE_BYTES} bytes of them")
    held = rules.toArrow()
    listed = list(zip(*(held[c].to_pylist() for c in ("place", "intent", "pattern"))))
    shared = messages.sparkSession.sparkContext.broadcast((listed, mode))
    at = messages.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(*shared.value)
        for batch in batches:
            found = [match(t or "") if t is not None else FALLBACK for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, out])

    return messages.mapInArrow(run, StructType([*messages.schema.fields, StructField(out, StringType())]))


def drain_classified(stream: DataFrame, read_rules: Callable[[], DataFrame], name: str, path: str | None = None, text: str = "text", mode: str = "search") -> DataFrame:
    """Classify all messages present in a stream, with the rules read anew for every micro-batch.

    ``read_rules`` gives the table as it is when called. A micro-batch writes a folder of its own, so a retried one overwrites only itself. Given the ``path`` of
    an earlier run, goes on where that one stopped.
    """
    spark = stream.sparkSession
    path = path or new_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        classify(batch, read_rules(), text, mode=mode).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(StructType([*stream.schema.fields, StructField("intent", StringType())])).parquet(path).drop("batch")
