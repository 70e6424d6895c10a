"""State per chat thread that expires, kept by ``transformWithState`` in RocksDB.

Two clocks. ``thread_sessions`` goes by the messages' own time: a thread that is silent for longer than ``expiry`` starts a new session at
attempt level 1, and may take its slots along. Messages are folded into spans, so their order within the watermark's delay does not matter; a
span is written once the watermark has passed it, and its state leaves the store with it. ``live_levels`` goes by the wall clock: every message is
answered at once with its level, and the store drops the state of a silent thread by its TTL.

A thread's messages arrive in Arrow batches that are folded one by one: a thread with most of all messages is never held in memory.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textloom.operators.chat import intent

# The processors travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE = 60_000_000
DAY = 24 * 60 * MINUTE

SESSION = (
    "conv_id {0}, session long, start_us long, end_us long, messages long, attempt_level long, description string, feedback string"
)
LEVEL = "conv_id {0}, turn long, attempt_level long, description string, feedback string"
_SPAN = ["end_us", "messages", "voiced", "d_us", "d_turn", "description", "f_us", "f_turn", "feedback"]


def signals(
    messages: DataFrame,
    phrases: tuple[str, ...] = ("not satisfied",),
    describing: tuple[str, ...] = ("report_issue", "provide_details"),
    mode: str = "search",
) -> DataFrame:
    """What a message says about its thread: ``voiced`` dissatisfaction, and the slots ``description`` and ``feedback``."""
    name = intent("text", mode=mode)
    voiced = F.lit(False)
    for phrase in phrases:
        voiced = voiced | F.lower("text").contains(phrase)
    return messages.withColumns(
        {
            "voiced": F.coalesce(voiced, F.lit(False)).cast("long"),
            "description": F.when(name.isin(*describing), F.col("text")),
            "feedback": F.when(name == "affirm", "yes").when(name == "deny", "no"),
        }
    )


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own choice comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _plain(value):
    """A cell of a frame as state keeps it: Python's own types, None for what is missing."""
    if value is None or value is pd.NaT or value != value:
        return None
    return value.item() if hasattr(value, "item") else value


def _later(left: dict, right: dict, slot: str, order: tuple[str, str]) -> dict:
    """The slot of the later message; a message without one does not count."""
    a, b = ([side[c] for c in order] for side in (left, right))
    pick = right if left[slot] is None or (right[slot] is not None and b >= a) else left
    return {c: pick[c] for c in (*order, slot)}


def join_spans(spans: list[dict], expiry_us: int) -> list[dict]:
    """Spans no further apart than ``expiry_us`` become one; the order in which they are given does not matter."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: s["start_us"]):
        if not out or span["start_us"] - out[-1]["end_us"] > expiry_us:
            out.append(dict(span))
            continue
        last = out[-1]
        last.update(_later(last, span, "description", ("d_us", "d_turn")), **_later(last, span, "feedback", ("f_us", "f_turn")))
        last["end_us"] = max(last["end_us"], span["end_us"])
        last["messages"] += span["messages"]
        last["voiced"] += span["voiced"]
    return out


def fold(messages: pd.DataFrame, expiry_us: int) -> list[dict]:
    """Spans of one batch of messages ``(at_us, turn, voiced, description, feedback)``."""
    messages = messages.sort_values(["at_us", "turn"], kind="stable")
    number = (messages["at_us"].diff() > expiry_us).cumsum()
    spans = []
    for _, part in messages.groupby(number, sort=False):
        span = {
            "start_us": int(part["at_us"].iloc[0]), "end_us": int(part["at_us"].iloc[-1]), "messages": len(part),
            "voiced": int(part["voiced"].sum()),
        }
        for slot, at, turn in (("description", "d_us", "d_turn"), ("feedback", "f_us", "f_turn")):
            said = part[part[slot].notna()]
            span |= dict.fromkeys((slot, at, turn)) if said.empty else {
                slot: said[slot].iloc[-1], at: int(said["at_us"].iloc[-1]), turn: int(said["turn"].iloc[-1])
            }
        spans.append(span)
    return spans


class ThreadSessions(StatefulProcessor):
    """Open spans of a thread by their start, and what its closed ones leave behind."""

    def __init__(self, expiry_us: int, carry_slots: bool, forget_us: int | None):
        self.expiry_us, self.carry_slots, self.forget_us = expiry_us, carry_slots, forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState(
            "open", "start_us long",
            "end_us long, messages long, voiced long, d_us long, d_turn long, description string, f_us long, f_turn long, feedback string",
        )
        self.past = handle.getValueState("past", "sessions long, description string, feedback string, forgotten_ms long")

    def _spans(self) -> list[dict]:
        return [{"start_us": _plain(k[0]), **dict(zip(_SPAN, map(_plain, v)))} for k, v in self.open.iterator()]

    def _closes_ms(self, span: dict) -> int:
        """First millisecond at which no message on time can still belong to the span."""
        return (span["end_us"] + self.expiry_us) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = {s["start_us"]: s for s in self._spans()}
        spans = list(before.values())
        for batch in rows:
            spans = join_spans(spans + fold(batch, self.expiry_us), self.expiry_us)
        after = {s["start_us"]: s for s in spans}
        for start, span in before.items():
            if after.get(start) != span:
                self.handle.deleteTimer(self._closes_ms(span))
                if start not in after:
                    self.open.removeKey((start,))
        for start, span in after.items():
            if before.get(start) != span:
                self.open.updateValue((start,), tuple(span[c] for c in _SPAN))
                self.handle.registerTimer(self._closes_ms(span))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Close all spans that are due, in the order of time, whichever timer has come."""
        now = expiredTimerInfo.getExpiryTimeInMs()
        nothing = (0, None, None, None)
        kept = self.past.get()
        before = past = tuple(map(_plain, kept)) if kept is not None else nothing
        spans = sorted(self._spans(), key=lambda s: s["start_us"])
        out = []
        for span in spans:
            if self._closes_ms(span) > now:
                break
            sessions, description, feedback, forgotten = past
            if forgotten is not None and forgotten <= span["start_us"] // 1000:
                sessions, description, feedback = 0, None, None
            sessions += 1
            description = span["description"] if span["description"] is not None or not self.carry_slots else description
            feedback = span["feedback"] if span["feedback"] is not None or not self.carry_slots else feedback
            out.append((key[0], sessions, span["start_us"], span["end_us"], span["messages"], span["voiced"] + 1, description, feedback))
            self.open.removeKey((span["start_us"],))
            past = sessions, description, feedback, None if self.forget_us is None else self._closes_ms(span) + self.forget_us // 1000
        later = spans[len(out) :]
        if past[3] is not None and past[3] <= now and not (later and later[0]["start_us"] // 1000 < past[3]):
            past = nothing
        if past[3] != before[3]:
            if before[3] is not None:
                self.handle.deleteTimer(before[3])
            if past[3] is not None:
                self.handle.registerTimer(past[3])
        if past == nothing and before != nothing:
            self.past.clear()
        elif past != before:
            self.past.update(past)
        if out:
            yield pd.DataFrame(out, columns=[
                "conv_id", "session", "start_us", "end_us", "messages", "attempt_level", "description", "feedback",
            ])

    def close(self) -> None:
        pass


def thread_sessions(
    messages: DataFrame,
    ts: str = "ts",
    expiry_us: int = 60 * MINUTE,
    delay: str = "10 minutes",
    carry_slots: bool = True,
    forget_us: int | None = 30 * DAY,
) -> DataFrame:
    """Closed sessions of the threads of a stream with the columns of ``signals``; see ``SESSION``.

    ``attempt_level`` is 1 + messages of the session that voice dissatisfaction. A slot holds the session's latest value; with
    ``carry_slots`` that of the thread's last session that had one. A thread's number of sessions and its slots are forgotten
    when it has been silent for ``forget_us`` more (None: never, so one small row per thread stays in the store).
    Start the stream inside ``rocksdb``. Messages without a thread or a time are left out.
    """
    timed = messages.withColumn(ts, F.col(ts).cast("timestamp")).filter(F.col("conv_id").isNotNull() & F.col(ts).isNotNull())
    narrow = timed.withWatermark(ts, delay).select(
        "conv_id", ts, F.unix_micros(ts).alias("at_us"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), "voiced", "description", "feedback"
    )
    kind = messages.schema["conv_id"].dataType.simpleString()
    return narrow.groupBy("conv_id").transformWithStateInPandas(
        ThreadSessions(expiry_us, carry_slots, forget_us), SESSION.format(kind), "Append", "EventTime"
    )


class LiveLevels(StatefulProcessor):
    """Dissatisfaction voiced so far, gone after ``ttl_ms`` of silence, and the slots, which may stay."""

    def __init__(self, ttl_ms: int, carry_slots: bool):
        self.ttl_ms, self.carry_slots = ttl_ms, carry_slots

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.level = handle.getValueState("level", "voiced long", self.ttl_ms)
        self.slots = handle.getMapState("slots", "name string", "value string", None if self.carry_slots else self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.level.get()
        voiced = _plain(known[0]) if known is not None else 0
        slots = {_plain(k[0]): _plain(v[0]) for k, v in self.slots.iterator()}
        for batch in rows:
            batch = batch.sort_values("turn", kind="stable")
            levels = 1 + voiced + batch["voiced"].cumsum()
            said = {"conv_id": key[0], "turn": batch["turn"], "attempt_level": levels}
            for slot in ("description", "feedback"):
                filled = batch[slot].astype(object).where(batch[slot].notna(), None).ffill()
                said[slot] = filled.where(filled.notna(), slots.get(slot))
                if len(filled) and filled.notna().iloc[-1]:
                    slots[slot] = filled.iloc[-1]
            voiced = int(voiced + batch["voiced"].sum())
            yield pd.DataFrame(said)
        self.level.update((voiced,))
        for slot, value in slots.items():
            self.slots.updateValue((slot,), (value,))

    def close(self) -> None:
        pass


def live_levels(messages: DataFrame, ttl_ms: int = 60 * 60_000, carry_slots: bool = True) -> DataFrame:
    """Every arriving message of a stream with the columns of ``signals`` and its thread's level and slots; see ``LEVEL``.

    For streams that go on: a drain of what is present (``availableNow``) did not end in a trial, so no test covers this one.
    Messages of one micro-batch are taken in the order of their turn within each Arrow batch, otherwise as they arrive.
    """
    narrow = messages.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), "voiced", "description", "feedback"
    )
    kind = messages.schema["conv_id"].dataType.simpleString()
    return narrow.groupBy("conv_id").transformWithStateInPandas(
        LiveLevels(ttl_ms, carry_slots), LEVEL.format(kind), "Append", "ProcessingTime"
    )
