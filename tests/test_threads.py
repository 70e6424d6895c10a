"""Thread state that expires, by the messages' time and by the clock."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.sources.scratch import new_path
from textloom.streaming import streams, threads

MINUTE = threads.MINUTE
START = 1_704_067_200_000_000
SCHEMA = "conv_id string, turn long, text string, at_us long"


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Every partition of a stateful stream has a store and a worker of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def table(spark, rows):
    """Rows ``(thread, turn, text, minute)``."""
    return spark.createDataFrame([(c, t, text, START + int(m * MINUTE)) for c, t, text, m in rows], SCHEMA)


def run(spark, path, like, out, **options):
    arriving = streams.file_stream(spark, path, like).withColumn("ts", F.timestamp_micros("at_us"))
    told = threads.signals(arriving, phrases=("not satisfied",), describing=("fallback",))
    with threads.rocksdb(spark):
        closed = streams.drain_append(threads.thread_sessions(told, **options), "sessions", out)
    return sorted(
        (r.conv_id, r.session, (r.start_us - START) // MINUTE, (r.end_us - START) // MINUTE, r.messages, r.attempt_level, r.description, r.feedback)
        for r in closed.collect()
    )


def test_silence_starts_a_session_at_level_one_and_slots_go_along(spark):
    rows = [
        ("a", 1, "it broke", 0), ("a", 2, "not satisfied", 30), ("a", 3, "still not satisfied", 150), ("a", 4, "yes", 151),
        ("b", 1, "not satisfied", 170), ("a", 5, "it broke again", 400), ("c", 1, None, 900), ("c", 2, "x", 1500),
    ]
    df = table(spark, rows)
    path, out = new_path(spark, "in"), new_path(spark, "out")
    df.filter("turn <= 2 AND conv_id = 'a'").coalesce(1).write.parquet(path)
    assert run(spark, path, df, out) == []  # all open
    for some in ("turn IN (3, 4) AND conv_id = 'a'", "conv_id = 'b'", "turn = 5", "conv_id = 'c' AND turn = 1", "conv_id = 'c' AND turn = 2"):
        df.filter(some).coalesce(1).write.mode("append").parquet(path)
    # The stream that goes on from its checkpoint knows the level and the slots from before.
    assert run(spark, path, df, out) == [
        ("a", 1, 0, 30, 2, 2, "it broke", "no"), ("a", 2, 150, 151, 2, 2, "it broke", "yes"), ("a", 3, 400, 400, 1, 1, "it broke again", "yes"),
        ("b", 1, 170, 170, 1, 2, None, "no"), ("c", 1, 900, 900, 1, 1, None, None),
    ]


@pytest.mark.parametrize("carry", [True, False])
def test_messages_out_of_order_against_plain_python(spark, carry):
    pick = random.Random(5)
    texts = ["not satisfied", "yes", "no", "broken thing", "", None]
    rows = [(c, t, pick.choice(texts), m) for c in "abcdef" for t, m in enumerate(sorted(pick.sample(range(0, 2000), 25)))]
    rows += [(None, 1, "lost", 5), ("z", 1, "end", 9000)]
    # Parts arrive in order; within a part of 500 minutes everything is shuffled.
    df = table(spark, rows)
    path, out = new_path(spark, "in"), new_path(spark, "out")
    for part in sorted({r[3] // 500 for r in rows}):
        some = [r for r in rows if r[3] // 500 == part]
        pick.shuffle(some)
        table(spark, some).coalesce(1).write.mode("append").parquet(path)
    got = run(spark, path, df, out, expiry_us=45 * MINUTE, delay="0 minutes", carry_slots=carry)
    intents = dict(zip(texts, [r.i for r in spark.createDataFrame([(t,) for t in texts], "text string").select(threads.intent("text").alias("i")).collect()]))
    wanted = []
    for c in "abcdef":
        last, slots = None, {"description": None, "feedback": None}
        mine = sorted((m, t, text) for k, t, text, m in rows if k == c)
        spans = []
        for m, t, text in mine:
            if last is None or m - last > 45:
                spans.append([])
            spans[-1].append((m, text))
            last = m
        for number, span in enumerate(spans, 1):
            if not carry:
                slots = {"description": None, "feedback": None}
            for _, text in span:
                name = intents[text]
                if name == "fallback" and text is not None:
                    slots["description"] = text
                if name in ("affirm", "deny"):
                    slots["feedback"] = "yes" if name == "affirm" else "no"
            level = 1 + sum(text == "not satisfied" for _, text in span)
            wanted.append((c, number, span[0][0], span[-1][0], len(span), level, slots["description"], slots["feedback"]))
    assert got == sorted(wanted)


def test_a_forgotten_thread_starts_anew(spark):
    rows = [("a", 1, "it broke", 0), ("a", 2, "more", 100), ("b", 1, "x", 1000), ("a", 3, "no", 1100), ("b", 2, "x", 5000)]
    df = table(spark, rows)
    path, out = new_path(spark, "in"), new_path(spark, "out")
    for row in rows:
        table(spark, [row]).coalesce(1).write.mode("append").parquet(path)
    got = [r for r in run(spark, path, df, out, forget_us=300 * MINUTE) if r[0] == "a"]
    assert got == [("a", 1, 0, 0, 1, 1, "it broke", None), ("a", 1, 1100, 1100, 1, 1, None, "no"), ("a", 2, 100, 100, 1, 1, "more", None)]


def test_spans_do_not_depend_on_the_order_of_joining():
    pick = random.Random(1)
    messages = pd.DataFrame({
        "at_us": [pick.randrange(10**6) for _ in range(60)], "turn": range(60), "voiced": [pick.randrange(2) for _ in range(60)],
        "description": [pick.choice([None, f"d{i}"]) for i in range(60)], "feedback": [pick.choice([None, "yes", "no"]) for _ in range(60)],
    })
    whole = threads.fold(messages, 20_000)
    for _ in range(5):
        shuffled = messages.sample(frac=1, random_state=pick.randrange(1000))
        spans = []
        for at in range(0, 60, 7):
            spans = threads.join_spans(spans + threads.fold(shuffled[at : at + 7], 20_000), 20_000)
        assert spans == whole


def test_arrivals_come_in_parts_of_bounded_files(spark):
    df = spark.range(1000).withColumn("at", F.col("id"))
    arrived = streams.Arrivals(df, "at", "parts", batches=4, rows_per_file=100)
    assert arrived.files == 3
    assert spark.read.parquet(arrived.deliver(1).path).count() == spark.read.parquet(arrived.path).filter("at <= 260").count()
    rest = spark.read.parquet(arrived.deliver().path)
    assert rest.count() == 1000 and rest.columns == ["id", "at"]
    twice = streams.Arrivals(df, "at", "parts", batches=2, late_copies=True).deliver()
    assert spark.read.parquet(twice.path).count() == 2000
