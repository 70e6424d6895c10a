"""Sessions: events of one user closer together than a gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.operators.ordered import blocked_window

MICROS = 1_000_000
DAY_MICROS = 86_400 * MICROS


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp's wall-clock fields, whatever the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    part = (F.extract(F.lit("SECOND"), ts) * MICROS).cast("bigint")
    return days * DAY_MICROS + seconds.cast("bigint") * MICROS + part


def sessions(
    events: DataFrame, user: str = "user_id", ts: str = "ts", event_id: str = "event_id", gap_minutes: int = 60
) -> DataFrame:
    """``(user, session_start, session_end, n_events)`` in microseconds; end = last event + gap.

    Several events at one instant are merged first, so instants are unique per user and a
    user with any share of the rows is handled block by block.
    """
    gap = gap_minutes * 60 * MICROS
    instants = events.groupBy(F.col(user), micros(ts).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    linked = blocked_window(instants, [user], "_t", prevs={"_prev_t": "_t"}, span=DAY_MICROS, measure=False)
    opens = F.col("_prev_t").isNull() | (F.col("_t") - F.col("_prev_t") > gap)
    numbered = blocked_window(
        linked, [user], "_t", lasts={"_start": F.when(opens, F.col("_t"))}, span=DAY_MICROS, measure=False
    )
    return numbered.groupBy(user, F.col("_start").alias("session_start")).agg(
        (F.max("_t") + gap).alias("session_end"), F.sum("_n").alias("n_events")
    )
