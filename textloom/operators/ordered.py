"""Running and neighbouring values over ordered rows of a key, safe when one key is huge.

A plain window would sort all rows of a key in one task. Here each key is cut into blocks of
``span`` order values: the window runs inside a block, one summary row per block carries values
over block borders, and the two are joined on (key, block). The order column must be unique
within its key, so that a block never holds more than ``span`` rows.

When the order values of the whole table are measured to lie in one block, as with short
conversations, no key can hold more than ``span`` rows and a plain window does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SPAN = 65_536


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _one_block(df: DataFrame, order: str, span: int) -> bool:
    """True when every order value of the table falls into the same ``span`` values."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    return low is None or high - low < span


def _plain_window(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: dict[str, Column | str],
    lasts: dict[str, Column | str],
    nexts: dict[str, Column | str],
    prevs: dict[str, Column | str],
) -> DataFrame:
    rows = Window.partitionBy(*keys).orderBy(order)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = [F.coalesce(F.sum(_as_column(v)).over(upto), F.lit(0)).alias(n) for n, v in sums.items()]
    out += [F.last(_as_column(v), ignorenulls=True).over(upto).alias(n) for n, v in lasts.items()]
    out += [F.lead(_as_column(v)).over(rows).alias(n) for n, v in nexts.items()]
    out += [F.lag(_as_column(v)).over(rows).alias(n) for n, v in prevs.items()]
    return df.select("*", *out)


def blocked_window(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    sums: dict[str, Column | str] | None = None,
    lasts: dict[str, Column | str] | None = None,
    nexts: dict[str, Column | str] | None = None,
    prevs: dict[str, Column | str] | None = None,
    span: int = SPAN,
    measure: bool = True,
    measure_on: DataFrame | None = None,
) -> DataFrame:
    """Add running sums, last non-null values so far, and values of the next / previous row.

    ``measure=False`` skips the look at the order range where it is known to be wide;
    ``measure_on`` names a cheaper table that covers the range, such as the unfiltered input.
    """
    sums, lasts, nexts, prevs = sums or {}, lasts or {}, nexts or {}, prevs or {}
    keys = list(keys)
    if measure and _one_block(df if measure_on is None else measure_on, order, span):
        return _plain_window(df, keys, order, sums, lasts, nexts, prevs)
    block_keys = [*keys, "_block"]
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(span)))

    def pack(values: dict[str, Column | str]) -> Column:
        return F.struct(*[_as_column(v).alias(n) for n, v in values.items()])

    # One summary row per (key, block), combined map-side before the shuffle.
    aggs: list[Column] = [F.sum(_as_column(v)).alias(f"_s_{n}") for n, v in sums.items()]
    for name, value in lasts.items():
        value = _as_column(value)
        aggs.append(F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(f"_l_{name}"))
    if nexts:
        aggs.append(F.min_by(pack(nexts), F.col(order)).alias("_first"))
    if prevs:
        aggs.append(F.max_by(pack(prevs), F.col(order)).alias("_last"))
    summary = blocked.groupBy(*block_keys).agg(*aggs)

    across = Window.partitionBy(*keys).orderBy("_block")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum(f"_s_{n}").over(before).alias(f"_cs_{n}") for n in sums]
    carried += [F.last(f"_l_{n}", ignorenulls=True).over(before).alias(f"_cl_{n}") for n in lasts]
    if nexts:
        carried.append(F.lead("_first").over(across).alias("_next_first"))
    if prevs:
        carried.append(F.lag("_last").over(across).alias("_prev_last"))
    summary = summary.select(*block_keys, *carried)

    inside = Window.partitionBy(*block_keys).orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns: list[Column] = [F.sum(_as_column(v)).over(upto).alias(f"_ws_{n}") for n, v in sums.items()]
    columns += [
        F.last(_as_column(v), ignorenulls=True).over(upto).alias(f"_wl_{n}") for n, v in lasts.items()
    ]
    if nexts:
        columns.append(F.lead(pack(nexts)).over(inside).alias("_next"))
    if prevs:
        columns.append(F.lag(pack(prevs)).over(inside).alias("_prev"))
    joined = blocked.select("*", *columns).join(summary, block_keys, "left")

    out: list[Column] = [F.col(c) for c in df.columns]
    out += [
        (F.coalesce(f"_ws_{n}", F.lit(0)) + F.coalesce(f"_cs_{n}", F.lit(0))).alias(n) for n in sums
    ]
    out += [F.coalesce(f"_wl_{n}", f"_cl_{n}").alias(n) for n in lasts]
    if nexts:
        follower = F.coalesce("_next", "_next_first")
        out += [follower[n].alias(n) for n in nexts]
    if prevs:
        leader = F.coalesce("_prev", "_prev_last")
        out += [leader[n].alias(n) for n in prevs]
    return joined.select(*out)
