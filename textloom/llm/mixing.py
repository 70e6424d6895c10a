"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens to the power of an exponent, normalised. The exponent is found by bisection: the largest
that is needed either for the weights' entropy to fall to a target (a share of the entropy of equal weights) or for no source to be repeated more often than
a limit. Sources whose own shares are flatter than the entropy asks for get an exponent above 1, up to where the limit on repetitions, now of the largest
source, stops it. The weights are then realised within a budget of tokens as blocks: a source's budget holds a number of whole blocks, each a
permutation of all its documents of its own, and the start of one more, cut where the next document would exceed what is left.

Sources may be as many as they like: the weights stay in a table, and each job of the bisection settles ``LEVELS`` steps. Only
narrow rows (source, hash, tokens) are shuffled to find the cuts, split by hash, so that one source may own most rows; documents are then
repeated or left out where they lie, by comparing their hash with the source's cut.

Defined cases: a null source is a source of its own. Null or empty text has no tokens. A source without tokens has no weight and is taken once. Documents
of a source with the same id and text share a hash and are taken or left together. Sources of one size meet no entropy under that of equal weights: they
keep their shares, and ``target_met`` is false. A table without rows gives none. Extra columns are handed through by ``mix_rows``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.llm.tables import checked_join
from textloom.sources.scratch import materialize

#: Steps of the bisection that one job settles, and jobs.
LEVELS = 4
JOBS = 8
MAX_EXPONENT = 64.0
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """What the exponent is to meet; ``None`` asks for nothing."""

    entropy_share: float | None = None  # of the entropy of equal weights, at most
    repetition_limit: float | None = None  # times that a source's tokens are taken, at most
    budget_tokens: float | None = None  # by default the least that takes every document at least once


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(seed: int, block: Column, doc_id: Column, digest: Column) -> Column:
    """Hash by which a block orders its documents; another one for each block."""
    return F.xxhash64(F.lit(seed), block.cast("int"), doc_id, digest)


def source_totals(narrow: DataFrame) -> DataFrame:
    return narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))


def solve_exponent(totals: DataFrame, target: Target) -> float:
    """Exponent by bisection; 1 keeps the sources' own shares. Where the target cannot be met, ``plan`` says so."""
    own = totals.filter("tokens > 0")
    sources, smallest, largest = own.agg(F.count(F.lit(1)), F.min("tokens"), F.max("tokens")).first()
    if not sources or sources == 1:
        return 1.0
    share = F.col("tokens") / F.lit(float(largest))

    def moments(points: list[float]) -> list[tuple[float, float]]:
        """Sum of the powers, and sum of power times logarithm of power, at each exponent."""
        sums = []
        for x in points:
            power = F.pow(share, F.lit(x))
            sums += [F.sum(power), F.sum(F.when(power > 0, power * F.log(power)).otherwise(0.0))]
        row = own.agg(*sums).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(points))]

    def flat(z: float, w: float) -> bool:
        return target.entropy_share is not None and math.log(z) - w / z > target.entropy_share * math.log(sources)

    def repeated(x: float, z: float) -> bool:
        if target.repetition_limit is None:
            return False
        # Repetition is weight * budget / tokens, a power of the size, so the extremes decide.
        rates = [(t / largest) ** x / z / t for t in (smallest, largest)]
        budget = (1 / min(rates) if min(rates) else math.inf) if target.budget_tokens is None else target.budget_tokens
        return max(rates) * budget > target.repetition_limit * (1 + 1e-12)

    def bisect(low: float, high: float, must_grow) -> float:
        """The least exponent that need not grow, to the precision of all steps; it must at ``low`` and need not at ``high``."""
        for _ in range(JOBS):
            parts = 2**LEVELS
            points = [low + (high - low) * k / parts for k in range(1, parts)]
            grows = [must_grow(x, z, w) for x, (z, w) in zip(points, moments(points))]
            i, j = 0, parts
            while j - i > 1:  # bisection over the points that this job has evaluated
                middle = (i + j) // 2
                i, j = (middle, j) if grows[middle - 1] else (i, middle)
            low, high = low + (high - low) * i / parts, low + (high - low) * j / parts
        return high

    at_0, at_1, at_most = moments([0.0, 1.0, MAX_EXPONENT])
    if flat(*at_1) and not flat(*at_most):
        return bisect(1.0, MAX_EXPONENT, lambda x, z, w: flat(z, w) and not repeated(x, z))
    if flat(*at_1):
        return 1.0
    if not flat(*at_0) and not repeated(0.0, at_0[0]):
        return 0.0
    return bisect(0.0, 1.0, lambda x, z, w: flat(z, w) or repeated(x, z))


def plan(narrow: DataFrame, target: Target, seed: int) -> DataFrame:
    """Per source: ``weight``, ``budget``, whole ``blocks`` and the ``cut`` of the block after them; ``target_met`` is the same for all.

    ``narrow`` is a written table ``(source, tokens, id, digest)``, where id and digest name a document.
    """
    totals = materialize(source_totals(narrow), "source-totals")
    exponent = solve_exponent(totals, target)
    largest = totals.agg(F.max("tokens")).first()[0] or 0
    powered = totals.withColumn(
        "power", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(largest, 1))), F.lit(exponent)))
    )
    mass, least = powered.agg(F.sum("power"), F.max(F.col("tokens") / F.col("power"))).first()
    mass = mass or 1.0
    budget = target.budget_tokens if target.budget_tokens is not None else (least or 0.0) * mass
    weighted = powered.select(
        "source", "tokens", "documents", (F.col("power") / F.lit(mass)).alias("weight"), F.lit(float(exponent)).alias("exponent")
    ).withColumn("budget", F.floor(F.col("weight") * F.lit(float(budget)) + F.lit(1e-6)))
    rate = F.col("budget") / F.nullif("tokens", F.lit(0))
    flatness, sources, repeats = weighted.agg(-F.sum(F.col("weight") * F.log("weight")), F.count("weight"), F.max(rate)).first()
    met = target.entropy_share is None or sources < 2 or flatness <= target.entropy_share * math.log(sources) + 1e-9
    met = met and (target.repetition_limit is None or (repeats or 0.0) <= target.repetition_limit * (1 + 1e-9))
    weighted = weighted.withColumn("target_met", F.lit(met))
    planned = weighted.withColumn(
        "blocks", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("int")
    ).withColumn("left", F.when(F.col("tokens") > 0, F.col("budget") - F.col("blocks") * F.col("tokens")).otherwise(0))
    planned = materialize(planned, "mixing-plan")

    # Where the next block stops: first the part of the hash range, then the document within it.
    count = narrow.count()
    bits = max(1, count.bit_length() // 2)  # parts of the hash range, about as many as rows in one
    open_sources = planned.filter("`left` > 0").select(F.col("source").alias("_s"), "blocks", "left")
    rows = checked_join(narrow, open_sources, F.col("source").eqNullSafe(F.col("_s")), "inner")
    rows = rows.withColumn("place", place_of(seed, F.col("blocks"), F.col("id"), F.col("digest")))
    rows = rows.select("source", "left", "place", "tokens", F.shiftright("place", 64 - bits).alias("part"))
    # Equal places stand for equal documents: they are one row, taken or left together.
    rows = rows.groupBy("source", "left", "part", "place").agg(F.sum("tokens").alias("tokens"))
    rows = materialize(rows, "places")
    ordered = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("source", "left", "part").agg(F.sum("tokens").alias("tokens"))
    sums = sums.withColumn("until", F.sum("tokens").over(ordered))
    border = sums.filter(F.col("until") > F.col("left")).groupBy("source").agg(F.min_by(F.struct("part", (F.col("until") - F.col("tokens")).alias("before")), "part").alias("b"))
    border = materialize(border.select(F.col("source").alias("_s"), "b.part", "b.before"), "borders").withColumnRenamed("part", "_part")
    at_border = checked_join(rows, border, F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_part")), "inner")
    within = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    fits = at_border.withColumn("until", F.col("before") + F.sum("tokens").over(within)).filter(F.col("until") <= F.col("left"))
    last = fits.groupBy(F.col("source").alias("_f")).agg(F.max("place").alias("last"))
    # If no document of the border part fits, the cut is where that part begins, and not itself taken.
    cuts = border.join(last, F.col("_s").eqNullSafe(F.col("_f")), "left").select(
        F.col("_s").alias("_c"),
        F.coalesce("last", F.shiftleft("_part", 64 - bits)).alias("cut"), F.col("last").isNotNull().alias("closed"),
    )
    # Without a border the whole block fits (only by rounding).
    return planned.join(cuts, F.col("source").eqNullSafe(F.col("_c")), "left").drop("_c").withColumn(
        "cut", F.when(F.col("left") > 0, F.coalesce("cut", F.lit(2**63 - 1)))
    ).withColumn("closed", F.coalesce("closed", F.lit(True)))


def mix_rows(docs: DataFrame, target: Target, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, as ``_row``, with ``source``, ``block``, ``place``, ``tokens`` and ``weight``."""
    body = F.col("_text")
    keyed = docs.select(
        F.struct(F.col("*")).alias("_row"), F.col(source).cast("string").alias("source"), F.col(doc_id).cast("string").alias("id"),
        F.col(text).cast("string").alias("_text"),
    ).select("_row", "source", "id", token_count(body).alias("tokens"), F.xxhash64(body).alias("digest"))
    narrow = materialize(keyed.drop("_row"), "mixing-rows")
    planned = materialize(plan(narrow, target, seed).select(F.col("source").alias("_s"), "blocks", "cut", "closed", "weight", "exponent", "target_met"), "mixing-cuts")
    joined = checked_join(keyed, planned, F.col("source").eqNullSafe(F.col("_s")), "inner")
    next_place = place_of(seed, F.col("blocks"), F.col("id"), F.col("digest"))
    taken = (next_place < F.col("cut")) | (F.col("closed") & (next_place == F.col("cut")))
    one_more = F.when(taken, 1).otherwise(0)
    times = F.col("blocks") + one_more
    repeated = joined.withColumn("times", times).filter("times > 0").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("times") - 1))
    )
    return repeated.select(
        "_row", "source", "block", place_of(seed, F.col("block"), F.col("id"), F.col("digest")).alias("place"), "tokens", "weight", "exponent", "target_met"
    )


def mix(docs: DataFrame, target: Target, seed: int = 17) -> DataFrame:
    """``(doc_id, source, block, place, n_tokens, weight)``: a row each time a document is taken; (block, place) orders a source."""
    return mix_rows(docs.select("doc_id", "text", "source"), target, seed).select(
        "_row.doc_id", "source", "block", "place", F.col("tokens").alias("n_tokens"), "weight", "exponent", "target_met"
    )


def mixed_documents(docs: DataFrame, target: Target, seed: int = 17) -> DataFrame:
    """Rows of ``docs`` with all their columns, repeated or left out by the mix."""
    return mix_rows(docs, target, seed).select("_row.*")
