"""URL filters: rules for hosts and path prefixes, and a list of canonical URLs behind a blocked Bloom filter.

A url is cut into host and path; the longest rule that fits decides. All other urls are looked up in the list by canonical form: a
blocked Bloom filter of the list (its size is bounded, whatever the list's) lets possible hits through, and an exact join on the
canonical url removes the false ones. Only possible hits are shuffled; a url that many pages share is one row of the
join's inner side, looked up as a hot key.

Defined cases: null urls and urls without ``://`` have empty host and path, fit no rule, are in no list and are allowed. Repeated rows are
judged alike. Urls of any length are read whole. Of rules of one length that fit, the last by its text decides. Null or empty entries of the list are
ignored; an empty list or table blocks or gives nothing. Extra columns are handed through by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.llm.tables import build_filter, checked_join, filter_rows
from textloom.sources.scratch import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]  # verdict, host/path


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host in lower case, path and query; empty if there are none."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), F.coalesce(query, F.lit(""))


def canonical_url(host: Column, path: Column, query: Column) -> Column:
    """Without scheme, a leading www. or m., trailing slashes, fragment and tracking parameters; null without host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    short = F.regexp_replace(path, r"/+$", "")
    wanted = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[a-z]+|ref)=[^&]*", ""), r"^&", "")
    full = F.concat(bare, short, F.when(wanted != "", F.concat(F.lit("?"), wanted)).otherwise(""))
    return F.when(host != "", full)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tried first
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, decision).otherwise(verdict)
    return text, verdict


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, url: str = "url") -> DataFrame:
    """Rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; ``listed`` has one string column of urls."""
    host, path, query = url_parts(F.col("_url"))
    packed = pages.select(F.struct(F.col("*")).alias("_row"), F.col(url).cast("string").alias("_url"))
    parts = packed.select("_row", host.alias("_host"), path.alias("_path"), query.alias("_query"))
    rule, decision = fitting_rule(F.col("_host"), F.col("_path"), rules)
    rows = parts.select(
        "_row", "_host", "_path", rule.alias("_rule"), decision.alias("_decision"),
        canonical_url(F.col("_host"), F.col("_path"), F.col("_query")).alias("_canonical"),
    ).withColumn("_key", F.xxhash64("_canonical"))

    entry_host, entry_path, entry_query = url_parts(F.col(listed.columns[0]).cast("string"))
    entries = listed.select(canonical_url(entry_host, entry_path, entry_query).alias("_canonical")).filter("_canonical IS NOT NULL")
    entries = materialize(entries.distinct().withColumn("_key", F.xxhash64("_canonical")), "listed-urls")
    words = build_filter(entries, "_key", entries.count())

    # Which canonical urls are listed: possible hits, each once, against the list.
    asked = rows.filter("_rule IS NULL AND _canonical IS NOT NULL").select("_canonical", "_key")
    possible = filter_rows(asked, "_key", words).select("_canonical").distinct()
    hits = possible.join(entries.select("_canonical").hint("merge"), "_canonical", "left_semi")
    hits = materialize(hits.withColumn("_listed", F.lit(True)), "listed-hits")
    marked = checked_join(rows, hits, ["_canonical"], "left")
    verdict = F.coalesce(F.col("_decision"), F.when(F.col("_listed") & F.col("_rule").isNull(), "block"), F.lit("allow"))
    return marked.select(
        "_row.*", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), verdict.alias("verdict")
    )
