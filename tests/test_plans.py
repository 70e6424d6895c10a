"""Shapes of plans: shuffles, pruned columns, pushed filters."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from textloom.functions.text import word_tokens
from textloom.operators import ranking, vocabulary as voc
from textloom.sources.tables import faq_pairs, load


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def shuffles(df) -> int:
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(r"\bExchange\b", tree))


@pytest.mark.parametrize("name", ["split_3way", "response_pick", "intent_regex", "intent_command", "labels_map", "unify_length"])
def test_row_wise_queries_do_not_shuffle(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert "hashpartitioning" not in text or name == "labels_map"  # that one joins the labels


def test_pairs_take_one_shuffle(spark, sf):
    assert shuffles(faq_pairs(load(spark, sf, "conversations"))) == 1


def test_texts_move_once_and_before_tokenizing(spark, sf):
    docs = load(spark, sf, "documents")
    tokens = voc.token_rows(docs, "doc_id", word_tokens("text"))
    counts = tokens.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("tf"))
    again = counts.groupBy("doc_id").agg(F.sum("tf").alias("n"))
    assert shuffles(counts) == 1 and shuffles(again) == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(counts)
    assert plan(counts).count("regexp_extract_all") == 1


def test_ranking_moves_rows_once(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = ranking.hash_rank(load(spark, sf, "documents"), 1, "doc_id", ["lang"])
        carrying = [line for line in plan(ranked).split("\n\n") if "Exchange" in line and "text#" in line]
        assert len(carrying) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_reach_the_scan(spark, sf):
    kept = load(spark, sf, "documents").filter("lang = 'en'").select("doc_id")
    text = plan(kept)
    assert "EqualTo(lang,en)" in text and "text" not in re.search(r"ReadSchema: (.*)", text).group(1)
