"""Question/answer pairs from lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.operators.ordered import blocked_window


def extract_pairs(lines: DataFrame, doc: str, line_no: str, text: str, span: int = 65_536) -> DataFrame:
    """``(doc, line_no, question, answer)`` from lines starting with ``Q:`` and ``A:``.

    A question line opens a pair, the last answer line before the next question closes it; other
    lines are ignored and unanswered questions are dropped. ``line_no`` runs through all pages.
    """
    body = F.trim(F.translate(text, "\t\r\n\f\x0b", "     "))
    marked = lines.select(
        doc, line_no, body.alias("_line"), F.lower(F.substring(body, 1, 2)).alias("_mark")
    ).filter(F.col("_mark").isin("q:", "a:"))
    grouped = blocked_window(
        marked, [doc], line_no, lasts={"_q": F.when(F.col("_mark") == "q:", F.col(line_no))}, span=span, measure_on=lines
    ).filter(F.col("_q").isNotNull())
    answers = F.max_by("_line", F.when(F.col("_mark") == "a:", F.col(line_no)))
    questions = F.max_by("_line", F.when(F.col("_mark") == "q:", F.col(line_no)))
    return (
        grouped.groupBy(doc, F.col("_q").alias(line_no))
        .agg(questions.alias("question"), answers.alias("answer"))
        .filter(F.col("answer").isNotNull())
    )
