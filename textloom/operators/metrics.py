"""Classification metrics over the long table ``(id, label_id, label, y, p)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed value: probabilities are clipped to this margin before taking logarithms.
CLIP = 1e-7


def _hit(threshold: float) -> Column:
    return F.col("p") > threshold


def binary_accuracy(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    right = (_hit(threshold) == (F.col("y") == 1)).cast("double")
    return scores.agg(F.avg(right).alias("binary_accuracy"))


def categorical_accuracy(scores: DataFrame, id_col: str) -> DataFrame:
    """Share of rows whose best label is their true label; ties go to the lower label id."""
    def arg_max(value: str) -> Column:
        return F.max(F.struct(F.col(value).alias("v"), (-F.col("label_id")).alias("neg")))["neg"]

    rows = scores.groupBy(id_col).agg((arg_max("p") == arg_max("y")).cast("double").alias("right"))
    return rows.agg(F.avg("right").alias("categorical_accuracy"))


def _confusion(threshold: float) -> list[Column]:
    hit, true = _hit(threshold), F.col("y") == 1
    return [
        F.count_if(hit & true).alias("tp"),
        F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & true).alias("fn"),
    ]


def _ratios() -> list[Column]:
    """Precision, recall and F1 from tp, fp, fn; an empty denominator counts as 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def share(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    return [
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def micro_scores(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scores.agg(*_confusion(threshold)).select("tp", "fp", "fn", *_ratios())


def label_scores(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision, recall and F1 per label."""
    return scores.groupBy("label").agg(*_confusion(threshold)).select("label", "tp", "fp", "fn", *_ratios())


def macro_scores(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    per_label = label_scores(scores, threshold)
    return per_label.agg(*[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")])


def true_label_recall(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Share of true labels scored at or above the threshold; null when there are none."""
    reached = (F.col("p") >= threshold).cast("double")
    return scores.filter("y = 1").agg(F.avg(reached).alias("label_recall"))


def binary_cross_entropy(scores: DataFrame) -> DataFrame:
    p = F.greatest(F.least(F.col("p"), F.lit(1 - CLIP)), F.lit(CLIP))
    loss = -(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))
    return scores.agg(F.avg(loss).alias("bce"))


def mean_squared_error(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("mse"))


def softmax(scores: DataFrame, id_col: str, logit: str, out: str = "softmax") -> DataFrame:
    """Softmax of the scores of a row; a row has one score per label."""
    row = Window.partitionBy(id_col)
    shifted = F.exp(F.col(logit) - F.max(logit).over(row))
    return scores.withColumn("_e", shifted).withColumn(
        out, F.col("_e") / F.sum("_e").over(row)
    ).drop("_e")


def all_close(a: DataFrame, b: DataFrame, keys: list[str], column: str, atol: float = 1e-6, rtol: float = 1e-5) -> DataFrame:
    """Compare two prediction sets: ``(n, all_close)``; a row missing on one side fails."""
    left = a.select(*keys, F.col(column).alias("_a"))
    right = b.select(*keys, F.col(column).alias("_b"))
    close = F.coalesce(
        F.abs(F.col("_a") - F.col("_b")) <= atol + rtol * F.abs(F.col("_b")), F.lit(False)
    )
    return left.join(right, keys, "full").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(close).alias("all_close")
    )
