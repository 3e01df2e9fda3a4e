"""Classifier metrics for all labels in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideguard.config import LABELS
from tideguard.operators.ordering import in_ranges


def confusion_matrix(df: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    return (df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
            .agg(F.count("*").alias("n")).orderBy("label", "prediction"))


def precision_recall_f1(df: DataFrame, labels: Sequence[str] = LABELS,
                        actual: str = "{}", predicted: str = "pred_{}") -> DataFrame:
    """Counts and metrics per label; a zero denominator gives 0."""
    def hits(label, y, p):
        return F.count(F.when((F.col(actual.format(label)) == y)
                              & (F.col(predicted.format(label)) == float(p)), 1))

    one_row = df.agg(*[
        hits(x, y, p).alias(f"{name}_{x}") for x in labels
        for name, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))])
    counts = one_row.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("label"),
                 *[F.col(f"{n}_{x}").alias(n) for n in ("tp", "fp", "fn", "tn")])
        for x in labels])))

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rated = counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", ratio(2 * p * r, p + r))


def auc_exact(df: DataFrame, labels: Sequence[str] = LABELS, actual: str = "{}",
              score: str = "prob_{}") -> DataFrame:
    """Exact area under the ROC and the precision-recall curve per label.

    Both areas are sums over the distinct scores in falling order. Equal scores
    are merged first (map-side); the distinct ones are dealt out by ranges, which
    are even however the scores lie, and each range is summed on its own, starting
    from the counts of the ranges above it: one row per label and range.
    """
    tall = df.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("label"), F.col(score.format(x)).alias("score"),
                 F.col(actual.format(x)).cast("int").alias("y"))
        for x in labels]))).filter(F.col("score").isNotNull() & F.col("y").isNotNull())
    merged = in_ranges(tall.groupBy("label", "score").agg(
        F.sum("y").cast("double").alias("pos"), F.sum(1 - F.col("y")).cast("double").alias("neg")), "label", F.desc("score"))

    per_range = merged.groupBy("label", "part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    above = Window.partitionBy("label").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("label")
    starts = per_range.select(
        "label", "part",
        F.coalesce(F.sum("pos").over(above), F.lit(0.0)).alias("tp_above"),
        F.coalesce(F.sum("neg").over(above), F.lit(0.0)).alias("fp_above"),
        F.sum("pos").over(whole).alias("n_pos"), F.sum("neg").over(whole).alias("n_neg"))

    inside = Window.partitionBy("label", "part").orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    curve = merged.join(starts, ["label", "part"]).select(
        "label", "pos", "neg", "n_pos", "n_neg",
        (F.col("tp_above") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("fp_above") + F.sum("neg").over(inside)).alias("fp"))
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    precision = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp - pos, tp - pos + fp - neg), precision)
    return curve.groupBy("label").agg(
        F.try_divide(F.sum(neg * (tp - pos / 2)),
                     F.first("n_pos") * F.first("n_neg")).alias("auc_roc"),
        F.try_divide(F.sum(pos * (precision + before) / 2), F.first("n_pos")).alias("auc_pr"))
