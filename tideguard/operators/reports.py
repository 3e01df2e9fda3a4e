"""Moderation reports over a table that went through ``apply_thresholds``.

Every report is one aggregate: all labels are counted in the same pass and
turned into rows afterwards, so the table is read once per report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.config import DEFAULTS, LABELS, ModerationConfig
from tideguard.functions.labels import first_max, set_names
from tideguard.operators.ordering import ntile_totals


def _percent(part: Column, whole: Column, digits: int | None = 4) -> Column:
    """part/whole in percent, 0.0 when there is nothing to divide by."""
    value = F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part, whole) * 100)
    return value if digits is None else F.round(value, digits)


def _total(column: Column) -> Column:
    """Sum of an indicator, 0 for no rows."""
    return F.coalesce(F.sum(column.cast("bigint")), F.lit(0))


def _per_label(one_row: DataFrame, fields: dict[str, str], *keep: str,
               labels=LABELS) -> DataFrame:
    """One row of ``{prefix}{label}`` columns to one row per label, in label order."""
    items = [F.struct(F.lit(label).alias("label"),
                      *[F.col(pattern.format(label)).alias(name)
                        for name, pattern in fields.items()])
             for label in labels]
    return one_row.select(*keep, F.inline(F.array(*items)))


def moderation_summary(flags: DataFrame, run_date: str) -> DataFrame:
    totals = flags.agg(
        F.count("*").alias("total_scanned"),
        _total(F.col("any_flagged")).alias("total_flagged"),
        *[_total(F.col(f"flag_{x}")).alias(f"{x}_count") for x in LABELS])
    return totals.select(
        F.lit(run_date).alias("run_date"), "total_scanned", "total_flagged",
        _percent(F.col("total_flagged"), F.col("total_scanned")).alias("flagged_pct"),
        *[f"{x}_count" for x in LABELS])


def category_breakdown(flags: DataFrame) -> DataFrame:
    """Per label: hits, share of all and of flagged rows, mean probability of all rows."""
    totals = flags.agg(
        F.count("*").alias("total"), _total(F.col("any_flagged")).alias("flagged"),
        *[_total(F.col(f"flag_{x}")).alias(f"n_{x}") for x in LABELS],
        *[F.coalesce(F.avg(f"prob1_{x}"), F.lit(0.0)).alias(f"p_{x}") for x in LABELS])
    tall = _per_label(totals, {"count": "n_{}", "p": "p_{}"}, "total", "flagged")
    return tall.select(
        "label", "count",
        _percent(F.col("count"), F.col("total")).alias("pct_of_total"),
        _percent(F.col("count"), F.col("flagged")).alias("pct_of_flagged"),
        F.round("p", 4).alias("avg_probability"))


def with_top_label(flags: DataFrame) -> DataFrame:
    label, value = first_max([F.col(f"prob1_{x}") for x in LABELS], LABELS)
    return flags.withColumns({"max_label": label, "max_probability": value})


def with_flag_list(flags: DataFrame) -> DataFrame:
    return flags.withColumn(
        "flagged_labels", set_names([F.col(f"flag_{x}") for x in LABELS], LABELS))


def flagged_comments(flags: DataFrame, run_date: str) -> DataFrame:
    found = with_flag_list(with_top_label(flags.filter("any_flagged")))
    return found.select("id", "user_id", "comment_text", "max_label", "max_probability",
                        "flagged_labels", F.lit(run_date).alias("run_date"))


def any_positive(predictions: DataFrame) -> DataFrame:
    """Rows with at least one positive hard prediction."""
    condition = F.lit(False)
    for label in LABELS:
        condition = condition | (F.col(f"pred_{label}") == 1.0)
    return predictions.filter(condition)


def flagged_by_prediction(predictions: DataFrame) -> DataFrame:
    """The older form of the flagged report: hard predictions under the label names."""
    return any_positive(predictions).select(
        "id", "comment_text", *[F.col(f"pred_{x}").alias(x) for x in LABELS])


def top_flagged(flags: DataFrame, run_date: str, k: int = 100) -> DataFrame:
    return flagged_comments(flags, run_date).orderBy(
        F.col("max_probability").desc(), F.col("id")).limit(k)


def user_profile(flags: DataFrame) -> DataFrame:
    """Per user: comments, flagged comments, their ratio, hits per label, top label.

    The aggregate combines map-side, so a user with very many rows costs one
    row per map task in the shuffle.
    """
    counts = [f"{x}_count" for x in LABELS]
    stats = flags.groupBy("user_id").agg(
        F.count("*").alias("total_comments"),
        F.sum(F.col("any_flagged").cast("int")).alias("flagged_count"),
        *[F.sum(F.col(f"flag_{x}").cast("int")).alias(f"{x}_count") for x in LABELS])
    top, _ = first_max([F.col(c) for c in counts], LABELS)
    return stats.select(
        "user_id", "total_comments", "flagged_count",
        (F.col("flagged_count") / F.col("total_comments")).alias("toxicity_ratio"),
        top.alias("top_label"), *counts)


def _risky(users: DataFrame, config: ModerationConfig) -> DataFrame:
    return users.filter((F.col("toxicity_ratio") > config.high_risk_ratio)
                        & (F.col("total_comments") >= config.high_risk_min_comments))


def _by_ratio(users: DataFrame) -> DataFrame:
    return users.orderBy(F.col("toxicity_ratio").desc(), F.col("user_id"))


def high_risk_users(flags: DataFrame, run_date: str,
                    config: ModerationConfig = DEFAULTS) -> DataFrame:
    return _by_ratio(_risky(user_profile(flags), config)).withColumn(
        "run_date", F.lit(run_date))


def top_users(flags: DataFrame, k: int = 10) -> DataFrame:
    return _by_ratio(user_profile(flags)).limit(k)


def user_stats_predicted(predictions: DataFrame,
                         config: ModerationConfig = DEFAULTS) -> DataFrame:
    """Per user from hard predictions; the ratio looks at ``toxic`` alone."""
    stats = predictions.groupBy("user_id").agg(
        F.count("*").alias("total_comments"),
        *[F.sum(f"pred_{x}").alias(f"{x}_count") for x in LABELS],
        F.avg("pred_toxic").alias("toxicity_ratio"))
    return _by_ratio(_risky(stats, config))


def user_stats_actual(predictions: DataFrame) -> DataFrame:
    """Per user: predicted toxic next to the actual labels."""
    return predictions.groupBy("user_id").agg(
        F.count("*").alias("total_comments"),
        F.sum("pred_toxic").alias("predicted_toxic_comments"),
        F.sum("toxic").alias("actual_toxic_comments"),
        F.sum("severe_toxic").alias("severe_toxic_comments"),
        F.sum("insult").alias("insult_comments"),
        F.sum("identity_hate").alias("identity_hate_comments"),
        F.avg("pred_toxic").alias("toxicity_ratio"))


def user_counts(flags: DataFrame, config: ModerationConfig = DEFAULTS) -> DataFrame:
    users = user_profile(flags)
    risky = ((F.col("toxicity_ratio") > config.high_risk_ratio)
             & (F.col("total_comments") >= config.high_risk_min_comments))
    return users.agg(F.count("*").alias("total_users"),
                     F.count(F.when(risky, 1)).alias("high_risk_users"))


def user_label_matrix(flags: DataFrame, config: ModerationConfig = DEFAULTS,
                      k: int = 20) -> DataFrame:
    """(user, label, hits) for the k riskiest users."""
    riskiest = _by_ratio(_risky(user_profile(flags), config)).limit(k)
    return _per_label(riskiest, {"n": "{}_count"}, "user_id")


def flag_distribution(flags: DataFrame) -> DataFrame:
    """How many rows are clean and how many flagged."""
    totals = flags.agg(F.count("*").alias("total"),
                       _total(F.col("any_flagged")).alias("flagged"))
    clean = F.greatest(F.lit(0), F.col("total") - F.col("flagged"))
    return totals.select(F.inline(F.array(
        F.struct(F.lit("clean").alias("segment"), clean.alias("n")),
        F.struct(F.lit("flagged").alias("segment"), F.col("flagged").alias("n")))))


def predicted_vs_actual(predictions: DataFrame) -> DataFrame:
    totals = predictions.agg(
        *[_total(F.col(f"pred_{x}")).alias(f"p_{x}") for x in LABELS],
        *[_total(F.col(x)).alias(f"a_{x}") for x in LABELS])
    return _per_label(totals, {"predicted": "p_{}", "actual": "a_{}"}).withColumn(
        "difference", F.col("predicted") - F.col("actual"))


def prediction_summary(predictions: DataFrame) -> DataFrame:
    totals = predictions.agg(
        F.count("*").alias("total"),
        *[_total(F.col(f"pred_{x}") == 1.0).alias(f"p_{x}") for x in LABELS])
    tall = _per_label(totals, {"flagged": "p_{}"}, "total")
    return tall.select("label", "flagged",
                       _percent(F.col("flagged"), F.col("total")).alias("pct_of_total"))


def volume_buckets(flags: DataFrame, config: ModerationConfig = DEFAULTS,
                   order: str = "id") -> DataFrame:
    """Comments and flags in ``volume_buckets`` equal slices of the row order.

    ``order`` must be a number: text ids have no order that says anything about
    time. Predictions of ``moderation.predict`` carry ``row_order`` for it.
    """
    if not isinstance(flags.schema[order].dataType, T.NumericType):
        raise TypeError(f"{order} has no order of rows; name a numeric column")
    return ntile_totals(flags, order, "any_flagged", config.volume_buckets)
