"""Catalogue entries on scored events: flags, reports, aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.config import DISPLAY_NAMES, LABELS
from tideguard.functions.hashing import synthetic_user
from tideguard.functions.labels import category_phrase, set_array
from tideguard.functions.scoring import apply_thresholds, with_probabilities
from tideguard.operators import profile, reports
from tideguard.operators.evaluation import (
    auc_exact, confusion_matrix, precision_recall_f1,
)
from tideguard.operators.joins import join_predictions
from tideguard.operators.responses import flatten_response, score_response
from tideguard.plans import sql_parts as sql
from tideguard.plans.fixtures import predictions
from tideguard.sources.readers import fill_prediction_defaults

RUN_DATE = "2024-01-31"


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_thresholds(predictions(spark, sf_dir))


def threshold_flags(spark, sf_dir):
    return flags(spark, sf_dir).select(
        "id", *[f"flag_{x}" for x in LABELS], "flagged_label_count", "any_flagged")


def probability_forms(spark, sf_dir):
    """toxic as array, insult missing, threat as float, the rest as they are."""
    p = predictions(spark, sf_dir).withColumns({
        "prob_toxic": F.array(1 - F.col("prob_toxic"), F.col("prob_toxic")),
        "prob_threat": F.col("prob_threat").cast("float")}).drop("prob_insult")
    return with_probabilities(p).select("id", *[f"prob1_{x}" for x in LABELS])


def argmax_label(spark, sf_dir):
    return reports.with_top_label(flags(spark, sf_dir)).select(
        "id", "max_label", "max_probability")


def flagged_label_list(spark, sf_dir):
    return reports.with_flag_list(flags(spark, sf_dir)).select("id", "flagged_labels")


def flagged_phrase(spark, sf_dir):
    categories = set_array([F.col(f"flag_{x}") for x in LABELS], LABELS)
    return flags(spark, sf_dir).select("id", category_phrase(categories).alias("phrase"))


def any_label_filter(spark, sf_dir):
    return reports.any_positive(predictions(spark, sf_dir)).select(
        "id", *[f"pred_{x}" for x in LABELS])


def moderation_summary(spark, sf_dir):
    return reports.moderation_summary(flags(spark, sf_dir), RUN_DATE)


def category_breakdown(spark, sf_dir):
    return reports.category_breakdown(flags(spark, sf_dir))


def flagged_comments(spark, sf_dir):
    return reports.flagged_comments(flags(spark, sf_dir), RUN_DATE)


def flagged_comments_by_prediction(spark, sf_dir):
    return reports.flagged_by_prediction(predictions(spark, sf_dir))


def top_flagged(spark, sf_dir):
    return reports.top_flagged(flags(spark, sf_dir), RUN_DATE)


def high_risk_users(spark, sf_dir):
    return reports.high_risk_users(flags(spark, sf_dir), RUN_DATE)


def top_users(spark, sf_dir):
    return reports.top_users(flags(spark, sf_dir))


def user_stats_predicted(spark, sf_dir):
    return reports.user_stats_predicted(predictions(spark, sf_dir)).withColumn(
        "toxicity_ratio", F.round("toxicity_ratio", 6))


def user_stats_actual(spark, sf_dir):
    return reports.user_stats_actual(predictions(spark, sf_dir)).withColumn(
        "toxicity_ratio", F.round("toxicity_ratio", 6))


def user_counts(spark, sf_dir):
    return reports.user_counts(flags(spark, sf_dir))


def volume_buckets(spark, sf_dir):
    return reports.volume_buckets(flags(spark, sf_dir))


def _skewed(flags_or_scores):
    """An order and scores of which almost all values lie close together: row numbers to the fifth, scores in a millionth."""
    return flags_or_scores.withColumns({
        "place": F.pow(F.col("id").cast("double"), F.lit(5.0)),
        **{f"prob_{x}": F.lit(0.5) + F.floor(F.col(f"prob_{x}") * 1000) / 2.0 ** 30 for x in LABELS}})


def volume_buckets_skewed(spark, sf_dir):
    return reports.volume_buckets(_skewed(flags(spark, sf_dir)), order="place")


def auc_roc_skewed(spark, sf_dir):
    return auc_exact(_skewed(predictions(spark, sf_dir))).select("label", F.round("auc_roc", 6).alias("auc_roc"))


def user_label_matrix(spark, sf_dir):
    return reports.user_label_matrix(flags(spark, sf_dir))


def flag_distribution(spark, sf_dir):
    return reports.flag_distribution(flags(spark, sf_dir))


def predicted_vs_actual(spark, sf_dir):
    return reports.predicted_vs_actual(predictions(spark, sf_dir))


def prediction_summary(spark, sf_dir):
    return reports.prediction_summary(predictions(spark, sf_dir))


def label_distribution(spark, sf_dir):
    return profile.label_distribution(predictions(spark, sf_dir))


def join_label_predictions(spark, sf_dir):
    p = predictions(spark, sf_dir)
    per_label = [p.select("id", f"pred_{x}", f"prob_{x}") for x in LABELS]
    return join_predictions(p.select("id", "comment_text", *LABELS), per_label)


def predictions_fill_defaults(spark, sf_dir):
    bare = predictions(spark, sf_dir).drop("user_id", "comment_text")
    return fill_prediction_defaults(bare).select("id", "user_id", "comment_text", "prob_toxic")


def synthetic_user_bucket(spark, sf_dir):
    return predictions(spark, sf_dir).select(
        "id", synthetic_user(F.col("id"), 1000).alias("user_id"))


def score_response_query(spark, sf_dir):
    return flatten_response(score_response(flags(spark, sf_dir)))


def confusion(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return confusion_matrix(p, "toxic", "pred_toxic")


def prf(spark, sf_dir):
    return precision_recall_f1(predictions(spark, sf_dir)).withColumns(
        {c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def auc_roc(spark, sf_dir):
    return auc_exact(predictions(spark, sf_dir)).select(
        "label", F.round("auc_roc", 6).alias("auc_roc"))


def auc_pr(spark, sf_dir):
    return auc_exact(predictions(spark, sf_dir)).select(
        "label", F.round("auc_pr", 6).alias("auc_pr"))


QUERIES = {
    "threshold_flags": threshold_flags,
    "probability_forms": probability_forms,
    "argmax_label": argmax_label,
    "flagged_label_list": flagged_label_list,
    "flagged_phrase": flagged_phrase,
    "any_label_filter": any_label_filter,
    "moderation_summary": moderation_summary,
    "category_breakdown": category_breakdown,
    "flagged_comments": flagged_comments,
    "flagged_comments_by_prediction": flagged_comments_by_prediction,
    "top_flagged": top_flagged,
    "high_risk_users": high_risk_users,
    "top_users": top_users,
    "user_stats_predicted": user_stats_predicted,
    "user_stats_actual": user_stats_actual,
    "user_counts": user_counts,
    "volume_buckets": volume_buckets,
    "volume_buckets_skewed": volume_buckets_skewed,
    "auc_roc_skewed": auc_roc_skewed,
    "user_label_matrix": user_label_matrix,
    "flag_distribution": flag_distribution,
    "predicted_vs_actual": predicted_vs_actual,
    "prediction_summary": prediction_summary,
    "label_distribution": label_distribution,
    "join_label_predictions": join_label_predictions,
    "predictions_fill_defaults": predictions_fill_defaults,
    "synthetic_user_bucket": synthetic_user_bucket,
    "score_response": score_response_query,
    "confusion_matrix": confusion,
    "precision_recall_f1": prf,
    "auc_roc_exact": auc_roc,
    "auc_pr_exact": auc_pr,
}

_F = "WITH " + sql.FLAGS + "\n"
_P = "WITH " + sql.PREDICTIONS + "\n"
_U = "WITH " + sql.USERS + "\n"
_TOP_LABEL, _TOP_VALUE = sql.first_max("prob_{L}")
_FLAG_LIST = "concat_ws(',', " + sql.each_label("CASE WHEN flag_{L} THEN '{L}' END") + ")"
_FLAGGED = f"""SELECT id, user_id, comment_text, {_TOP_LABEL} AS max_label,
  {_TOP_VALUE} AS max_probability, {_FLAG_LIST} AS flagged_labels,
  '{RUN_DATE}' AS run_date FROM F WHERE any_flagged"""
_NAMES = "[" + ", ".join(
    f"CASE WHEN flag_{x} THEN '{DISPLAY_NAMES[x]}' END" for x in LABELS) + "]"
def _auc(score: str) -> str:
    return _P + """, L AS (""" + sql.per_label(score + " AS score, {L} AS y", "P") + """),
G AS (SELECT label, score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM L GROUP BY ALL),
W AS (SELECT label, score, pos, neg,
  sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER (PARTITION BY label) AS n_pos, sum(neg) OVER (PARTITION BY label) AS n_neg
  FROM G WINDOW w AS (PARTITION BY label ORDER BY score DESC)),
S AS (SELECT *, tp / (tp + fp) AS prec,
  lag(tp / (tp + fp)) OVER (PARTITION BY label ORDER BY score DESC) AS prev_prec FROM W)
"""


_ROC = """SELECT label,
  round(sum(neg * (tp - pos / 2)) / (any_value(n_pos) * any_value(n_neg)), 6) AS auc_roc
  FROM S GROUP BY label"""

ORACLES = {
    "threshold_flags": _F + "SELECT id, " + sql.each_label("flag_{L}")
    + ", flagged_label_count, any_flagged FROM F",
    "probability_forms": _P + """SELECT id, prob_toxic AS prob1_toxic,
  prob_severe_toxic AS prob1_severe_toxic, prob_obscene AS prob1_obscene,
  prob_threat::FLOAT::DOUBLE AS prob1_threat, pred_insult AS prob1_insult,
  prob_identity_hate AS prob1_identity_hate FROM P""",
    "argmax_label": _F + f"SELECT id, {_TOP_LABEL} AS max_label, "
    f"{_TOP_VALUE} AS max_probability FROM F",
    "flagged_label_list": _F + f"SELECT id, {_FLAG_LIST} AS flagged_labels FROM F",
    "flagged_phrase": _F + f""", N AS (
  SELECT id, list_filter({_NAMES}, lambda c: c IS NOT NULL) AS names FROM F)
SELECT id, CASE len(names) WHEN 0 THEN 'harmful content' WHEN 1 THEN names[1]
  ELSE array_to_string(names[1:len(names) - 1], ', ') || ' and ' || names[len(names)]
  END AS phrase FROM N""",
    "any_label_filter": _P + "SELECT id, " + sql.each_label("pred_{L}") + " FROM P WHERE "
    + " OR ".join(f"pred_{x} = 1.0" for x in LABELS),
    "moderation_summary": _F + f"""SELECT '{RUN_DATE}' AS run_date, count(*) AS total_scanned,
  CAST(sum(any_flagged::INTEGER) AS BIGINT) AS total_flagged,
  round(sum(any_flagged::INTEGER)::DOUBLE / count(*) * 100, 4) AS flagged_pct,
  """ + sql.each_label("CAST(sum(flag_{L}::INTEGER) AS BIGINT) AS {L}_count") + " FROM F",
    "category_breakdown": _F + sql.per_label("""count(*) FILTER (flag_{L}) AS "count",
  round(count(*) FILTER (flag_{L})::DOUBLE / count(*) * 100, 4) AS pct_of_total,
  round(count(*) FILTER (flag_{L})::DOUBLE / count(*) FILTER (any_flagged) * 100, 4)
    AS pct_of_flagged,
  round(avg(prob_{L}), 4) AS avg_probability""", "F"),
    "flagged_comments": _F + _FLAGGED,
    "flagged_comments_by_prediction": _P + "SELECT id, comment_text, "
    + sql.each_label("pred_{L} AS {L}") + " FROM P WHERE "
    + " OR ".join(f"pred_{x} = 1.0" for x in LABELS),
    "top_flagged": _F + _FLAGGED + " ORDER BY max_probability DESC, id LIMIT 100",
    "high_risk_users": _U + f"SELECT *, '{RUN_DATE}' AS run_date FROM U WHERE {sql.RISK}",
    "top_users": _U + "SELECT * FROM U ORDER BY toxicity_ratio DESC, user_id LIMIT 10",
    "user_stats_predicted": _P + "SELECT * FROM (SELECT user_id, count(*) AS total_comments, "
    + sql.each_label("sum(pred_{L}) AS {L}_count")
    + ", round(avg(pred_toxic), 6) AS toxicity_ratio FROM P GROUP BY user_id) WHERE " + sql.RISK,
    "user_stats_actual": _P + """SELECT user_id, count(*) AS total_comments,
  sum(pred_toxic) AS predicted_toxic_comments,
  CAST(sum(toxic) AS BIGINT) AS actual_toxic_comments,
  CAST(sum(severe_toxic) AS BIGINT) AS severe_toxic_comments,
  CAST(sum(insult) AS BIGINT) AS insult_comments,
  CAST(sum(identity_hate) AS BIGINT) AS identity_hate_comments,
  round(avg(pred_toxic), 6) AS toxicity_ratio FROM P GROUP BY user_id""",
    "user_counts": _U + f"""SELECT count(*) AS total_users,
  count(*) FILTER ({sql.RISK}) AS high_risk_users FROM U""",
    "volume_buckets": _F + """, B AS (
  SELECT any_flagged, ntile(20) OVER (ORDER BY id) - 1 AS b FROM F)
SELECT CAST(b AS INTEGER) AS bucket_index, count(*) AS comment_count,
  CAST(sum(any_flagged::INTEGER) AS BIGINT) AS flagged_count FROM B GROUP BY b""",
    "volume_buckets_skewed": _F + """, B AS (
  SELECT any_flagged, ntile(20) OVER (ORDER BY pow(id::DOUBLE, 5)) - 1 AS b FROM F)
SELECT CAST(b AS INTEGER) AS bucket_index, count(*) AS comment_count,
  CAST(sum(any_flagged::INTEGER) AS BIGINT) AS flagged_count FROM B GROUP BY b""",
    "auc_roc_skewed": _auc("floor(prob_{L} * 1000)") + _ROC,
    "user_label_matrix": _U + f""", T AS (SELECT * FROM U WHERE {sql.RISK}
  ORDER BY toxicity_ratio DESC, user_id LIMIT 20)
""" + sql.per_label("user_id, {L}_count AS n", "T"),
    "flag_distribution": _F + """SELECT 'clean' AS segment,
  count(*) - count(*) FILTER (any_flagged) AS n FROM F
UNION ALL SELECT 'flagged', count(*) FILTER (any_flagged) FROM F""",
    "predicted_vs_actual": _P + sql.per_label("""CAST(sum(pred_{L}) AS BIGINT) AS predicted,
  CAST(sum({L}) AS BIGINT) AS actual,
  CAST(sum(pred_{L}) AS BIGINT) - CAST(sum({L}) AS BIGINT) AS difference""", "P"),
    "prediction_summary": _P + sql.per_label("""count(*) FILTER (pred_{L} = 1.0) AS flagged,
  round(count(*) FILTER (pred_{L} = 1.0)::DOUBLE / count(*) * 100, 4) AS pct_of_total""", "P"),
    "label_distribution": _P + sql.per_label("""count(*) FILTER ({L} = 1) AS positives,
  round(count(*) FILTER ({L} = 1)::DOUBLE / count(*) * 100, 4) AS pct""", "P"),
    "join_label_predictions": _P + "SELECT id, comment_text, " + sql.each_label("{L}") + ", "
    + sql.each_label("pred_{L}") + ", " + sql.each_label("prob_{L}") + " FROM P",
    "predictions_fill_defaults": _P + "SELECT id, CAST(" + sql.bucket("id", 1000)
    + " AS INTEGER) AS user_id, '' AS comment_text, prob_toxic FROM P",
    "synthetic_user_bucket": "SELECT event_id AS id, CAST(" + sql.bucket("event_id", 1000)
    + " AS INTEGER) AS user_id FROM events",
    "score_response": _F + ", R AS (" + sql.per_label(f"""id, comment_text AS comment,
  array_to_string({sql.model_words('comment_text')}, ' ') AS cleaned, any_flagged AS is_toxic,
  {_FLAG_LIST} AS flagged_categories, round(prob_{{L}} * 100, 2) AS probability,
  flag_{{L}} AS flagged, CAST(NULL AS VARCHAR) AS flagged_by""", "F") + """)
SELECT R.*, T.threshold FROM R JOIN (VALUES """ + ", ".join(
        f"('{x}', {t * 100}::DOUBLE)" for x, t in sql.THRESHOLDS.items())
    + ") AS T(label, threshold) USING (label)",
    "confusion_matrix": _P + """SELECT toxic AS label, pred_toxic AS prediction,
  count(*) AS n FROM P GROUP BY ALL""",
    "precision_recall_f1": _P + ", M AS (" + sql.per_label("""
  count(*) FILTER ({L} = 1 AND pred_{L} = 1.0) AS tp,
  count(*) FILTER ({L} = 0 AND pred_{L} = 1.0) AS fp,
  count(*) FILTER ({L} = 1 AND pred_{L} = 0.0) AS fn,
  count(*) FILTER ({L} = 0 AND pred_{L} = 0.0) AS tn""", "P") + """), Q AS (SELECT *,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0::DOUBLE END AS p,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0::DOUBLE END AS r FROM M)
SELECT label, tp, fp, fn, tn, round(p, 6) AS "precision", round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0::DOUBLE END, 6) AS f1 FROM Q""",
    "auc_roc_exact": _auc("prob_{L}") + _ROC,
    "auc_pr_exact": _auc("prob_{L}") + """SELECT label,
  round(sum(pos / n_pos * (prec + coalesce(prev_prec, prec)) / 2), 6) AS auc_pr
  FROM S GROUP BY label""",
}
