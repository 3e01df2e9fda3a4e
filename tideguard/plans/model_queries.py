"""Catalogue entries that train and apply models.

What a fit decides has no SQL form. The entries return what the data decide
(rows, positives, weights, folds) and checks of the rest, which SQL can state;
the tests compare the models and their metrics with plain MLlib code.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideguard.config import DEFAULTS, LABELS
from tideguard.functions.scoring import with_probabilities
from tideguard.operators import scoring, training
from tideguard.operators.certificates import TOLERANCE, certify_training
from tideguard.operators.evaluation import precision_recall_f1
from tideguard.plans import sql_parts as sql
from tideguard.plans.fixtures import long_texts, predictions, training_comments
from tideguard.session import fresh_path


def _fit_six(spark, sf_dir):
    return training.train_multilabel(training_comments(spark, sf_dir))


def _saved(spark, model: training.MultiLabelModel) -> training.MultiLabelModel:
    """The model after a way over the shared folder."""
    path = fresh_path(spark, "six-label-model")
    model.save(path)
    return training.MultiLabelModel.load(path)


def _all_documents(spark, sf_dir):
    return long_texts(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.col("text").alias("comment_text"))


def _shown(metrics):
    """The counts that the data decide, and whether what the model decides is sound:
    areas between 0 and 1, and precision, recall and F1 those of the counts."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    near = lambda c, want: F.abs(F.coalesce(c, F.lit(0.0)) - F.coalesce(want, F.lit(0.0))) < 1e-9
    one_class = (tp + fn == 0) | (fp + F.col("tn") == 0)  # there is no area then
    area = lambda c: F.coalesce(F.col(c).between(0, 1), one_class)
    sound = (area("auc_roc") & area("auc_pr")
             & near(F.col("precision"), F.try_divide(tp, tp + fp)) & near(F.col("recall"), F.try_divide(tp, tp + fn))
             & near(F.col("f1"), F.try_divide(2 * tp, 2 * tp + fp + fn)))
    return metrics.select("label", (tp + fp + fn + F.col("tn")).alias("n_rows"), (tp + fn).alias("n_positive"), sound.alias("sound"))


def train_lr(spark, sf_dir):
    return _shown(training.train_plain(training_comments(spark, sf_dir)).metrics)


def train_lr_baseline(spark, sf_dir):
    return _shown(training.train_baseline(training_comments(spark, sf_dir)).metrics)


def train_lr_weighted(spark, sf_dir):
    return _shown(training.train_weighted(training_comments(spark, sf_dir)).metrics)


def train_gbt(spark, sf_dir):
    return _shown(training.train_trees(training_comments(spark, sf_dir)).metrics)


def train_final(spark, sf_dir):
    return _shown(training.train_final(training_comments(spark, sf_dir)).metrics)


def cv_grid(spark, sf_dir):
    """The grid's settings, and whether one of them, the one with the largest area, is the best."""
    grid = training.cv_grid(training_comments(spark, sf_dir)).grid
    best = Window.partitionBy()  # one row for each of the six settings
    sound = ((F.sum(F.col("is_best").cast("int")).over(best) == 1) & F.col("auc_roc").between(0, 1)
             & (F.max("auc_roc").over(best) == F.max(F.when(F.col("is_best"), F.col("auc_roc"))).over(best)))
    return grid.select("reg_param", "elastic_net", sound.alias("sound"))


def train_multilabel(spark, sf_dir):
    return _shown(_fit_six(spark, sf_dir).metrics)


def fit_certificates(spark, sf_dir):
    """Proof of the fits: is each as good as the optimum of its own loss, within the stated tolerance?"""
    comments = training_comments(spark, sf_dir)
    six = _fit_six(spark, sf_dir).model
    found = [("six", x, c) for x, c in certify_training(comments, six.features, six.heads, True, DEFAULTS.reg_param,
                                                        DEFAULTS.elastic_net, weights_of_all=True).items()]
    for name, trained, settings in (
            ("plain", training.train_plain(comments), {"weighted": False}), ("weighted", training.train_weighted(comments), {}),
            ("final", training.train_final(comments), {"reg_param": DEFAULTS.reg_param, "elastic_net": DEFAULTS.elastic_net, "on_all": True})):
        stages = trained.model.stages
        found += [(name, x, c) for x, c in certify_training(comments, PipelineModel(stages[:-1]), {"toxic": stages[-1]}, **settings).items()]
    return spark.createDataFrame([(fit, x, c.rows, c.residual <= TOLERANCE and c.loss < c.null_loss) for fit, x, c in found],
                                 "fit string, label string, n_rows bigint, certified boolean")


def model_metrics_table(spark, sf_dir):
    """The model card, written as JSON and read back."""
    card = training.model_card(_fit_six(spark, sf_dir).metrics)
    path = fresh_path(spark, "model-card")
    card.coalesce(1).write.json(path)
    stored = spark.read.schema(card.schema).json(path)
    measured = F.lit(True)
    for c in ("auc_roc", "auc_pr", "recall", "precision", "f1"):
        measured = measured & F.coalesce(F.col(c).between(0, 1), F.lit(True))  # undefined without positives
    return stored.select("label", "n_positive", "class_weight", "status", measured.alias("measured"))


def model_leaderboard(spark, sf_dir):
    """Three runs with the metrics of arithmetic scores, placed per label and metric."""
    scored = predictions(spark, sf_dir)
    runs = {}
    for name, turn in (("as_is", 0), ("squared", 1), ("reversed", 2)):
        changed = [F.col(f"prob_{x}") * F.col(f"prob_{x}") if turn == 1 else 1 - F.col(f"prob_{x}") if turn == 2 else F.col(f"prob_{x}")
                   for x in LABELS]
        table_ = scored.select("id", *LABELS, *[c.alias(f"prob_{x}") for c, x in zip(changed, LABELS, strict=True)])
        table_ = table_.withColumns({f"pred_{x}": (F.col(f"prob_{x}") >= 0.5).cast("double") for x in LABELS})
        runs[name] = precision_recall_f1(table_, LABELS)
    placed = training.leaderboard(runs, ("recall", "precision"))
    return placed.select("label", "metric", "place", "model", F.round("value", 9).alias("value"))


def _readable(scored):
    return with_probabilities(scored).select(
        "id", *[f"pred_{x}" for x in LABELS],
        *[F.round(f"prob1_{x}", 6).alias(f"prob_{x}") for x in LABELS])


def score_multilabel(spark, sf_dir):
    """All documents scored by six heads in one pass, next to each head's own pipeline."""
    model = _fit_six(spark, sf_dir).model
    documents = _all_documents(spark, sf_dir)
    both = _readable(model.score(documents)).select("id", *[F.col(f"prob_{x}").alias(x) for x in LABELS])
    for x in LABELS:
        alone = model.pipeline(x).transform(documents).select(
            "id", F.round(F.get(vector_to_array(F.col(f"prob_{x}")), 1), 6).alias("own"))
        both = both.join(alone, "id").withColumn(x, F.col(x) == F.col("own")).drop("own")
    return both


def model_roundtrip_scores(spark, sf_dir):
    """Do the scores of the model in memory and after save and load agree?"""
    model = _fit_six(spark, sf_dir).model
    documents = _all_documents(spark, sf_dir)
    fresh = _readable(model.score(documents)).select("id", F.col("prob_toxic").alias("fitted"))
    again = _readable(_saved(spark, model).score(documents)).select("id", F.col("prob_toxic").alias("loaded"))
    return fresh.join(again, "id").select("id", (F.col("fitted") == F.col("loaded")).alias("equal"))


def linear_score_relational(spark, sf_dir):
    """The toxic head as a coefficient table joined to the vector entries, next to the head itself."""
    model = _fit_six(spark, sf_dir).model
    head = model.heads["toxic"]
    weights = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(head.coefficients.toArray()) if w],
        "idx int, weight double")
    documents = _all_documents(spark, sf_dir)
    scores = scoring.linear_scores_hashed(model.features.transform(documents), "features", weights, head.intercept)
    alone = _readable(model.score(documents)).select("id", "prob_toxic")
    return scores.join(alone, "id").select(
        "id", (F.abs(F.col("probability") - F.col("prob_toxic")) < 1e-5).alias("equal"))


QUERIES = {
    "train_lr": train_lr,
    "train_lr_baseline": train_lr_baseline,
    "train_lr_weighted": train_lr_weighted,
    "train_gbt": train_gbt,
    "train_final": train_final,
    "cv_grid": cv_grid,
    "train_multilabel": train_multilabel,
    "fit_certificates": fit_certificates,
    "model_metrics_table": model_metrics_table,
    "model_leaderboard": model_leaderboard,
    "score_multilabel": score_multilabel,
    "model_roundtrip_scores": model_roundtrip_scores,
    "linear_score_relational": linear_score_relational,
}

# Labelled comments, and the part that is held out.
_T = "WITH " + sql.COMMENTS + ", T AS (SELECT C.* FROM C SEMI JOIN labels l ON C.id = l.doc_id), " \
    "E AS (SELECT * FROM T WHERE " + sql.bucket("id", 100) + " >= 80)\n"
_ONE = _T + "SELECT 'toxic' AS label, count(*) AS n_rows, CAST(sum(toxic) AS BIGINT) AS n_positive, true AS sound FROM "
_EACH = "count(*) AS n_rows, CAST(sum({L}) AS BIGINT) AS n_positive, true AS sound"

ORACLES: dict[str, str] = {
    **{name: _ONE + "E" for name in ("train_lr", "train_lr_baseline", "train_lr_weighted", "train_gbt")},
    "train_final": _ONE + "T",
    "train_multilabel": _T + sql.per_label(_EACH, "E"),
    "fit_certificates": _T + "SELECT fit, label, CASE WHEN fit = 'final' THEN (SELECT count(*) FROM T) "
    "ELSE (SELECT count(*) FROM T) - (SELECT count(*) FROM E) END AS n_rows, true AS certified FROM ("
    + " UNION ALL ".join(f"SELECT '{f}' AS fit, '{x}' AS label" for f, x in
                         [*[("six", x) for x in LABELS], ("plain", "toxic"), ("weighted", "toxic"), ("final", "toxic")]) + ")",
    "cv_grid": "SELECT r::DOUBLE AS reg_param, e::DOUBLE AS elastic_net, true AS sound FROM "
    + f"(SELECT unnest({list(training.REG_GRID)}) AS r), (SELECT unnest({list(training.NET_GRID)}) AS e)",
    "model_metrics_table": _T + sql.per_label("""CAST(sum({L}) AS BIGINT) AS n_positive,
  round(count(*) FILTER ({L} = 0)::DOUBLE / count(*) FILTER ({L} = 1), 2) AS class_weight,
  'trained' AS status, true AS measured""", "T"),
    "model_leaderboard": "WITH " + sql.PREDICTIONS + """, R AS (
SELECT 'as_is' AS model, * FROM P UNION ALL
SELECT 'squared', * REPLACE (""" + sql.each_label("prob_{L} * prob_{L} AS prob_{L}") + """) FROM P UNION ALL
SELECT 'reversed', * REPLACE (""" + sql.each_label("1 - prob_{L} AS prob_{L}") + """) FROM P),
M AS (""" + "\nUNION ALL ".join(
        f"SELECT '{x}' AS label, model, count(*) FILTER (prob_{x} >= 0.5 AND {x} = 1)::DOUBLE AS tp, "
        f"count(*) FILTER (prob_{x} >= 0.5) AS p, count(*) FILTER ({x} = 1) AS a FROM R GROUP BY model" for x in LABELS) + """),
V AS (SELECT label, model, 'recall' AS metric, tp / a AS value FROM M
UNION ALL SELECT label, model, 'precision', tp / p FROM M)
SELECT label, metric, CAST(row_number() OVER (PARTITION BY label, metric ORDER BY value DESC, model) AS INTEGER) AS place,
  model, round(value, 9) AS value FROM V""",
    "score_multilabel": "SELECT doc_id AS id, " + ", ".join(f"true AS {x}" for x in LABELS) + " FROM documents",
    "model_roundtrip_scores": "SELECT doc_id AS id, true AS equal FROM documents",
    "linear_score_relational": "SELECT doc_id AS id, true AS equal FROM documents",
}
