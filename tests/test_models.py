"""Training and scoring against single-purpose MLlib code."""

import math
from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from tideguard.config import DEFAULTS, LABELS, ModerationConfig
from tideguard.functions.scoring import apply_thresholds, sigmoid
from tideguard.functions.text import model_tokens
from tideguard.operators import features, scoring, training
from tideguard.operators.joins import join_predictions
from tideguard.operators.evaluation import auc_exact, confusion_matrix
from tideguard.operators.responses import score_response
from tideguard.plans import fixtures, text_queries
from tideguard.session import fresh_path
from tideguard.streaming.scoring import score_in_stream

QUICK = ModerationConfig(max_iter=5, min_doc_freq=2)


@pytest.fixture(scope="module")
def comments(spark, sf):
    return fixtures.training_comments(spark, sf)


@pytest.fixture(scope="module")
def trained(comments):
    return training.train_multilabel(comments, QUICK)


@pytest.fixture(scope="module")
def scored(trained, comments):
    return trained.model.score(comments, ["id", "comment_text", *LABELS])


def test_model_words_equal_the_column_expression(spark, comments):
    stages = Pipeline(stages=training.text_stages()).fit(comments)
    counted = stages.transform(comments.withColumn("ours", model_tokens(F.col("comment_text"))))
    ml = Pipeline(stages=[
        RegexTokenizer(inputCol="clean_text", outputCol="cut", pattern=r"\W"),
        StopWordsRemover(inputCol="cut", outputCol="theirs")]).fit(counted).transform(counted)
    got = ml.select("filtered_words", "ours", "theirs").collect()
    assert all(a == b == c for a, b, c in got)


def test_each_label_equals_its_own_pipeline(trained, comments, scored):
    for label in ("toxic", "insult"):
        alone = trained.model.pipeline(label).transform(comments).select(
            "id", f"pred_{label}", vector_to_array(f"prob_{label}").alias("p"))
        together = scored.select("id", f"pred_{label}", vector_to_array(f"prob_{label}").alias("p"))
        assert rows(alone) == rows(together)


def test_saved_pipelines_chained_equal_joined(spark, trained, comments, scored):
    path = fresh_path(spark, "pipelines")
    trained.model.save_pipelines(path)
    models = {x: PipelineModel.load(f"{path}/{x}_model") for x in ("toxic", "insult")}
    chained = scoring.score_pipelines(comments, models, ["id"])
    assert chained.columns == ["id", "pred_toxic", "prob_toxic", "pred_insult", "prob_insult"]
    joined = join_predictions(comments.select("id"), [
        m.transform(comments).select("id", f"pred_{x}", f"prob_{x}") for x, m in models.items()])
    assert rows(chained) == rows(joined)
    assert rows(chained.select("id", "pred_toxic")) == rows(scored.select("id", "pred_toxic"))
    # Under MLlib's own output names, as another program would have saved them.
    plain = Pipeline(stages=[*training.text_stages(QUICK), training.idf_stage(2),
                             LogisticRegression(labelCol="toxic", maxIter=2)]).fit(comments)
    twice = scoring.score_pipelines(comments, {"a": plain, "b": plain}, ["id"])
    assert twice.filter("pred_a <> pred_b").count() == 0


def test_scoring_neither_joins_nor_shuffles(spark, trained, tmp_path, comments):
    comments.write.parquet(str(tmp_path / "c"))
    plan = plan_of(trained.model.score(spark.read.parquet(str(tmp_path / "c"))))
    assert "Join" not in plan and "Exchange" not in plan


def test_save_and_load(spark, trained, comments, scored):
    path = fresh_path(spark, "model")
    trained.model.save(path)
    loaded = training.MultiLabelModel.load(path)
    assert list(loaded.heads) == list(trained.model.heads)
    again = loaded.score(comments, ["id"])
    pick = [vector_to_array(f"prob_{x}")[1].alias(x) for x in loaded.heads]
    assert rows(again.select("id", *pick)) == rows(scored.select("id", *pick))


def test_linear_model_as_a_table(spark, trained, comments, scored):
    head = trained.model.heads["toxic"]
    weights = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(head.coefficients.toArray())], "idx int, weight double")
    got = {r.id: r.probability for r in scoring.linear_scores_hashed(
        trained.model.features.transform(comments), "features", weights, head.intercept).collect()}
    want = {r.id: r.p for r in scored.select(
        "id", vector_to_array("prob_toxic")[1].alias("p")).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-12


def test_exact_areas_equal_the_evaluator_without_bins(spark, sf):
    p = fixtures.predictions(spark, sf)
    exact = {r.label: r for r in auc_exact(p).collect()}
    for label in LABELS[:2]:
        df = p.select(F.col(label).cast("double").alias("label"),
                      F.col(f"prob_{label}").alias("rawPrediction"))
        for name, ours in (("areaUnderROC", exact[label].auc_roc),
                           ("areaUnderPR", exact[label].auc_pr)):
            theirs = BinaryClassificationEvaluator(metricName=name, numBins=0).evaluate(df)
            assert math.isclose(ours, theirs, abs_tol=1e-12)


def test_label_without_positives_is_reported_not_fitted(comments):
    none = comments.withColumn("threat", F.lit(0))
    result = training.train_multilabel(none, QUICK, ("toxic", "threat"))
    by = {r.label: r for r in result.metrics.collect()}
    assert (by["threat"].status, by["threat"].class_weight, by["threat"].auc_roc) == (
        "no_positives", None, None)
    assert by["toxic"].status == "trained" and by["toxic"].train_seconds > 0
    assert list(result.model.heads) == ["toxic"]


def test_metrics_agree_with_the_confusion_matrix(trained):
    toxic = trained.metrics.filter("label = 'toxic'").first()
    cells = {(r.label, r.prediction): r.n for r in confusion_matrix(
        trained.predictions, "toxic", "pred_toxic").collect()}
    assert (toxic.tp, toxic.fp) == (cells.get((1, 1.0), 0), cells.get((0, 1.0), 0))
    assert (toxic.fn, toxic.tn) == (cells.get((1, 0.0), 0), cells.get((0, 0.0), 0))


def test_grid_search_takes_the_first_maximum(comments):
    result = training.cv_grid(comments, config=QUICK, reg_grid=(0.01, 0.1), net_grid=(0.0,), folds=2)
    grid = result.grid.collect()
    best = [r for r in grid if r.is_best]
    assert len(grid) == 2 and len(best) == 1
    assert best[0].auc_roc == max(r.auc_roc for r in grid)
    again = training.cv_grid(comments.repartition(3), config=QUICK, reg_grid=(0.01, 0.1),
                             net_grid=(0.0,), folds=2).grid.collect()
    assert all(math.isclose(a.auc_roc, b.auc_roc, abs_tol=1e-6) for a, b in zip(grid, again))


def test_boosted_trees(comments):
    result = training.train_trees(comments, config=QUICK, rounds=2, depth=2)
    assert result.metrics.count() == 1
    assert set(result.predictions.columns) == {"id", "toxic", "pred_toxic", "prob_toxic"}


def test_baseline_can_reproduce_frequencies_over_all_rows(comments):
    apart = training.train_baseline(comments, config=QUICK)
    leaking = training.train_baseline(comments, config=QUICK, idf_on_all=True)
    docs = [t.model.stages[-2].numDocs for t in (apart, leaking)]
    assert docs[0] < docs[1] == comments.count()


def test_leaderboard_order(trained):
    board = training.leaderboard({"a": trained.metrics, "b": trained.metrics}).filter(
        "label = 'toxic' AND metric = 'auc_roc'").orderBy("place").collect()
    assert [(r.place, r.model) for r in board] == [(1, "a"), (2, "b")]


def test_idf_equals_ml(spark, sf):
    docs = text_queries._tokenised(spark, sf)
    hashed = HashingTF(inputCol="tokens", outputCol="raw", numFeatures=10000).transform(docs)
    model = IDF(inputCol="raw", outputCol="x", minDocFreq=5).fit(hashed)
    idfs, n = model.idf.toArray(), docs.count()
    ours = {r["df"]: r.idf for r in features.idf_table(docs).collect()}
    theirs = {int(d): w for d, w in zip(model.docFreq, idfs)}
    assert n == model.numDocs
    shared = ours.keys() & theirs.keys()
    assert len(shared) > 5
    assert all(math.isclose(ours[d], theirs[d], abs_tol=1e-12) for d in shared)


def test_sigmoid_is_clipped(spark):
    df = spark.createDataFrame([(0.0,), (1e6,), (-1e6,), (1.5,)], "x double")
    got = [r[0] for r in df.select(sigmoid(F.col("x"))).collect()]
    want = [1 / (1 + math.exp(-max(-500, min(500, x)))) for x in (0.0, 1e6, -1e6, 1.5)]
    assert got == pytest.approx(want, abs=1e-15)


def test_dense_head_with_a_model_of_ones_own(spark, sf):
    def load():
        import numpy as np
        weights = np.ones((64, 6), np.float32)
        return lambda batch: batch @ weights

    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    logits = scoring.batch_model(load, 64)(F.col("embedding"))
    built_in = scoring.dense_head(df, "embedding", {x: ([1.0] * 64, 0.0) for x in LABELS}, ["vec_id"])
    own = df.select("vec_id", sigmoid(logits[0].cast("double"), clip=None).alias("p"))
    for r in own.join(built_in, "vec_id").collect():
        assert math.isclose(r.p, r.prob_toxic, abs_tol=1e-5)


def test_response_record(scored):
    row = score_response(apply_thresholds(scored)).orderBy("id").first().response
    assert row.comment and row.is_toxic == (len(row.flagged_categories) > 0)
    assert set(row.scores) == set(LABELS)
    assert row.scores["severe_toxic"].threshold == 80.0
    assert 0 <= row.scores["toxic"].probability <= 100


def test_fitted_model_on_a_stream(spark, trained, comments, tmp_path):
    source = str(tmp_path / "in")
    comments.select("id", "comment_text").write.parquet(source)
    stream = spark.readStream.schema("id long, comment_text string").parquet(source)
    path = fresh_path(spark, "model")
    trained.model.save(path)
    model = training.MultiLabelModel.load(path)

    class AllHeads:
        def transform(self, df):
            return model.score(df, ["id", "comment_text"])

    query = (score_in_stream(stream, AllHeads()).writeStream.format("parquet")
             .option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "checkpoint"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    kept = comments.filter(F.char_length("comment_text") <= 5000).count()
    assert 0 < spark.read.parquet(str(tmp_path / "out")).count() <= kept + 5


def test_a_task_of_a_tree_fit_holds_a_bounded_part(spark, monkeypatch):
    monkeypatch.setattr(training, "TREE_TASK_BYTES", 1000)
    config = replace(DEFAULTS, num_features=10)
    rows_ = spark.range(200).coalesce(1)     # 40 bytes a row, stored in one part
    held = [len(part) for part in training.dealt_for_trees(rows_, config).rdd.glom().collect()]
    assert sum(held) == 200 and len(held) == 8 and max(held) <= 30
    assert training.dealt_for_trees(rows_.limit(20), config).rdd.getNumPartitions() == 1
    assert training.dealt_for_trees(rows_, replace(config, fit_tasks=1)).rdd.getNumPartitions() == 1
