"""Training and evaluating comment classifiers with MLlib.

The hashed word counts of all rows are made once and written to the shared
folder; every fit, fold and label reads those. Document frequencies are fitted
on the training part only, and applying them is a cheap multiplication.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, LogisticRegressionModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    IDF, HashingTF, SQLTransformer, StopWordsRemover, Tokenizer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideguard.config import DEFAULTS, LABELS, ModerationConfig
from tideguard.functions.hashing import bucket, whole_number
from tideguard.functions.text import LINK, NOT_LETTERS, STOP_WORDS
from tideguard.operators.evaluation import auc_exact, precision_recall_f1
from tideguard.operators.sampling import class_balance, in_train
from tideguard.operators.scoring import score_multilabel
from tideguard.session import Stored, materialise, store

FOLDS = 3
REG_GRID = (0.01, 0.1, 0.5)
NET_GRID = (0.0, 0.5)
#: What a task of a tree fit holds at most (it reads up to three times as much). Fewer rows a task would make more tasks
#: send their sums to the one that decides a split.
TREE_TASK_BYTES = 1 << 27


# --- features ---------------------------------------------------------------

def text_stages(config: ModerationConfig = DEFAULTS, by_whitespace: bool = False) -> list:
    """Raw ``comment_text`` to hashed counts. Cleaning is a stage too, so a saved
    model treats text at scoring time as it did at training time.

    Words are cut and stop words dropped by SQL expressions, which is what
    ``RegexTokenizer`` on ``\\W`` and ``StopWordsRemover`` come to on cleaned text,
    without handing every word array to two more functions.
    """
    clean = SQLTransformer(statement=(
        f"SELECT *, trim(regexp_replace(regexp_replace(lower(comment_text), r'{LINK}', ''), "
        f"r'{NOT_LETTERS}', ' ')) AS clean_text FROM __THIS__"))
    if by_whitespace:
        words = [Tokenizer(inputCol="clean_text", outputCol="words"),
                 StopWordsRemover(inputCol="words", outputCol="filtered_words")]
    else:
        # Cleaned words hold no apostrophe, so stop words with one cannot occur.
        stop = ", ".join(f"'{w}'" for w in STOP_WORDS if "'" not in w)
        words = [SQLTransformer(statement=(
            "SELECT *, filter(split(clean_text, ' '), "
            f"w -> w != '' AND w NOT IN ({stop})) AS filtered_words FROM __THIS__"))]
    return [clean, *words, HashingTF(inputCol="filtered_words", outputCol="raw_features",
                                     numFeatures=config.num_features)]


def packed(rows: DataFrame, config: ModerationConfig) -> DataFrame:
    """``fit_tasks`` partitions if the caller asks for them: a fit runs dozens of
    jobs over its table, which a small table is best given few tasks for."""
    return rows.coalesce(config.fit_tasks) if config.fit_tasks else rows


def dealt_for_trees(rows: DataFrame, config: ModerationConfig) -> DataFrame:
    """``rows`` over as many tasks as trees need, which hold a whole number for every
    row and column, filled or not, and read them in each round: a task gets
    ``TREE_TASK_BYTES`` of them, however the rows were stored."""
    if config.fit_tasks:
        return packed(rows, config)
    tasks = -(-rows.count() * 4 * config.num_features // TREE_TASK_BYTES)
    # Always dealt anew when a task is not enough for all: stored parts may be uneven.
    return rows.repartition(max(tasks, rows.rdd.getNumPartitions())) if tasks > 1 else rows


def idf_stage(min_doc_freq: int) -> IDF:
    return IDF(inputCol="raw_features", outputCol="features", minDocFreq=min_doc_freq)


@dataclass
class Counted:
    """Hashed counts of a labelled table, and the stages that made them.

    The stored counts are as large as the corpus; leaving the ``with`` block
    removes them. What a fit returns no longer needs them.
    """

    stored: Stored               # id, labels, raw_features, is_train, fold
    stages: PipelineModel

    def __enter__(self) -> Counted:
        return self

    def __exit__(self, *_) -> None:
        self.stored.discard()

    @property
    def rows(self) -> DataFrame:
        return self.stored.df

    @property
    def train(self) -> DataFrame:
        return self.rows.filter("is_train")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter("NOT is_train")


def count_words(df: DataFrame, labels: Sequence[str] = LABELS,
                config: ModerationConfig = DEFAULTS, key: str = "id",
                by_whitespace: bool = False, folds: int = FOLDS) -> Counted:
    """One pass over the text; the 80/20 split and the folds hang on the key."""
    text = df.filter(F.col("comment_text").isNotNull()).select(key, "comment_text", *labels)
    number = whole_number(F.col(key), df.schema[key].dataType)
    stages = Pipeline(stages=text_stages(config, by_whitespace)).fit(text)
    counted = stages.transform(text).select(
        F.col(key).alias("id"), *labels, "raw_features", in_train(number).alias("is_train"),
        # Buckets below the split go to train; folds are cut across them.
        (bucket(number, 1_000_003) % folds).cast("int").alias("fold"))
    return Counted(store(counted, "word-counts"), stages)


# --- fits -------------------------------------------------------------------

def _named(stage, label: str):
    return (stage.setFeaturesCol("features").setLabelCol(label)
            .setPredictionCol(f"pred_{label}").setProbabilityCol(f"prob_{label}")
            .setRawPredictionCol(f"raw_{label}"))


def logistic(label: str, max_iter: int, reg_param: float = 0.0, elastic_net: float = 0.0,
             weight: str | None = None) -> LogisticRegression:
    head = _named(LogisticRegression(maxIter=max_iter, regParam=reg_param,
                                     elasticNetParam=elastic_net), label)
    return head.setWeightCol(weight) if weight else head


def boosted_trees(label: str, rounds: int = 20, depth: int = 5, step: float = 0.1):
    return _named(GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step), label)


def _weight(label: str, ratio: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(1.0)


def balance_of(df: DataFrame, labels: Sequence[str]) -> dict:
    """Counts and class weights of all labels: one row on the driver."""
    return class_balance(df, labels).first().asDict()


@dataclass
class Trained:
    """A fitted label model with what was measured on the rows it has not seen."""

    model: PipelineModel
    metrics: DataFrame
    predictions: DataFrame


def lean(predictions: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Only labels, predictions and probabilities: what the metrics read."""
    scored = predictions.select("id", *[c for x in labels for c in (
        F.col(x), F.col(f"pred_{x}"),
        F.get(vector_to_array(F.col(f"prob_{x}")), 1).alias(f"prob_{x}"))])
    return materialise(scored, "test-scores")


def metrics_of(predictions: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(label, auc_roc, auc_pr, precision, recall, f1, counts), one row per label."""
    return auc_exact(predictions, labels).join(precision_recall_f1(predictions, labels), "label")


def _train(counted: Counted, label: str, head, min_doc_freq: int, config: ModerationConfig,
           idf_rows: DataFrame | None = None, fit_rows: DataFrame | None = None) -> Trained:
    idf = idf_stage(min_doc_freq).fit(idf_rows if idf_rows is not None else counted.train)
    rows = fit_rows if fit_rows is not None else counted.train
    rows = dealt_for_trees(rows, config) if isinstance(head, GBTClassifier) else packed(rows, config)
    model = head.fit(idf.transform(rows).drop("raw_features"))
    scored = lean(model.transform(idf.transform(counted.test)), [label])
    return Trained(PipelineModel([*counted.stages.stages, idf, model]),
                   metrics_of(scored, [label]), scored)


def train_plain(df: DataFrame, label: str = "toxic",
                config: ModerationConfig = DEFAULTS) -> Trained:
    with count_words(df, [label], config) as counted:
        return _train(counted, label, logistic(label, config.max_iter), config.min_doc_freq, config)


def train_baseline(df: DataFrame, label: str = "toxic", config: ModerationConfig = DEFAULTS,
                   idf_on_all: bool = False) -> Trained:
    """Whitespace tokens, no frequency floor, ten iterations.

    ``idf_on_all`` lets the document frequencies see the test rows.
    """
    with count_words(df, [label], config, by_whitespace=True) as counted:
        return _train(counted, label, logistic(label, 10), 0, config,
                      idf_rows=counted.rows if idf_on_all else None)


def train_weighted(df: DataFrame, label: str = "toxic",
                   config: ModerationConfig = DEFAULTS) -> Trained:
    with count_words(df, [label], config) as counted:
        ratio = _ratio(balance_of(counted.train, [label]), label)
        weighted = counted.train.withColumn("weight", _weight(label, ratio))
        return _train(counted, label, logistic(label, config.max_iter, weight="weight"),
                      config.min_doc_freq, config, fit_rows=weighted)


def _ratio(balance: Mapping, label: str) -> float:
    if balance[f"weight_{label}"] is None:
        raise ValueError(f"no positive rows for {label}")
    return balance[f"weight_{label}"]


def train_trees(df: DataFrame, label: str = "toxic", config: ModerationConfig = DEFAULTS,
                rounds: int = 20, depth: int = 5, step: float = 0.1) -> Trained:
    with count_words(df, [label], config) as counted:
        return _train(counted, label, boosted_trees(label, rounds, depth, step),
                      config.min_doc_freq, config)


def train_final(df: DataFrame, label: str = "toxic",
                config: ModerationConfig = DEFAULTS) -> Trained:
    """Weighted fit on every row with the chosen parameters; measured on the same rows."""
    with count_words(df, [label], config) as counted:
        ratio = _ratio(balance_of(counted.rows, [label]), label)
        idf = idf_stage(config.min_doc_freq).fit(counted.rows)
        rows = idf.transform(packed(counted.rows.withColumn("weight", _weight(label, ratio)), config))
        model = logistic(label, config.max_iter, config.reg_param, config.elastic_net,
                         "weight").fit(rows.drop("raw_features"))
        scored = lean(model.transform(rows), [label])
    return Trained(PipelineModel([*counted.stages.stages, idf, model]),
                   metrics_of(scored, [label]), scored)


@dataclass
class GridResult:
    grid: DataFrame              # reg_param, elastic_net, auc_roc, is_best
    best: CrossValidatorModel
    metrics: DataFrame


def cv_grid(df: DataFrame, label: str = "toxic", config: ModerationConfig = DEFAULTS,
            reg_grid: Sequence[float] = REG_GRID, net_grid: Sequence[float] = NET_GRID,
            folds: int = FOLDS) -> GridResult:
    """Grid search with folds that hang on the key; the first maximum wins.

    The word counts do not depend on the fold and are made beforehand; document
    frequencies and the weighted regression are fitted per fold.
    """
    with count_words(df, [label], config, folds=folds) as counted:
        return _search(df.sparkSession, counted, label, config, reg_grid, net_grid, folds)


def _search(spark, counted, label, config, reg_grid, net_grid, folds) -> GridResult:
    ratio = _ratio(balance_of(counted.train, [label]), label)
    train = packed(counted.train.withColumn("weight", _weight(label, ratio)), config)
    head = logistic(label, config.max_iter, weight="weight")
    settings = (ParamGridBuilder().addGrid(head.regParam, list(reg_grid))
                .addGrid(head.elasticNetParam, list(net_grid)).build())
    judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=f"raw_{label}",
                                          metricName="areaUnderROC")
    search = CrossValidator(
        estimator=Pipeline(stages=[idf_stage(config.min_doc_freq), head]),
        estimatorParamMaps=settings, evaluator=judge, numFolds=folds, foldCol="fold",
        parallelism=config.fit_parallelism)
    found = search.fit(train)
    scores = found.avgMetrics
    top = scores.index(max(scores))
    grid = spark.createDataFrame(
        [(float(s[head.regParam]), float(s[head.elasticNetParam]), float(score), i == top)
         for i, (s, score) in enumerate(zip(settings, scores))],
        "reg_param double, elastic_net double, auc_roc double, is_best boolean")
    return GridResult(grid, found, metrics_of(lean(found.transform(counted.test), [label]),
                                              [label]))


# --- six labels -------------------------------------------------------------

@dataclass
class MultiLabelModel:
    """Shared feature stages and one linear head per label."""

    features: PipelineModel
    heads: dict[str, LogisticRegressionModel]

    def score(self, df: DataFrame, keep: Sequence[str] = ("id", "comment_text")) -> DataFrame:
        return score_multilabel(df, self.features, self.heads, keep)

    def pipeline(self, label: str) -> PipelineModel:
        """One label from raw text on, as a single saved model would hold it."""
        return PipelineModel([*self.features.stages, self.heads[label]])

    def save(self, path: str) -> None:
        self.features.write().overwrite().save(f"{path}/features")
        for label, head in self.heads.items():
            head.write().overwrite().save(f"{path}/heads/{label}")
        spark = SparkSession.active()
        spark.createDataFrame([(x, i) for i, x in enumerate(self.heads)],
                              "label string, position int").coalesce(1).write.mode(
            "overwrite").json(f"{path}/labels")

    def save_pipelines(self, path: str) -> None:
        """One self-contained pipeline per label, for ``scoring.score_pipelines``."""
        for label in self.heads:
            self.pipeline(label).write().overwrite().save(f"{path}/{label}_model")

    @staticmethod
    def load(path: str) -> MultiLabelModel:
        stored = SparkSession.active().read.schema("label string, position int").json(
            f"{path}/labels").orderBy("position").collect()     # one row per label
        return MultiLabelModel(
            PipelineModel.load(f"{path}/features"),
            {r.label: LogisticRegressionModel.load(f"{path}/heads/{r.label}") for r in stored})


@dataclass
class MultiLabelResult:
    model: MultiLabelModel
    metrics: DataFrame           # one row per label, also for those not trained
    predictions: DataFrame


def train_multilabel(df: DataFrame, config: ModerationConfig = DEFAULTS,
                     labels: Sequence[str] = LABELS) -> MultiLabelResult:
    """A weighted regression per label on shared features.

    Class weights come from the whole table, fits from the training part. A
    label without positive rows is not fitted and says so in ``status``.
    """
    with count_words(df, labels, config) as counted:
        return _fit_labels(df.sparkSession, counted, config, labels)


def _fit_labels(spark, counted, config, labels) -> MultiLabelResult:
    balance = balance_of(counted.rows, labels)
    fitted = [x for x in labels if balance[f"weight_{x}"] is not None]
    idf = idf_stage(config.min_doc_freq).fit(counted.train)
    train = idf.transform(packed(counted.train, config)).drop("raw_features")

    def fit(label):
        start = time.monotonic()
        head = logistic(label, config.max_iter, config.reg_param, config.elastic_net, "weight")
        rows = train.select("features", label,
                            _weight(label, balance[f"weight_{label}"]).alias("weight"))
        return head.fit(rows), time.monotonic() - start

    with ThreadPoolExecutor(config.fit_parallelism) as pool:
        fits = dict(zip(fitted, pool.map(fit, fitted)))
    heads = {x: fits[x][0] for x in fitted}
    model = MultiLabelModel(PipelineModel([*counted.stages.stages, idf]), heads)

    scored = idf.transform(counted.test)
    for head in heads.values():
        scored = head.transform(scored)
    scored = lean(scored, fitted)
    known = spark.createDataFrame(
        [(x, i, balance[f"n_pos_{x}"], balance[f"weight_{x}"],
          "trained" if x in fits else "no_positives", fits[x][1] if x in fits else None)
         for i, x in enumerate(labels)],
        "label string, position int, n_positive bigint, class_weight double, status string, "
        "train_seconds double")
    metrics = known.join(metrics_of(scored, fitted), "label", "left").orderBy("position")
    return MultiLabelResult(model, metrics.drop("position"), scored)


def model_card(metrics: DataFrame) -> DataFrame:
    """The metrics record: four decimals, weight with two."""
    return metrics.select(
        "label", *[F.round(c, 4).alias(c) for c in
                   ("auc_roc", "auc_pr", "recall", "precision", "f1")],
        "n_positive", F.round("class_weight", 2).alias("class_weight"), "status",
        F.round("train_seconds", 2).alias("train_seconds"))


def leaderboard(runs: Mapping[str, DataFrame],
                metrics: Sequence[str] = ("auc_roc", "auc_pr", "recall", "precision", "f1"),
                ) -> DataFrame:
    """Metric tables of several runs as (label, metric, place, model, value).

    A handful of rows per run; places are counted within label and metric.
    """
    parts = [table.select(F.lit(name).alias("model"), "label", *metrics)
             for name, table in runs.items()]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    tall = first.unpivot(["model", "label"], list(metrics), "metric", "value")
    order = Window.partitionBy("label", "metric").orderBy(F.col("value").desc(), "model")
    return tall.withColumn("place", F.row_number().over(order))
