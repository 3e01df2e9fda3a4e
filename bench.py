"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR  folder with the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores              (default 8)
    BENCH_COPIES  copies of the documents that the pipeline stages run on (default 50)

Every query runs to the end into the ``noop`` sink, in the registered
configuration; the documents, one row group, are dealt out to all cores
(``spark.tideguard.textTasks``). The three pipeline stages (load and clean,
six-model inference, report) run on a table of many copies with ids of their
own, about 500,000 rows at sf0.1, and give rows per second; each runs twice and
both times are reported.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tideguard.functions.text import clean_text  # noqa: E402
from tideguard.operators import training  # noqa: E402
from tideguard.plans import catalogue, fixtures, moderation  # noqa: E402
from tideguard.session import fresh_path  # noqa: E402

HEADLINE = (
    "threshold_flags", "category_breakdown", "moderation_summary", "flagged_comments",
    "high_risk_users", "top_users", "user_stats_actual", "volume_buckets", "user_label_matrix",
    "join_label_predictions", "score_response", "precision_recall_f1", "auc_roc_exact",
    "clean_text", "tokenize_regex", "remove_stopwords", "stopword_anti_join",
    "lexicon_override", "validate_comments", "harmonize_union", "majority_vote",
    "partition_pruned_scan", "idf_table", "tfidf_exact", "hashing_tf", "linear_score_tokens",
    "dense_head_scores", "batch_strikes", "strike_status", "stream_strikes",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tideguard-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tideguard-bench-"))
             .config("spark.tideguard.textTasks", cpus)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    # Start the JVM, the Python workers and code generation on something small.
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(small):
        for name in ("category_breakdown", "remove_stopwords", "batch_strikes"):
            drain(catalogue.QUERIES[name](spark, small))

    seconds: dict[str, float] = {}
    comments = fixtures.training_comments(spark, sf_dir)
    fitted = {}

    def fit():
        fitted["result"] = training.train_multilabel(comments)
        drain(fitted["result"].metrics)

    seconds["train_multilabel"] = timed(fit)
    model = fitted["result"].model

    for name in HEADLINE:
        seconds[name] = timed(lambda n=name: drain(catalogue.QUERIES[n](spark, sf_dir)))

    # The stages come last, on a JVM that has compiled its hot code.
    copies = int(os.environ.get("BENCH_COPIES", "50"))
    many = fresh_path(spark, "bench-comments")
    (fixtures.six_label_comments(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
     .withColumn("id", F.col("id") * copies + F.col("copy")).drop("copy").write.parquet(many))
    documents = spark.read.parquet(many)
    stages: dict[str, list[float]] = {"stage_load_clean": [], "stage_inference": [], "stage_report": []}
    for _ in range(2):
        scored_path, report_path = fresh_path(spark, "bench-predictions"), fresh_path(spark, "bench-reports")
        stages["stage_load_clean"].append(timed(lambda: drain(documents.select("id", clean_text(F.col("comment_text"))))))
        stages["stage_inference"].append(timed(lambda p=scored_path: moderation.predict(documents, model, p)))
        stages["stage_report"].append(timed(
            lambda p=scored_path, r=report_path: moderation.report(spark, p, r, "2024-01-31")))
    seconds |= {name: times[-1] for name, times in stages.items()}

    rows = documents.count()
    labelled = comments.count() * 6
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "rows": rows, "stage_runs": stages,
        "pipeline_rows_per_s": round(rows / sum(t[-1] for t in stages.values()), 1),
        "training_label_rows_per_s": round(labelled / seconds["train_multilabel"], 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
