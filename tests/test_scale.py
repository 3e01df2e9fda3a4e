"""Plans and results that must hold at any size: skew, pruning, partitioning."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from tideguard.config import LABELS
from tideguard.operators import features, sampling
from tideguard.operators.evaluation import auc_exact
from tideguard.operators.features import frequency_of_counts
from tideguard.operators.harmonize import majority_vote
from tideguard.operators.joins import lookup_even
from tideguard.plans import catalogue, fixtures
from tideguard.session import fresh_path
from tideguard.sources import readers, writers


def explained(df):
    text = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "Cross" not in text
    return text


@pytest.mark.parametrize("name", [
    "category_breakdown", "high_risk_users", "volume_buckets", "auc_roc_exact", "tfidf_exact",
    "class_weights", "lexicon_override", "linear_score_tokens", "majority_vote",
    "join_label_predictions", "harmonize_union"])
def test_no_cross_join(spark, sf, name):
    text = explained(catalogue.QUERIES[name](spark, sf))
    assert "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(catalogue.QUERIES["parquet_scan"](spark, sf))
    assert "PushedFilters: [IsNotNull(text)]" in plan
    assert "lang" not in plan.split("ReadSchema")[1]


def test_partition_filter(spark, sf):
    path = fresh_path(spark, "pruned")
    writers.write_partitioned(fixtures.six_label_comments(spark, sf), path, "toxic")
    plan = plan_of(spark.read.parquet(path).filter("toxic = 1"))
    assert "PartitionFilters: [isnotnull(toxic" in plan


def test_reports_read_text_only_where_they_show_it(spark, sf):
    path = fresh_path(spark, "predictions")
    fixtures.predictions(spark, sf).write.parquet(path)
    from tideguard.functions.scoring import apply_thresholds
    from tideguard.operators import reports
    flags = apply_thresholds(spark.read.parquet(path))
    for report in (reports.category_breakdown(flags), reports.high_risk_users(flags, "d"),
                   reports.moderation_summary(flags, "d")):
        assert "comment_text" not in plan_of(report)


def test_costly_arrays_are_computed_once(spark, sf):
    plan = plan_of(catalogue.QUERIES["idf_table"](spark, sf))
    assert "(size(" not in plan


@pytest.mark.parametrize("name", ["train_test_split", "synthetic_user_bucket", "stable_row_id",
                                  "hash_sample", "volume_buckets", "auc_pr_exact"])
def test_results_do_not_depend_on_partitions(spark, sf, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(rows(catalogue.QUERIES[name](spark, sf)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_samples_nest(spark, sf):
    docs = fixtures.predictions(spark, sf)
    small = {r.id for r in sampling.hash_sample(docs, 0.25).collect()}
    large = {r.id for r in sampling.hash_sample(docs, 0.5).collect()}
    assert small < large
    assert abs(len(small) / 1000 - 0.25) < 0.02


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [0, 5, 100, 10**6])
def test_lookup_with_hot_keys(spark, how, hot_rows):
    """A third of the rows share one key; some keys are NULL, some unknown."""
    facts = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}") for i in range(300)],
        "id int, k string")
    counts = (facts.filter("k IS NOT NULL AND k <> 'k5'").groupBy("k")
              .agg(F.count("*").alias("n")).withColumn("v", F.length("k") * 10))
    got = lookup_even(facts, counts, "k", "n", "id", how=how, hot_rows=hot_rows)
    assert rows(got) == rows(facts.join(counts, "k", how).select("id", "k", "n", "v"))


def test_hot_terms_change_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").alias("id"),
        F.filter(F.split(F.lower("text"), r"\W+"), lambda t: t != "").alias("tokens"))
    plain = features.tfidf(docs)
    split = features.tfidf(docs, hot_rows=20)
    assert rows(plain) == rows(split)


def test_majority_tie_goes_to_the_earliest(spark):
    votes = spark.createDataFrame(
        [(1, "normal", 3), (1, "offensive", 1), (1, "hatespeech", 2),
         (2, "normal", 1), (2, "hatespeech", 2), (2, "hatespeech", 3)], "post int, v string, at int")
    got = {r.post: (r.majority, r.votes, r.toxic, r.insult)
           for r in majority_vote(votes, "post", "v", ["at"]).collect()}
    assert got == {1: ("offensive", 1, 1, 1), 2: ("hatespeech", 2, 1, 0)}


def test_class_without_positives(spark):
    df = spark.createDataFrame([(1, 1, *[0] * 5), (2, 0, *[0] * 5)],
                               "id int, " + ", ".join(f"{x} int" for x in LABELS))
    by = {r.label: r for r in sampling.class_weight_summary(df).collect()}
    assert (by["toxic"].weight, by["toxic"].status) == (1.0, "ok")
    assert (by["threat"].weight, by["threat"].status) == (None, "no_positives")


def test_auc_with_one_score_for_a_third_of_the_rows(spark):
    data = [(i % 5 == 0, 0.5 if i % 3 == 0 else (i * 37 % 101) / 101) for i in range(900)]
    df = spark.createDataFrame([(int(y), s) for y, s in data], "toxic int, prob_toxic double")
    pos = [s for y, s in data if y]
    neg = [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    for parts in (1, 3, 40):
        spread = df.repartition(parts)
        got = auc_exact(spread, ["toxic"]).first().auc_roc
        assert abs(got - want) < 1e-12


@pytest.mark.parametrize("scores", [lambda i: 0.5 + i % 700 * 2.0 ** -52, lambda i: 2.0 ** -(i % 900), lambda i: 0.25])
def test_auc_of_skewed_scores(spark, scores):
    """Scores that share their first digits, that fall by powers, or that are one."""
    data = [(int(i * 7919 % 11 < 4), scores(i)) for i in range(1500)]
    df = spark.createDataFrame(data, "toxic int, prob_toxic double").repartition(7)
    pos, neg = np.array([s for y, s in data if y]), np.array([s for y, s in data if not y])
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / len(pos) / len(neg)
    result = auc_exact(df, ["toxic"])
    assert abs(result.first().auc_roc - want) < 1e-12
    assert "BroadcastNestedLoop" not in plan_of(result) and "SinglePartition" not in plan_of(result)


def test_text_tables_are_spread_only_on_demand(spark, sf):
    path = f"{sf}/documents.parquet"
    assert "Exchange" not in plan_of(readers.read_parallel(spark, path, "doc_id"))
    assert readers.read_parallel(spark, path, "doc_id", tasks=5).rdd.getNumPartitions() == 5


@pytest.mark.parametrize("name", ["tfidf_exact", "linear_score_tokens"])
def test_plans_do_not_depend_on_the_number_of_files(spark, sf, tmp_path, name):
    exchanges = []
    for files in (1, 40):
        folder = tmp_path / str(files)
        for table in ("documents", "labels"):
            df = spark.read.parquet(f"{sf}/{table}.parquet")
            df.repartition(files).write.parquet(str(folder / f"{table}.parquet"))
        text = plan_of(catalogue.QUERIES[name](spark, str(folder)))
        exchanges.append([text.count("Exchange hashpartitioning"), text.count("BroadcastExchange"), text.count("SortMergeJoin")])
    assert exchanges[0] == exchanges[1]


@pytest.fixture
def plain_plans(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def test_word_counts_are_shuffled_once(spark, tmp_path, plain_plans):
    """Scores and frequencies read the same shuffle; the NULL term of a row without words is no word."""
    docs = [(1, "alpha beta alpha"), (2, "beta gamma"), (3, ""), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    scores = catalogue.QUERIES["linear_score_tokens"](spark, str(tmp_path))
    assert len(re.findall(r"[+:]- Exchange hashpartitioning\(id#\d+L?, term#", plan_of(scores))) == 1
    assert sorted(r.id for r in scores.collect()) == [1, 2, 3, 4]
    counts = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (2, "", 1), (3, None, 1)], "id long, term string, tf long")
    assert sorted(map(tuple, frequency_of_counts(counts).collect())) == [("", 1), ("a", 2)]


@pytest.mark.parametrize("hot_rows", [10, 10 ** 6])
def test_rows_of_hot_keys_are_spread(spark, plain_plans, hot_rows):
    """By a limit of rows, and by a share of all rows."""
    facts = spark.range(400).selectExpr("id", "IF(id < 390, 'often', IF(id < 395, 'rare', IF(id < 398, NULL, 'unknown'))) AS term")
    lookup = spark.createDataFrame([("often", 390, 1.5), ("rare", 5, 2.5)], "term string, df long, w double")
    found = lookup_even(facts, lookup, "term", "df", "id", how="left", hot_rows=hot_rows)
    at = found.withColumn("at", F.spark_partition_id()).collect()
    assert len({r["at"] for r in at if r.term == "often"}) > 4
    assert sorted((r.id, r.term, r.df, r.w) for r in at) == [
        (i, *(("often", 390, 1.5) if i < 390 else ("rare", 5, 2.5) if i < 395 else (None if i < 398 else "unknown", None, None)))
        for i in range(400)]
