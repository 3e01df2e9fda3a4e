"""Reports on a small patterned table with known results."""

import decimal

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.config import LABELS, ModerationConfig
from tideguard.functions.labels import category_phrase, first_max
from tideguard.functions.scoring import apply_thresholds
from tideguard.operators import reports
from tideguard.operators.evaluation import precision_recall_f1
from tideguard.operators.ordering import ntile_totals
from tideguard.sources.readers import fill_prediction_defaults

DAY = "2024-05-01"


def patterned(spark, n, low=0.05):
    """Row i belongs to user i % 10 and is toxic iff i % 5 == 0."""
    schema = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("user_id", T.IntegerType()),
         T.StructField("comment_text", T.StringType())]
        + [f for x in LABELS for f in (T.StructField(f"pred_{x}", T.DoubleType()),
                                       T.StructField(f"prob_{x}", VectorUDT()))])
    data = []
    for i in range(n):
        hot = i % 5 == 0 and low == 0.05
        row = [i, i % 10, f"comment {i}"]
        for x in LABELS:
            p = 0.85 if hot and x == "toxic" else low
            row += [float(p >= 0.5), Vectors.dense([1 - p, p])]
        data.append(tuple(row))
    return spark.createDataFrame(data, schema)


def flags(spark, n, **kw):
    return apply_thresholds(patterned(spark, n, **kw))


def test_thresholds(spark):
    f = flags(spark, 50)
    assert f.filter("flag_toxic").count() == 10
    assert f.filter("any_flagged").count() == 10
    assert f.filter("flag_threat").count() == 0


def test_summary(spark):
    row = reports.moderation_summary(flags(spark, 100), DAY).first()
    assert (row.run_date, row.total_scanned, row.total_flagged, row.flagged_pct) == (
        DAY, 100, 20, 20.0)
    assert (row.toxic_count, row.threat_count, row.severe_toxic_count) == (20, 0, 0)


def test_breakdown(spark):
    by = {r.label: r for r in reports.category_breakdown(flags(spark, 100)).collect()}
    assert list(by) == list(LABELS)
    assert (by["toxic"]["count"], by["toxic"].pct_of_total, by["toxic"].pct_of_flagged) == (
        20, 20.0, 100.0)
    assert (by["threat"]["count"], by["threat"].pct_of_total) == (0, 0.0)
    assert by["toxic"].avg_probability == 0.21


def test_flagged_comments(spark):
    found = reports.flagged_comments(flags(spark, 25), DAY).collect()
    assert len(found) == 5
    assert all(r.max_label == "toxic" and r.flagged_labels == "toxic"
               and r.max_probability >= 0.5 for r in found)


def test_high_risk_users(spark):
    strict = ModerationConfig(high_risk_min_comments=5, high_risk_ratio=0.5)
    found = reports.high_risk_users(flags(spark, 100), DAY, strict).collect()
    assert [r.user_id for r in found] == [0, 5]
    assert all((r.toxicity_ratio, r.toxic_count, r.threat_count, r.top_label) == (
        1.0, 10, 0, "toxic") for r in found)
    assert reports.high_risk_users(flags(spark, 100), DAY).count() == 0


def test_ratio_bound_is_strict(spark):
    exact = ModerationConfig(high_risk_min_comments=10, high_risk_ratio=1.0)
    assert reports.high_risk_users(flags(spark, 100), DAY, exact).count() == 0


def test_volume_buckets(spark):
    found = reports.volume_buckets(flags(spark, 100), ModerationConfig(volume_buckets=10)).collect()
    assert [r.bucket_index for r in found] == list(range(10))
    assert sum(r.comment_count for r in found) == 100
    assert sum(r.flagged_count for r in found) == 20


def test_all_clean(spark):
    f = flags(spark, 10, low=0.01)
    row = reports.moderation_summary(f, DAY).first()
    assert (row.total_flagged, row.flagged_pct) == (0, 0.0)
    assert all(row[f"{x}_count"] == 0 for x in LABELS)
    assert reports.category_breakdown(f).filter("pct_of_flagged <> 0").count() == 0


def test_no_rows(spark):
    f = flags(spark, 0)
    assert reports.moderation_summary(f, DAY).first().flagged_pct == 0.0
    assert {r.pct_of_total for r in reports.category_breakdown(f).collect()} == {0.0}
    assert {r.n for r in reports.flag_distribution(f).collect()} == {0}
    assert reports.volume_buckets(f).count() == 0


def scalars(spark, rows):
    columns = ["id"] + [f"prob_{x}" for x in LABELS]
    return spark.createDataFrame(
        rows, "id int, " + ", ".join(f"{c} double" for c in columns[1:]))


def test_null_probability_leaves_flagged_but_counts(spark):
    df = scalars(spark, [(1, None, .9, .9, .9, .9, .9), (2, .9, .1, .1, .1, .1, .1)])
    f = apply_thresholds(fill_prediction_defaults(df))
    null_row = f.filter("id = 1").first()
    assert null_row.flag_toxic is None and null_row.any_flagged is None
    assert reports.flagged_comments(f, DAY).count() == 1
    assert reports.moderation_summary(f, DAY).first().total_scanned == 2


def test_probability_forms(spark):
    base = scalars(spark, [(1, .3, .3, .3, .3, .3, .3)])
    forms = base.withColumns({
        "prob_toxic": F.array(F.lit(.7), F.lit(.3)), "prob_threat": F.array(F.lit(.7)),
        "pred_insult": F.lit(1.0)}).drop("prob_insult")
    row = apply_thresholds(forms).first()
    assert (row.prob1_toxic, row.prob1_threat, row.prob1_insult) == (.3, None, 1.0)


def test_threshold_meets_unrounded_probability(spark):
    row = apply_thresholds(scalars(spark, [(1, .49996, .8, .5, .7, .5, .64999)])).first()
    assert (row.flag_toxic, row.flag_severe_toxic, row.flag_identity_hate) == (False, True, False)


def test_argmax_ties_go_to_the_earlier_label(spark):
    df = scalars(spark, [(1, .2, .6, .6, .1, .6, .3)])
    forward, _ = first_max([F.col(f"prob_{x}") for x in LABELS], LABELS)
    backward, _ = first_max([F.col(f"prob_{x}") for x in LABELS[::-1]], LABELS[::-1])
    assert tuple(df.select(forward, backward).first()) == ("severe_toxic", "insult")


@pytest.mark.parametrize("names, phrase", [
    ([], "harmful content"), (["threat"], "threatening language"),
    (["toxic", "insult"], "toxic content and insults"),
    (["toxic", "obscene", "insult"], "toxic content, obscene language and insults"),
    (["unknown"], "unknown")])
def test_phrase(spark, names, phrase):
    df = spark.createDataFrame([(names,)], "c array<string>")
    assert df.select(category_phrase(F.col("c"))).first()[0] == phrase


def test_metrics_with_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0)], "toxic int, pred_toxic double")
    row = precision_recall_f1(df, ["toxic"]).first()
    assert (row.precision, row.recall, row.f1, row.tn) == (0.0, 0.0, 0.0, 2)


def ntile_by_hand(rows_in, buckets):
    want, start, n = {}, 0, len(rows_in)
    ordered = sorted(rows_in, key=lambda r: ((r[0] is not None) + (r[0] is not None and r[0] != r[0]), r[0] if r[0] == r[0] and r[0] is not None else 0, r[1]))
    for b in range(buckets):
        size = n // buckets + (b < n % buckets)
        if size:
            part = ordered[start:start + size]
            want[b] = (size, sum(f for _, f in part))
        start += size
    return want


def ntile_found(spark, rows_in, kind, buckets, cells):
    df = spark.createDataFrame(rows_in, f"k {kind}, f boolean").repartition(5)
    return {r.bucket_index: (r.comment_count, r.flagged_count) for r in ntile_totals(df, "k", "f", buckets, cells).collect()}


@pytest.mark.parametrize("n, buckets, cells, spread", [
    (1003, 20, 50, 10**6), (7, 20, 5, 100), (500, 7, 3, 4), (400, 9, 40, 1), (1000, 20, 65_536, 30), (0, 20, 9, 1)])
def test_ntile_equals_brute_force_with_ties(spark, n, buckets, cells, spread):
    """A few order values shared by many rows, down to a single one."""
    rows_in = [((i * 7919) % spread, i % 3 == 0) for i in range(n)]
    assert ntile_found(spark, rows_in, "long", buckets, cells) == ntile_by_hand(rows_in, buckets)


@pytest.mark.parametrize("kind, values", [
    ("double", [None, float("-inf"), float("inf"), float("nan"), -1.7e308, 1.7e308, 5e-324, 0.0, 1e-300, 0.1]),
    ("double", [0.5 + i * 2.0 ** -53 for i in range(40)] + [2.0 ** -i for i in range(60)]),
    ("long", [-(1 << 63), (1 << 63) - 1, 0, 1, (1 << 60) + 1, (1 << 60) + 2, None]),
    ("decimal(38,2)", [decimal.Decimal(10) ** 30 + i for i in range(30)] + [decimal.Decimal("0.01"), None])])
def test_ntile_of_skewed_and_extreme_values(spark, kind, values):
    rows_in = [(values[i % len(values)], i % 4 == 1) for i in range(300)]
    for buckets, cells in ((7, 16), (20, 65_536)):
        assert ntile_found(spark, rows_in, kind, buckets, cells) == ntile_by_hand(rows_in, buckets)


def test_what_the_driver_gets_does_not_grow_with_the_rows(spark):
    """Two histograms of 200,000 rows and of 2,000 bring the same few rows to the driver."""
    got = []
    for n in (2_000, 200_000):
        df = spark.range(n).select(F.pow("id", F.lit(3)).alias("k"), (F.col("id") % 7 == 0).alias("f"))
        seen, collect = [], type(df).collect

        def counting(self, keep=collect, into=seen):
            out = keep(self)
            into.append(len(out))
            return out

        type(df).collect = counting
        try:
            result = ntile_totals(df, "k", "f", 20, 256)
        finally:
            type(df).collect = collect
        got.append(max(seen))
        assert [r.comment_count for r in result.collect()] == [n // 20] * 20
    assert got[0] <= 40 and got[1] <= 40
