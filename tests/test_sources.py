"""Readers, writers, publishing, harmonising."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tideguard.config import LABELS
from tideguard.functions.labels import labels_from_grades, majority_of
from tideguard.operators import harmonize
from tideguard.operators.ids import number_copies
from tideguard.plans import fixtures, moderation
from tideguard.session import fresh_path, materialise, shared_dir
from tideguard.sources import readers, writers


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "id,comment_text," + ",".join(LABELS) + '\n'
        '1,"line one\nline ""two"", done",1,0,0,0,1,0\n2,plain,0,0,0,0,0,0\n3,,0,0,0,0,0,0\n')
    df = readers.read_csv(spark, str(tmp_path), readers.COMMENT_SCHEMA)
    assert df.schema == readers.COMMENT_SCHEMA
    got = df.orderBy("id").collect()
    assert got[0].comment_text == 'line one\nline "two", done'
    assert got[2].comment_text is None


def test_posts_over_many_lines_and_per_line(spark, tmp_path):
    whole, lines = tmp_path / "whole", tmp_path / "lines"
    whole.mkdir(), lines.mkdir()
    (whole / "p.json").write_text("""{
      "a": {"post_tokens": ["You", "FOOL"], "annotators": [
         {"label": "offensive"}, {"label": "hatespeech"}, {"label": "normal"}]},
      "b": {"post_tokens": ["..."], "annotators": [{"label": "hatespeech"}]}
    }""")
    (lines / "p.json").write_text(
        '{"a": {"post_tokens": ["You", "FOOL"], "annotators": [{"label": "offensive"}, '
        '{"label": "hatespeech"}, {"label": "normal"}]}}\n'
        '{"b": {"post_tokens": ["..."], "annotators": [{"label": "hatespeech"}]}}\n')
    a = readers.read_posts(spark, str(whole), whole_files=True)
    b = readers.read_posts(spark, str(lines))
    assert rows(a) == rows(b)
    kept = harmonize.from_posts(a, "posts", drop_empty=True).collect()
    assert [(r.comment_text, r.toxic, r.insult, r.identity_hate) for r in kept] == [
        ("you fool", 1, 1, 0)]
    assert harmonize.from_posts(a, "posts").count() == 2


@pytest.mark.parametrize("votes, winner", [
    (["a", "b", "c"], "a"), (["a", "b", "b"], "b"), (["c"], "c"), ([], None)])
def test_majority(spark, votes, winner):
    df = spark.createDataFrame([(votes,)], "v array<string>")
    assert df.select(majority_of(F.col("v"))).first()[0] == winner


def test_class_codes(spark):
    df = spark.createDataFrame([("x y", 0), ("x", 1), ("x", 2), ("x", 9), ("!!", 0), (None, 0)],
                               "tweet string, class int")
    got = harmonize.from_class_code(df, "codes", drop_empty=True).collect()
    assert [tuple(r[x] for x in LABELS) for r in got] == [
        (1, 0, 0, 0, 0, 1), (1, 0, 1, 0, 1, 0), (0,) * 6, (0,) * 6]
    assert harmonize.from_class_code(df, "codes").count() == 5


def test_missing_grade_is_zero(spark):
    df = spark.createDataFrame([(0.5, None, 0.49, 1.0, 0.0, 0.7)],
                               "target double, severe_toxicity double, obscene double, "
                               "threat double, insult double, identity_attack double")
    assert tuple(df.select(*labels_from_grades()).first()) == (1, 0, 0, 1, 0, 1)


def test_union_matches_columns_by_name_and_keeps_copies(spark, sf):
    six = fixtures.six_label_comments(spark, sf).drop("id")
    turned = six.select(*reversed(six.columns))
    both = harmonize.union_sources(six, turned)
    assert [(f.name, f.dataType) for f in both.schema] == [
        (f.name, f.dataType) for f in readers.HARMONISED_SCHEMA]
    assert both.count() == 2 * six.count()
    assert both.agg(F.sum("toxic")).first()[0] == 2 * six.agg(F.sum("toxic")).first()[0]


def test_publish_replaces_as_a_whole(spark, tmp_path):
    target = str(tmp_path / "t")
    assert writers.publish(spark.range(10).withColumn("source", F.lit("a")), target) == 10
    assert writers.publish(spark.range(4).withColumn("source", F.lit("b")), target) == 4
    spark.catalog.clearCache()
    assert spark.read.parquet(target).count() == 4
    # A version built from the stored one.
    stored = spark.read.parquet(target)
    assert writers.publish(stored.unionByName(stored), target, keep_previous=True) == 8
    assert spark.read.parquet(target + "__previous").count() == 4
    check = writers.verify_readback(spark, target, spark.range(7).withColumn("source", F.lit("b")))
    assert [tuple(r) for r in check.collect()] == [("b", 7, 8, False)]


def _counted(spark, df):
    """The table, and a counter of how often its rows are computed."""
    seen = spark.sparkContext.accumulator(0)

    def touch(text):
        seen.add(1)
        return text

    return df.withColumn("comment_text", F.udf(touch, "string")("comment_text")), seen


def test_publishing_computes_each_source_once(spark, sf, tmp_path):
    six = fixtures.six_label_comments(spark, sf).drop("id")
    one, seen_one = _counted(spark, six.withColumn("source", F.lit("one")))
    some = six.filter("toxic = 1 OR insult = 1")
    two, seen_two = _counted(spark, some.withColumn("source", F.lit("two")))
    none = six.filter("false").withColumn("source", F.lit("none"))
    target = str(tmp_path / "corpus")
    found = moderation.build_corpus([one, two, none], target)
    n, m = six.count(), some.count()
    assert sorted(tuple(r) for r in found.collect()) == [("one", n, n, True), ("two", m, m, True)]
    assert (seen_one.value, seen_two.value) == (n, m)
    assert writers.marker(spark, target) == writers.Published(n + m, {"one": n, "two": m})
    plain, seen = _counted(spark, six)
    assert writers.publish(plain, target) == n and seen.value == n
    mixed = six.withColumn("source", F.when(F.col("toxic") == 1, "a"))
    check = writers.publish_sources([mixed, six.withColumn("source", F.lit("a"))], target).collect()
    assert sum(r.expected for r in check) == 2 * n and {r.source for r in check} == {"a", None} and all(r.matches for r in check)


def test_recovery_after_a_crash(spark, tmp_path):
    target = str(tmp_path / "t")
    assert writers.recover(spark, target) == "none"
    writers.publish(spark.range(3), target)
    assert writers.recover(spark, target) == "whole"
    (tmp_path / "t").rename(tmp_path / "t__previous")           # between the two renames, the new version half written
    spark.range(9).write.parquet(target + "__staged")
    assert writers.recover(spark, target) == "old" and spark.read.parquet(target).count() == 3
    writers.publish(spark.range(5), str(tmp_path / "u"))
    (tmp_path / "t").rename(tmp_path / "t__previous")           # the same, the new version whole
    spark.range(1).write.mode("overwrite").parquet(target + "__staged")
    writers._mark(spark, target + "__staged", writers.Published(1, {}))
    assert writers.recover(spark, target) == "new" and spark.read.parquet(target).count() == 1


def test_broken_records_are_set_aside_or_raise(spark, tmp_path):
    good = '{"a": {"post_tokens": ["x"], "annotators": [{"label": "normal"}]}}'
    (tmp_path / "p.json").write_text("\n".join([
        good, good[:30], "", "[1]", "7", "{}", "null", '{"b": {"post_tokens": "x", "annotators": []}, "c": {"post_tokens": [], "annotators": []}}',
        '{"d": {"post_tokens": ["x"]}}', '{"e": null}']))
    kept, bad = readers.split_posts(spark, str(tmp_path))
    assert sorted(r.post_id for r in kept.collect()) == ["a", "c"]
    found = sorted((r.post_id or "", r.reason) for r in bad.collect())
    assert found == sorted([("", "not_json"), ("", "no_posts"), ("", "no_posts"), ("", "no_posts"), ("", "no_posts"), ("b", "bad_tokens"),
                            ("d", "bad_votes"), ("e", "bad_tokens")])
    assert bad.filter("value IS NULL").count() == 0
    with pytest.raises(Exception, match="cannot read a post"):
        readers.read_posts(spark, str(tmp_path)).collect()


def test_broken_csv_rows(spark, tmp_path):
    zeros = ",0" * (len(LABELS) - 1)
    (tmp_path / "c.csv").write_text("id,comment_text," + ",".join(LABELS) + f"\n1,fine,1{zeros}\ntwo,bad id,0{zeros}\n3,short,0\n4,,x{zeros}\n5,\"a\nb\",0{zeros}\n")
    kept, bad = readers.split_csv(spark, str(tmp_path), readers.COMMENT_SCHEMA)
    assert sorted(r.id for r in kept.select("id").collect()) == [1, 5] and bad.count() == 3
    assert kept.schema == readers.COMMENT_SCHEMA
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, str(tmp_path), readers.COMMENT_SCHEMA).collect()
    moderation.ingest(spark, str(tmp_path), f"{tmp_path}-out", f"{tmp_path}-bad")
    assert spark.read.parquet(f"{tmp_path}-out").count() == 2 and spark.read.parquet(f"{tmp_path}-bad").count() == 3


@pytest.mark.parametrize("parts", [1, 6])
def test_ids_tell_copies_apart(spark, parts):
    rows_in = [("same" if i % 3 == 0 else None if i % 7 == 0 else f"t{i}", f"s{i % 2}", i) for i in range(300)]
    df = spark.createDataFrame(rows_in, "comment_text string, source string, other int").repartition(parts)
    got = number_copies(df, ["comment_text", "source"]).collect()
    assert len({r.id for r in got}) == 300 and sorted(r.other for r in got) == list(range(300))
    content = {}
    for r in got:
        content.setdefault((r.comment_text, r.source), []).append(r.id)
    for own in content.values():
        base = min(own, key=len)
        assert sorted(own) == sorted([base, *[f"{base}-{k}" for k in range(1, len(own))]])
    assert number_copies(df.filter("false"), ["comment_text"]).count() == 0


def test_predictions_of_copies_do_not_multiply_in_joins(spark, tmp_path):
    class Model:
        def score(self, df, keep):
            return df.withColumn("clean_text", F.col("comment_text")).select(*keep, *[F.lit(0.5).alias(f"prob_{x}") for x in LABELS])

    comments = spark.createDataFrame([("a", "s")] * 4 + [("b", "s"), (None, "s")], "comment_text string, source string")
    moderation.predict(comments, Model(), str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 5 and out.join(out.select("id"), "id").count() == 5


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = materialise(spark.range(3), "three")
    assert shared_dir(spark) + "/three-" in kept.inputFiles()[0]


def test_pipeline_from_csv_to_reports(spark, sf, tmp_path):
    """ingest, corpus, training, scoring, user tables and reports in a row."""
    csv, base = str(tmp_path / "csv"), str(tmp_path)
    writers.write_report(fixtures.six_label_comments(spark, sf).drop("source"), csv,
                         single_file=False)
    nulls = moderation.ingest(spark, csv, f"{base}/raw")
    assert {r.nulls for r in nulls.collect()} == {0}
    stored = spark.read.parquet(f"{base}/raw")
    check = moderation.build_corpus([harmonize.from_six_labels(stored, "documents")],
                                    f"{base}/corpus")
    assert [(r.source, r.matches) for r in check.collect()] == [("documents", True)]
    corpus = spark.read.parquet(f"{base}/corpus")
    result = moderation.train(corpus, f"{base}/model", f"{base}/card")
    moderation.predict(corpus, result.model, f"{base}/predictions")
    moderation.aggregate_users(spark, f"{base}/predictions", f"{base}/users")
    moderation.report(spark, f"{base}/predictions", f"{base}/reports", "2024-05-01")
    n = stored.count()
    assert spark.read.parquet(f"{base}/predictions").count() == n
    summary = spark.read.csv(f"{base}/reports/summary", header=True).first()
    assert (summary.run_date, int(summary.total_scanned)) == ("2024-05-01", n)
    buckets = spark.read.csv(f"{base}/reports/volume_buckets", header=True, inferSchema=True)
    assert buckets.agg(F.sum("comment_count")).first()[0] == n
    assert spark.read.parquet(f"{base}/users/user_stats").agg(
        F.sum("total_comments")).first()[0] == n


def test_volume_buckets_follow_the_rows_end_to_end(spark, tmp_path):
    """Flags at the end of the input are in the last buckets of the report, whatever the ids are."""
    from tideguard.config import LABELS
    from tideguard.functions.scoring import apply_thresholds
    from tideguard.operators import reports
    from tideguard.plans import moderation
    from tideguard.sources import readers

    class Model:
        def score(self, df, keep):
            late = F.col("row_order") >= 950
            scored = df.withColumn("clean_text", F.col("comment_text"))
            return scored.select(*keep, *[F.when(late, 0.99).otherwise(0.01).alias(f"prob_{x}") for x in LABELS])

    comments = spark.range(1000).coalesce(1).select(F.concat(F.lit("c"), "id").alias("comment_text"))
    for name, df in (("text", comments), ("number", comments.withColumn("id", F.substring("comment_text", 2, 9).cast("long")))):
        out = str(tmp_path / name)
        moderation.predict(df, Model(), out)
        flags = apply_thresholds(readers.load_predictions(spark, out))
        found = [r["flagged_count"] for r in reports.volume_buckets(flags, order="row_order").orderBy("bucket_index").collect()]
        assert sum(found) == 50 and sum(found[:-1]) == 0
        with pytest.raises(TypeError):
            reports.volume_buckets(flags)
