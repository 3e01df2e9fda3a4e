"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tideguard.llm import decontamination, language_model, mixing, personal_data, quality_classifier
from tideguard.llm import quality_rules, setsketch, substring_dedup, token_files, toxicity
from tideguard.llm.common import fold, labelled_sample

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [(1, "a plain text of some ten words or so , is here now", "en", "s", 1, "x"), (None, "null id", None, None, None, None),
        (2, None, "en", "s", 0, "y"), (3, "", "en", None, 0, "y"), (4, " \n\t", "en", "s", 3, "y"), (5, LONG, "en", "t", 9, "y"),
        (6, "tie tie tie tie", "en", "t", 1, "y"), (7, "tie tie tie tie", "en", "t", 1, "y"), (7, "tie tie tie tie", "en", "t", 1, "y"),
        (8, "mail me at a.b@c.org or 10.0.0.1 please", "en", "s", 1, "y")]
BASE = "doc_id long, text string, lang string, source string, n_chars long, other string"
#: Names that the operators use inside.
CLASHES = ("key", "body", "score", "n", "rep", "row", "h", "word", "rank", "kept", "registers", "_body", "_words", "_n", "tokens", "block",
           "sub", "total", "weight", "epochs", "mix_epoch", "shard", "label", "y", "start", "spans", "base", "rejected_by", "component_id")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, BASE)
    return df.select("*", *[F.lit(i if i % 3 else None).cast("int").alias(c) for i, c in enumerate(CLASHES)]).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (6, 0, 1), (7, 1, 1), (7, 1, 1), (8, None, None), (None, 1, 1), (99, 1, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(0, "mail me at please"), (1, None), (None, "x"), (2, ""), (2, "tie tie tie tie")], "item_id long, text string")


ALL = "true"


def jobs(labels, items):
    def language(d):
        model, counts = language_model.train(d, fold("doc_id", 7) != 2, language_model.BrownConfig(symbols=5, classes=4, surfaces=4))
        return language_model.score(d, model, counts, d.where(fold("doc_id", 7) != 2).count())

    return {
        "op1": lambda d: quality_rules.cascade(quality_rules.measured(d)),
        "op2": lambda d: substring_dedup.repeats(d, substring_dedup.RepeatConfig(4)),
        "op3": lambda d: toxicity.score(d, toxicity.train(d, labels, F.expr(ALL))),
        "op4": language,
        "op6": token_files.round_trip,
        "op8": lambda d: quality_classifier.score(d, quality_classifier.train(d, labels, F.expr(ALL))),
        "op9": personal_data.personal_data,
        "op10": setsketch.near_duplicates,
    }


NAMES = ["op1", "op2", "op3", "op4", "op6", "op8", "op9", "op10"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(docs, labels, items, name):
    found = jobs(labels, items)[name](docs).collect()
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in found)
    assert ids == sorted((r[0] is not None, r[0] or 0) for r in ROWS)
    twins = [tuple(x for c, x in r.asDict().items() if c not in ("start", "rejected_by")) for r in found if r["doc_id"] == 7]
    assert repr(twins[0]) == repr(twins[1])


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, labels, items, name):
    assert jobs(labels, items)[name](docs.where("false")).count() == 0


def test_empty_labels_and_items(docs, labels, items):
    none = labels.where("false")
    assert {r["score"] for r in quality_classifier.score(docs, quality_classifier.train(docs, none, ALL)).collect()} == {0.5}
    assert len({r["score"] for r in toxicity.score(docs, toxicity.train(docs, none, ALL)).collect()}) == 1
    assert decontamination.contaminations(docs, items.where("false")).count() == 0
    assert decontamination.clean(docs, items.where("false")).count() == len(ROWS)


def test_defined_results(docs, labels, items):
    near = {r["doc_id"]: r for r in setsketch.near_duplicates(docs).collect()}
    assert (near[7]["component_id"], near[2]["n_shingles"], near[4]["kept"], near[None]["kept"]) == (6, 0, True, True)
    found = decontamination.contaminations(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(6, 2), (7, 2), (7, 2)]
    assert sorted((r["doc_id"] or 0) for r in decontamination.clean(docs, items).collect()) == [0, 1, 2, 3, 4, 5, 8]
    spans = {r["doc_id"]: r for r in personal_data.personal_data(docs).select("doc_id", personal_data.joined("base").alias("b")).collect()}
    assert spans[8]["b"] == "email:11:20,ip:24:32" and spans[2]["b"] == ""
    rows = sorted((r["start"], r["n_tokens"]) for r in token_files.round_trip(docs).collect())
    assert all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:], strict=False))


def test_filters_pass_columns_unchanged(docs, labels, items):
    net = quality_classifier.train(docs, labels, F.expr(ALL))
    kept = quality_classifier.accepted(docs, net, 0.0)
    assert kept.schema == docs.schema and sorted(map(repr, kept.collect())) == sorted(map(repr, docs.collect()))
    assert decontamination.clean(docs, items).schema == docs.schema


def test_mix_of_odd_rows(docs):
    mixed = mixing.mix(docs, mixing.MixConfig(budget=2.0, entropy=0.0, max_repeats=2.0, blocks=4))
    got = sorted((r["doc_id"] or 0) for r in mixed.collect())
    assert got == sorted([0, 1, 5, 6, 7, 7, 8] * 2)  # every row with words twice; the null source is a source
    assert mixing.mix(docs.where("false")).count() == 0 and mixing.mix(docs.where("text is null")).count() == 0


def test_pipeline_stages_on_odd_rows(spark, docs, labels, items, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (docs, docs.where("false")):
        stage_docs = rows.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, stage_docs, str(tmp_path))
            if name != "token_files":
                assert out.columns == stage_docs.columns
            out.count()


def test_one_row_of_each_group_stays(spark):
    words = lambda c: " ".join(f"{c}{i}" for i in range(30))
    rows = [(7, words("a")), (7, words("b")), (3, words("b")), (8, words("c")), (8, words("c")), (None, words("d")), (None, words("d")),
            (None, words("b")), (None, None), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()]
    want = [(7, words("a")), (3, words("b")), (8, words("c")), (None, words("d")), (None, None), (4, ""), (4, "")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_sample_of_a_hot_id_and_of_labels_without_documents(spark):
    rows = [(i, f"text {i}") for i in range(12)] + [(h, f"hot {h} {k}") for h in range(12) for k in range(30)] + [(50, "long " * 100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(i, i % 2) for i in range(50, 500)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = labelled_sample(docs, labels, "quality", F.expr(ALL), 6, max_chars=200)
    assert sorted(y for y, _ in got) == [0] * 6 + [1] * 6 and len({t.split()[1] for _, t in got}) == 12
    one = labelled_sample(docs.where("doc_id > 0 or text = 'text 0'"), labels, "quality", F.expr(ALL), 2, max_chars=200)
    assert sorted(y for y, _ in one) == [0, 0, 1, 1]


def test_item_ids_of_type_int_in_several_shards(docs, items):
    found = decontamination.contaminations(docs, items.withColumn("item_id", F.col("item_id").cast("int")), decontamination.SearchConfig(max_items=1))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(6, 2), (7, 2), (7, 2)]
