"""Cleaning and tokens against plain Python and the ML transformers."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from tideguard.functions.text import (
    STOP_WORDS, clean_text, has_letters, model_tokens, remove_stopwords, tokenize_regex,
    tokenize_whitespace,
)
from tideguard.operators.filters import (
    admit_messages, drop_empty_clean, lexicon_hit, validate_comments,
)

TRICKY = ["", "   ", "\t\n", "Hello, World!", "a  b\tc\n\nd", "see http://x.y/z?q=1 now",
          "http://only.link", "foohttp://x bar", "http", "http ", "HTTP://UP.CASE end",
          "httpx httpy", "café déjà", "123 456", "don't stop", "x\x0by", "a b",
          "the THE The", "http://a http://b http://c", "a" * 20000, "!" * 20000,
          "http://q " * 3000, " lead and trail "]


def plain_clean(text):
    blank = " \t\n\x0b\f\r"
    text = re.sub(f"http[^{blank}]+", "", text.lower())
    text = re.sub(f"[^a-zA-Z{blank}]", " ", text)
    return re.sub(f"[{blank}]+", " ", text).strip(" ")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string")


def test_clean(spark):
    got = frame(spark, TRICKY + [None]).select("id", clean_text(F.col("t"))).collect()
    assert [c for _, c in sorted(got)[:-1]] == [plain_clean(t) for t in TRICKY]
    assert sorted(got, key=lambda r: r[0])[-1][1] is None


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(st.text(alphabet="aZhtp:/. \n\té1-", max_size=30), min_size=200, max_size=300))
def test_clean_of_anything(spark, texts):
    got = frame(spark, texts).select("id", clean_text(F.col("t")), has_letters(F.col("t"))).collect()
    for i, cleaned, letters in got:
        assert cleaned == plain_clean(texts[i])
        assert letters == (cleaned != "")


@pytest.mark.parametrize("ours, theirs", [
    (tokenize_whitespace, lambda: Tokenizer(inputCol="t", outputCol="x")),
    (tokenize_regex, lambda: RegexTokenizer(inputCol="t", outputCol="x", pattern=r"\W"))])
def test_tokens_equal_ml(spark, ours, theirs):
    df = frame(spark, TRICKY)
    got = theirs().transform(df.withColumn("ours", ours(F.col("t")))).collect()
    assert [r.ours for r in got] == [r.x for r in got]


def test_empty_text_tokens(spark):
    row = frame(spark, [""]).select(tokenize_whitespace(F.col("t")), tokenize_regex(F.col("t"))).first()
    assert tuple(row) == ([""], [])


def test_stop_words(spark):
    assert STOP_WORDS == tuple(StopWordsRemover.loadDefaultStopWords("english"))
    df = frame(spark, TRICKY).withColumn("w", tokenize_regex(F.col("t")))
    got = StopWordsRemover(inputCol="w", outputCol="x").transform(
        df.withColumn("ours", remove_stopwords(F.col("w")))).collect()
    assert [r.ours for r in got] == [r.x for r in got]
    row = frame(spark, ["The cat and THE dog"]).select(model_tokens(F.col("t"))).first()
    assert row[0] == ["cat", "dog"]


def test_drop_empty(spark):
    df = frame(spark, ["ok", "123", "http://x.y", None]).withColumnRenamed("t", "comment_text")
    assert [r.comment_text for r in drop_empty_clean(df).collect()] == ["ok"]


def test_validation(spark):
    texts = [None, "", " \n\t", "x" * 5000, " " + "x" * 5000 + " ", "x" * 5001, "fine"]
    got = validate_comments(frame(spark, texts).withColumnRenamed("t", "comment_text")).collect()
    assert [r.reason for r in sorted(got)] == [
        "missing", "empty", "empty", None, None, "too_long", None]
    assert [r.accepted for r in sorted(got)] == [False, False, False, True, True, False, True]


def test_admission(spark):
    texts = [None, "", "  ", "/start", "hello /start", " /x"]
    got = admit_messages(frame(spark, texts), "t").collect()
    assert sorted(r.t for r in got) == [" /x", "hello /start"]


def test_lexicon_looks_at_whole_uncleaned_words(spark):
    texts = ["what an ASSHOLE!", "class assignment", "http://moron", "a moron.", ""]
    got = frame(spark, texts).select("id", lexicon_hit(F.col("t"))).collect()
    assert [hit for _, hit in sorted(got)] == [True, False, True, True, False]


def test_words_and_blanks_of_all_scripts(spark):
    from tideguard.operators import filters
    df = spark.createDataFrame([(1, "dické"), (2, "a dick!"), (3, "   "), (4, " x")], "id int, text string")
    hits = df.select("id", filters.lexicon_hit(F.col("text"), ["dick"]).alias("hit")).collect()
    assert {r["id"] for r in hits if r["hit"]} == {2}
    lexicon = spark.createDataFrame([("dick",)], "word string")
    assert {r["id"] for r in filters.lexicon_matches(df, lexicon, "id", "text").collect()} == {2}
    checked = filters.validate_comments(df, "text").collect()
    assert {r["id"] for r in checked if not r["accepted"]} == {3}


def test_samples_of_text_ids(spark):
    from tideguard.functions.hashing import stable_row_id
    from tideguard.operators import sampling
    df = spark.range(500).select(stable_row_id(F.col("id")).alias("id"))
    assert 80 < sampling.hash_sample(df, 0.25).count() < 170
    train, test = sampling.train_test(df)
    assert train.count() + test.count() == 500 and 350 < train.count() < 450
