"""The online job against its parts on a stored table."""

import glob
import os
import random
import shutil
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tideguard.config import DEFAULT_LEXICON, LABELS
from tideguard.operators.strikes import strike_actions
from tideguard.plans.stream_queries import QUERIES
from tideguard.streaming.online import Scorer, judge, linear_scorer, moderate, moderate_online
from tideguard.streaming.strikes import stream_status

T0 = datetime(2024, 3, 1, 12, 0, 0)
SCHEMA = "user long, id long, ts timestamp, text string"


def _scorer(df):
    """Flags the word "bad"; the scores of a text with "broken" are missing."""
    p = F.when(F.col("comment_text").contains("broken"), F.lit(None).cast("double")).when(
        F.col("comment_text").contains("bad"), 0.99).otherwise(0.0)
    return df.withColumns({f"prob_{x}": p for x in LABELS})


def _messages(spark):
    texts = ["bad", "/bad command", None, "  ", "fine", "broken bad", "bad " * 2000, DEFAULT_LEXICON[0],
             "bad", "bad again", "fine"]
    return spark.createDataFrame(
        [(user, 100 * user + i, T0 + timedelta(minutes=4 * i), text)
         for user in (1, 2) for i, text in enumerate(texts)], SCHEMA)


def test_judge(spark):
    got = {r.id % 100: r.toxic for r in judge(_messages(spark), _scorer, "text").collect()}
    assert got == {0: True, 4: False, 5: False, 6: False, 7: True, 8: True, 9: True, 10: False}


def test_stream_equals_table(spark, tmp_path):
    source = f"{tmp_path}/in"
    _messages(spark).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    query = (moderate(stream, _scorer, ["user"], "ts", "id").writeStream.format("parquet")
             .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select("user", "id", "action", "strikes")
    judged = judge(_messages(spark), _scorer, "text")
    wanted = strike_actions(judged, ["user"], "ts", "id", F.col("toxic")).select("user", "id", "action", "strikes")
    assert rows(got) == rows(wanted)
    assert [r.action for r in got.where("user = 1").orderBy("id").collect()] == [
        "warn", "pass", "pass", "pass", "final_warning", "mute", "muted", "muted"]


# --- scored where the state is -------------------------------------------------

def _counting(folder):
    """Writes down every text that is scored."""
    def score(frame):
        with open(f"{folder}/scored", "a") as out:
            out.writelines(f"{t}\n" for t in frame["text"])
        p = np.where(frame["text"].str.contains("bad"), 0.99, 0.0)
        p[frame["text"].str.contains("broken").to_numpy()] = np.nan
        return np.repeat(p[:, None], len(LABELS), axis=1)
    return Scorer({"text": F.col("text")}, score)


def _answers(spark, rows_in, folder, files=1, **more):
    schema = "chat string, user long, id long, ts timestamp, text string, back boolean"
    for part in range(files):
        (spark.createDataFrame(rows_in[part * len(rows_in) // files:(part + 1) * len(rows_in) // files], schema)
         .coalesce(1).write.mode("append").parquet(f"{folder}/in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = (moderate_online(stream, _counting(folder), ["chat", "user"], "ts", "id", rejoin=F.col("back"), **more)
             .writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    with open(f"{folder}/scored") as scored:
        return {r.id: r for r in spark.read.parquet(f"{folder}/out").collect()}, scored.read().splitlines()


def test_muted_messages_are_not_scored(spark, tmp_path):
    texts = ["bad 0", "fine 1", "bad 2", "bad 3", "bad 4", "fine 5", "bad 6", "/bad 7", "bad " * 2000, "bad 9"]
    big = (1 << 60) + 1   # beyond the whole numbers of a double
    rows_in = [(chat, user, big + 100 * k + i, T0 + timedelta(minutes=10 * i), t, False)
               for k, (chat, user) in enumerate([("a", 1), ("a", None), (None, big)]) for i, t in enumerate(texts)]
    got, scored = _answers(spark, rows_in, tmp_path)
    for k, key in enumerate([("a", 1), ("a", None), (None, big)]):
        own = {i: got.get(big + 100 * k + i) for i in range(10)}
        assert [own[i] and own[i].action for i in range(10)] == [
            "warn", "pass", "final_warning", "mute", "muted", "muted", "warn", None, "pass", "final_warning"]
        assert [own[i].scored for i in (0, 1, 2, 3, 4, 5, 6, 8, 9)] == [True] * 4 + [False, False, True, False, True]
        assert (own[0].chat, own[0].user) == key and own[0].categories == list(LABELS) and own[1].categories == []
        assert own[4].categories is None and own[3].muted_until == T0 + timedelta(minutes=60)
    assert sorted(scored) == sorted(3 * ["bad 0", "fine 1", "bad 2", "bad 3", "bad 6", "bad 9"])


@pytest.mark.parametrize("files, ahead", [(1, 1), (4, 1), (1, 7)])
def test_online_equals_table_in_any_micro_batches(spark, tmp_path, files, ahead):
    pick = random.Random(files + ahead)
    words = ["bad", "fine", "fine words", "broken bad", DEFAULT_LEXICON[0], "  ", None, "/cmd"]
    rows_in = [("c", pick.randrange(3), i, T0 + timedelta(minutes=2 * i), pick.choice(words), pick.random() < 0.03) for i in range(300)]
    got, scored = _answers(spark, rows_in, tmp_path, files, ahead=ahead)
    table = spark.createDataFrame(rows_in, "chat string, user long, id long, ts timestamp, text string, back boolean")

    def scorer(df):
        p = F.when(F.col("text").contains("broken"), F.lit(None).cast("double")).when(F.col("text").contains("bad"), 0.99).otherwise(0.0)
        return df.withColumns({f"prob_{x}": p for x in LABELS})

    judged = judge(table.filter("not back"), scorer).unionByName(
        table.filter("back").withColumn("toxic", F.lit(False)))
    want = {r.id: (r.action, r.strikes, r.muted_until) for r in strike_actions(
        judged, ["chat", "user"], "ts", "id", F.col("toxic") & ~F.col("back"), F.col("back")).collect()}
    assert {i: (r.action, r.strikes, r.muted_until) for i, r in got.items()} == want
    counted = [r for r in got.values() if r.scored]
    assert len(scored) == len(counted) if ahead == 1 else len(scored) >= len(counted)


def test_linear_scorer_scores_as_the_model_does(spark, sf):
    from tideguard.operators import training
    from tideguard.plans import fixtures
    comments = fixtures.training_comments(spark, sf).limit(150)
    model = training.train_multilabel(comments, labels=LABELS[:3]).model
    scorer = linear_scorer(model.heads)
    rows_in = model.features.transform(comments).select("id", *[c.alias(n) for n, c in scorer.inputs.items()]).orderBy("id").toPandas()
    got = scorer.score(rows_in)
    want = model.score(comments, ["id"]).orderBy("id").collect()
    for k, label in enumerate(model.heads):
        assert np.allclose(got[:, k], [r[f"prob_{label}"][1] for r in want], atol=1e-12)


def test_status_from_the_state_of_the_stream(spark, tmp_path):
    rows_in = [("a", 1, i, T0 + timedelta(minutes=i), "bad", False) for i in range(4)] + [("a", None, 9, T0, "bad", False), ("b", 1, 10, T0, "fine", False)]
    _answers(spark, rows_in, tmp_path)
    users = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("c", 5)], "chat string, user long")
    found = {(r.chat, r.user): (r.strikes, r.status, r.remaining, r.minutes_left) for r in stream_status(
        users, f"{tmp_path}/state", ["chat", "user"], F.lit(T0 + timedelta(minutes=12))).collect()}
    assert found == {("a", 1): (3, "muted", None, 21), ("a", None): (1, "warned", 2, None), ("b", 1): (0, "none", None, None),
                     ("c", 5): (0, "none", None, None)}


def _tables(spark, folder, files):
    turns = [(c, t, "system" if t == 0 else "user", f"bad {DEFAULT_LEXICON[0]} {c}" if (c + t) % 3 else "fine words") for c in range(6) for t in range(3)]
    texts = [(i, f"words of text {i}" if i % 4 else "  ", "en", "web", 10) for i in range(12)]
    for name, data, schema in (("conversations", turns, "conv_id long, turn long, role string, text string"),
                               ("documents", texts, "doc_id long, text string, lang string, source string, n_chars long")):
        df = spark.createDataFrame(data, schema).repartition(files)
        df.write.parquet(f"{folder}/written/{name}")
        if files > 1:
            shutil.copytree(f"{folder}/written/{name}", f"{folder}/in/{name}.parquet")
        else:
            os.makedirs(f"{folder}/in", exist_ok=True)
            shutil.copy(glob.glob(f"{folder}/written/{name}/part-*.parquet")[0], f"{folder}/in/{name}.parquet")
    return f"{folder}/in"


@pytest.mark.parametrize("name", ["online_strikes", "stream_score"])
def test_streams_read_tables_of_one_file_and_of_a_folder(spark, tmp_path, name):
    one, many = (rows(QUERIES[name](spark, _tables(spark, f"{tmp_path}/{n}", n))) for n in (1, 3))
    assert one == many and len(one) > 10
