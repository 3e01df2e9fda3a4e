"""The strike machine: rules, slices, streams, brute force."""

import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from tideguard.config import ModerationConfig
from tideguard.functions import strikes as machine
from tideguard.functions.strikes import Rules
from tideguard.operators import strikes
from tideguard.operators.strikes import slice_units, strike_actions, strike_status
from tideguard.plans import stream_queries
from tideguard.streaming import strikes as strike_stream
from tideguard.streaming.strikes import first_of_repeats, stream_status, stream_strikes

T0 = datetime(2024, 3, 1, 12, 0, 0)
SCHEMA = "user long, id long, ts timestamp, bad boolean, back boolean"


def brute(messages, max_strikes=3, mute=timedelta(minutes=30)):
    """One message after the other, as a person would do it."""
    count, until, out = {}, {}, {}
    for user, i, ts, bad, back in sorted(messages, key=lambda m: (m[2], m[1])):
        if until.get(user) and ts >= until[user]:
            until.pop(user)
            count[user] = 0
        if back:
            until.pop(user, None)
            count[user] = 0
            act = "rejoin"
        elif user in until:
            act = "muted"
        elif not bad:
            act = "pass"
        else:
            count[user] = count.get(user, 0) + 1
            act = ("mute" if count[user] >= max_strikes
                   else "final_warning" if count[user] == max_strikes - 1 else "warn")
            if act == "mute":
                until[user] = ts + mute
        out[i] = (act, count.get(user, 0), until.get(user))
    return out


def made_up(n, seed, minutes, users=(1, 2, None)):
    pick = random.Random(seed)
    return [(pick.choice(users), i, T0 + timedelta(seconds=pick.randrange(minutes * 60)),
             pick.random() < 0.4, pick.random() < 0.02) for i in range(n)]


def result(df):
    return {r.id: (r.action, r.strikes, r.muted_until) for r in df.collect()}


def play(spark, messages, **kw):
    df = spark.createDataFrame(messages, SCHEMA)
    return strike_actions(df, ["user"], "ts", "id", F.col("bad"), F.col("back"), **kw)


@pytest.mark.parametrize("minutes, mute", [(3000, 30), (200, 30), (200, 5)])
@pytest.mark.parametrize("slice_rows", [10**6, 40, 9])
def test_equals_brute_force_with_and_without_slices(spark, minutes, mute, slice_rows):
    messages = made_up(400, minutes + mute, minutes)
    got = play(spark, messages, config=ModerationConfig(mute_minutes=mute), slice_rows=slice_rows)
    assert result(got) == brute(messages, mute=timedelta(minutes=mute))


def test_chains_of_slices_over_several_parents(spark, monkeypatch):
    monkeypatch.setattr(strikes, "FAN_IN", 3)
    messages = made_up(400, 77, 300)
    assert result(play(spark, messages, slice_rows=7)) == brute(messages)


def test_one_user_with_a_third_of_all_rows(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")))
    bad = F.col("event_type") == "error"
    whole = strike_actions(events, ["user_id"], "ts", "event_id", bad)
    sliced = strike_actions(events, ["user_id"], "ts", "event_id", bad, slice_rows=50)
    assert rows(whole) == rows(sliced)


def test_slices_follow_the_messages_and_not_the_time(spark):
    """23,000 messages spread over two years, and as many in one minute."""
    pick = random.Random(8)
    spread = [(1, i, T0 + timedelta(minutes=pick.randrange(1_200_000)), True, False) for i in range(23_000)]
    packed = [(None, 30_000 + i, T0 + timedelta(milliseconds=3 * i), i % 50 == 0, False) for i in range(20_000)]
    few = [(2, 60_000 + i, T0 + timedelta(minutes=i), True, False) for i in range(9)]
    rows_in = spark.createDataFrame(spread + packed + few, SCHEMA).select("user", F.unix_micros("ts").alias("__us"))
    units = slice_units(rows_in, ["user"], 1000)
    found = {r.user: (r.slices, r.seconds) for r in units.groupBy("user").agg(
        F.count_distinct("__slice").alias("slices"), F.count("*").alias("seconds")).collect()}
    assert set(found) == {1, None} and found[1][0] <= 24 and found[None][0] <= 21
    full = rows_in.withColumn("__second", F.floor(F.col("__us") / 1_000_000)).join(
        units.withColumnRenamed("user", "u"), F.col("user").eqNullSafe(F.col("u")) & (units["__second"] == F.floor(F.col("__us") / 1_000_000)))
    assert full.groupBy("u", "__slice").count().agg(F.max("count")).first()[0] <= 1000 + 334   # and what one second holds


def test_nothing_runs_before_the_result_is_asked_for(spark):
    df = spark.createDataFrame([(1, 1, T0, True, False)] * 30, SCHEMA)
    group = "strikes-are-lazy"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for size in (10, 10**6):
            plan = plan_of(strike_actions(df, ["user"], "ts", "id", F.col("bad"), slice_rows=size))
            assert "rangepartitioning" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_message_exactly_at_the_end_of_the_mute_counts(spark):
    at = [0, 1, 2, 32, 33]
    messages = [(1, i, T0 + timedelta(minutes=m), True, False) for i, m in enumerate(at)]
    acts = result(play(spark, messages))
    assert [acts[i][0] for i in range(5)] == ["warn", "final_warning", "mute", "warn",
                                              "final_warning"]


def test_rejoin_while_muted(spark):
    messages = [(1, i, T0 + timedelta(minutes=i), True, False) for i in range(4)]
    messages += [(1, 4, T0 + timedelta(minutes=4), False, True),
                 (1, 5, T0 + timedelta(minutes=5), True, False)]
    acts = result(play(spark, messages))
    assert [acts[i][0] for i in range(6)] == ["warn", "final_warning", "mute", "muted",
                                              "rejoin", "warn"]


def test_two_part_key(spark):
    messages = [(i % 2, i, T0 + timedelta(minutes=i), True, False) for i in range(6)]
    df = spark.createDataFrame(messages, SCHEMA).withColumn("chat", F.lit("c"))
    got = strike_actions(df, ["chat", "user"], "ts", "id", F.col("bad"))
    assert sorted(r.action for r in got.collect()) == sorted(
        ["warn", "final_warning", "mute"] * 2)


def test_status(spark):
    messages = ([(1, i, T0 + timedelta(minutes=i), True, False) for i in range(3)]
                + [(2, 10, T0, True, False), (3, 11, T0, False, False)])
    actions = play(spark, messages)

    def at(minutes):
        now = F.lit(T0 + timedelta(minutes=minutes))
        return {r.user: (r.status, r.remaining, r.minutes_left) for r in strike_status(
            actions, ["user"], "ts", "id", now).collect()}

    assert at(2) == {1: ("muted", None, 31), 2: ("warned", 2, None), 3: ("none", None, None)}
    assert at(31.5)[1] == ("muted", None, 1)
    assert at(32)[1] == ("expired", None, None)
    assert at(1)[1] == ("warned", 1, None)


def test_summaries_chain_like_playing_on():
    pick = np.random.default_rng(5)
    rules = machine.Rules(3, 30)
    times = np.sort(pick.integers(0, 400, 90))
    resets = pick.random(90) < 0.05
    tables, cuts = [], [0, 20, 21, 55, 90]
    for a, b in zip(cuts, cuts[1:]):
        tables.append(machine.summarise(times[a:b], resets[a:b], rules, machine.FOREVER - 1))
    joined = machine.chain(tables, rules, machine.FOREVER - 1)
    for count, until in [(0, -1), (1, -1), (2, -1), (3, 5), (3, 17), (3, 90), (3, 1000)]:
        *_, want = machine.play(times, ~resets, resets, count, until, rules)
        for steps in ([joined], tables):
            c, u = np.array([count]), np.array([until])
            for table in steps:
                c, u = machine.follow(table, c, u)
            assert (int(c[0]), int(u[0])) == want


# --- streams ----------------------------------------------------------------

def write_batches(spark, messages, folder, n):
    for k in range(n):
        part = messages[k::n]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def drain(stream, folder):
    query = (stream.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/out")


def source(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            .parquet(str(folder)))


def test_stream_in_order_equals_batch(spark, tmp_path):
    messages = sorted(made_up(300, 3, 600), key=lambda m: (m[2], m[1]))
    for k in range(3):
        (spark.createDataFrame(messages[k * 100:(k + 1) * 100], SCHEMA).coalesce(1)
         .write.mode("append").parquet(str(tmp_path / "in")))
    got = stream_strikes(source(spark, tmp_path / "in"), ["user"], "ts", "id",
                         F.col("bad"), F.col("back"))
    assert result(drain(got, tmp_path)) == brute(messages)


@pytest.mark.parametrize("files", [1, 4])
def test_stream_in_event_time_does_not_depend_on_the_batches(spark, tmp_path, files):
    messages = made_up(240, 11, 600, users=(1, 2))
    write_batches(spark, messages, tmp_path / "in", files)
    # A last row per user, far enough ahead to push the watermark past the rest.
    for k in range(2):
        closing = [(u, 900 + 10 * k + u, T0 + timedelta(days=2 + k), False, False) for u in (1, 2)]
        spark.createDataFrame(closing, SCHEMA).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
    got = stream_strikes(source(spark, tmp_path / "in"), ["user"], "ts", "id", F.col("bad"),
                         F.col("back"), delay="700 minutes")
    found = {i: v for i, v in result(drain(got, tmp_path)).items() if i < 900}
    assert found == brute(messages)


def test_repeated_delivery_is_dropped(spark, tmp_path):
    messages = [(1, i, T0 + timedelta(minutes=i), True, False) for i in range(3)]
    for _ in range(2):
        spark.createDataFrame(messages, SCHEMA).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
    once = first_of_repeats(source(spark, tmp_path / "in"), "id", "ts", "1 hour")
    assert drain(once, tmp_path).count() == 3


class State:
    """State of one user, in memory; counts the calls."""

    def __init__(self):
        self.calls, self.values, self.timers = 0, {}, set()

    def getValueState(self, name, _):
        return Slot(self, name)

    getMapState = lambda self, name, *_: Slot(self, name)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class Slot:
    def __init__(self, state, name):
        self.state, self.name = state, name

    def at(self, key=()):
        self.state.calls += 1
        return (self.name, *key)

    def get(self):
        return self.state.values.get(self.at())

    def exists(self):
        return self.at() in self.state.values

    def update(self, value):
        self.state.values[self.at()] = value

    def clear(self):
        self.state.values.pop(self.at(), None)

    def getValue(self, key):
        return self.state.values[self.at(key)]

    def containsKey(self, key):
        return self.at(key) in self.state.values

    def updateValue(self, key, value):
        self.state.values[self.at(key)] = value

    def removeKey(self, key):
        del self.state.values[self.at(key)]


@pytest.mark.parametrize("parcel", [1, 7, 512])
def test_state_calls_follow_micro_batches_and_not_messages(monkeypatch, parcel):
    monkeypatch.setattr(strike_stream, "PARCEL", parcel, raising=False)
    state, slot_ms = State(), 60_000
    processor = strike_stream.StrikesInTime(Rules(3, 30 * 60_000_000), "long", slot_ms)
    processor.init(state)
    rng = random.Random(5)
    messages = [(i, 20_000_000 * i + rng.randrange(10 ** 7), rng.random() < 0.5, rng.random() < 0.05) for i in range(600)]
    messages += [(600 + i, *messages[7 * i][1:]) for i in range(40)]     # equal times
    arrivals = sorted(messages, key=lambda m: m[1] + rng.randrange(3_000_000_000))
    got, watermark = [], 0
    for k in range(4):
        part = arrivals[160 * k: 160 * (k + 1)]
        list(processor.handleInputRows(("u",), iter([pd.DataFrame(part, columns=["id", "us", "toxic", "rejoin"])]), None))
        watermark = 10 ** 9 if k == 3 else (max(m[1] for m in arrivals[:160 * (k + 1)]) - 3_000_000_000) // 1000
        while due := [t for t in sorted(state.timers) if t <= watermark]:
            state.timers.discard(due[0])
            for out in processor.handleExpiredTimer(("u",), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark),
                                                  SimpleNamespace(getExpiryTimeInMs=lambda: due[0])):
                got += list(zip(out["id"], out["action"], out["strikes"], strict=True))
    assert got == [(i, a, c) for i, (a, c) in _plain(sorted(messages, key=lambda m: (m[1], m[0])))]
    assert not state.values and not state.timers     # nothing waits, and no mute is left
    assert parcel < 512 or state.calls < 80


@pytest.mark.parametrize("kind, parcel", [("long", 16), ("long", 16_384), ("string", 100)])
def test_state_calls_do_not_follow_the_users_of_a_bucket(monkeypatch, kind, parcel):
    """Users of a bucket are played together, each by their own messages, and in order of arrival where times and ids are equal."""
    monkeypatch.setattr(strike_stream, "PARCEL", parcel, raising=False)
    state = State()
    processor = strike_stream.StrikesInTime(Rules(3, 30 * 60_000_000), kind, 60_000)
    processor.init(state)
    rng = random.Random(9)
    messages = [(f"u{rng.randrange(150)}", i, rng.randrange(7_200_000_000), rng.random() < 0.6, rng.random() < 0.05) for i in range(3000)]
    messages += [(u, i, us, not toxic, back) for u, i, us, toxic, back in messages[:200]]     # the same message again, judged otherwise
    if kind == "string":
        messages = [(u, None if i % 50 == 0 else str(i), *rest) for u, i, *rest in messages]
    got, calls = {}, []
    for k in range(4):
        state.calls = 0
        part = sorted(messages, key=lambda m: m[2])[800 * k:800 * (k + 1)]
        rng.shuffle(part)
        frames = [pd.DataFrame(part[j:j + 300], columns=["key", "id", "us", "toxic", "rejoin"]) for j in range(0, 800, 300)]
        list(processor.handleInputRows((3,), iter(frames), None))
        for j, m in enumerate(part):
            got.setdefault(m[0], []).append((m[2], m[1] is not None, "" if m[1] is None else m[1], k, j, m))
        watermark = 10 ** 9 if k == 3 else max(m[2] for m in part) // 1000 - 600_000
        while due := [t for t in sorted(state.timers) if t <= watermark]:
            state.timers.discard(due[0])
            for out in processor.handleExpiredTimer((3,), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark),
                                                    SimpleNamespace(getExpiryTimeInMs=lambda: due[0])):
                calls += list(zip(out["key"], out["id"], out["action"], out["strikes"], strict=True))
        assert parcel < 10_000 or state.calls < 30
    for user, mine in got.items():
        expected = [(i, a, c) for i, (a, c) in _plain([m[1:] for *_, m in sorted(mine, key=lambda x: x[:5])])]
        assert [x[1:] for x in calls if x[0] == user] == expected
    assert len(calls) == len(messages) and set(state.values) == {("strikes",)} and not state.timers    # who is warned stays so
    last = {user: (count, action) for user, _, action, count in calls}
    users, counts, untils = state.values["strikes",]
    assert dict(zip(users, counts, strict=True)) == {u: c for u, (c, a) in last.items() if c and a not in ("mute", "muted")} and set(untils) == {machine.NEVER}


def test_many_users_at_once_equal_one_after_the_other():
    rng, rules = np.random.default_rng(4), Rules(3, 50)
    sizes = rng.integers(1, 60, 200)
    users = np.repeat(np.arange(200), sizes)
    times = np.concatenate([np.sort(rng.integers(0, 400, n)) for n in sizes])
    toxic, rejoin = rng.random(len(users)) < 0.4, rng.random(len(users)) < 0.03
    counts = rng.integers(0, 4, 200).astype(np.int32)
    ends = np.where(counts == 3, rng.integers(0, 500, 200), machine.NEVER)
    expected = [machine.play(times[users == u], toxic[users == u], rejoin[users == u], int(counts[u]), int(ends[u]), rules) for u in range(200)]
    action, strikes, end = machine.play_users(users, times, toxic, rejoin, counts, ends, rules)
    for got, k in ((action, 0), (strikes, 1), (end, 2)):
        assert (got == np.concatenate([x[k] for x in expected])).all()
    assert list(zip(counts.tolist(), ends.tolist(), strict=True)) == [x[3] for x in expected]


def test_status_of_a_stream_in_event_time(spark, tmp_path):
    messages = made_up(200, 21, 600, users=(1, 2, 3, 4, None))
    write_batches(spark, messages, tmp_path / "in", 2)
    closing = [(9, 900, T0 + timedelta(days=2), False, False)]
    spark.createDataFrame(closing, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = stream_strikes(source(spark, tmp_path / "in"), ["user"], "ts", "id", F.col("bad"), F.col("back"), delay="700 minutes", buckets=3)
    assert {i: v for i, v in result(drain(got, tmp_path)).items() if i < 900} == brute(messages)
    now = F.lit(T0 + timedelta(days=2))
    users = spark.createDataFrame([(u,) for u in (1, 2, 3, 4, None, 77)], "user long")
    played = strike_actions(spark.createDataFrame(messages, SCHEMA), ["user"], "ts", "id", F.col("bad"), F.col("back"))
    expected = {r.user: r.strikes if r.status == "warned" else 0 for r in strike_status(played, ["user"], "ts", "id", now).collect()} | {77: 0}
    found = {r.user: r.strikes for r in stream_status(users, str(tmp_path / "checkpoint"), ["user"], now).collect()}
    assert found == expected and any(expected.values())


def test_late_events_in_many_files(spark, tmp_path, monkeypatch):
    """Micro-batches of several files each, some of them without a row, bring every event in order."""
    monkeypatch.setattr(stream_queries, "FILE_EVENTS", 4, raising=False)
    messages = made_up(60, 5, 600) + [(u, 100 + i, ts + timedelta(days=9), bad, back) for u, i, ts, bad, back in made_up(60, 6, 600)]
    events = [(i, ts, u, "error" if bad else "view") for u, i, ts, bad, _ in messages]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    arrivals = stream_queries._arrivals(spark, str(tmp_path), 5)
    counts = {}
    (arrivals.writeStream.foreachBatch(lambda part, k: counts.update({k: part.count()})).option("checkpointLocation", f"{tmp_path}/seen")
     .trigger(availableNow=True).start().awaitTermination())
    assert [counts[k] for k in range(6)] == [60, 0, 0, 0, 60, 1]
    found = stream_queries.stream_strikes_event_time(spark, str(tmp_path))
    assert rows(found) == rows(stream_queries.batch_strikes(spark, str(tmp_path)))


def _plain(messages):
    """The machine one message at a time."""
    count, until = 0, None
    for i, us, toxic, rejoin in messages:
        if until is not None and us >= until:
            count, until = 0, None
        action = "pass"
        if rejoin:
            count, until, action = 0, None, "rejoin"
        elif until is not None:
            action = "muted"
        elif toxic:
            count += 1
            action = {1: "warn", 2: "final_warning"}.get(count, "mute")
            until = us + 30 * 60_000_000 if count >= 3 else None
        yield i, (action, count)
