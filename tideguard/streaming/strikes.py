"""The strike machine on a stream of messages, with checkpointed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideguard.config import DEFAULTS, ModerationConfig
from tideguard.functions import strikes as machine
from tideguard.functions.strikes import NEVER, Rules
from tideguard.operators.strikes import micros, rules_of, with_status
from tideguard.session import keep_state_on_disk


#: Keyed state of a user: strikes, and the end of a mute in microseconds.
STATE = "count int, until long"
#: The same of a bucket of users, as columns.
STATES = "users array<string>, counts array<int>, untils array<long>"
_NO_ID = -(1 << 63)
#: Messages of a bucket that wait together.
PARCEL = 16_384
#: Buckets of users in a stream with a delay. A checkpoint goes on with the number it began with.
BUCKETS = 512


def folded(df: DataFrame, keys: Sequence[str], ts: str, event_id: str) -> list[Column]:
    """``key``, ``id`` and ``us`` as stateful processors can take them.

    Processors see pandas frames, where a NULL makes whole numbers floats and breaks
    groups, and names may not begin with an underscore. So the keys are one JSON
    text, which is never NULL, and a whole-numbered id that is NULL has a stand-in.
    """
    whole = isinstance(df.schema[event_id].dataType, T.IntegralType)
    number = F.coalesce(F.col(event_id).cast("long"), F.lit(_NO_ID)) if whole else F.col(event_id).cast("string")
    return [F.to_json(F.struct(*keys)).alias("key"), number.alias("id"), micros(F.col(ts)).alias("us")]


def unfolded(schema: T.StructType, keys: Sequence[str], ts: str, event_id: str) -> list[Column]:
    """Keys, id and time as columns again."""
    kind = T.StructType([T.StructField(k, schema[k].dataType) for k in keys])
    whole = isinstance(schema[event_id].dataType, T.IntegralType)
    number = F.when(F.col("id") != _NO_ID, F.col("id")) if whole else F.col("id")
    return [*[F.from_json("key", kind)[k].alias(k) for k in keys],
            number.cast(schema[event_id].dataType).alias(event_id), F.timestamp_micros("us").alias(ts)]


def sorted_rows(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """A user's part of a micro-batch, in order of (time, id)."""
    return pd.concat(list(parts), ignore_index=True).sort_values(["us", "id"], kind="stable", ignore_index=True, na_position="first")


def played(key: str, rows: pd.DataFrame, count: int, until: int, rules: Rules) -> tuple[pd.DataFrame, tuple[int, int]]:
    """Rows in order through the machine: their actions, and the state afterwards."""
    action, counts, ends, state = machine.play(
        rows["us"].to_numpy(np.int64), rows["toxic"].to_numpy(bool), rows["rejoin"].to_numpy(bool), count, until, rules)
    return pd.DataFrame({"key": key, "id": rows["id"].to_numpy(), "us": rows["us"].to_numpy(),
                         "action": machine.ACTIONS[action], "strikes": counts, "end": ends}), state


class StrikesOnArrival(StatefulProcessor):
    """Each micro-batch on top of the state that the last one left."""

    def __init__(self, rules: Rules) -> None:
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("strikes", STATE)

    def close(self) -> None:
        pass

    def keep(self, before: tuple[int, int], after: tuple[int, int]) -> None:
        if after == (0, NEVER):
            if before != after:
                self.state.clear()
        elif before != after:
            self.state.update(after)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.state.get() if self.state.exists() else (0, NEVER)
        out, after = played(key[0], sorted_rows(rows), *before, self.rules)
        self.keep(tuple(before), after)
        yield out


class StrikesInTime(StatefulProcessor):
    """Messages wait until the watermark has passed their slot of time.

    A group is a bucket of users, named by the column ``key`` (one user, without it). Its
    messages wait in parcels of Arrow bytes, each under its first slot: what a micro-batch
    brings, in order of time, in pieces of ``PARCEL`` messages. A group has one timer, at
    the end of the first slot that waits. When it rings, all parcels that have begun to
    settle are read together, the settled messages of all users are played at once, and
    the rest is put back; later parcels are not touched. So the calls to the state
    follow groups and micro-batches, not users, slots or messages.
    """

    def __init__(self, rules: Rules, id_type: str, slot_ms: int) -> None:
        self.rules, self.slot_ms = rules, slot_ms
        self.kept = pa.schema([("key", pa.string()), ("id", pa.string() if id_type == "string" else pa.int64()), ("us", pa.int64()),
                               ("toxic", pa.bool_()), ("rejoin", pa.bool_()), ("arrival", pa.int64())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("strikes", STATES)
        self.waiting = handle.getMapState("waiting", "parcel long", "rows binary")
        self.index = handle.getValueState("index", "slots array<long>, parcels array<long>, next long, timer long")

    def close(self) -> None:
        pass

    def known(self) -> tuple[list[int], list[int], int, int]:
        """First slots and numbers of the parcels, the next number, and the timer that is set (NEVER: none)."""
        found = self.index.get()
        return (list(found[0]), list(found[1]), found[2], found[3]) if found else ([], [], 0, NEVER)

    def brought(self, user: str, rows: pd.DataFrame, next_: int) -> pa.RecordBatch:
        """A frame as Arrow columns; numbers only grow, so they keep the order of arrival."""
        users = rows["key"] if "key" in rows else [user] * len(rows)
        columns = [users, rows["id"], rows["us"], rows["toxic"], rows["rejoin"], np.arange(next_, next_ + len(rows))]
        return pa.record_batch([pa.array(c, f.type, from_pandas=True) for c, f in zip(columns, self.kept, strict=True)], schema=self.kept)

    def put(self, rows: pa.Table, slots: list[int], parcels: list[int], next_: int) -> int:
        """Rows into parcels, in order of time; gives the next free number."""
        rows = rows.take(np.argsort(rows["us"].to_numpy(), kind="stable")).combine_chunks()
        for part in rows.to_batches(max_chunksize=PARCEL):
            self.waiting.updateValue((next_,), (part.serialize().to_pybytes(),))
            slots.append(part["us"][0].as_py() // (1000 * self.slot_ms))
            parcels.append(next_)
            next_ += 1
        return next_

    def taken(self, parcels: list[int]) -> pa.Table:
        """Rows of parcels, which wait no longer."""
        found = [pa.ipc.read_record_batch(pa.py_buffer(self.waiting.getValue((n,))[0]), self.kept) for n in parcels]
        for n in parcels:
            self.waiting.removeKey((n,))
        return pa.Table.from_batches(found).combine_chunks()

    def settle(self, slots: list[int], parcels: list[int], next_: int, until: int) -> None:
        """Writes the index down, with the timer for the first slot or the end of the first mute."""
        ends = [(min(slots) + 1) * self.slot_ms] if slots else []
        if until != NEVER:
            ends.append((until // (1000 * self.slot_ms) + 1) * self.slot_ms)
        if ends:
            self.handle.registerTimer(min(ends))
            self.index.update((slots, parcels, next_, min(ends)))
        else:
            self.index.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slots, parcels, next_, timer = self.known()
        parts = []
        for frame in rows:
            parts.append(self.brought(key[0], frame, next_))
            next_ += len(frame)
        first = len(slots)
        next_ = self.put(pa.Table.from_batches(parts), slots, parcels, next_)
        end = (min(slots[first:]) + 1) * self.slot_ms
        if timer == NEVER or end < timer:
            if timer != NEVER:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(end)
            timer = end
        self.index.update((slots, parcels, next_, timer))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rang = expiredTimerInfo.getExpiryTimeInMs()
        slots, parcels, next_, timer = self.known()
        if timer != rang:
            return
        # All slots that end by the watermark; a message still to come is behind it.
        passed = max(rang, timerValues.getCurrentWatermarkInMs()) // self.slot_ms
        border = 1000 * passed * self.slot_ms
        before = {user: (count, until) for user, count, until in zip(*(self.state.get() or ((), (), ())), strict=True)}
        states = dict(before)
        due = [n for s, n in zip(slots, parcels, strict=True) if s < passed]
        if due:
            rows = self.taken(due)
            kept = [(s, n) for s, n in zip(slots, parcels, strict=True) if s >= passed]
            slots, parcels = [s for s, _ in kept], [n for _, n in kept]
            settled = rows["us"].to_numpy() < border
            yield from self.played(rows.filter(settled).combine_chunks(), states)
            next_ = self.put(rows.filter(~settled), slots, parcels, next_)
        # Nothing is kept for users without strikes, and whose mute is over for all that can still come.
        states = {user: x for user, x in states.items() if x != (0, NEVER) and (x[1] == NEVER or x[1] > border)}
        if not states and before:
            self.state.clear()
        elif states != before:
            self.state.update((list(states), [c for c, _ in states.values()], [u for _, u in states.values()]))
        self.settle(slots, parcels, next_, min((u for _, u in states.values() if u != NEVER), default=NEVER))    # the timer that rang is gone

    def played(self, rows: pa.Table, states: dict[str, tuple[int, int]]) -> Iterator[pd.DataFrame]:
        """Settled rows in order through the machine; ``states`` is brought up to date."""
        keys = rows["key"].chunk(0).dictionary_encode()
        at, users = keys.indices.to_numpy(), keys.dictionary.to_pylist()
        us, ids = rows["us"].to_numpy(), rows["id"].to_numpy()
        rank = pd.factorize(ids, sort=True)[0] if ids.dtype == object else ids    # NULL comes first
        order = np.lexsort((rows["arrival"].to_numpy(), rank, us, at))
        at, us, ids = at[order], us[order], ids[order]
        entry = [states.get(user, (0, NEVER)) for user in users]
        counts, ends = np.array([c for c, _ in entry], np.int32), np.array([u for _, u in entry], np.int64)
        action, strikes, end = machine.play_users(at, us, rows["toxic"].to_numpy()[order], rows["rejoin"].to_numpy()[order], counts, ends, self.rules)
        states.update(zip(users, zip(counts.tolist(), ends.tolist(), strict=True), strict=True))
        names = np.array(users, dtype=object)
        for k in range(0, len(at), PARCEL):
            part = slice(k, k + PARCEL)
            yield pd.DataFrame({"key": names[at[part]], "id": ids[part], "us": us[part], "action": machine.ACTIONS[action[part]],
                                "strikes": strikes[part], "end": end[part]})


def stream_strikes(messages: DataFrame, keys: Sequence[str], ts: str, event_id: str,
                   toxic: Column, rejoin: Column | None = None,
                   config: ModerationConfig = DEFAULTS, delay: str | None = None,
                   slot_seconds: int = 60, buckets: int = BUCKETS) -> DataFrame:
    """Messages with their action, as ``operators.strikes.strike_actions`` gives.

    Without ``delay`` messages count in order of arrival: each micro-batch is
    applied in order of (time, id), on top of the state the last one left. With
    a ``delay`` ("10 minutes") messages wait in the state until the watermark
    has passed their slot of ``slot_seconds`` and are then applied in time order,
    whatever the micro-batches were; Spark drops messages older than the watermark.

    A task holds one user's part of one micro-batch, or with a ``delay`` that of one
    of ``buckets`` groups of users, and what settles of it at once; size micro-batches
    with the source's limits (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). State is
    kept in RocksDB: two numbers per user who has strikes, nothing for the others, and
    the waiting messages in parcels. Users stay in their bucket for as long as a
    checkpoint lives, so ``buckets`` must not change with it; more of them give more tasks
    work at once. Messages without a time are left out. ``ts`` comes back as a timestamp.
    """
    rules = rules_of(config)
    keep_state_on_disk(messages.sparkSession)

    def flag(column):
        return (F.coalesce(column, F.lit(False)) if column is not None else F.lit(False))

    rows = messages.select(*folded(messages, keys, ts, event_id), flag(toxic).alias("toxic"), flag(rejoin).alias("rejoin")).filter("us is not null")
    kind = rows.schema["id"].dataType.simpleString()
    output = f"key string, id {kind}, us long, action string, strikes int, end long"
    if delay is None:
        answered = rows.groupBy("key").transformWithStateInPandas(StrikesOnArrival(rules), output, "Append", "None")
    else:
        timed = rows.withColumn("time", F.timestamp_micros("us")).withWatermark("time", delay)
        answered = timed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")).groupBy("bucket").transformWithStateInPandas(
            StrikesInTime(rules, kind, 1000 * slot_seconds), output, "Append", "EventTime")
    return answered.select(*unfolded(messages.schema, keys, ts, event_id), "action", "strikes", *endings())


def endings() -> list[Column]:
    return [F.when(F.col("end") != NEVER, F.timestamp_micros("end")).alias("muted_until"),
            F.col("action").isin("warn", "final_warning", "mute").alias("remove")]


def stream_status(users: DataFrame, checkpoint: str, keys: Sequence[str], now: Column,
                  config: ModerationConfig = DEFAULTS) -> DataFrame:
    """Where the ``users`` (their keys) stand at ``now``, by the live state of a stream.

    As ``strike_status``, without a replay of messages: one scan of the checkpoint's
    keyed state, as the last finished micro-batch left it, through Spark's state
    source, and a join with the users asked for. The stream may be running. Who has
    no state has no strikes; ``now`` must not be before the last message.
    """
    state = users.sparkSession.read.format("statestore").option("stateVarName", "strikes").load(checkpoint)
    if "users" in state.schema["value"].dataType.names:    # of a stream with a delay: a row for each bucket
        one = F.explode(F.arrays_zip("value.users", "value.counts", "value.untils"))
        state = state.select(one.alias("x")).select(F.col("x.users").alias("key"), F.col("x.counts").alias("strikes"), F.col("x.untils").alias("until"))
    else:
        state = state.select("key.key", F.col("value.count").alias("strikes"), F.col("value.until").alias("until"))
    asked = users.select(*keys).distinct().withColumn("key", F.to_json(F.struct(*keys)))
    found = asked.alias("u").join(state.alias("s"), F.col("u.key") == F.col("s.key"), "left").select(
        *[F.col(f"u.{k}").alias(k) for k in keys], F.coalesce("s.strikes", F.lit(0)).alias("strikes"),
        F.when(F.col("s.until") != NEVER, F.timestamp_micros("s.until")).alias("muted_until"))
    return with_status(found, keys, now, config)


def first_of_repeats(messages: DataFrame, event_id: str, time: str, delay: str) -> DataFrame:
    """Drops messages delivered again within ``delay``; ``time`` is a timestamp."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark([event_id])
