"""Strike replay over a stored table of messages.

Messages of one user must be taken in time order. Normally that is a shuffle
by user and a sort inside each partition, streamed through the strike machine
a batch at a time. A user with very many messages would make one task run far
behind the others, so such users are cut into slices of time by running counts:

1. messages are counted per second, the counts summed up per hour and then within
   the hour, and a slice ends where its count is full,
2. every slice is summarised on its own as a function from the state at its
   start to the state at its end,
3. those functions are chained, ``FAN_IN`` at a time, and the state at the start
   of each slice is handed back down,
4. all slices, and all other users, are replayed in parallel.

The plan is the same whether there are such users or not, and nothing runs before
the result is asked for. The result is the same with or without slices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.config import DEFAULTS, ModerationConfig
from tideguard.functions import strikes as machine
from tideguard.functions.strikes import NEVER, Rules

# A user with more messages than this is cut into slices of about so many: a slice
# ends with the second in which it becomes full.
SLICE_ROWS = 1_000_000
# Summaries chained in one task; its square is the number of slices of a user from
# which the last task of a user gets more than so many.
FAN_IN = 1024
_SECOND_US = 1_000_000
_MINUTE_US = 60 * _SECOND_US
_SPAN = 3_600


def rules_of(config: ModerationConfig) -> Rules:
    return Rules(config.max_strikes, config.mute_minutes * _MINUTE_US)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(us).cast(kind)


def _prepare(df, keys, ts, event_id, toxic, rejoin):
    """Only what the machine needs: keys, id, time, two flags."""
    def flag(column):
        return F.coalesce(column, F.lit(False)) if column is not None else F.lit(False)
    return df.select(*keys, F.col(event_id).alias("__id"), micros(F.col(ts)).alias("__us"),
                     flag(toxic).alias("__toxic"), flag(rejoin).alias("__rejoin"))


def strike_actions(df: DataFrame, keys: Sequence[str], ts: str, event_id: str, toxic: Column,
                   rejoin: Column | None = None, config: ModerationConfig = DEFAULTS,
                   slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Every message with its action, the strikes and the end of a mute after it.

    Order: ``ts``, then ``event_id``. Actions: pass, warn, final_warning, mute,
    muted (ignored), rejoin. ``remove`` tells whether the message is deleted.
    """
    keys = list(keys)
    rules = rules_of(config)
    rows = _prepare(df, keys, ts, event_id, toxic, rejoin)
    crowded = _crowded(rows, keys, slice_rows)
    others = _attach(rows, crowded, keys, "left_anti").withColumns(
        {"__slice": F.lit(0).cast("bigint"), "__count": F.lit(0), "__until": F.lit(NEVER).cast("bigint")})
    played = _replay(others.unionByName(_sliced(rows, keys, rules, slice_rows)), keys, rules)
    kind = df.schema[ts].dataType
    until = F.col("__end")
    return played.select(
        *keys, F.col("__id").alias(event_id),
        from_micros(F.col("__us"), kind).alias(ts), "action", "strikes",
        F.when(until != NEVER, from_micros(until, kind)).alias("muted_until"),
        F.col("action").isin("warn", "final_warning", "mute").alias("remove"))


def _replay(sliced: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """Sort inside partitions, then one pass that keeps a single state."""
    group = [*keys, "__slice"]
    ordered = sliced.repartition(*group).sortWithinPartitions(*group, "__us", "__id")
    schema = T.StructType([
        *[f for f in sliced.schema.fields if f.name in keys], sliced.schema["__id"],
        T.StructField("__us", T.LongType()), T.StructField("action", T.StringType()),
        T.StructField("strikes", T.IntegerType()), T.StructField("__end", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            times = batch["__us"].to_numpy()
            toxic = batch["__toxic"].to_numpy(zero_copy_only=False)
            rejoin = batch["__rejoin"].to_numpy(zero_copy_only=False)
            bounds = _group_starts([batch[g] for g in group])
            parts = []
            for a, b in zip(bounds, [*bounds[1:], batch.num_rows]):
                # Only a batch's first group can go on from the batch before.
                first = tuple(batch[g][a].as_py() for g in group) if a == 0 else None
                if a > 0 or first != here:
                    state = batch["__count"][a].as_py(), batch["__until"][a].as_py()
                *columns, state = machine.play(
                    times[a:b], toxic[a:b], rejoin[a:b], *state, rules)
                parts.append(columns)
            here = tuple(batch[g][bounds[-1]].as_py() for g in group)
            action, counts, ends = (np.concatenate(c) for c in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [*[batch[k] for k in keys], batch["__id"], batch["__us"],
                 pa.array(machine.ACTIONS[action], pa.string()), pa.array(counts, pa.int32()),
                 pa.array(ends, pa.int64())], names=schema.names)

    return ordered.mapInArrow(run, schema)


def _group_starts(columns: list[pa.Array]) -> list[int]:
    """Row numbers at which a new group begins; NULL equals NULL."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[0] = True
    for column in columns:
        left, right = column[:-1], column[1:]
        differ = pc.fill_null(pc.not_equal(left, right), False)
        one_null = pc.not_equal(pc.is_null(left), pc.is_null(right))
        new[1:] |= pc.or_(differ, one_null).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new).tolist()


# --- users with very many messages -------------------------------------------

def _attach(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str,
            also: Sequence[str] = ()) -> DataFrame:
    """Join a table on the keys (NULL matches NULL) and on ``also``; Spark picks the way by its size."""
    on = [*keys, *also]
    renamed = other.select(*[F.col(c).alias(f"__on_{c}") for c in on],
                           *[c for c in other.columns if c not in on])
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__on_{c}"))
    return rows.join(renamed, condition, how).drop(*[f"__on_{c}" for c in on])


def _crowded(rows: DataFrame, keys: list[str], slice_rows: int) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > slice_rows).select(*keys)


def _second() -> Column:
    return F.floor(F.col("__us") / _SECOND_US)


def slice_units(rows: DataFrame, keys: list[str], slice_rows: int) -> DataFrame:
    """(keys, __second, __slice): the slice of every second in which a crowded user has messages.

    ``__slice`` is the count of messages before the second over ``slice_rows``, so a
    user has at most rows / slice_rows + 1 slices, however time is filled. The running
    count is a sum over hours and one within the hour: no window holds more rows
    than a user has hours, or an hour seconds.
    """
    per_second = (_attach(rows, _crowded(rows, keys, slice_rows), keys, "left_semi")
                  .groupBy(*keys, _second().alias("__second")).agg(F.count("*").alias("n"))
                  .withColumn("__span", F.floor(F.col("__second") / _SPAN)))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    spans = (per_second.groupBy(*keys, "__span").agg(F.sum("n").alias("n"))
             .withColumn("__base", F.coalesce(F.sum("n").over(earlier(Window.partitionBy(*keys).orderBy("__span"))), F.lit(0))).drop("n"))
    within = F.coalesce(F.sum("n").over(earlier(Window.partitionBy(*keys, "__span").orderBy("__second"))), F.lit(0))
    counted = _attach(per_second.withColumn("__within", within), spans, keys, "inner", also=["__span"])
    return counted.select(*keys, "__second", F.floor((F.col("__base") + F.col("__within")) / slice_rows).alias("__slice"))


def _sliced(rows: DataFrame, keys: list[str], rules: Rules, slice_rows: int) -> DataFrame:
    """The rows of crowded users with ``__slice`` and the state at the slice's start."""
    units = slice_units(rows, keys, slice_rows)
    entries = _entries(rows, units, keys, rules)
    states = _attach(units, entries, keys, "inner", also=["__slice"])
    return _attach(rows.withColumn("__second", _second()), states, keys, "inner", also=["__second"]).drop("__second")


def _entries(rows: DataFrame, units: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """(keys, __slice, __count, __until): the state in which every slice begins."""
    key_fields = [rows.schema[k] for k in keys]
    summary_schema = T.StructType([
        *key_fields, T.StructField("__slice", T.LongType()),
        T.StructField("__start", T.LongType()), T.StructField("kind", T.IntegerType()),
        T.StructField("upto", T.LongType()), T.StructField("count", T.IntegerType()),
        T.StructField("until", T.LongType())])
    entry_schema = T.StructType([
        *key_fields, T.StructField("__slice", T.LongType()),
        T.StructField("__count", T.IntegerType()), T.StructField("__until", T.LongType())])

    def frame(like, key_values, number, start, table):
        """A summary table as rows of ``summary_schema``."""
        out = pd.DataFrame(dict(zip(("kind", "upto", "count", "until"), table)))
        for name, value in zip(keys, key_values):
            out[name] = pd.Series([value] * len(out), dtype=like[name].dtype, index=out.index)
        return out.assign(__slice=number, __start=start)[summary_schema.names]

    def tables(pdf):
        """(slice, start, summary table) per slice, in order."""
        for number, part in pdf.groupby("__slice", sort=True):
            counts = part[part["kind"] >= 0].sort_values("kind")
            steps = part[part["kind"] < 0].sort_values("upto")
            part = pd.concat([counts, steps])
            yield number, int(part["__start"].iloc[0]), tuple(
                part[c].to_numpy() for c in ("kind", "upto", "count", "until"))

    # One summary per slice, from the rows that can change a state, and from a
    # marker row at the slice's first second, as a slice may have no others.
    columns = [*keys, "__slice", "__us", "__id", "__rejoin", "__marker"]
    deciding = _attach(rows.filter("__toxic OR __rejoin").withColumn("__second", _second()), units, keys, "inner", also=["__second"])
    markers = units.groupBy(*keys, "__slice").agg((F.min("__second") * _SECOND_US).alias("__us")).withColumns({
        "__rejoin": F.lit(False), "__id": F.lit(None).cast(rows.schema["__id"].dataType), "__marker": F.lit(True)})

    def summarise(group, pdf):
        start = int(pdf.loc[pdf["__marker"], "__us"].iloc[0])
        found = pdf[~pdf["__marker"]].sort_values(["__us", "__id"])
        table = machine.summarise(found["__us"].to_numpy(np.int64),
                                  found["__rejoin"].to_numpy(bool), rules, start + rules.mute_us)
        return frame(pdf, group[:-1], group[-1], start, table)

    summaries = (deciding.withColumn("__marker", F.lit(False)).select(*columns).unionByName(markers.select(*columns))
                 .groupBy(*keys, "__slice").applyInPandas(summarise, summary_schema))

    # Summaries are chained, and the state at the start of each is handed down.
    def chain(group, pdf):
        pieces = list(tables(pdf))
        start = pieces[0][1]
        table = machine.chain([t for *_, t in pieces], rules, start + rules.mute_us)
        return frame(pdf, group[:-1], group[-1], start, table)

    def follow(group, pdf, counts, ends):
        out = []
        for number, _, table in tables(pdf):
            out.append((*group, number, int(counts[0]), int(ends[0])))
            counts, ends = machine.follow(table, counts, ends)
        return pd.DataFrame(out, columns=entry_schema.names)

    def first(group, pdf):
        return follow(group, pdf, np.array([0], np.int32), np.array([NEVER], np.int64))

    def descend(group, pdf, entry):
        return follow(group[:-1], pdf, entry["__count"].to_numpy(np.int32), entry["__until"].to_numpy(np.int64))

    parent = F.floor(F.col("__slice") / FAN_IN).alias("__parent")
    chained = summaries.groupBy(*keys, parent).applyInPandas(chain, summary_schema)
    above = chained.groupBy(*keys).applyInPandas(first, entry_schema).withColumnRenamed("__slice", "__parent")
    return (summaries.groupBy(*keys, parent).cogroup(above.groupBy(*keys, "__parent"))
            .applyInPandas(descend, entry_schema))


def strike_status(actions: DataFrame, keys: Sequence[str], ts: str, event_id: str, now: Column,
                  config: ModerationConfig = DEFAULTS) -> DataFrame:
    """Where every user stands at ``now``: none, warned, muted or expired.

    The last row per user is a max over (time, id), which combines map-side.
    """
    last = (actions.filter(F.col(ts) <= now).groupBy(*keys)
            .agg(F.max_by(F.struct("strikes", "muted_until"), F.struct(ts, event_id)).alias("s"))
            .select(*keys, "s.*"))
    return with_status(last, keys, now, config)


def with_status(last: DataFrame, keys: Sequence[str], now: Column, config: ModerationConfig) -> DataFrame:
    """(keys, strikes, muted_until) put into words at ``now``."""
    left_us = micros(F.col("muted_until")) - micros(now)
    full = F.col("strikes") >= config.max_strikes
    status = (F.when(F.col("strikes") == 0, "none").when(~full, "warned")
              .when(left_us > 0, "muted").otherwise("expired"))
    return last.withColumn("status", status).select(
        *keys, "strikes", "status",
        F.when(F.col("status") == "warned", config.max_strikes - F.col("strikes"))
        .alias("remaining"),
        F.when(F.col("status") == "muted", (F.floor(left_us / _MINUTE_US) + 1).cast("int"))
        .alias("minutes_left"))


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))
