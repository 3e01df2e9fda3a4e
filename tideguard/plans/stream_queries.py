"""Catalogue entries on strikes and streams."""

from __future__ import annotations

import datetime
import math

import numpy as np
from pyspark.sql import functions as F

from tideguard.config import DEFAULT_LEXICON, LABELS, LEXICON_LABELS, LEXICON_MARK, THRESHOLDS
from tideguard.functions.text import model_tokens
from tideguard.operators import features, scoring, strikes
from tideguard.operators.responses import flatten_response
from tideguard.plans import sql_parts as sql
from tideguard.plans.fixtures import table
from tideguard.plans.text_queries import _term_weight
from tideguard.session import fresh_path, materialise
from tideguard.streaming import online
from tideguard.streaming import scoring as stream_scoring
from tideguard.streaming import strikes as strike_stream

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _toxic():
    return F.col("event_type") == "error"


def _rejoin():
    return F.col("event_type") == "signup"


def _actions(spark, sf_dir, rejoin=None):
    return strikes.strike_actions(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id",
                                  _toxic(), rejoin)


def _shown(actions):
    return actions.select("user_id", "event_id", "action", "strikes", "remove",
                          F.date_format("muted_until", TIME_FORMAT).alias("muted_until"))


def batch_strikes(spark, sf_dir):
    return _shown(_actions(spark, sf_dir))


def strikes_with_rejoin(spark, sf_dir):
    return _shown(_actions(spark, sf_dir, _rejoin()))


# Fixed values of the crowded fixture: one event in CROWD belongs to user -1, who is cut
# into slices of SLICE messages.
CROWD, SLICE = 3, 200


def batch_strikes_sliced(spark, sf_dir):
    """Strikes where one user has a third of all events and is replayed in slices."""
    user = F.when(F.col("event_id") % CROWD == 0, -1).otherwise(F.col("user_id"))
    events = table(spark, sf_dir, "events").withColumn("user_id", user)
    return _shown(strikes.strike_actions(events, ["user_id"], "ts", "event_id", _toxic(), _rejoin(), slice_rows=SLICE))


def strike_action_counts(spark, sf_dir):
    return strikes.action_counts(_actions(spark, sf_dir))


def strike_status(spark, sf_dir):
    """Where everybody stands at the time of the last event."""
    now = table(spark, sf_dir, "events").agg(F.max("ts").alias("now")).scalar()
    return strikes.strike_status(_actions(spark, sf_dir), ["user_id"], "ts", "event_id", now)


def _to_the_end(spark, answers, out):
    """Plays a stream until its source has no more, and reads what it has written."""
    (answers.writeStream.format("parquet").option("path", f"{out}/actions")
     .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{out}/actions")


def _played_events(spark, sf_dir):
    """The events as a stream, played to its end: actions, and the folder of the stream."""
    schema = table(spark, sf_dir, "events").schema
    events = stream_scoring.read_table_stream(spark, sf_dir, "events", schema)
    out = fresh_path(spark, "strike-stream")
    return _to_the_end(spark, strike_stream.stream_strikes(events, ["user_id"], "ts", "event_id", _toxic()), out), out


def stream_strikes(spark, sf_dir):
    return _shown(_played_events(spark, sf_dir)[0])


def stream_status(spark, sf_dir):
    """Where everybody stands at the time of the last event, read from the state of the stream."""
    _, out = _played_events(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now")).scalar()
    return strike_stream.stream_status(events.select("user_id"), f"{out}/checkpoint", ["user_id"], now)


# Events arrive up to LATE_HOURS late, in so many micro-batches.
LATE_HOURS, ARRIVALS = 12, 5
#: Events in a file of a micro-batch, about; each file can be written and read by a task of its own.
FILE_EVENTS = 500_000


def _arrivals(spark, sf_dir, batches):
    """The events as a stream that brings them late and out of order, then a last message that settles all."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    hours = F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000 + F.pmod(F.col("event_id") * 37, F.lit(LATE_HOURS))
    bounds = events.agg(F.min(hours).alias("a"), F.max(hours).alias("b"), F.max("ts").alias("last"), F.count("*").alias("n")).first()
    width = (bounds["b"] - bounds["a"]) / batches
    files = max(1, math.ceil(bounds["n"] / batches / FILE_EVENTS))
    source = fresh_path(spark, "late-events")

    def written():
        return len(spark.read.schema(events.schema).parquet(source).inputFiles())

    for k in range(batches):  # as many files each, written in the order of arrival, as a stream lists files by their age
        arrives = F.least(F.floor((hours - bounds["a"]) / width), F.lit(batches - 1))
        events.filter(arrives == k).repartition(files, "event_id").write.mode("append").parquet(source)
        for _ in range(written(), (k + 1) * files):  # parts without a row have left no file
            spark.createDataFrame([], events.schema).coalesce(1).write.mode("append").parquet(source)
    late = bounds["last"] + datetime.timedelta(days=30)
    spark.createDataFrame([(-1, late, None, "")], events.schema).coalesce(1).write.mode("append").parquet(source)
    return stream_scoring.read_table_stream(spark, source, "part-", events.schema, files_per_trigger=files)


def stream_strikes_event_time(spark, sf_dir, batches=ARRIVALS):
    """Strikes strictly by time, whatever the micro-batches were that brought the events."""
    arrivals = _arrivals(spark, sf_dir, batches)
    actions = strike_stream.stream_strikes(arrivals, ["user_id"], "ts", "event_id", _toxic(), delay=f"{LATE_HOURS} hours",
                                           slot_seconds=600)
    return _shown(_to_the_end(spark, actions, fresh_path(spark, "event-time-stream")).filter("event_id >= 0"))


def chat_messages(turns):
    """Conversation turns as chat messages, 20 seconds apart, a conversation a minute; system turns are rejoins."""
    return turns.select(
        (F.col("conv_id") % 10).alias("chat_id"), (F.floor(F.col("conv_id") / 10) % 3).alias("user_id"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("message_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("conv_id") * 60 + F.col("turn") * 20).alias("sent"), "text",
        (F.col("role") == "system").alias("rejoined"))


def _word_scores(rows):
    """Probabilities from the weights of the words (the arithmetic of ``_term_weight``)."""
    sums = np.array([[sum((len(w) * (31 + 2 * k) + ord(w[0]) * (7 + k)) % 101 - 50 for w in words) for k in range(len(LABELS))]
                     for words in rows["tokens"]])
    return 1.0 / (1.0 + np.exp(-(sums / 5000.0 - 0.02)))


def online_strikes(spark, sf_dir):
    """Chat messages admitted, checked, scored where nobody is muted, and answered, as one stream."""
    turns = stream_scoring.read_table_stream(spark, sf_dir, "conversations", table(spark, sf_dir, "conversations").schema)
    scorer = online.Scorer({"tokens": model_tokens(F.col("text"))}, _word_scores)
    answers = online.moderate_online(chat_messages(turns), scorer, ["chat_id", "user_id"], "sent", "message_id", rejoin=F.col("rejoined"))
    return _to_the_end(spark, answers, fresh_path(spark, "online-stream")).select(
        "chat_id", "user_id", "message_id", "action", "strikes", "remove", "scored",
        F.array_join("categories", ",").alias("categories"), F.date_format("muted_until", TIME_FORMAT).alias("muted_until"))


def stream_score(spark, sf_dir):
    """Conversation turns and documents as one stream, scored with a weight table."""
    def read(name):
        schema = table(spark, sf_dir, name).schema
        return stream_scoring.read_table_stream(spark, sf_dir, name, schema)

    turns = read("conversations").select(
        F.concat_ws(":", F.lit("turn"), "conv_id", "turn").alias("id"),
        F.col("text").alias("comment_text"))
    documents = read("documents").select(
        F.concat_ws(":", F.lit("doc"), "doc_id").alias("id"), F.col("text").alias("comment_text"))

    vocabulary = features.document_frequency(table(spark, sf_dir, "documents").select(
        model_tokens(F.col("text")).alias("tokens")))
    # Written once, before the stream starts: every micro-batch reads the table.
    weights = materialise(vocabulary.withColumns({f"w_{x}": _term_weight(k) for k, x in enumerate(LABELS)}), "stream-weights")

    def scorer(comments):
        counts = features.term_counts(
            comments.select("id", model_tokens(F.col("comment_text")).alias("tokens")),
            keep_empty=True)
        return scoring.linear_scores(counts, weights)

    out = fresh_path(spark, "score-stream")
    stream_scoring.score_stream(turns.unionByName(documents), scorer, out,
                                f"{out}/checkpoint").awaitTermination()
    scored = flatten_response(stream_scoring.answers(spark, out)).select(
        "id", "is_toxic", "flagged_categories", "label", "probability", "flagged", "flagged_by",
        F.lit(None).cast("string").alias("reason"))
    return scored.unionByName(stream_scoring.rejected(spark, out), allowMissingColumns=True)


QUERIES = {
    "batch_strikes": batch_strikes,
    "strikes_with_rejoin": strikes_with_rejoin,
    "batch_strikes_sliced": batch_strikes_sliced,
    "strike_action_counts": strike_action_counts,
    "strike_status": strike_status,
    "stream_strikes": stream_strikes,
    "stream_strikes_event_time": stream_strikes_event_time,
    "stream_status": stream_status,
    "online_strikes": online_strikes,
    "stream_score": stream_score,
}


def _machine(rejoin: bool) -> str:
    """The strike machine on the events."""
    return "WITH RECURSIVE " + _steps(f"""SELECT event_id, user_id, ts, event_type = 'error' AS toxic,
  {"event_type = 'signup'" if rejoin else "false"} AS rejoin FROM events""")


def _steps(messages: str) -> str:
    """The strike machine one message at a time, by recursion over the row number."""
    expired = "s.muted_until IS NOT NULL AND m.ts >= s.muted_until"
    return f"""m AS (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ({messages})),
a AS (SELECT DISTINCT user_id, 0::BIGINT AS rn, CAST(NULL AS BIGINT) AS event_id,
  CAST(NULL AS TIMESTAMP) AS ts, '' AS action, 0 AS strikes,
  CAST(NULL AS TIMESTAMP) AS muted_until FROM m
UNION ALL
SELECT user_id, rn, event_id, ts,
  CASE WHEN rejoin THEN 'rejoin' WHEN held IS NOT NULL THEN 'muted' WHEN NOT toxic THEN 'pass'
    WHEN had + 1 >= 3 THEN 'mute' WHEN had + 1 = 2 THEN 'final_warning' ELSE 'warn' END,
  CASE WHEN rejoin THEN 0 WHEN held IS NOT NULL OR NOT toxic THEN had ELSE had + 1 END,
  CASE WHEN rejoin THEN NULL WHEN held IS NOT NULL THEN held
    WHEN toxic AND had + 1 >= 3 THEN ts + INTERVAL 30 MINUTE END
FROM (SELECT m.*, CASE WHEN {expired} THEN 0 ELSE s.strikes END AS had,
  CASE WHEN {expired} THEN NULL ELSE s.muted_until END AS held
  FROM a s JOIN m ON m.user_id = s.user_id AND m.rn = s.rn + 1)),
act AS (SELECT * FROM a WHERE rn > 0)
"""


_SHOWN = """SELECT user_id, event_id, action, strikes,
  action IN ('warn', 'final_warning', 'mute') AS remove,
  strftime(muted_until, '%Y-%m-%d %H:%M:%S.%f') AS muted_until FROM act"""
_STREAM_TEXT = """M AS (SELECT 'turn:' || conv_id || ':' || turn AS id, text FROM conversations
UNION ALL SELECT 'doc:' || doc_id, text FROM documents),
K AS (SELECT id, text, CASE WHEN text IS NULL THEN 'missing'
  WHEN trim(text, E' \\t\\n\\x0b\\f\\r') = '' THEN 'empty'
  WHEN length(trim(text, E' \\t\\n\\x0b\\f\\r')) > 5000 THEN 'too_long' END AS reason FROM M),
A AS (SELECT id, """ + sql.model_words("text") + """ AS tokens FROM K WHERE reason IS NULL),
Y AS (SELECT DISTINCT unnest(""" + sql.model_words("text") + """) AS term FROM documents),
X AS (SELECT id, unnest(tokens) AS term FROM A),
Z AS (SELECT id, """ + ", ".join(
    f"sum(((length(term) * {31 + 2 * k} + ascii(term) * {7 + k}) % 101 - 50)"
    f" / 5000.0::DOUBLE) AS z_{x}" for k, x in enumerate(LABELS)) + """
  FROM X JOIN Y USING (term) GROUP BY id),
Q AS (SELECT A.id, """ + sql.each_label(
    "1.0 / (1.0 + exp(-coalesce(z_{L}, 0.0::DOUBLE))) AS prob_{L}") + """
  FROM A LEFT JOIN Z ON A.id = Z.id),
H AS (SELECT DISTINCT id FROM (SELECT id,
  unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}_]+')) AS word FROM K)
  WHERE word IN (""" + ", ".join(f"'{w}'" for w in DEFAULT_LEXICON) + """)),
G AS (SELECT *, """ + ", ".join(
        (f"(prob_{x} >= {t} OR id IN (SELECT id FROM H)) AS flag_{x}, CASE WHEN prob_{x} < {t} "
         f"AND id IN (SELECT id FROM H) THEN '{LEXICON_MARK}' END AS by_{x}") if x in LEXICON_LABELS
        else f"prob_{x} >= {t} AS flag_{x}, CAST(NULL AS VARCHAR) AS by_{x}"
        for x, t in THRESHOLDS.items()) + " FROM Q)\n"

_STATUS = _machine(False) + """, l AS (SELECT * FROM act
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1),
t AS (SELECT *, (SELECT max(ts) FROM events) AS now FROM l),
u AS (SELECT *, CASE WHEN strikes = 0 THEN 'none' WHEN strikes < 3 THEN 'warned'
  WHEN now < muted_until THEN 'muted' ELSE 'expired' END AS status FROM t)
SELECT user_id, strikes, status, CASE WHEN status = 'warned' THEN 3 - strikes END AS remaining,
  CASE WHEN status = 'muted' THEN
    CAST(floor(date_diff('microsecond', now, muted_until) / 60000000.0) + 1 AS INTEGER)
  END AS minutes_left FROM u"""

_CHAT = """WITH RECURSIVE N AS (SELECT conv_id % 10 AS chat_id, (conv_id // 10) % 3 AS member, conv_id * 100 + turn AS event_id,
  TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn * 20) AS ts, role = 'system' AS rejoin, text,
  trim(text, E' \\t\\n\\x0b\\f\\r') AS stripped FROM conversations),
K AS (SELECT *, coalesce(length(stripped) BETWEEN 1 AND 5000, false) AND NOT rejoin AS ok FROM N
  WHERE rejoin OR (text IS NOT NULL AND stripped <> '' AND NOT starts_with(text, '/'))),
W AS (SELECT event_id, """ + sql.model_words("text") + """ AS tokens FROM K WHERE ok),
X AS (SELECT event_id, unnest(tokens) AS term FROM W),
Z AS (SELECT event_id, """ + ", ".join(
    f"sum((length(term) * {31 + 2 * k} + ascii(term) * {7 + k}) % 101 - 50) AS s_{x}" for k, x in enumerate(LABELS)) + """
  FROM X GROUP BY event_id),
H AS (SELECT DISTINCT event_id FROM (SELECT event_id,
  unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}_]+')) AS word FROM K)
  WHERE word IN (""" + ", ".join(f"'{w}'" for w in DEFAULT_LEXICON) + """)),
G AS (SELECT K.*, """ + ", ".join(
    f"ok AND (1.0 / (1.0 + exp(-(coalesce(s_{x}, 0) / 5000.0::DOUBLE - 0.02::DOUBLE))) >= {t}"
    + (" OR event_id IN (SELECT event_id FROM H)" if x in LEXICON_LABELS else "") + f") AS flag_{x}"
    for x, t in THRESHOLDS.items()) + """ FROM K LEFT JOIN Z USING (event_id)),
""" + _steps("SELECT event_id, chat_id * 10 + member AS user_id, ts, (" + " OR ".join(f"flag_{x}" for x in LABELS)
             + ") AS toxic, rejoin FROM G") + """SELECT chat_id, member AS user_id, act.event_id AS message_id, action, strikes,
  action IN ('warn', 'final_warning', 'mute') AS remove, ok AND action <> 'muted' AS scored,
  CASE WHEN ok AND action <> 'muted' THEN concat_ws(',', """ + sql.each_label("CASE WHEN flag_{L} THEN '{L}' END") + """) END AS categories,
  strftime(muted_until, '%Y-%m-%d %H:%M:%S.%f') AS muted_until FROM act JOIN G ON G.event_id = act.event_id"""

ORACLES = {
    "stream_strikes_event_time": _machine(False) + _SHOWN,
    "stream_status": _STATUS,
    "online_strikes": _CHAT,
    "batch_strikes_sliced": "WITH RECURSIVE " + _steps(f"""SELECT event_id, CASE WHEN event_id % {CROWD} = 0 THEN -1 ELSE user_id END AS user_id,
  ts, event_type = 'error' AS toxic, event_type = 'signup' AS rejoin FROM events""") + _SHOWN,
    "batch_strikes": _machine(False) + _SHOWN,
    "stream_strikes": _machine(False) + _SHOWN,
    "strikes_with_rejoin": _machine(True) + _SHOWN,
    "strike_action_counts": _machine(False)
    + "SELECT action, count(*) AS n FROM act GROUP BY action",
    "strike_status": _STATUS,
    "stream_score": "WITH " + _STREAM_TEXT + sql.per_label(
        "id, CAST(NULL AS VARCHAR) AS reason, concat_ws(',', " + sql.each_label(
            "CASE WHEN flag_{L} THEN '{L}' END")+ """)
  AS flagged_categories, (""" + " OR ".join(f"flag_{x}" for x in LABELS) + """) AS is_toxic,
  round(prob_{L} * 100, 2) AS probability, flag_{L} AS flagged, by_{L} AS flagged_by""", "G") + """
UNION ALL SELECT NULL, id, reason, NULL, NULL, NULL, NULL, NULL FROM K WHERE reason IS NOT NULL""",
}
