"""The online job: messages are admitted, checked, scored and given their strikes.

``moderate`` scores row by row inside the plan, before the state is known.
``moderate_online`` asks the state first: a muted user's messages cost no score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideguard.config import DEFAULT_LEXICON, DEFAULTS, LEXICON_LABELS, ModerationConfig
from tideguard.functions import strikes as machine
from tideguard.functions.scoring import apply_thresholds
from tideguard.functions.strikes import FINAL, MUTE, MUTED, NEVER, REJOIN, WARN, Rules
from tideguard.operators.filters import admit_messages, lexicon_hit, override_by_lexicon, validate_comments
from tideguard.operators.strikes import rules_of
from tideguard.session import keep_state_on_disk
from tideguard.streaming.strikes import STATE, endings, folded, sorted_rows, stream_strikes, unfolded


def judge(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame], text: str = "text",
          config: ModerationConfig = DEFAULTS, lexicon: Sequence[str] = DEFAULT_LEXICON) -> DataFrame:
    """Admitted messages with ``toxic``: does a model or the lexicon flag a label?

    ``scorer`` adds the ``prob_L`` columns row by row (``PipelineModel.transform``,
    or column expressions), from ``comment_text``. Commands and blank messages
    are left out. A message that may not be scored (too long), and one whose
    scores are NULL because scoring failed, passes as not toxic. Works on a
    table and on a stream, without a shuffle.
    """
    admitted = admit_messages(messages, text).withColumn("comment_text", F.col(text))
    checked = validate_comments(admitted, config=config)
    flags = override_by_lexicon(apply_thresholds(scorer(checked), config),
                                lexicon_hit(F.col("comment_text"), lexicon))
    flagged = F.lit(False)
    for label in config.labels:
        flagged = flagged | F.coalesce(F.col(f"flag_{label}"), F.lit(False))
    return flags.select(*messages.columns, (F.col("accepted") & flagged).alias("toxic"))


def moderate(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame], keys: Sequence[str], ts: str,
             event_id: str, text: str = "text", config: ModerationConfig = DEFAULTS,
             lexicon: Sequence[str] = DEFAULT_LEXICON, delay: str | None = None) -> DataFrame:
    """The streaming answer to every admitted message, as ``stream_strikes`` gives it.

    One query from source to sink: a message of a muted user gets the action
    "muted" whatever its score is. Its score is computed all the same, as the
    state is known only behind the shuffle by user: for cheap scorers, or with a
    ``delay``. ``moderate_online`` has the other way. Size micro-batches with the
    source's limits (see ``stream_strikes``).
    """
    judged = judge(messages, scorer, text, config, lexicon)
    return stream_strikes(judged, keys, ts, event_id, F.col("toxic"), config=config, delay=delay)


@dataclass(frozen=True)
class Scorer:
    """A model that scores rows where the state is.

    ``inputs`` are computed inside the plan (cleaned tokens, hashed features) and
    arrive as columns of a pandas frame; ``score`` returns a probability for each
    row and label. A row of NaN says that scoring it failed.
    """

    inputs: Mapping[str, Column]
    score: Callable[[pd.DataFrame], np.ndarray]


def linear_scorer(heads: Mapping[str, object], vector: str = "features") -> Scorer:
    """Fitted binary regressions, in the order of the labels, on a sparse or dense vector column.

    The coefficients travel with the job; for hashed features their number is fixed.
    """
    weights = np.array([head.coefficients.toArray() for head in heads.values()]).T
    starts = np.array([head.intercept for head in heads.values()])
    stored = F.unwrap_udt(F.col(vector))
    # A dense vector stores no indices.
    inputs = {"indices": F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(stored["values"]) - 1)), "values": stored["values"]}

    def score(rows: pd.DataFrame) -> np.ndarray:
        out = np.empty((len(rows), len(starts)))
        for i, (at, values) in enumerate(zip(rows["indices"], rows["values"], strict=True)):
            out[i] = np.asarray(values) @ weights[np.asarray(at, dtype=np.int64)] if len(at) else 0.0
        return 1.0 / (1.0 + np.exp(-(out + starts)))

    return Scorer(inputs, score)


class OnlineStrikes(StatefulProcessor):
    """Strikes of one user, with scores for the messages that are not muted.

    A user with c strikes cannot be muted before the next (limit - c) messages
    have been scored, so these are scored together, then the next ones: with
    ``ahead`` 1 no muted message is ever scored. A larger ``ahead`` scores so many
    messages at a time, some of them for nothing, for models that need batches.
    """

    def __init__(self, scorer: Scorer, rules: Rules, config: ModerationConfig, ahead: int) -> None:
        self.score, self.inputs, self.rules, self.ahead = scorer.score, list(scorer.inputs), rules, ahead
        self.labels = np.array(config.labels, dtype=object)
        self.limits = np.array([config.thresholds[x] for x in config.labels])
        self.by_word = np.array([x in LEXICON_LABELS for x in config.labels])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("strikes", STATE)

    def close(self) -> None:
        pass

    def flags(self, rows: pd.DataFrame) -> np.ndarray:
        """Which labels each row has, by the model or by the lexicon."""
        scores = np.asarray(self.score(rows[[f"in_{c}" for c in self.inputs]].set_axis(self.inputs, axis=1)), dtype=np.float64)
        return (scores >= self.limits) | (rows["hit"].to_numpy(bool)[:, None] & self.by_word[None, :])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rows = sorted_rows(rows)
        count, until = self.state.get() if self.state.exists() else (0, NEVER)
        known = (count, until)
        n, times = len(rows), rows["us"].to_numpy(np.int64)
        scorable, resets = np.flatnonzero(rows["ok"].to_numpy(bool)), np.flatnonzero(rows["rejoin"].to_numpy(bool))
        rejoin = rows["rejoin"].to_numpy(bool)
        action, counts, ends = np.zeros(n, np.int8), np.empty(n, np.int32), np.full(n, NEVER, np.int64)
        scored, found = np.zeros(n, bool), np.full(n, None, dtype=object)
        at = 0
        while at < n:
            reset = np.searchsorted(resets, at)
            stop = int(resets[reset]) if reset < len(resets) else n
            if until != NEVER:
                stop = min(stop, at + int(np.searchsorted(times[at:], until)))
                action[at:stop], counts[at:stop], ends[at:stop] = MUTED, count, until
                at = stop
                if at < n:
                    count, until = 0, NEVER
                continue
            if rejoin[at]:
                count, action[at], counts[at], at = 0, REJOIN, 0, at + 1
                continue
            first = np.searchsorted(scorable, at)
            now = scorable[first: first + max(self.rules.max_strikes - count, self.ahead)]
            now = now[now < stop]
            last = int(now[-1]) + 1 if len(now) else stop
            flags = self.flags(rows.iloc[now]) if len(now) else np.zeros((0, len(self.labels)), bool)
            scored[now] = True
            for i, own in zip(now.tolist(), flags, strict=True):
                counts[at:i] = count
                at = i
                found[i] = self.labels[own].tolist()
                if own.any():
                    count += 1
                    action[i] = MUTE if count >= self.rules.max_strikes else FINAL if count == self.rules.max_strikes - 1 else WARN
                    if action[i] == MUTE:
                        until = ends[i] = int(times[i]) + self.rules.mute_us
                counts[i], at = count, i + 1
                if until != NEVER:
                    late = now[now > i]
                    found[late] = None
                    break
            else:
                counts[at:last] = count
                at = last
        if (count, until) != known:
            if (count, until) == (0, NEVER):
                self.state.clear()
            else:
                self.state.update((int(count), int(until)))
        yield pd.DataFrame({"key": key[0], "id": rows["id"].to_numpy(), "us": times, "action": machine.ACTIONS[action], "strikes": counts,
                            "end": ends, "scored": scored, "categories": found})


def moderate_online(messages: DataFrame, scorer: Scorer, keys: Sequence[str], ts: str, event_id: str, text: str = "text",
                    rejoin: Column | None = None, config: ModerationConfig = DEFAULTS,
                    lexicon: Sequence[str] = DEFAULT_LEXICON, ahead: int = 1) -> DataFrame:
    """The streaming answer to every admitted message and every rejoin.

    As ``moderate``, but the state of the user is asked before the scorer:
    messages of a muted user are not scored. ``scored`` tells which were,
    ``categories`` has the labels found (NULL where nothing was scored). A message
    that may not be scored (too long), or whose scores are NaN, passes.

    Messages count in order of arrival, each micro-batch in order of (time, id).
    A task holds one user's part of a micro-batch; the state, in RocksDB, is two
    numbers per user who has strikes, under the name ``strikes`` (``stream_status``
    reads it). NULL keys are a user like others.
    """
    rules = rules_of(config)
    keep_state_on_disk(messages.sparkSession)
    back = F.coalesce(rejoin, F.lit(False)) if rejoin is not None else F.lit(False)
    admitted = admit_messages(messages.withColumn("__back", back), text, F.col("__back")).withColumn("comment_text", F.col(text))
    checked = validate_comments(admitted, config=config)
    rows = checked.select(
        *folded(messages, keys, ts, event_id), F.col("__back").alias("rejoin"), (F.col("accepted") & ~F.col("__back")).alias("ok"),
        F.coalesce(lexicon_hit(F.col(text), lexicon), F.lit(False)).alias("hit"),
        *[c.alias(f"in_{name}") for name, c in scorer.inputs.items()]).filter("us is not null")
    kind = rows.schema["id"].dataType.simpleString()
    answered = rows.groupBy("key").transformWithStateInPandas(
        OnlineStrikes(scorer, rules, config, ahead),
        f"key string, id {kind}, us long, action string, strikes int, end long, scored boolean, categories array<string>", "Append", "None")
    return answered.select(*unfolded(messages.schema, keys, ts, event_id), "action", "strikes", *endings(), "scored", "categories")
