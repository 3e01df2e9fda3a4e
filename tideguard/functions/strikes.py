"""The strike machine of one user, on time-ordered arrays.

State: ``(count, until)``. A toxic message adds a strike; the last allowed
strike mutes until a time. While muted, messages are ignored. The first message
at or after the end of the mute, and any rejoin, start again from zero.
Times are microseconds; ``NEVER`` stands for "not muted".
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NEVER = -1
FOREVER = np.iinfo(np.int64).max
ACTIONS = np.array(["pass", "warn", "final_warning", "mute", "muted", "rejoin"], dtype=object)
PASS, WARN, FINAL, MUTE, MUTED, REJOIN = range(6)


@dataclass(frozen=True)
class Rules:
    max_strikes: int
    mute_us: int


def play(times, toxic, rejoin, count, until, rules):
    """Actions, strike counts and mute ends row by row, and the state afterwards.

    Steps from one deciding row to the next, so the work in Python follows the
    strikes and not the messages.
    """
    n = len(times)
    action = np.zeros(n, np.int8)
    counts = np.empty(n, np.int32)
    ends = np.full(n, NEVER, np.int64)
    deciding = np.flatnonzero(toxic | rejoin)
    resets = np.flatnonzero(rejoin)
    at = 0
    while at < n:
        if until != NEVER:
            reset = np.searchsorted(resets, at)
            stop = at + int(np.searchsorted(times[at:], until))
            if reset < len(resets):
                stop = min(stop, int(resets[reset]))
            action[at:stop] = MUTED
            counts[at:stop] = count
            ends[at:stop] = until
            at = stop
            if at < n:
                count, until = 0, NEVER
            continue
        found = np.searchsorted(deciding, at)
        stop = int(deciding[found]) if found < len(deciding) else n
        counts[at:stop] = count
        if stop == n:
            break
        if rejoin[stop]:
            count, action[stop] = 0, REJOIN
        else:
            count += 1
            if count >= rules.max_strikes:
                until = int(times[stop]) + rules.mute_us
                action[stop] = MUTE
            else:
                action[stop] = FINAL if count == rules.max_strikes - 1 else WARN
        counts[stop], ends[stop] = count, until
        at = stop + 1
    return action, counts, ends, (int(count), int(until))


def play_users(users, times, toxic, rejoin, counts, ends, rules):
    """``play`` for many users at once: rows by user and time, ``users`` the place of each row's user.

    ``counts`` and ``ends`` hold the entry states by place and are overwritten with
    the states afterwards. Python steps over the deciding rows only; the others follow
    from the deciding row before them, as a mute ends by the clock alone.
    """
    deciding = np.flatnonzero(toxic | rejoin)
    acts, had, held = [], [], []
    at, count, until = None, 0, NEVER
    for user, time, back in zip(users[deciding].tolist(), times[deciding].tolist(), rejoin[deciding].tolist(), strict=True):
        if user != at:
            at, count, until = user, int(counts[user]), int(ends[user])
        if until != NEVER and time >= until:
            count, until = 0, NEVER
        if back:
            act, count, until = REJOIN, 0, NEVER
        elif until != NEVER:
            act = MUTED
        else:
            count += 1
            act = MUTE if count >= rules.max_strikes else FINAL if count == rules.max_strikes - 1 else WARN
            if act == MUTE:
                until = time + rules.mute_us
        acts.append(act)
        had.append(count)
        held.append(until)
    strikes, until = counts[users].astype(np.int32), ends[users].astype(np.int64)
    if len(deciding):
        before = np.cumsum(np.bincount(deciding, minlength=len(users))) - 1
        own = (before >= 0) & (users[deciding[before]] == users)
        strikes[own], until[own] = np.array(had, np.int32)[before[own]], np.array(held, np.int64)[before[own]]
    over = (until != NEVER) & (times >= until)
    strikes[over], until[over] = 0, NEVER
    action = np.where(until != NEVER, MUTED, PASS).astype(np.int8)
    action[deciding] = acts
    last = np.flatnonzero(np.append(users[1:] != users[:-1], True)) if len(users) else deciding
    counts[users[last]], ends[users[last]] = strikes[last], until[last]
    return action, strikes, until


def summarise(times, rejoin, rules, last_entry):
    """A stretch of deciding rows as a function from entry to exit state.

    Returns columns (kind, upto, count, until). ``kind`` c >= 0 is the entry
    "c strikes, not muted". ``kind`` -1 rows are steps: an entry muted until T
    leaves like the first row with T <= upto, and unchanged if there is none.
    Nobody enters muted beyond ``last_entry``, so steps after it are left out.
    """
    n, k = len(times), rules.max_strikes
    counts = np.zeros((n + 1, k), np.int32)
    ends = np.full((n + 1, k), NEVER, np.int64)
    counts[n] = np.arange(k)
    after_mute = np.searchsorted(times, times + rules.mute_us)
    reset = n                               # first rejoin after the row at hand
    for i in range(n - 1, -1, -1):
        if rejoin[i]:
            counts[i], ends[i], reset = counts[i + 1, 0], ends[i + 1, 0], i
            continue
        counts[i, :-1], ends[i, :-1] = counts[i + 1, 1:], ends[i + 1, 1:]
        resume = min(int(after_mute[i]), reset)
        if resume < n:
            counts[i, -1], ends[i, -1] = counts[resume, 0], ends[resume, 0]
        else:
            counts[i, -1], ends[i, -1] = k, times[i] + rules.mute_us
    upto = np.append(times[:reset], FOREVER) if reset < n else times
    size = min(len(upto), int(np.searchsorted(upto, last_entry)) + 1)
    return _merge_steps(counts[0], ends[0], upto[:size], counts[:size, 0], ends[:size, 0])


def _merge_steps(entry_counts, entry_ends, upto, counts, ends):
    """Count rows and steps as one table; of equal neighbouring steps the last stays."""
    last = np.ones(len(upto), bool)
    last[:-1] = (counts[1:] != counts[:-1]) | (ends[1:] != ends[:-1])
    k = len(entry_counts)
    return (np.concatenate([np.arange(k), np.full(last.sum(), -1)]).astype(np.int32),
            np.concatenate([np.full(k, NEVER), upto[last]]).astype(np.int64),
            np.concatenate([entry_counts, counts[last]]).astype(np.int32),
            np.concatenate([entry_ends, ends[last]]).astype(np.int64))


def follow(table, counts, ends):
    """Entry states through one summary table, all at once."""
    kind, upto, out_counts, out_ends = table
    k = int((kind >= 0).sum())
    steps = upto[k:]
    step = np.searchsorted(steps, ends)
    muted = ends != NEVER
    hit = np.where(muted, k + step, np.minimum(counts, k - 1))
    same = muted & (step == len(steps))
    hit[same] = 0
    return (np.where(same, counts, out_counts[hit]), np.where(same, ends, out_ends[hit]))


def chain(tables, rules, last_entry):
    """Consecutive summary tables as one."""
    k = rules.max_strikes
    steps = np.unique(np.concatenate([t[1][k:] for t in tables]))
    steps = steps[:int(np.searchsorted(steps, last_entry)) + 1]
    counts = np.concatenate([np.arange(k), np.full(len(steps), k)])
    ends = np.concatenate([np.full(k, NEVER), steps])
    for table in tables:
        counts, ends = follow(table, counts, ends)
    return _merge_steps(counts[:k], ends[:k], steps, counts[k:], ends[k:])
