"""Waiting for a reply until the topic falls silent (JOIN4, STR4).

A reader starts at the end of the reply topic when its request is sent, passes over
the replies to other requests, and gives up once no message at all has come for
``silence_seconds``. So a request ends at its first reply, or at the first silence
after it, however long it has waited by then: each message puts the end off.

Arbitrary stateful processing with event-time timers, keyed by a shard of the UUID:
the state of a shard holds its waiting requests, replies that came before their
request, and the topic's pulse. The pulse is all that a request must know of the other
messages: the first and last message time of every window of ``silence_seconds``. A
gap longer than that can only lie between two windows, so each task sends one row a
window (not a message) to every shard.

A reply that is found is emitted at once: later messages can only close a silence,
never open one. TIMEOUT is emitted when the watermark has passed the silence's end. Of
several replies the earliest of those received by then wins; one dated before its request
was not seen by its reader. State is bounded by the requests that wait, by the
watermark's delay and by the windows since the oldest waiting request.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aerolake.functions.labels import STATUS_OK, STATUS_TIMEOUT

REQUEST, REPLY, PULSE = 0, 1, 2
#: Shards of the state. Each gets the pulse: a row a window and task.
SHARDS = 32
_ROWS = "kind int, UUID string, low long, prediction double, ts timestamp"
_STATE = ("waiting array<string>, since array<long>, reply array<string>, reply_at array<long>, "
          "reply_value array<double>, window array<long>, first array<long>, last array<long>")
RESULT = "UUID string, rq_ts timestamp, status string, prediction double"


def silence_ends(pulse: list[tuple[int, int]], silence: int) -> list[int]:
    """For each (first, last) of the windows in order: when the silence ends that follows it."""
    ends: list[int] = []
    for i in range(len(pulse) - 1, -1, -1):
        broken = i + 1 == len(pulse) or pulse[i + 1][0] - pulse[i][1] > silence
        ends.append(pulse[i][1] + silence if broken else ends[-1])
    return ends[::-1]


def end_of_wait(since: int, pulse: list[tuple[int, int]], lasts: list[int], ends: list[int], silence: int) -> int:
    """When a reader that began at ``since`` gives up, as far as the pulse tells."""
    i = bisect_left(lasts, since)  # the first window with a message from then on
    if i == len(pulse) or pulse[i][0] - since > silence:
        return since + silence
    return ends[i]


def _pulse(silence: int):
    """Message times -> first and last one of each window, once a batch of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            times = rows["ts"].dropna()
            if len(times):
                found = times.groupby(times.astype("datetime64[us]").astype("int64") // silence).agg(["min", "max"])
                yield pd.DataFrame({"kind": PULSE, "UUID": None, "low": found["min"].astype("datetime64[us]").astype("int64"),
                                    "prediction": None, "ts": found["max"]})
    return run


def _shard(silence: int):
    """One shard's step: take in new rows, tell what is settled, set the next timer."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get if state.exists else ([],) * 8
        waiting = list(zip(old[0], old[1]))
        replies: dict[str, list[tuple]] = {}
        for uuid, at, value in zip(old[2], old[3], old[4]):
            replies.setdefault(uuid, []).append((at, value))
        windows = {w: (a, b) for w, a, b in zip(old[5], old[6], old[7])}
        for rows in ([] if state.hasTimedOut else batches):
            at = rows["ts"].astype("datetime64[us]").astype("int64")
            for kind, uuid, low, value, t in zip(rows["kind"], rows["UUID"], rows["low"], rows["prediction"], at):
                if kind == REQUEST:
                    waiting.append((uuid, t))
                elif kind == REPLY:
                    replies.setdefault(uuid, []).append((t, None if pd.isna(value) else float(value)))
                else:
                    a, b = windows.get(t // silence, (t, t))
                    windows[t // silence] = (min(a, int(low)), max(b, t))
        watermark = state.getCurrentWatermarkMs() * 1000
        numbers = sorted(windows)
        pulse = [windows[w] for w in numbers]
        lasts, ends = [b for _, b in pulse], silence_ends(pulse, silence)
        settled, still, timers = [], [], []
        for uuid, since in waiting:
            end = end_of_wait(since, pulse, lasts, ends, silence)
            own = min((r for r in replies.get(uuid, ()) if since <= r[0] <= end), default=None, key=lambda r: (r[0], r[1] is not None, r[1] or 0.0))
            if own is not None:
                settled.append((uuid, since, STATUS_OK, own[1]))
            elif end < watermark:
                settled.append((uuid, since, STATUS_TIMEOUT, None))
            else:
                still.append((uuid, since))
                timers.append(end)
        # A reply is needed while its request can still come, or waits.
        names = {u for u, _ in still}
        kept = [(u, at, v) for u, rs in replies.items() for at, v in rs if u in names or at >= watermark]
        since = min([t for _, t in still] + [watermark])
        numbers = [w for w in numbers if windows[w][1] >= since]
        if still or kept or numbers:
            state.update(([u for u, _ in still], [t for _, t in still], [u for u, _, _ in kept], [a for _, a, _ in kept], [v for _, _, v in kept],
                          numbers, [windows[w][0] for w in numbers], [windows[w][1] for w in numbers]))
            timers += [a for _, a, _ in kept] + [windows[w][1] for w in numbers if not still]
            state.setTimeoutTimestamp(max(min(timers), watermark) // 1000 + 1)
        elif state.exists:
            state.remove()
        if settled:
            frame = pd.DataFrame(settled, columns=["UUID", "rq_ts", "status", "prediction"])
            yield frame.assign(rq_ts=pd.to_datetime(frame["rq_ts"], unit="us"), prediction=frame["prediction"].astype("float64"))
    return run


def await_replies(requests: DataFrame, responses: DataFrame, silence_seconds: int = 20, watermark: str = "5 seconds",
                  shards: int = SHARDS) -> DataFrame:
    """Streams (UUID, rq_ts) and (UUID, rs_ts, prediction) -> one row (UUID, rq_ts, status,
    prediction) for each request: OK with its reply, or TIMEOUT. Rows without a time are left out."""
    silence = silence_seconds * 1_000_000
    asked = requests.where("rq_ts IS NOT NULL AND UUID IS NOT NULL").select(
        F.lit(REQUEST).alias("kind"), "UUID", F.lit(None).cast("long").alias("low"), F.lit(None).cast("double").alias("prediction"),
        F.col("rq_ts").alias("ts")).withWatermark("ts", watermark)
    said = responses.where("rs_ts IS NOT NULL").select(
        F.lit(REPLY).alias("kind"), "UUID", F.lit(None).cast("long").alias("low"), "prediction", F.col("rs_ts").alias("ts")).withWatermark("ts", watermark)
    of_uuid = F.pmod(F.xxhash64("UUID"), F.lit(shards)).alias("shard")
    pulse = said.select("ts").mapInPandas(_pulse(silence), _ROWS)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    rows = asked.select(of_uuid, "*").unionByName(said.where("UUID IS NOT NULL").select(of_uuid, "*")).unionByName(pulse.select(every, "*"))
    return rows.groupBy("shard").applyInPandasWithState(_shard(silence), RESULT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
