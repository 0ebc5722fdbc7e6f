"""Waiting for a reply until the topic is silent: against a plain loop over all messages."""

import datetime as dt
import random

import pytest

from aerolake.session import shared_path, state_partitions
from aerolake.streaming import scoring as sc
from aerolake.streaming import silence as S

T0 = dt.datetime(2024, 1, 1)
RQ, RS = "UUID string, rq_ts timestamp", "UUID string, rs_ts timestamp, prediction double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def brute(requests, replies, limit=20):
    """What a reader of the topic sees, message after message."""
    out = []
    topic = sorted((t, p is not None, p or 0.0, u, p) for u, t, p in replies if t is not None)
    for uuid, since in requests:
        last, status, prediction = since, "TIMEOUT", None
        for t, _, _, u, p in topic:
            if t < since:
                continue
            if (t - last).total_seconds() > limit:
                break
            last = t
            if u == uuid:
                status, prediction = "OK", p
                break
        out.append((uuid, since, status, prediction))
    return sorted(out, key=str)


def run(spark, rq_path, rs_path, root, per_batch=None):
    opts = {"maxFilesPerTrigger": str(per_batch)} if per_batch else {}
    out = S.await_replies(spark.readStream.schema(RQ).options(**opts).parquet(rq_path), spark.readStream.schema(RS).options(**opts).parquet(rs_path), shards=3)
    with state_partitions(spark, 2):
        q = (out.writeStream.format("parquet").option("checkpointLocation", f"{root}/ck").outputMode("append").trigger(availableNow=True).start(f"{root}/out"))
    sc.run_to_end(q)
    rows = spark.read.schema(out.schema).parquet(f"{root}/out").where("UUID <> 'end'")
    return sorted(((r["UUID"], r["rq_ts"], r["status"], r["prediction"]) for r in rows.collect()), key=str)


END_RQ, END_RS = [("end", at(99_999))], [("end", at(99_999), None)]


def write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_gaps_put_off_and_end_the_wait(spark):
    requests = [("a", at(0)), ("b", at(0)), ("c", at(100)), ("d", at(100)), ("d", at(100)), ("e", at(300)), ("f", at(500)), ("g", at(600.5)), ("h", at(700))]
    replies = [("a", at(2), 1.0), ("a", at(3), 2.0),                                 # the first reply
               ("x", at(20), 0.0), ("y", at(39), 0.0), ("b", at(58), 3.0),          # others keep b waiting for 58 s
               ("c", at(121), 1.0),                                                 # 21 s of silence: too late
               ("d", at(99), 2.0),                                                  # before its request
               ("e", at(320), None),                                                # just in time, without a value
               ("f", at(520.000001), 1.0),                                          # just too late
               (None, at(615), 0.0), ("g", at(633), 1.0), ("z", None, 1.0)]         # a message without id counts as one
    root = shared_path(spark, "test_silence", unique=True)
    write(spark, requests + END_RQ, RQ, f"{root}/rq")
    write(spark, replies + END_RS, RS, f"{root}/rs")
    got = run(spark, f"{root}/rq", f"{root}/rs", root)
    assert got == brute(requests, replies)
    assert [r[2] for r in got] == ["OK", "OK", "TIMEOUT", "TIMEOUT", "TIMEOUT", "OK", "TIMEOUT", "OK", "TIMEOUT"]


def test_replay_in_batches_and_restart(spark):
    """Both topics in time order over several micro-batches; stopped and started again half-way."""
    rng = random.Random(3)
    requests = [(f"u{i}", at(rng.uniform(0, 3000))) for i in range(150)]
    replies = [(u, t + dt.timedelta(seconds=rng.choice([1, 5, 15, 25, 70])), float(i % 4)) for i, (u, t) in enumerate(requests) if i % 5]
    requests.sort(key=lambda r: r[1])
    replies.sort(key=lambda r: r[1])
    root = shared_path(spark, "test_silence", unique=True)
    half = at(1500)

    def publish(low, high, last):
        for edge in range(low, high, 300):
            own = lambda rows: [r for r in rows if at(edge) <= r[1] < at(edge + 300)]  # noqa: E731,B023
            write(spark, own(requests), RQ, f"{root}/rq")
            write(spark, own(replies), RS, f"{root}/rs")
        if last:
            write(spark, END_RQ, RQ, f"{root}/rq")
            write(spark, [r for r in replies if r[1] >= at(high)] + END_RS, RS, f"{root}/rs")

    publish(0, 1500, False)
    first = run(spark, f"{root}/rq", f"{root}/rs", root, per_batch=1)
    want = brute(requests, replies)
    assert first and set(first) <= set(want)  # what is told before the end is final
    assert all(r[1] < half for r in first)
    publish(1500, 3000, True)
    assert run(spark, f"{root}/rq", f"{root}/rs", root, per_batch=1) == want
    assert {r[2] for r in want} == {"OK", "TIMEOUT"}


def test_silence_ends():
    pulse = [(0, 15), (21, 39), (61, 61), (70, 75)]
    assert S.silence_ends(pulse, 20) == [59, 59, 95, 95]
    lasts = [b for _, b in pulse]
    ends = S.silence_ends(pulse, 20)
    for since, end in ((0, 59), (16, 59), (40, 60), (41, 95), (75, 95), (76, 96), (100, 120)):
        assert S.end_of_wait(since, pulse, lasts, ends, 20) == end
    assert S.end_of_wait(5, [], [], [], 20) == 25


@pytest.mark.parametrize("seed", range(3))
def test_windows_tell_as_much_as_all_messages(seed):
    rng = random.Random(seed)
    times = sorted(rng.randrange(0, 3000) for _ in range(90))
    windows = {}
    for t in times:
        a, b = windows.get(t // 20, (t, t))
        windows[t // 20] = (min(a, t), max(b, t))
    pulse = [windows[w] for w in sorted(windows)]
    lasts, ends = [b for _, b in pulse], S.silence_ends(pulse, 20)
    for since in range(0, 3000, 7):
        last = since
        for t in times:
            if t >= since:
                if t - last > 20:
                    break
                last = t
        assert S.end_of_wait(since, pulse, lasts, ends, 20) == last + 20
