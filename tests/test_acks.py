import random
from datetime import datetime, timedelta

import pytest
from conftest import seq, shard_id
from pyspark.sql import functions as F

from shardweave.operators import (
    checkpoints_from_acks,
    completed_shards,
    consumer_lag,
    drop_redelivered,
    missing_leases,
    multi_app_resume,
    pending_retries,
    resume_read,
)
from shardweave.schemas import LEASES, RECORDS, SHARDS
from shardweave.sources import read_limited

T0 = datetime(2024, 1, 1)


def acks(spark, *rows):
    """Rows (ack_id, position, sequence_number, status)."""
    return spark.createDataFrame(
        [("a", shard_id(0), *r) for r in rows],
        "app_name string, shard_id string, ack_id long, position long, sequence_number string, "
        "status string",
    )


def test_all_ok(spark, rows):
    got = checkpoints_from_acks(acks(spark, (1, 0, "12345", "ok")))
    assert rows(got) == [("a", shard_id(0), 1, "12345", 1, 0)]


def test_all_failed_gives_no_checkpoint(spark, rows):
    df = acks(spark, (1, 0, "1", "failed"), (1, 1, "2", "failed"))
    for mode in ("last_ok", "contiguous"):
        assert rows(checkpoints_from_acks(df, mode)) == [("a", shard_id(0), 1, None, 0, 2)]


def test_mixed_ack(spark, rows):
    df = acks(spark, (1, 0, "10", "ok"), (1, 1, "11", "ok"), (1, 2, "12", "failed"), (1, 3, "13", "ok"))
    assert rows(checkpoints_from_acks(df)) == [("a", shard_id(0), 1, "13", 3, 1)]
    assert rows(checkpoints_from_acks(df, "contiguous")) == [("a", shard_id(0), 1, "11", 3, 1)]


def test_position_decides_not_the_sequence_number(spark, rows):
    df = acks(spark, (1, 0, "20", "ok"), (1, 1, "9", "ok"))
    assert rows(checkpoints_from_acks(df), "checkpoint") == [("9",)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        checkpoints_from_acks(acks(spark, (1, 0, "1", "ok")), "all")


def attempts(spark, *rows):
    return spark.createDataFrame(
        [("a", shard_id(0), *r) for r in rows],
        "app_name string, shard_id string, sequence_number string, attempt long, status string",
    )


def test_latest_attempt_decides(spark, rows):
    df = attempts(
        spark, ("1", 0, "failed"), ("1", 1, "ok"), ("2", 0, "failed"), ("2", 1, "failed"), ("3", 0, "ok")
    )
    cols = ("sequence_number", "attempt", "exhausted")
    assert rows(pending_retries(df), *cols) == [("2", 1, False)]
    assert rows(pending_retries(df, max_attempts=2), *cols) == [("2", 1, True)]
    assert rows(pending_retries(df, max_attempts=3), *cols) == [("2", 1, False)]


def records(spark, *rows):
    """Rows (shard, sequence number, minutes)."""
    return spark.createDataFrame(
        [("s", shard_id(s), seq(n), "k", "d", T0 + timedelta(minutes=m)) for s, n, m in rows], RECORDS
    )


def leases(spark, *rows):
    """Rows (app, shard, checkpoint number or None)."""
    return spark.createDataFrame(
        [(a, shard_id(s), None if c is None else seq(c), "w", 1, False) for a, s, c in rows], LEASES
    )


def test_resume_read(spark, rows):
    recs = records(spark, (0, 1, 0), (0, 2, 0), (1, 1, 0), (1, 2, 0), (2, 1, 0))
    held = leases(spark, ("a", 0, None), ("a", 1, 1), ("b", 1, 2), ("b", 2, None))
    cols = ("app_name", "shard_id", "sequence_number")
    a = [("a", shard_id(0), seq(1)), ("a", shard_id(0), seq(2)), ("a", shard_id(1), seq(2))]
    assert rows(resume_read(recs, held, "a"), *cols) == a
    assert rows(missing_leases(recs, held, "a"), *cols) == [("a", shard_id(2), seq(1))]
    assert rows(multi_app_resume(recs, held), *cols) == [*a, ("b", shard_id(2), seq(1))]
    assert resume_read(recs, held, "c").count() == 0


def test_reading_in_steps_reads_everything_once(spark, rows):
    recs = records(spark, *[(n % 2, n, 0) for n in range(40)])
    held, seen = leases(spark, ("a", 0, None), ("a", 1, None)), []
    for _ in range(10):
        part = rows(read_limited(resume_read(recs, held, "a"), 3), "shard_id", "sequence_number")
        seen += part
        marks = {s: max(q for t, q in seen if t == s) for s, _ in seen}
        held = spark.createDataFrame([("a", s, q, "w", 1, False) for s, q in marks.items()], LEASES)
    assert sorted(seen) == rows(recs, "shard_id", "sequence_number")
    assert resume_read(recs, held, "a").count() == 0


def test_completed_shards(spark):
    shards = spark.createDataFrame(
        [("s", shard_id(n), None, None, "0", "1", "1", "9" if n else None) for n in range(6)], SHARDS
    )
    recs = records(spark, *[(n, 1, 0) for n in range(6)])
    held = leases(spark, ("a", 0, 1), ("a", 1, 1), ("a", 2, None), ("a", 3, 1), ("a", 4, 1))
    done = spark.createDataFrame(
        [("a", shard_id(n), seq(1), 0, "ok", T0 + timedelta(minutes=10 if n == 4 else 0)) for n in range(5)]
        + [("a", shard_id(3), seq(0), 0, "failed", T0)],
        "app_name string, shard_id string, sequence_number string, attempt long, status string, "
        "ack_ts timestamp_ntz",
    )
    as_of = T0 + timedelta(minutes=5)
    got = {
        int(r.shard_id[-2:]): (r.has_unread, r.n_pending, r.quiet, r.completed)
        for r in completed_shards(shards, held, recs, done, "a", as_of).collect()
    }
    assert got == {
        1: (False, 0, True, True),
        2: (True, 0, True, False),
        3: (False, 1, True, False),
        4: (False, 0, False, False),
    }
    early = completed_shards(shards, held, recs, done, "a", as_of - timedelta(milliseconds=1))
    assert early.where("completed").count() == 0


def test_drop_redelivered(spark):
    recs = records(spark, (0, 1, 0), (0, 1, 0), (0, 2, 0), (1, 1, 0))
    assert drop_redelivered(recs).count() == 3


def test_consumer_lag(spark, rows):
    recs = records(spark, *[(0, n, n) for n in range(10)], (1, 5, 3))
    held = leases(spark, ("a", 0, 6), ("b", 0, None), ("c", 0, 9), ("a", 1, 5), ("a", 2, 4))
    assert rows(consumer_lag(recs, held)) == [
        ("a", shard_id(0), 3, 180_000),
        ("a", shard_id(1), 0, 0),
        ("a", shard_id(2), 0, None),
        ("b", shard_id(0), 10, 540_000),
        ("c", shard_id(0), 0, 0),
    ]


def test_consumer_lag_of_a_shard_with_ten_thousand_applications(spark):
    rng = random.Random(5)
    at = sorted(rng.sample(range(4_000), 1_500))
    recs = records(spark, *[(0, n, rng.randrange(500)) for n in at], (1, 5, 3))
    held = leases(spark, *[(f"app-{i}", 0, rng.choice([None, *range(-1, 4_001, 7)])) for i in range(10_000)])
    minute = {r.sequence_number: r.arrival_ts for r in recs.where(F.col("shard_id") == shard_id(0)).collect()}
    oldest, newest = min(minute.values()), max(minute.values())
    want, by_mark = set(), {}
    for r in held.collect():
        if r.checkpoint not in by_mark:
            read = [] if r.checkpoint is None else [
                t for s, t in minute.items() if (len(s), s) <= (len(r.checkpoint), r.checkpoint)
            ]
            behind = newest - (max(read) if read else oldest)
            by_mark[r.checkpoint] = len(minute) - len(read), int(behind.total_seconds() * 1000)
        want.add((r.app_name, r.shard_id, *by_mark[r.checkpoint]))
    for slice_rows in (100, 1_000_000):
        lag = consumer_lag(recs, held, slice_rows)
        assert {tuple(r) for r in lag.collect()} == want and lag.count() == 10_000
