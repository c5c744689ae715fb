from datetime import datetime, timedelta

import pandas as pd
from conftest import seq, shard_id
from pyspark.sql import functions as F

from shardweave.operators import map_batches
from shardweave.schemas import LEASES, RECORDS, SHARDS
from shardweave.sources import LeaseStore, write_records
from shardweave.streaming import ConsumeState, Handlers, consume, consume_once

NOW = datetime(2024, 1, 1)
APP, ME = "app", "worker-1"


def records(spark, numbers, shards=2):
    return spark.createDataFrame(
        [("s", shard_id(n % shards), seq(n), str(n % 7), str(n), NOW) for n in numbers], RECORDS
    )


def listing(spark, *rows):
    """Rows (shard, parent, closed)."""
    return spark.createDataFrame(
        [
            ("s", shard_id(n), None if p is None else shard_id(p), None, "0", "1", "1", "9" if c else None)
            for n, p, c in rows
        ],
        SHARDS,
    )


def marks(state):
    return {
        int(r.shard_id[-2:]): (None if r.checkpoint is None else int(r.checkpoint[-9:]), r.completed)
        for r in state.leases.collect()
    }


def test_steps_read_every_record_once(spark, rows):
    recs = records(spark, range(50))
    shards = listing(spark, (0, None, False), (1, None, False))
    state, seen = ConsumeState.empty(spark), []
    for step in range(4):
        out = consume_once(recs, shards, state, APP, ME, NOW + timedelta(seconds=step), limit=10)
        seen += rows(out.messages, "shard_id", "sequence_number")
        state = out.state
    assert sorted(seen) == rows(recs, "shard_id", "sequence_number")
    assert marks(state) == {0: (48, False), 1: (49, False)}


def test_failed_messages_are_retried_and_never_lost(spark, rows):
    recs = records(spark, range(20))
    shards = listing(spark, (0, None, False), (1, None, False))
    fails = lambda upto: Handlers(  # noqa: E731 - fail until the given attempt
        on_message={
            "status": F.when(
                (F.col("data").cast("int") % 5 == 0) & (F.col("attempt") < upto), "failed"
            ).otherwise("ok")
        }
    )
    first = consume_once(recs, shards, ConsumeState.empty(spark), APP, ME, NOW, fails(2))
    assert rows(first.state.pending, "data", "attempt") == [(str(n), 0) for n in (0, 10, 15, 5)]
    assert marks(first.state) == {0: (18, False), 1: (19, False)}
    second = consume_once(recs, shards, first.state, APP, ME, NOW, fails(2))
    assert rows(second.messages, "data", "attempt", "status") == [
        (str(n), 1, "failed") for n in (0, 10, 15, 5)
    ]
    third = consume_once(recs, shards, second.state, APP, ME, NOW, fails(2))
    assert rows(third.messages, "data", "status") == [(str(n), "ok") for n in (0, 10, 15, 5)]
    assert third.state.pending.count() == 0
    # the success of old messages does not rewind the shards
    assert marks(third.state) == {0: (18, False), 1: (19, False)}
    assert consume_once(recs, shards, third.state, APP, ME, NOW).messages.count() == 0


def test_a_step_that_fails_altogether_reads_nothing_twice(spark, rows):
    recs = records(spark, range(6))
    shards = listing(spark, (0, None, False), (1, None, False))
    bad = Handlers(on_message={"status": F.lit("failed")})
    first = consume_once(recs, shards, ConsumeState.empty(spark), APP, ME, NOW, bad)
    assert marks(first.state) == {0: (None, False), 1: (None, False)}
    second = consume_once(recs, shards, first.state, APP, ME, NOW)
    assert rows(second.messages, "data", "attempt") == [(str(n), 1) for n in range(6)]


def test_exhausted_messages_become_dead_letters(spark, rows):
    recs = records(spark, range(6))
    shards = listing(spark, (0, None, False), (1, None, False))
    bad = Handlers(on_message={"status": F.when(F.col("data") == "3", "failed").otherwise("ok")})
    first = consume_once(recs, shards, ConsumeState.empty(spark), APP, ME, NOW, bad, max_attempts=2)
    assert first.dead_letters.count() == 0
    second = consume_once(recs, shards, first.state, APP, ME, NOW, bad, max_attempts=2)
    assert rows(second.dead_letters, "data", "attempt") == [("3", 1)]
    assert second.state.pending.count() == 0


def test_children_start_after_their_parent_is_done(spark, rows):
    recs = records(spark, range(30), shards=3)
    shards = listing(spark, (0, None, True), (1, 0, False), (2, 0, False))
    state = ConsumeState.empty(spark)
    first = consume_once(recs, shards, state, APP, ME, NOW)
    assert rows(first.messages.select("shard_id").distinct()) == [(shard_id(0),)]
    assert marks(first.state) == {0: (27, False)}
    waiting = consume_once(recs, shards, first.state, APP, ME, NOW + timedelta(seconds=299))
    assert waiting.messages.count() == 0 and marks(waiting.state) == {0: (27, False)}
    done = consume_once(recs, shards, waiting.state, APP, ME, NOW + timedelta(seconds=300))
    assert marks(done.state) == {0: (27, True)}
    after = consume_once(recs, shards, done.state, APP, ME, NOW + timedelta(seconds=301))
    assert rows(after.messages.select("shard_id").distinct()) == [(shard_id(1),), (shard_id(2),)]
    assert marks(after.state) == {0: (27, True), 1: (28, False), 2: (29, False)}


def test_leases_of_other_workers_are_left_alone(spark, rows):
    recs = records(spark, range(10))
    shards = listing(spark, (0, None, False), (1, None, False))
    other = spark.createDataFrame([(APP, shard_id(0), None, "worker-2", 3, False)], LEASES)
    state = ConsumeState.empty(spark)._replace(leases=other)
    out = consume_once(recs, shards, state, APP, ME, NOW)
    assert rows(out.messages.select("shard_id").distinct()) == [(shard_id(1),)]
    assert marks(out.state) == {0: (None, False), 1: (9, False)}


def test_batch_callback_may_fail_messages(spark, rows):
    recs = records(spark, range(40))
    shards = listing(spark, (0, None, False), (1, None, False))

    def check(batch: pd.DataFrame, worst: int) -> pd.DataFrame:
        bad = batch["data"].astype(int) == worst
        return batch.assign(status=bad.map({True: "failed", False: "ok"}))

    def on_batch(df, **context):
        return map_batches(df, check, df.schema, **context)

    handlers = Handlers(on_batch=on_batch, batch_size=6, context={"worst": 7})
    handlers = Handlers(
        on_message=lambda df, **_: df, on_batch=on_batch, batch_size=6, context={"worst": 7}
    )
    out = consume_once(recs, shards, ConsumeState.empty(spark), APP, ME, NOW, handlers)
    assert rows(out.state.pending, "data") == [("7",)]
    assert out.messages.where("position >= 6").count() == 0


def _drain(spark, root, clock, shards, **options):
    query = consume(
        spark,
        f"{root}/records",
        lambda: shards,
        f"{root}/state",
        f"{root}/out",
        APP,
        ME,
        trigger={"availableNow": True},
        clock=clock,
        **options,
    )
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_streaming_consumer_matches_the_batch_step(spark, tmp_path, rows):
    root = str(tmp_path)
    shards = listing(spark, (0, None, True), (1, None, False), (2, 0, False))
    recs = records(spark, range(60), shards=3)
    handlers = Handlers(
        on_message={"status": F.when(F.col("data") == "33", "failed").otherwise("ok")}, batch_size=8
    )
    ticks = iter(NOW + timedelta(minutes=10 * i) for i in range(100))
    options = {"handlers": handlers, "max_attempts": 2, "max_files_per_trigger": 2, "limit": 12}
    for part in range(3):
        write_records(recs.where(F.col("data").cast("int") % 3 == part), f"{root}/records")
        _drain(spark, root, lambda: next(ticks), shards, **options)

    got = spark.read.parquet(f"{root}/out/messages")
    ok = rows(got.where("status = 'ok'"), "shard_id", "sequence_number")
    assert len(ok) == len(set(ok))
    dead = rows(spark.read.parquet(f"{root}/out/dead_letters"), "data")
    want = rows(recs.where("data <> '33'"), "shard_id", "sequence_number")
    state = marks(ConsumeState(LeaseStore(spark, f"{root}/state/leases").read(), None, None))
    assert ok == want
    assert dead == [("33",)] and state[0] == (57, True)


def test_one_run_drains_what_the_limit_holds_back(spark, tmp_path, rows):
    root = str(tmp_path)
    shards = listing(spark, (0, None, False))
    recs = records(spark, range(10), shards=1)
    write_records(recs, f"{root}/records")
    _drain(spark, root, lambda: NOW, shards, limit=4)
    assert rows(spark.read.parquet(f"{root}/out/messages"), "data") == sorted((str(n),) for n in range(10))
    # without new files waiting messages are retried
    failing = Handlers(on_message={"status": F.lit("failed")})
    write_records(records(spark, range(10, 13), shards=1), f"{root}/records")
    _drain(spark, root, lambda: NOW, shards, limit=2, handlers=failing)
    _drain(spark, root, lambda: NOW, shards, limit=2)
    got = spark.read.parquet(f"{root}/out/messages").where("cast(data as int) >= 10 and status = 'ok'")
    assert rows(got, "data") == [("10",), ("11",), ("12",)]


def test_a_callback_whose_outcome_varies_decides_once(spark, rows):
    recs = records(spark, range(1000))
    shards = listing(spark, (0, None, False), (1, None, False))
    varies = Handlers(on_message={"status": F.when(F.rand() < 0.3, "failed").otherwise("ok")})
    out = consume_once(recs, shards, ConsumeState.empty(spark), APP, ME, NOW, varies)
    assert rows(out.messages, "data") == sorted((str(n),) for n in range(1000))
    bad = out.messages.where("status = 'failed'")
    assert rows(bad, "data") == rows(out.state.pending, "data")


def test_dead_letters_at_the_end_are_not_read_again(spark, rows):
    recs = records(spark, range(3), shards=1)
    shards = listing(spark, (0, None, True), (1, 0, False))
    bad = Handlers(on_message={"status": F.when(F.col("data") == "2", "failed").otherwise("ok")})
    told = []
    bad = Handlers(on_message=bad.on_message, on_failed=lambda df: told.append(df.count()))
    state = ConsumeState.empty(spark)
    dead = []
    for step in range(3):
        out = consume_once(recs, shards, state, APP, ME, NOW + timedelta(hours=step), bad, max_attempts=1)
        dead += rows(out.dead_letters, "data")
        state = out.state
    assert dead == [("2",)] and told == [1, 0, 0]
    assert marks(state)[0] == (2, True) and 1 in marks(state)


def test_a_closed_shard_without_records_completes(spark):
    recs = records(spark, range(2), shards=1).where("shard_id = 'none'")
    shards = listing(spark, (0, None, True), (1, 0, False))
    state = consume_once(recs, shards, ConsumeState.empty(spark), APP, ME, NOW).state
    assert marks(state) == {0: (None, False)}
    state = consume_once(recs, shards, state, APP, ME, NOW + timedelta(seconds=299)).state
    assert marks(state) == {0: (None, False)}
    state = consume_once(recs, shards, state, APP, ME, NOW + timedelta(seconds=300)).state
    assert marks(state) == {0: (None, True)}


def test_leases_left_behind_are_taken_and_read_on(spark, rows):
    recs = records(spark, range(10))
    shards = listing(spark, (0, None, False), (1, None, False))
    other = spark.createDataFrame([(APP, shard_id(0), seq(4), "worker-2", 3, False)], LEASES)
    state = ConsumeState.empty(spark)._replace(leases=other)

    def step(state, seconds):
        return consume_once(
            recs, shards, state, APP, ME, NOW + timedelta(seconds=seconds), lease_expiry_ms=90_000
        )

    first = step(state, 0)
    assert rows(first.messages.select("shard_id").distinct()) == [(shard_id(1),)]
    moved = first.state.leases.withColumn(
        "lease_count", F.when(F.col("lease_owner") == "worker-2", 4).otherwise(F.col("lease_count")).cast("long")
    )
    second = step(first.state._replace(leases=moved), 80)  # the other worker renewed it
    third = step(second.state, 160)
    assert third.messages.count() == 0
    fourth = step(third.state, 171)
    assert rows(fourth.messages, "data") == [("6",), ("8",)]
    assert rows(fourth.state.leases, "shard_id", "lease_owner", "lease_count") == [
        (shard_id(0), ME, 5), (shard_id(1), ME, 4),
    ]


def _mark_as_the_readme_does(df, **_):
    return df.withColumn("status", F.when(F.col("data") == "7", "failed"))


def test_batch_callback_may_leave_the_status_out(spark, tmp_path, rows):
    root = str(tmp_path)
    shards = listing(spark, (0, None, False), (1, None, False))
    write_records(records(spark, range(11)), f"{root}/records")
    handlers = Handlers(on_batch=_mark_as_the_readme_does, batch_size=4)
    _drain(spark, root, lambda: NOW, shards, handlers=handlers, limit=50, max_attempts=1)
    got = rows(spark.read.parquet(f"{root}/out/messages"), "data", "status")
    assert got == sorted((str(n), "failed" if n == 7 else "ok") for n in range(11))
    assert rows(spark.read.parquet(f"{root}/out/dead_letters"), "data") == [("7",)]


def test_what_callbacks_drop_or_misname_has_failed(spark, rows):
    recs = records(spark, range(12))
    shards = listing(spark, (0, None, False), (1, None, False))

    def on_message(df, **_):
        odd = F.when(F.col("data") == "3", "broken").when(F.col("data") == "5", F.lit(None))
        return df.where("data <> '2'").withColumn("status", odd.otherwise("ok"))

    def on_batch(df, **_):
        return df.where("data <> '8'").drop("status", "batch_no")

    handlers = Handlers(on_message=on_message, on_batch=on_batch, batch_size=4)
    out = consume_once(recs, shards, ConsumeState.empty(spark), APP, ME, NOW, handlers)
    bad = {"2": "dropped by a callback", "3": "unknown status broken", "8": "dropped by a callback"}
    want = sorted((str(n), "failed" if str(n) in bad else "ok", bad.get(str(n))) for n in range(12))
    assert rows(out.messages, "data", "status", "error") == want
    assert rows(out.state.pending, "data") == [("2",), ("3",), ("8",)]
    again = consume_once(recs, shards, out.state, APP, ME, NOW)
    assert rows(again.messages, "data") == [("2",), ("3",), ("8",)] and again.state.pending.count() == 0
