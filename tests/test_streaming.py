import random
import time
from datetime import datetime

import pytest
from conftest import seq, shard_id
from pyspark.sql import functions as F
from test_leases import by_hand, random_log

from shardweave.operators import completed_shards, pending_retries
from shardweave.schemas import LEASE_COMMANDS, LEASES, RECORDS
from shardweave.sources import read_table, write_records
from shardweave.streaming import (
    consume,
    drop_redelivered_stream,
    fold_leases_stream,
    stream_records,
    watch_shards,
    write_record_stream,
)
from shardweave.streaming.timers import EVENTS


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(
        name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    yield
    spark.conf.set(name, old)


def test_fold_of_a_command_stream(spark, tmp_path, rows, rocksdb):
    log, path = random_log(7, 300, 20), str(tmp_path / "commands")
    latest = {}
    df = spark.createDataFrame(log, LEASE_COMMANDS)
    for part in range(3):
        df.where((F.col("seq") >= 100 * part) & (F.col("seq") < 100 * part + 100)).coalesce(
            1
        ).write.mode("append").parquet(path)

        def keep(batch, _):
            latest.update({(r.app_name, r.shard_id): tuple(r) for r in batch.collect()})

        stream = stream_records(spark, path, max_files_per_trigger=1)
        (
            fold_leases_stream(stream)
            .writeStream.outputMode("update")
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
            .awaitTermination()
        )
    assert sorted(latest.values(), key=repr) == by_hand(log, {})


def test_redelivered_records_of_a_stream(spark, tmp_path, rows):
    path, out = str(tmp_path / "records"), str(tmp_path / "out")
    recs = spark.createDataFrame(
        [("s", shard_id(n % 2), seq(n % 10), "k", "d", datetime(2024, 1, 1)) for n in range(30)],
        RECORDS,
    )
    write_records(recs, path)
    (
        drop_redelivered_stream(stream_records(spark, path, 1))
        .writeStream.option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(out, format="parquet")
        .awaitTermination()
    )
    cols = ("shard_id", "sequence_number")
    assert rows(spark.read.parquet(out), *cols) == rows(recs.dropDuplicates(cols), *cols)


def test_records_through_a_stream(spark, tmp_path, rows):
    path, out = str(tmp_path / "records"), str(tmp_path / "out")
    recs = spark.createDataFrame(
        [("s", str(n % 3), seq(n), "k", "d", datetime(2024, 1, 1)) for n in range(20)], RECORDS
    )
    write_records(recs, path)
    stream = stream_records(spark, path).drop("seq_len")
    write_record_stream(
        stream, out, str(tmp_path / "state"), {"availableNow": True}
    ).awaitTermination()
    # shard ids that look like numbers stay text
    assert dict(read_table(spark, out).dtypes)["shard_id"] == "string"
    assert rows(read_table(spark, out), *recs.columns) == rows(recs)


@pytest.mark.parametrize("names", [{"app_name": ""}, {"app_name": None}, {"worker": 3}])
def test_names_are_checked(spark, names):
    options = {"app_name": "a", "worker": "w", **names}
    with pytest.raises(ValueError, match="non-empty string"):
        consume(spark, "/none", lambda: None, "/none", "/none", **options)


def _watched(spark, tmp_path, steps, delay_ms, until):
    """Feed the steps one micro-batch each; the changes, until there are enough."""
    path, told = str(tmp_path / "events"), []
    spark.createDataFrame([], EVENTS).write.parquet(path)
    query = (
        watch_shards(spark.readStream.schema(EVENTS).parquet(path), delay_ms)
        .writeStream.outputMode("update")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(processingTime="200 milliseconds")
        .foreachBatch(lambda df, _: told.extend((time.time(), r) for r in df.collect()))
        .start()
    )
    for rows in steps:
        at = len(query.recentProgress) and query.lastProgress["batchId"]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)
        for _ in range(300):
            if query.lastProgress and query.lastProgress["batchId"] > at and query.lastProgress["numInputRows"]:
                break
            time.sleep(0.1)
    for _ in range(300):
        if until(told) or query.exception():
            break
        time.sleep(0.1)
    query.stop()
    return told


def test_retries_and_countdowns_equal_the_batch_operators(spark, tmp_path, rows, rocksdb):
    app, rng = "app", random.Random(4)
    acks = [(shard_id(k), seq(n), a, rng.choice(["ok", "failed"])) for k in range(6) for n in range(5) for a in range(rng.randrange(1, 4))]
    acks = [(s, n, a, "ok" if s in (shard_id(0), shard_id(1)) else st) for s, n, a, st in acks]
    rng.shuffle(acks)  # attempts come late and early
    marks = {shard_id(k): seq(4 if k != 1 else 2) for k in range(6)}  # shard 1 has unread records
    events = [(app, s, "ack", n, a, st) for s, n, a, st in acks]
    events += [(app, shard_id(k), "record", seq(n), None, None) for k in range(6) for n in range(5)]
    events += [(app, s, "checkpoint", m, None, None) for s, m in marks.items()]
    events += [(app, shard_id(k), "closed", None, None, None) for k in range(5)]
    rng.shuffle(events)
    steps = [events[i : i + 40] for i in range(0, len(events), 40)]

    now = datetime(2024, 1, 1)
    table = spark.createDataFrame([(app, s, n, a, st, now) for s, n, a, st in acks], "app_name string, shard_id string, sequence_number string, attempt long, status string, ack_ts timestamp_ntz")
    shards = spark.createDataFrame([(shard_id(k), seq(9) if k < 5 else None) for k in range(6)], "shard_id string, seq_end string")
    leases = spark.createDataFrame([(app, s, m, "w", 1, False) for s, m in marks.items()], LEASES)
    recs = spark.createDataFrame([(shard_id(k), seq(n)) for k in range(6) for n in range(5)], "shard_id string, sequence_number string")
    done = completed_shards(shards, leases, recs, table, app, datetime(2024, 1, 2)).where("completed")
    want_done = rows(done, "shard_id")
    want_pending = rows(pending_retries(table), "shard_id", "sequence_number", "attempt")
    assert want_done and want_pending

    told = _watched(spark, tmp_path, steps, 1500, lambda t: sum(r.kind == "completed" for _, r in t) >= len(want_done))
    last = {(r.shard_id, r.sequence_number): r for _, r in told if r.kind == "retry"}
    assert sorted((*k, r.attempt) for k, r in last.items() if r.pending) == want_pending
    assert sorted((r.shard_id,) for _, r in told if r.kind == "completed") == want_done


def test_a_failure_cancels_and_a_success_restarts_the_countdown(spark, tmp_path, rocksdb):
    event = lambda kind, n=None, a=None, st=None: ("app", "x", kind, n, a, st)
    steps = [
        [event("closed"), event("record", "1"), event("record", "2"), event("checkpoint", "2"), event("ack", "1", 0, "ok")],
        [event("ack", "2", 0, "failed")],
        [event("ack", "2", 1, "ok")],
    ]
    told = _watched(spark, tmp_path, steps, 4000, lambda t: any(r.kind == "completed" for _, r in t))
    assert [r.kind for _, r in told] == ["retry"] * 3 + ["completed"]
    assert told[3][0] - told[2][0] >= 3  # counted from the last success
