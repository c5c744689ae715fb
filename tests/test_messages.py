import pandas as pd
import pytest
from conftest import seq, shard_id
from pyspark.sql import functions as F

from shardweave.operators import (
    map_batches,
    map_messages,
    micro_batches,
    partition_by,
    route_batchers,
    split_failed,
    wrap_messages,
)


@pytest.fixture(scope="module")
def records(spark):
    """90 records, two thirds of them in shard 0."""
    return spark.range(90).select(
        F.when(F.col("id") % 3 == 2, shard_id(1)).otherwise(shard_id(0)).alias("shard_id"),
        F.format_string("49606519%048d", "id").alias("sequence_number"),
        (F.col("id") % 5).cast("string").alias("partition_key"),
        F.col("id").cast("string").alias("data"),
    )


def test_wrap_messages(records):
    msg = wrap_messages(records).first()
    assert msg.data == "0"
    assert msg.metadata.asDict() == {
        "shard_id": shard_id(0),
        "sequence_number": seq(0),
        "partition_key": "0",
    }


def test_message_callbacks_agree(records, rows):
    bad = F.col("data").cast("int") % 10 == 0
    by_columns = map_messages(records, {"status": F.when(bad, "failed")})

    def by_frame(df, every):
        return df.withColumn("status", F.when(F.col("data").cast("int") % every == 0, "failed"))

    def by_pandas(frame: pd.DataFrame, every: int) -> pd.DataFrame:
        hit = frame["data"].astype(int) % every == 0
        return frame.assign(status=hit.map({True: "failed", False: "ok"}))

    schema = f"{', '.join(c + ' string' for c in records.columns)}, status string"
    want = rows(by_columns)
    assert rows(map_messages(records, by_frame, every=10)) == want
    assert rows(map_messages(records, pandas_fn=by_pandas, schema=schema, every=10)) == want
    assert sum(r[-2] == "failed" for r in want) == 9
    good, failed = split_failed(by_columns)
    assert good.count() == 81 and failed.count() == 9


def test_no_callback_means_ok(records):
    assert map_messages(records).where("status = 'ok' AND error IS NULL").count() == 90


def test_pandas_callback_needs_a_schema(records):
    with pytest.raises(ValueError, match="schema"):
        map_messages(records, pandas_fn=lambda f: f)


def test_batches_do_not_cross_shards_or_batchers(records):
    rule = F.when(F.col("data").cast("int") % 2 == 0, "even")
    batched = micro_batches(route_batchers(records, rule), {"even": 4})
    seen = {}
    for r in batched.orderBy("sequence_number").collect():
        i = seen.get((r.shard_id, r.batcher), 0)
        size = 4 if r.batcher == "even" else 20
        assert (r.batch_no, r.position) == divmod(i, size)
        seen[r.shard_id, r.batcher] = i + 1
    assert set(seen) == {(shard_id(s), b) for s in (0, 1) for b in ("even", "default")}


def test_batches_of_a_hot_shard_in_slices(records, rows):
    routed = route_batchers(records)
    assert rows(micro_batches(routed, 7, slice_rows=10)) == rows(micro_batches(routed, 7))


def test_batch_callback_gets_context_and_order(records, rows):
    def last(batch: pd.DataFrame, label: str) -> pd.DataFrame:
        assert list(batch["position"]) == list(range(len(batch)))
        assert batch["sequence_number"].is_monotonic_increasing
        return pd.DataFrame({"label": [label], "n": [len(batch)]})

    batched = micro_batches(route_batchers(records), 40)
    got = map_batches(batched, last, "label string, n long", label="x")
    assert rows(got) == [("x", 20), ("x", 30), ("x", 40)]


def test_partition_by_keeps_keys_together(records, rows):
    plain = partition_by(records, "partition_key", 3)
    keys = {}
    for r in plain.orderBy("sequence_number").collect():
        keys.setdefault(r.partition_key, set()).add(r.processor)
    assert all(len(p) == 1 for p in keys.values()) and len(keys) == 5
    assert rows(partition_by(records, "partition_key", 3, slice_rows=8)) == rows(plain)
    for p in range(3):
        mine = plain.where(F.col("processor") == p).orderBy("processor_pos").collect()
        assert [r.processor_pos for r in mine] == list(range(1, len(mine) + 1))
        assert [r.sequence_number for r in mine] == sorted(r.sequence_number for r in mine)


def test_failed_messages_are_left_as_the_callback_leaves_them(spark, rows):
    msgs = spark.createDataFrame([(1, "ok"), (2, "failed"), (3, "failed")], "n int, status string")
    good, bad = split_failed(msgs, lambda df: df.withColumn("reason", F.lit("late")))
    assert rows(good, "n") == [(1,)] and rows(bad, "n", "reason") == [(2, "late"), (3, "late")]


def test_messages_without_a_status_went_well(spark):
    msgs = spark.createDataFrame([("a", "ok"), ("b", None), ("c", "failed")], "data string, status string")
    good, bad = split_failed(msgs)
    assert sorted(r.data for r in good.collect()) == ["a", "b"] and [r.data for r in bad.collect()] == ["c"]
