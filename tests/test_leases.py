import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from conftest import shard_id

from shardweave.operators import (
    apply_checkpoints,
    close_shards,
    create_leases,
    fold_leases,
    lease_actions,
    renew_leases,
    stale_leases,
    take_leases,
)
from shardweave.schemas import LEASE_COMMANDS, LEASES

A, S1, S2 = "a", shard_id(1), shard_id(2)


def leases(spark, *rows):
    return spark.createDataFrame(list(rows), LEASES)


def requests(spark, schema, *rows):
    base = "app_name string, shard_id string, request_seq long, worker string"
    return spark.createDataFrame(list(rows), f"{base}, {schema}" if schema else base)


def outcomes(change):
    return [r.outcome for r in change.outcomes.orderBy("request_seq").collect()]


def test_create_lease(spark, rows):
    change = create_leases(leases(spark), requests(spark, "", (A, S1, 1, "w1"), (A, S1, 2, "w2")))
    assert outcomes(change) == ["ok", "already_exists"]
    assert rows(change.leases) == [(A, S1, None, "w1", 1, False)]
    again = create_leases(change.leases, requests(spark, "", (A, S1, 3, "w3"), (A, S2, 4, "w3")))
    assert outcomes(again) == ["already_exists", "ok"]
    assert again.leases.count() == 2


def test_renew_lease(spark, rows):
    table = leases(spark, (A, S1, "7", "w1", 12, False))
    got = renew_leases(
        table,
        requests(
            spark,
            "expected_count long",
            (A, S1, 1, "w2", 12),
            (A, S1, 2, "w1", 11),
            (A, S1, 3, "w1", 12),
            (A, S1, 4, "w1", 12),
            (A, S2, 5, "w1", 1),
        ),
    )
    assert outcomes(got) == ["lease_renew_failed"] * 2 + ["ok"] + ["lease_renew_failed"] * 2
    assert rows(got.leases) == [(A, S1, "7", "w1", 13, False)]


def test_take_lease(spark, rows):
    table = leases(spark, (A, S1, "7", "w1", 12, False))
    got = take_leases(
        table,
        requests(
            spark,
            "expected_count long",
            (A, S1, 1, "w1", 12),
            (A, S1, 2, "w2", 11),
            (A, S1, 3, "w2", 12),
            (A, S1, 4, "w3", 12),
            (A, S2, 5, "w2", 1),
        ),
    )
    assert outcomes(got) == ["lease_take_failed"] * 2 + ["ok"] + ["lease_take_failed"] * 2
    assert rows(got.leases) == [(A, S1, "7", "w2", 13, False)]


def test_checkpoint_needs_the_owner_and_may_go_back(spark, rows):
    table = leases(spark, (A, S1, "70", "w1", 12, False), (A, S2, None, "w1", 1, False))
    asked = requests(
        spark,
        "checkpoint string",
        (A, S1, 1, "w2", "99"),
        (A, S1, 2, "w1", "80"),
        (A, S1, 3, "w1", "9"),
        (A, shard_id(3), 4, "w1", "5"),
    )
    got = apply_checkpoints(table, asked)
    assert outcomes(got) == ["lease_owner_match", "ok", "ok", "lease_owner_match"]
    assert "checkpoint" in got.outcomes.columns
    assert rows(got.leases, "checkpoint") == [("9",), (None,)]
    assert rows(apply_checkpoints(table, asked, monotonic=True).leases, "checkpoint") == [
        ("80",),
        (None,),
    ]


def test_monotonic_checkpoint_keeps_the_higher_one(spark, rows):
    table = leases(spark, (A, S1, "100", "w1", 1, False))
    asked = requests(spark, "checkpoint string", (A, S1, 1, "w1", "99"))
    got = apply_checkpoints(table, asked, monotonic=True)
    assert outcomes(got) == ["ok"] and rows(got.leases, "checkpoint") == [("100",)]


def test_close_shard(spark, rows):
    table = leases(spark, (A, S1, "7", "w1", 12, False), (A, S2, None, "w1", 1, False))
    got = close_shards(table, requests(spark, "", (A, S1, 1, "w1"), (A, S2, 2, "w2")))
    assert outcomes(got) == ["ok", "lease_owner_match"]
    assert rows(got.leases, "shard_id", "completed") == [(S1, True), (S2, False)]


def test_lease_actions(spark):
    table = leases(spark, (A, S1, None, "w1", 5, False))
    seen = spark.createDataFrame(
        [
            (A, S1, "w1", 100_000, 5, 0),  # own lease, however old
            (A, S1, "w2", 90_001, 5, 0),  # not longer than the expiry
            (A, S1, "w2", 90_002, 5, 0),  # longer
            (A, S1, "w2", 90_002, 4, 0),  # expiry is tested before the count
            (A, S1, "w2", 10, 4, 0),  # count moved
            (A, S1, "w2", 10, None, 0),  # never seen
            (A, S2, "w2", 10, None, 0),  # no lease
        ],
        "app_name string, shard_id string, worker string, now_ms long, tracked_count long, "
        "counted_at_ms long",
    )
    got = lease_actions(table, seen).collect()
    assert sorted(
        ((r.action, r.expected_count, r.next_count, r.next_counted_at_ms) for r in got), key=repr
    ) == sorted(
        [
            ("renew", 5, 5, 0),
            ("track", None, 5, 0),
            ("take", 5, 5, 0),
            ("take", 4, 4, 0),
            ("track", None, 5, 10),
            ("track", None, 5, 10),
            ("create", None, None, 0),
        ],
        key=repr,
    )


def test_stale_leases_in_slices(spark, rows):
    rng = random.Random(5)
    start, data, count = datetime(2024, 1, 1), [], {}
    for i in range(2_000):
        shard = "hot" if i % 3 == 0 else f"s{rng.randrange(20)}"
        if rng.random() < 0.02:
            count[shard] = count.get(shard, 1) + 1
        data.append((shard, i, start + timedelta(seconds=i), count.get(shard, 1)))
    df = spark.createDataFrame(data, "shard_id string, obs_id long, obs_ts timestamp_ntz, lease_count long")
    plain = stale_leases(df, 90_001)
    assert rows(stale_leases(df, 90_001, slice_rows=30)) == rows(plain)
    last, changed, want = {}, {}, []
    for shard, i, ts, n in data:
        since = changed.get(shard)
        want.append((shard, i, since is not None and ts - since > timedelta(milliseconds=90_001)))
        if last.get(shard) != n:
            changed[shard] = ts
        last[shard] = n
    assert rows(plain, "shard_id", "obs_id", "stale") == sorted(want, key=repr)
    assert any(w[2] for w in want)


def test_stale_leases_on_the_event_table(spark):
    """Known number: leases counted by purchases, expiry of three days."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    events.createOrReplaceTempView("ev")
    history = spark.sql(
        "SELECT CAST(user_id AS STRING) AS shard_id, event_id AS obs_id, ts AS obs_ts, 1 + "
        "sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id "
        "ORDER BY event_id) AS lease_count FROM ev"
    )
    assert stale_leases(history, 3 * 86_400_000).where("stale").count() == 2_379


# --- the command log --------------------------------------------------------


def by_hand(commands, initial):
    """The lease table after the commands, one after the other."""
    table = {k: list(v) for k, v in initial.items()}  # owner, count, checkpoint, completed
    for app, shard, _, op, worker, expected, checkpoint in sorted(commands, key=lambda c: c[2]):
        lease = table.get((app, shard))
        if lease is None:
            if op == "create":
                table[app, shard] = [worker, 1, None, False]
            continue
        counted = expected is None or expected == lease[1]
        if op == "renew" and lease[0] == worker and counted:
            lease[1] += 1
        elif op == "take" and lease[0] != worker and counted:
            lease[0], lease[1] = worker, lease[1] + 1
        elif op == "checkpoint" and lease[0] == worker:
            lease[2] = checkpoint
        elif op == "close" and lease[0] == worker:
            lease[3] = True
    return sorted(((*k, v[2], v[0], v[1], v[3]) for k, v in table.items()), key=repr)


def random_log(seed, n, expected_span):
    rng = random.Random(seed)
    log = []
    for i in range(n):
        shard = S1 if i % 3 == 0 else shard_id(rng.randrange(8))
        op = rng.choices(["create", "renew", "take", "checkpoint", "close"], [2, 8, 8, 4, 0.1])[0]
        expected = rng.randint(1, expected_span) if rng.random() < 0.4 else None
        if op in ("renew", "take") and rng.random() < 0.3:
            expected = max(1, i // 12 + rng.randint(-3, 3))  # near the true count
        log.append((A, shard, i, op, f"w{rng.randrange(4)}", expected, str(i)))
    return log


@pytest.mark.parametrize(("seed", "span"), [(1, 3), (2, 40), (3, 400)])
@pytest.mark.parametrize("slice_rows", [25, 10_000])
def test_fold_leases(spark, rows, seed, span, slice_rows):
    log = random_log(seed, 1_200, span)
    first = {(A, S1): ("w9", 4, "x", False), (A, shard_id(99)): ("w1", 2, None, True)}
    initial = leases(spark, *[(*k, v[2], v[0], v[1], v[3]) for k, v in first.items()])
    commands = spark.createDataFrame(log, LEASE_COMMANDS)
    assert rows(fold_leases(commands, slice_rows=slice_rows)) == by_hand(log, {})
    got = fold_leases(commands, initial, slice_rows=slice_rows)
    assert rows(got) == by_hand(log, first)


def test_summary_of_a_slice_holds_for_every_start():
    from shardweave.operators.lease_log import _chain, _summarise

    for seed in range(8):
        log = [c for c in random_log(seed, 60, 12) if c[1] == S1]
        frame = pd.DataFrame(log, columns=[f.name for f in LEASE_COMMANDS.fields]).assign(_slice=0)
        table = _summarise(frame)
        after = pd.concat([table, table.assign(_slice=1)])
        starts = [None] + [(o, n) for o in ("w0", "w1", "w2", "w3", "zz") for n in range(1, 16)]
        for start in starts:
            first = pd.DataFrame(
                [] if start is None else [start], columns=["lease_owner", "lease_count"]
            )
            out = _chain(after, first)
            end = out[out["_slice"] == 1].iloc[0]
            want = by_hand(log, {} if start is None else {(A, S1): [*start, None, False]})
            if want:
                assert (end["owner_in"], end["count_in"]) == (want[0][3], want[0][4])
            else:
                assert pd.isna(end["owner_in"])


def test_summary_costs_no_more_for_many_counts():
    """Every command names a count of its own; quadratic work would take minutes."""
    from shardweave.operators.lease_log import _summarise

    n = 30_000
    frame = pd.DataFrame(
        {
            "app_name": "a",
            "shard_id": "s",
            "_slice": 0,
            "seq": range(n),
            "op": ["renew" if i % 2 else "take" for i in range(n)],
            "worker": [f"w{i % 3}" for i in range(n)],
            "expected_count": range(1, n + 1),
        }
    )
    start = time.perf_counter()
    assert len(_summarise(frame)) > n
    assert time.perf_counter() - start < 20
