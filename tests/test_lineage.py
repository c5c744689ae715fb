import random

import pytest
from conftest import shard_id
from pyspark.sql import functions as F

from shardweave.operators import (
    lineage_cycles,
    ordered_replay,
    ready_shards,
    shard_edges,
    shard_generations,
    shard_parents,
    shard_vertices,
)
from shardweave.schemas import LEASES, SHARDS


def listing(spark, *rows):
    """Rows (shard, parent, adjacent) of one stream by number."""
    name = lambda n: None if n is None else shard_id(n)
    return spark.createDataFrame(
        [("s", name(n), name(p), name(a), "0", "1", "1", None) for n, p, a in rows], SHARDS
    ).drop("stream_name")


def leases(spark, **completed):
    """Leases by shard number: s0=True means shard 0 is completed."""
    return spark.createDataFrame(
        [("a", shard_id(int(k[1:])), None, "w", 1, v) for k, v in completed.items()], LEASES
    )


SPLIT = [(0, None, None), (1, None, None), (2, 0, None), (3, 0, None)]
MERGE = [(0, None, None), (1, None, None), (2, 0, 1)]
DIAMOND = [*MERGE, (3, 2, None), (4, 2, None), (5, 3, 4)]


def actions(df):
    return {int(r.shard_id[-12:]): (r.action, r.reason) for r in df.collect()}


def test_split_waits_for_its_parent(spark):
    got = actions(ready_shards(listing(spark, *SPLIT), leases(spark, s0=False, s1=False), "a"))
    assert got == {
        0: ("start", "root"),
        1: ("start", "root"),
        2: ("wait", "parent_open"),
        3: ("wait", "parent_open"),
    }


def test_split_starts_when_its_parent_is_done(spark):
    got = actions(ready_shards(listing(spark, *SPLIT), leases(spark, s0=True, s1=False), "a"))
    assert got == {
        0: ("skip", "completed"),
        1: ("start", "root"),
        2: ("start", "parent_done"),
        3: ("start", "parent_done"),
    }


@pytest.mark.parametrize(
    ("state", "ours", "reference"),
    [
        ({"s0": True, "s1": True}, ("start", "parent_done"), ("start", "parent_done")),
        ({"s0": True, "s1": False}, ("wait", "parent_open"), ("wait", "parent_open")),
        ({"s0": False, "s1": False}, ("wait", "parent_open"), ("wait", "parent_open")),
        ({"s0": True}, ("wait", "parent_lease_missing"), ("wait", "parent_open")),
        (
            {"s0": True, "s1": True, "s2": True},
            ("skip", "completed"),
            ("start", "parent_done"),
        ),
    ],
)
def test_merge_needs_both_parents(spark, state, ours, reference):
    shards, held = listing(spark, *MERGE), leases(spark, **state)
    assert actions(ready_shards(shards, held, "a"))[2] == ours
    assert actions(ready_shards(shards, held, "a", reference_mode=True))[2] == reference


def test_lone_parent_without_lease(spark):
    shards, held = listing(spark, *SPLIT), leases(spark, s1=False)
    assert actions(ready_shards(shards, held, "a"))[2] == ("wait", "parent_lease_missing")
    got = actions(ready_shards(shards, held, "a", reference_mode=True))
    assert got[2] == ("error", "parent_lease_missing")


def test_leases_of_other_applications_do_not_count(spark):
    got = actions(ready_shards(listing(spark, *SPLIT), leases(spark, s0=True), "b"))
    assert got[0] == ("start", "root") and got[2][0] == "wait"


def test_unlisted_parent(spark):
    shards = listing(spark, (7, 6, None))
    got = ready_shards(shards, leases(spark), "a")
    assert actions(got) == {6: ("skip", "not_listed"), 7: ("start", "parent_not_listed")}
    assert {r.shard_id: r.in_listing for r in shard_vertices(shards).collect()} == {
        shard_id(6): False,
        shard_id(7): True,
    }
    assert actions(ready_shards(shards, leases(spark), "a", reference_mode=True)) == {
        6: ("start", "root"),
        7: ("error", "parent_lease_missing"),
    }


def test_all_parents_completed_starts_exactly_the_open_children(spark):
    held = leases(spark, s0=True, s1=True, s2=True, s3=True, s4=False)
    got = actions(ready_shards(listing(spark, *DIAMOND), held, "a"))
    assert {n for n, (action, _) in got.items() if action == "start"} == {4}


def test_edges_and_parents(spark, rows):
    shards = listing(spark, *MERGE, (8, None, 1))
    assert rows(shard_edges(shards)) == [
        (shard_id(0), shard_id(2), "parent"),
        (shard_id(1), shard_id(2), "adjacent"),
    ]
    got = [(r.shard_id, r.n_parents) for r in shard_parents(shards).collect()]
    assert got == [(shard_id(0), 0), (shard_id(1), 0), (shard_id(8), 0), (shard_id(2), 2)]


def generations(df):
    return {int(r.shard_id[-12:]): (r.generation, r.in_cycle) for r in df.collect()}


def test_generations_of_a_diamond(spark):
    got = generations(shard_generations(listing(spark, *DIAMOND)))
    assert {n: g for n, (g, _) in got.items()} == {0: 0, 1: 0, 2: 1, 3: 2, 4: 2, 5: 3}


def test_generation_follows_the_longest_path(spark):
    rows = [(0, None, None), (1, 0, None), (2, 1, None), (3, 2, 0), (4, 3, 9)]
    got = generations(shard_generations(listing(spark, *rows)))
    assert {n: g for n, (g, _) in got.items()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 9: 0}


def test_cycles_are_reported(spark):
    rows = [(9, 10, None), (10, 9, None), (11, 9, 0), (0, None, None), (1, 0, None)]
    shards = listing(spark, *rows)
    got = generations(shard_generations(shards))
    assert got == {
        9: (None, True),
        10: (None, True),
        11: (None, True),
        0: (0, False),
        1: (1, False),
    }
    assert lineage_cycles(shards).count() == 3


def test_a_long_chain_of_splits_and_merges(spark):
    rows = [(0, None, None)]
    for level in range(12):
        top = 3 * level
        rows += [(top + 1, top, None), (top + 2, top, None), (top + 3, top + 1, top + 2)]
    got = generations(shard_generations(listing(spark, *rows)))
    assert got[36] == (24, False) and got[34][0] == 23


def test_a_chain_of_200_splits_takes_few_steps(spark, monkeypatch):
    from shardweave.operators import lineage

    steps = []
    written = lineage.cut_lineage
    monkeypatch.setattr(lineage, "cut_lineage", lambda df: steps.append(1) or written(df))
    rows = [(0, None, None)]
    for level in range(200):
        rows += [(2 * level + 1, 2 * level, None), (2 * level + 2, 2 * level, None)]
    got = generations(shard_generations(listing(spark, *rows)))
    assert got == {n: ((n + 1) // 2, False) for n in range(401)}
    assert len(steps) <= 10


def test_generations_of_any_lineage(spark):
    rng = random.Random(11)
    rows, longest = [], {}
    for n in range(150):
        back = [None if n < 3 else rng.randrange(max(0, n - 6), n), None if n < 3 else rng.randrange(n)]
        parent, other = (back[0], back[1] if rng.random() < 0.5 else None) if rng.random() < 0.95 else (None, None)
        rows.append((n, parent, other))
        longest[n] = max((longest[p] + 1 for p in (parent, other) if p is not None), default=0)
    knot = [(200, 201, None), (201, 202, 149), (202, 200, None), (203, 202, 5), (204, 203, None), (205, 205, None)]
    got = generations(shard_generations(listing(spark, *rows, *knot)))
    assert got == {n: (g, False) for n, g in longest.items()} | {n: (None, True) for n in range(200, 206)}


def test_replay_order_across_a_reshard(spark):
    gens = shard_generations(listing(spark, *DIAMOND))
    records = spark.createDataFrame(
        [
            ("k", shard_id(5), "1"),
            ("k", shard_id(2), "10"),
            ("k", shard_id(2), "9"),
            ("k", shard_id(0), "77"),
            ("k", shard_id(99), "0"),
            ("j", shard_id(3), "5"),
        ],
        "partition_key string, shard_id string, sequence_number string",
    )
    got = {
        (r.partition_key, r.replay_no): (r.shard_id, r.sequence_number, r.generation)
        for r in ordered_replay(records, gens).collect()
    }
    assert got == {
        ("k", 1): (shard_id(0), "77", 0),
        ("k", 2): (shard_id(2), "9", 1),
        ("k", 3): (shard_id(2), "10", 1),
        ("k", 4): (shard_id(5), "1", 3),
        ("k", 5): (shard_id(99), "0", None),
        ("j", 1): (shard_id(3), "5", 2),
    }


def test_replay_of_a_hot_key_in_slices(spark, rows):
    gens = shard_generations(listing(spark, *DIAMOND))
    records = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("partition_key"),
        F.format_string("shardId-%012d", F.col("id") % 7).alias("shard_id"),
        F.col("id").cast("string").alias("sequence_number"),
    )
    plain = ordered_replay(records, gens)
    assert rows(ordered_replay(records, gens, slice_rows=40)) == rows(plain)


def test_streams_with_the_same_shard_ids_do_not_mix(spark, rows):
    schema = "stream_name string, shard_id string, parent_shard_id string, adjacent_parent_shard_id string"
    shards = spark.createDataFrame(
        [("a", "0", None, None), ("a", "1", "0", None), ("b", "0", None, None), ("b", "1", None, None)], schema
    )
    assert rows(shard_vertices(shards)) == [("a", "0", True), ("a", "1", True), ("b", "0", True), ("b", "1", True)]
    assert rows(shard_generations(shards), "stream_name", "shard_id", "generation") == [
        ("a", "0", 0), ("a", "1", 1), ("b", "0", 0), ("b", "1", 0),
    ]
    leases = spark.createDataFrame(
        [("app", "b", "0", True)], "app_name string, stream_name string, shard_id string, completed boolean"
    )
    assert rows(ready_shards(shards, leases, "app"), "stream_name", "shard_id", "action") == [
        ("a", "0", "start"), ("a", "1", "wait"), ("b", "0", "skip"), ("b", "1", "start"),
    ]
