import json
import random

from conftest import seq, shard_id
from pyspark.sql import functions as F

from shardweave.operators import resume_read
from shardweave.schemas import LEASES, LISTING_PAGE, RECORDS, SHARDS
from shardweave.sources import (
    LeaseStore,
    active_streams,
    encode_records,
    lease_lookup,
    listing_pages,
    poll_pacing,
    read_limited,
    read_records,
    read_table,
    read_unread,
    route_to_shard,
    shard_listing,
    write_records,
)
from shardweave.sources.listing import paged
from shardweave.workloads import inputs, queries
from shardweave.workloads.queries import QUERIES


def entry(n, lo=0, hi=10, start="1", parent=None):
    return (shard_id(n), parent, None, (str(lo), str(hi)), (start, None))


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), LISTING_PAGE)


def test_two_pages_with_the_same_five_shards(spark, rows):
    five = [entry(n) for n in range(1, 6)]
    df = pages(spark, ("s", 1, "ACTIVE", True, five), ("s", 2, "ACTIVE", False, five))
    assert rows(shard_listing(df), "shard_id") == [(shard_id(n),) for n in range(1, 6)]


def test_lowest_page_and_last_position_win(spark, rows):
    df = pages(
        spark,
        ("s", 1, "ACTIVE", True, [entry(1, start="1"), entry(1, start="2")]),
        ("s", 2, "ACTIVE", False, [entry(1, start="3"), entry(2, start="4")]),
    )
    assert rows(shard_listing(df), "shard_id", "seq_start") == [
        (shard_id(1), "2"),
        (shard_id(2), "4"),
    ]


def test_pages_after_the_last_are_ignored(spark, rows):
    df = pages(
        spark,
        ("s", 1, "ACTIVE", False, [entry(1)]),
        ("s", 2, "DELETING", False, [entry(2)]),
    )
    assert rows(shard_listing(df), "shard_id") == [(shard_id(1),)]
    assert rows(active_streams(df)) == [("s", "ACTIVE", True, None)]


def test_only_active_streams(spark, rows):
    df = pages(
        spark,
        ("s", 1, "UPDATING", False, [entry(1)]),
        ("t", 1, "ACTIVE", False, [entry(2)]),
    )
    assert rows(active_streams(df)) == [("s", "UPDATING", False, 30_000), ("t", "ACTIVE", True, None)]
    assert rows(shard_listing(df, active_only=True), "shard_id") == [(shard_id(2),)]


def test_listing_round_trip(spark, rows, tmp_path):
    shards = spark.createDataFrame(
        [("s", shard_id(n), None, None, "0", "9", "1", None) for n in range(7)], SHARDS
    )
    path = str(tmp_path / "pages")
    paged(shards, 3).write.json(path)
    back = listing_pages(spark, path)
    assert back.count() == 3
    assert rows(shard_listing(back), *shards.columns) == rows(shards)


def test_encode_records_from_a_json_array(spark, tmp_path, rows):
    people = [{"id": f"id-{i}", "name": f"n{i}", "email": f"{i}@x", "city": "c"} for i in range(5)]
    file = tmp_path / "people.json"
    file.write_text(json.dumps(people, indent=1))
    df = spark.read.json(str(file), multiLine=True)
    out = encode_records(df, "id").collect()
    assert sorted(r.partition_key for r in out) == [p["id"] for p in people]
    assert sorted((json.loads(r.data) for r in out), key=lambda p: p["id"]) == people


def _records(spark, n):
    return spark.range(n).select(
        F.lit("s").alias("stream_name"),
        F.format_string("shardId-%012d", F.col("id") % 3).alias("shard_id"),
        F.format_string("49606519%048d", "id").alias("sequence_number"),
        F.col("id").cast("string").alias("partition_key"),
        F.lit("d").alias("data"),
        F.lit(None).cast("timestamp_ntz").alias("arrival_ts"),
    )


def test_write_and_read_records(spark, tmp_path, rows):
    path = str(tmp_path / "records")
    records = _records(spark, 90)
    write_records(records.where("partition_key < 50"), path)
    write_records(records.where("NOT partition_key < 50"), path)
    cols = [f.name for f in RECORDS.fields]
    assert rows(read_table(spark, path), *cols) == rows(records, *cols)
    assert read_table(spark, path, lowest=seq(59)).count() == 30


def test_read_unread(spark, tmp_path, rows):
    path = str(tmp_path / "records")
    records = _records(spark, 90)
    write_records(records, path)
    held = spark.createDataFrame(
        [("a", shard_id(0), seq(60), "w", 1, False), ("a", shard_id(1), None, "w", 1, False)], LEASES
    )
    cols = ("shard_id", "sequence_number")
    some = read_unread(spark, path, held, "a")
    assert rows(resume_read(some, held, "a"), *cols) == rows(resume_read(records, held, "a"), *cols)
    assert some.count() == 9 + 30
    assert read_unread(spark, path, held, "b").count() == 0


def test_read_positions(spark):
    records = _records(spark, 30)
    assert read_records(records, "trim_horizon").count() == 30
    assert read_records(records, "after_sequence_number", seq(9)).count() == 20
    assert read_records(records, "at_sequence_number", seq(9)).count() == 21
    assert read_records(records, "latest").count() == 0


def test_limit_and_pacing(spark, rows):
    records = _records(spark, 10)  # shards 0..2 have 4, 3, 3 records
    shards = spark.createDataFrame([(shard_id(n),) for n in range(4)], "shard_id string")
    read = read_limited(records, 4)
    assert rows(poll_pacing(read, shards, 4)) == [
        (shard_id(0), 4, None),
        (shard_id(1), 3, 0),
        (shard_id(2), 3, 0),
        (shard_id(3), 0, 5_000),
    ]
    assert rows(poll_pacing(read, shards, 0, 7)) == [
        (shard_id(0), 4, 0),
        (shard_id(1), 3, 0),
        (shard_id(2), 3, 0),
        (shard_id(3), 0, 7),
    ]


def _six(spark, which):
    """Six even ranges; their bounds are no whole hex digits."""
    cut = [i * 2**128 // 6 for i in range(7)]
    return spark.createDataFrame(
        [
            ("s", shard_id(n), None, None, str(cut[n]), str(cut[n + 1] - 1), "1", None)
            for n in which
        ],
        SHARDS,
    )


def _keys(spark):
    return spark.range(2_000).select(
        F.lit("s").alias("stream_name"), F.col("id").cast("string").alias("partition_key")
    )


def test_routing_by_hash_range(spark):
    out = route_to_shard(_keys(spark), _six(spark, range(6))).collect()
    for r in out:
        assert r.shard_id == shard_id(int(r.hash_key, 16) * 6 // 2**128)
    assert len({r.shard_id for r in out}) == 6


def test_keys_no_shard_covers(spark):
    out = route_to_shard(_keys(spark), _six(spark, range(1, 6))).collect()
    assert len(out) == 2_000
    for r in out:
        n = int(r.hash_key, 16) * 6 // 2**128
        assert r.shard_id == (shard_id(n) if n else None)


def test_routing_skips_closed_shards_and_finds_bounds_inside_a_prefix(spark):
    half, quarter = 2**127, 2**126 - 1
    listing = spark.createDataFrame(
        [
            ("s", shard_id(0), None, None, "0", str(half - 1), "1", "9"),
            ("s", shard_id(1), None, None, str(half), str(2**128 - 1), "1", None),
            ("s", shard_id(2), shard_id(0), None, "0", str(quarter - 1), "1", None),
            ("s", shard_id(3), shard_id(0), None, str(quarter), str(half - 1), "1", None),
        ],
        SHARDS,
    )
    for r in route_to_shard(_keys(spark), listing).collect():
        h = int(r.hash_key, 16)
        assert r.shard_id == shard_id(1 if h >= half else 2 if h < quarter else 3)


def test_routing_with_many_shards(spark):
    cut = [i * 2**128 // 700 for i in range(701)]
    listing = spark.createDataFrame(
        [("s", shard_id(n), None, None, str(cut[n]), str(cut[n + 1] - 1), "1", None) for n in range(700)],
        SHARDS,
    )
    for r in route_to_shard(_keys(spark), listing).collect():
        n = int(r.shard_id[-12:])
        assert cut[n] <= int(r.hash_key, 16) < cut[n + 1]


def _bounds_inside_one_prefix(n):
    """Bounds of n + 2 ranges of which n lie within 1/16^6 of the space."""
    width = 2**104
    low = 0xABCDEF * width
    return [0, *[low + i * width // n for i in range(n + 1)], 2**128]


def test_routing_with_dense_splits_has_small_cells(spark):
    from shardweave.sources import routing

    cut = _bounds_inside_one_prefix(10_000)
    listing = spark.createDataFrame(
        [("s", shard_id(n), None, None, str(cut[n]), str(cut[n + 1] - 1), "1", None) for n in range(len(cut) - 1)]
        + [("t", shard_id(0), None, None, "0", str(2**128 - 1), "1", None)],
        SHARDS,
    )
    ranges = routing.hex_ranges(listing).select("stream_name", "shard_id", "hash_start", "hash_end")
    sizes = routing._cells(ranges, disjoint=True).groupBy("stream_name", "_cell").count()
    assert sizes.agg(F.max("count")).first()[0] <= 16
    assert sizes.groupBy(F.length("_cell")).count().count() >= 8

    keys = [("s", f"k{i}", f"{h:032x}") for i, h in enumerate([*cut[:-1], *[c - 1 for c in cut[1:]]])]
    keys += [("t", "k", "f" * 32), ("u", "k", "0" * 32), ("s", None, None)]
    found = _routed_by_key(spark, keys, listing)
    for i in range(len(cut) - 1):
        assert found["s", keys[i][2]] == found["s", keys[len(cut) - 1 + i][2]] == shard_id(i)
    assert found["t", "f" * 32] == shard_id(0)
    assert found["u", "0" * 32] is None and found["s", None] is None


def test_routing_with_overlapping_ranges(spark):
    rng = random.Random(2)
    spans = [sorted(rng.sample(range(2**128 >> 100), 2)) for _ in range(60)] + [(0, 2**28 - 1)]
    spans += [(77 * 2**16 + i, 77 * 2**16 + i + 3) for i in range(60)]
    spans = [(a << 100, ((b + 1) << 100) - 1) for a, b in spans]
    listing = spark.createDataFrame(
        [("s", shard_id(n), None, None, str(a), str(b), "1", None) for n, (a, b) in enumerate(spans)], SHARDS
    )
    probes = [h for a, b in spans for h in (a, b, (a + b) // 2)]
    found = _routed_by_key(spark, [("s", "k", f"{h:032x}") for h in probes], listing, open_only=False)
    for h in probes:
        first = min((a, b, shard_id(n)) for n, (a, b) in enumerate(spans) if a <= h <= b)
        assert found["s", f"{h:032x}"] == first[2]


def _routed_by_key(spark, keys, listing, **options):
    """The shard per (stream, hash), with the hash taken as the partition key."""
    from unittest.mock import patch

    from shardweave.sources import routing

    recs = spark.createDataFrame(keys, "stream_name string, name string, partition_key string")
    with patch.object(routing, "hash_key", F.col):
        routed = route_to_shard(recs, listing, **options)
        return {(r.stream_name, r.partition_key): r.shard_id for r in routed.collect()}


def test_lease_lookup(spark, rows):
    leases = spark.createDataFrame([("a", shard_id(1), None, "w", 3, False)], LEASES)
    keys = spark.createDataFrame(
        [("a", shard_id(1)), ("a", shard_id(2)), ("b", shard_id(1))], "app_name string, shard_id string"
    )
    got = rows(lease_lookup(leases, keys), "app_name", "shard_id", "lease_count", "found")
    assert got == [
        ("a", shard_id(1), 3, True),
        ("a", shard_id(2), None, False),
        ("b", shard_id(1), None, False),
    ]


def test_lease_store_versions(spark, tmp_path, rows):
    store = LeaseStore(spark, str(tmp_path / "leases"))
    assert store.read().count() == 0 and store.versions() == []
    one = spark.createDataFrame([("a", shard_id(1), None, "w", 1, False)], LEASES)
    two = spark.createDataFrame([("a", shard_id(1), seq(4), "w", 2, False)], LEASES)
    store.write(0, one)
    store.write(10, two)
    assert store.versions() == [0, 10]
    assert rows(store.read(), *one.columns) == rows(two)
    assert rows(store.read(before=10), *one.columns) == rows(one)
    store.write(10, one)
    assert rows(store.read(), *one.columns) == rows(one)
    store.write(11, one.limit(0))
    assert store.versions() == [0, 10, 11] and store.read().count() == 0


def _table(spark, rows):
    return spark.createDataFrame([("a", shard_id(k), None, "w", n, False) for k, n in sorted(rows.items())], LEASES)


def test_lease_store_writes_in_proportion_to_changes(spark, tmp_path, rows):
    """A thousand leases, then steps that change, add or drop one: the state is
    right after each, and a step does not write the table anew."""
    store = LeaseStore(spark, str(tmp_path / "leases"))
    state = {k: 1 for k in range(1000)}
    store.write((0, 0), _table(spark, state))
    whole = store.folder.size(store._all()[0].name)
    for n in range(1, 21):
        batch, step = divmod(n, 8)
        if n % 7 == 3:
            del state[n]
        else:
            state[n % 5 + (2000 if n % 6 == 0 else 0)] = n
        store.write((batch, step), _table(spark, state))
        if n % 10 == 0:
            assert rows(store.read().select("shard_id", "lease_count")) == sorted((shard_id(k), v) for k, v in state.items())
        store.compact()
    assert rows(store.read().select("shard_id", "lease_count")) == sorted((shard_id(k), v) for k, v in state.items())
    store.compact()
    changes = [p for p in store._all() if p.level == 0 and p.first != (0, 0)]
    assert len(store.folder.names()) < 18 and all(store.folder.size(p.name) < whole / 2 for p in changes)


def test_lease_store_repeats_a_micro_batch(spark, tmp_path, rows):
    store = LeaseStore(spark, str(tmp_path / "leases"))
    store.write((0, 0), _table(spark, {1: 1, 2: 1}))
    for step in range(9):
        store.write((1, step), _table(spark, {1: 1, 3: step}))
        store.compact()
    assert rows(store.read((1, 0)).select("lease_count")) == [(1,), (1,)]
    store.write((1, 0), _table(spark, {1: 5}))  # the repetition; it takes one step
    assert rows(store.read().select("shard_id", "lease_count")) == [(shard_id(1), 5)]
    store.write((2, 0), _table(spark, {}))
    assert store.read().count() == 0


def test_lease_store_passes_over_what_was_not_committed(spark, tmp_path, rows):
    store = LeaseStore(spark, str(tmp_path / "leases"))
    store.write(0, _table(spark, {1: 1}))
    store.write(1, _table(spark, {1: 2}))
    (tmp_path / "leases" / store._all()[1].name / "_SUCCESS").unlink()
    assert rows(store.read().select("lease_count")) == [(1,)] and store.versions() == [0]


def test_listing_pages_are_made_in_slices(spark, tmp_path, rows, monkeypatch):
    types = F.element_at(F.array(*map(F.lit, ("view", "click", "signup"))), (F.col("id") % 3 + 1).cast("int"))
    events = spark.range(0, 1000, 1, 1).select(F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"), types.alias("event_type"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    whole = rows(QUERIES["shard_listing"](spark, str(tmp_path)))
    monkeypatch.setattr(inputs, "SLICE_ROWS", 50)
    monkeypatch.setattr(queries, "SLICE_ROWS", 50)
    assert inputs.table(spark, str(tmp_path), "listing").rdd.getNumPartitions() == 20
    found = QUERIES["shard_listing"](spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 40 and rows(found) == whole
