"""Shard lineage: splits and merges as a graph of parents and children.

The operators take a listing with one row per shard (as ``shard_listing`` gives
it).  Shard ids begin anew in every stream, so where the listing has a
``stream_name`` it is part of every key and of every result; without one, the
listing is of one stream.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seq_order
from ..plans import cut_lineage, lookup_join, number_rows
from ..plans.numbering import SLICE_ROWS


def _stream(*tables: DataFrame) -> list[str]:
    """The key columns beside the shard id that all the tables have."""
    return ["stream_name"] if all("stream_name" in t.columns for t in tables) else []


def shard_edges(shards: DataFrame) -> DataFrame:
    """``(parent, child, kind)``: an edge from the parent, and one from the
    adjacent parent only where there is a parent as well."""
    stream = _stream(shards)
    named = F.array(
        F.struct(F.col("parent_shard_id").alias("parent"), F.lit("parent").alias("kind")),
        F.struct(F.col("adjacent_parent_shard_id").alias("parent"), F.lit("adjacent").alias("kind")),
    )
    return (
        shards.where(F.col("parent_shard_id").isNotNull())
        .select(*stream, F.col("shard_id").alias("child"), F.explode(named).alias("e"))
        .select(*stream, "e.parent", "child", "e.kind")
        .where(F.col("parent").isNotNull())
        .distinct()
    )


def shard_vertices(shards: DataFrame) -> DataFrame:
    """Listed shards and the parents they name, with ``in_listing``."""
    stream = _stream(shards)
    listed = shards.select(*stream, "shard_id", F.lit(True).alias("in_listing"))
    named = shard_edges(shards).select(*stream, F.col("parent").alias("shard_id"), F.lit(False).alias("in_listing"))
    return listed.unionByName(named).groupBy(*stream, "shard_id").agg(F.max("in_listing").alias("in_listing"))


def shard_parents(shards: DataFrame, ordered: bool = True) -> DataFrame:
    """Per vertex its sorted ``parents`` and their number, fewest first."""
    stream = _stream(shards)
    parents = (
        shard_edges(shards)
        .groupBy(*stream, F.col("child").alias("shard_id"))
        .agg(F.array_sort(F.collect_set("parent")).alias("parents"))
    )
    out = (
        shard_vertices(shards)
        .join(parents, [*stream, "shard_id"], "left")
        .withColumn("parents", F.coalesce("parents", F.array().cast("array<string>")))
        .withColumn("n_parents", F.size("parents"))
    )
    return out.orderBy("n_parents", *stream, "shard_id") if ordered else out


def ready_shards(
    shards: DataFrame, leases: DataFrame, app_name: str, reference_mode: bool = False
) -> DataFrame:
    """Per vertex whether the application starts it now: ``action`` is
    ``start``, ``wait`` or ``skip``, with a ``reason``.

    A root starts unless it is completed; a child starts when every parent is
    completed.  A parent the listing no longer names has nothing left to read
    and does not hold its children back.  Leases without a ``stream_name`` are
    those of the one stream that is listed.

    ``reference_mode`` follows the letter of the original rules instead: a
    completed child is started again, an unlisted parent is started like any
    root and holds its children back, and a lone parent without a lease gives
    ``error``.
    """
    stream, of_lease = _stream(shards), _stream(shards, leases)
    mine = leases.where(F.col("app_name") == app_name).select(*of_lease, "shard_id", "completed")
    edges = shard_edges(shards).select(*stream, "parent", "child").distinct()

    listed = shards.select(*stream, F.col("shard_id").alias("parent"), F.lit(True).alias("p_listed"))
    done_parents = mine.withColumnsRenamed({"shard_id": "parent", "completed": "p_done"})
    parents = (
        edges.join(listed, [*stream, "parent"], "left")
        .join(done_parents, [*of_lease, "parent"], "left")
        .withColumn("p_listed", F.coalesce("p_listed", F.lit(False)))
    )
    vertices = shard_vertices(shards)
    if reference_mode:
        done, missing = F.col("p_done"), F.col("p_done").isNull()
    else:
        done = F.col("p_done") | ~F.col("p_listed")
        missing = F.col("p_done").isNull() & F.col("p_listed")
    gates = parents.groupBy(*stream, F.col("child").alias("shard_id")).agg(
        F.count(F.lit(1)).cast("int").alias("n_parents"),
        F.bool_and(F.coalesce(done, F.lit(False))).alias("all_done"),
        F.bool_or(missing).alias("any_missing"),
        F.bool_and("p_listed").alias("all_listed"),
    )
    joined = (
        vertices.join(mine, [*of_lease, "shard_id"], "left")
        .join(gates, [*stream, "shard_id"], "left")
        .withColumn("n_parents", F.coalesce("n_parents", F.lit(0)))
        .withColumn("self_done", F.coalesce("completed", F.lit(False)))
    )

    def outcome(action: str, reason: str):
        return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))

    root = F.col("n_parents") == 0
    if reference_mode:
        lone_missing = (F.col("n_parents") == 1) & F.col("any_missing")
        verdict = (
            F.when(root & F.col("self_done"), outcome("skip", "completed"))
            .when(root, outcome("start", "root"))
            .when(lone_missing, outcome("error", "parent_lease_missing"))
            .when(F.col("all_done"), outcome("start", "parent_done"))
            .otherwise(outcome("wait", "parent_open"))
        )
    else:
        verdict = (
            F.when(~F.col("in_listing"), outcome("skip", "not_listed"))
            .when(F.col("self_done"), outcome("skip", "completed"))
            .when(root, outcome("start", "root"))
            .when(F.col("all_done") & F.col("all_listed"), outcome("start", "parent_done"))
            .when(F.col("all_done"), outcome("start", "parent_not_listed"))
            .when(F.col("any_missing"), outcome("wait", "parent_lease_missing"))
            .otherwise(outcome("wait", "parent_open"))
        )
    return joined.withColumn("verdict", verdict).select(
        *stream, "shard_id", "in_listing", "n_parents", "verdict.action", "verdict.reason"
    )


_FARTHEST = 2**40  # only distances around a cycle grow beyond it


def _next_state(waiting: DataFrame, known: DataFrame) -> DataFrame:
    """One step of every shard that waits.  An ancestor with a generation adds to
    ``base``; one that waits for a single ancestor is skipped, so that distances
    double; one that waits for several stays.  Of two ways to an ancestor the
    longer counts."""
    stream = _stream(waiting)
    ahead = known.select(
        *stream, F.col("shard_id").alias("parent"), F.col("base").alias("p_base"), F.col("up").alias("p_up")
    )
    over, behind = F.get("p_up", 0), F.size("p_up")
    via = F.struct(
        over["parent"].alias("parent"), F.least(over["d"] + F.col("d"), F.lit(_FARTHEST)).alias("d")
    )
    steps = (
        waiting.select(*stream, "shard_id", "base", F.explode("up").alias("e"))
        .select(*stream, "shard_id", "base", "e.parent", "e.d")
        .join(ahead, [*stream, "parent"], "left")
        .withColumn("so_far", F.when(behind <= 1, F.col("p_base") + F.col("d")))
        .withColumn("next", F.when(behind == 1, via).when(behind > 1, F.struct("parent", "d")))
    )
    farthest = F.filter(
        "up",
        lambda e, i: ~F.coalesce(F.get(F.col("up"), i + 1)["parent"] == e["parent"], F.lit(False)),
    )
    return (
        steps.groupBy(*stream, "shard_id")
        .agg(
            F.greatest(F.max("base"), F.max("so_far")).alias("base"),
            F.array_sort(F.collect_set("next")).alias("up"),
        )
        .withColumn("up", farthest)
    )


def _generations(shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(shard_id, base)`` of all vertices that are not in or below a cycle,
    their generation, and the vertices that are.

    A vertex keeps the ancestors it waits for with its distance to them
    (``up``, a few), and the greatest generation that follows from the others
    (``base``).  Along splits, and along merges whose ways meet again, the
    distances double from step to step, so a chain takes as many steps as its
    length has bits.  Every step is one job that reads what the one before wrote
    and gives a generation to one vertex at least, else the rest waits for ever.
    """
    stream = _stream(shards)

    def link(shard: Column, parent: Column) -> Column:
        return F.struct(shard.alias("shard_id"), parent.cast("string").alias("parent"))

    # the listing is read once: every shard with each of its parents, and these as shards
    shard, parent, nothing = F.col("shard_id"), F.col("parent_shard_id"), F.lit(None)
    adjacent = F.when(parent.isNotNull(), F.col("adjacent_parent_shard_id"))
    links = F.array(
        link(shard, parent), link(shard, adjacent), link(parent, nothing), link(adjacent, nothing)
    )
    one_up = F.struct(F.col("parent"), F.lit(1).cast("long").alias("d"))
    state = cut_lineage(
        shards.select(*stream, F.explode(links).alias("l"))
        .select(*stream, "l.shard_id", "l.parent")
        .where(F.col("shard_id").isNotNull())
        .groupBy(*stream, "shard_id")
        .agg(F.collect_set(F.when(F.col("parent").isNotNull(), one_up)).alias("up"))
        .withColumn("base", F.when(F.size("up") == 0, F.lit(0)).cast("long"))
        .select(*stream, "shard_id", "base", "up")
    )
    solved = []
    while True:
        n, n_solved = state.agg(F.count(F.lit(1)), F.count_if(F.size("up") == 0)).first()
        waiting = state.where(F.size("up") > 0)
        if n_solved:
            solved.append(state.where(F.size("up") == 0))
        if n_solved in (0, n):
            empty = state.where(F.lit(False))
            return reduce(DataFrame.unionByName, solved, empty), waiting
        known = reduce(DataFrame.unionByName, solved, waiting)
        state = cut_lineage(_next_state(waiting, known))


def shard_generations(shards: DataFrame) -> DataFrame:
    """``generation`` of every vertex: 0 for roots and unlisted parents, else
    one more than the greatest generation of its parents.  Shards in a cycle,
    or below one, have ``generation`` NULL and ``in_cycle`` true."""
    stream = _stream(shards)
    solved, waiting = _generations(shards)

    def rows(of: DataFrame, generation: Column, in_cycle: bool) -> DataFrame:
        return of.select(
            *stream,
            "shard_id",
            generation.cast("int").alias("generation"),
            F.lit(in_cycle).alias("in_cycle"),
        )

    return rows(solved, F.col("base"), False).unionByName(rows(waiting, F.lit(None), True))


def lineage_cycles(shards: DataFrame) -> DataFrame:
    """Shards that can never start because they are in or below a cycle."""
    return shard_generations(shards).where("in_cycle").select(*_stream(shards), "shard_id", "in_cycle")


def ordered_replay(
    records: DataFrame, generations: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Add ``generation`` and ``replay_no``, the position of a record among the
    records of its partition key: parent shards before their children, by
    sequence number inside a shard.  Records of shards without a generation
    come last (``generation`` NULL)."""
    shard = [*_stream(records, generations), "shard_id"]
    gens = generations.select(*shard, "generation")
    salt_by = [c for c in records.columns if c not in shard]
    with_gen = lookup_join(records, gens, shard, salt_by=salt_by)
    last = F.coalesce("generation", F.lit(2**31 - 1))
    return number_rows(
        with_gen,
        ["partition_key"],
        [last, seq_order("sequence_number"), *map(F.col, shard)],
        name="replay_no",
        slice_rows=slice_rows,
    )
