"""Finding the shard a record belongs to by the hash of its partition key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decimal_to_hex, hash_key
from ..plans import cut_lineage, lookup_join
from ..plans.joins import MAX_BROADCAST_ROWS
from ..plans.numbering import count_at_or_below

RANGES_PER_CELL = 16
_DIGITS = 32


def hex_ranges(shards: DataFrame) -> DataFrame:
    """The listing with its decimal hash ranges as 32 hex digits."""
    return shards.withColumn("hash_start", decimal_to_hex("hash_start")).withColumn(
        "hash_end", decimal_to_hex("hash_end")
    )


def _prefixes(key: Column, shortest: int, longest: Column) -> Column:
    """The first ``shortest`` to ``longest`` digits of a key, one row each."""
    return F.explode(
        F.transform(F.sequence(F.lit(shortest), longest), lambda n: F.substring(key, F.lit(1), n))
    )


def _parts(nodes: DataFrame) -> DataFrame:
    """The sixteen cells a node of the tree divides into."""
    digits = F.explode(F.array(*[F.lit(f"{d:x}") for d in range(16)]))
    return nodes.withColumn("_digit", digits).withColumn("_cell", F.concat("_node", "_digit")).drop("_digit")


def _cells(ranges: DataFrame, disjoint: bool) -> DataFrame:
    """``(stream_name, _cell, range)``: the ranges that touch each leaf of the
    stream's prefix tree.

    A prefix under which sixteen ranges or more begin is a node and divides into
    sixteen; what is below a node and none itself is a leaf.  So a leaf holds at
    most fifteen disjoint ranges and the one that reaches into it, however close
    together they lie.  A range touches a part of a node that holds neither of
    its ends only by covering it; if ranges may overlap, such a part may be
    divided, and then the range belongs to all leaves below.  All steps are joins
    by equal prefixes.
    """
    last_node = F.lit(_DIGITS - 1)
    nodes = cut_lineage(
        ranges.select("stream_name", _prefixes(F.col("hash_start"), 0, last_node).alias("_node"))
        .groupBy("stream_name", "_node")
        .count()
        .where(F.col("count") >= RANGES_PER_CELL)
        .select("stream_name", "_node")
    )
    as_cells = nodes.withColumnRenamed("_node", "_cell")
    at = ["stream_name", "_cell"]
    roots = ranges.select("stream_name", F.lit("").alias("_cell")).distinct()
    leaves = _parts(nodes).select(*at).union(roots).join(as_cells, at, "left_anti")

    bounds = ranges.withColumn("_bound", F.explode(F.array("hash_start", "hash_end")))
    low, high = F.rpad("_cell", _DIGITS, "0"), F.rpad("_cell", _DIGITS, "f")
    touched = (
        _parts(
            bounds.withColumn("_node", _prefixes(F.col("_bound"), 0, last_node))
            .join(nodes, ["stream_name", "_node"], "left_semi")
            .drop("_bound")
        )
        .where((F.col("hash_start") <= high) & (low <= F.col("hash_end")))
        .drop("_node")
        .unionByName(ranges.withColumn("_cell", F.lit("")))
        .distinct()
    )
    inside = touched.join(leaves, at, "left_semi")
    if disjoint:
        return inside
    covered = touched.where((F.col("hash_start") <= low) & (high <= F.col("hash_end"))).join(
        as_cells, at, "left_semi"
    )
    below = leaves.where(F.length("_cell") > 1).select(
        "stream_name",
        F.col("_cell").alias("_leaf"),
        _prefixes(F.col("_cell"), 1, F.length("_cell") - 1).alias("_cell"),
    )
    under = covered.join(below, at).drop("_cell").withColumnRenamed("_leaf", "_cell")
    return inside.unionByName(under.select(*inside.columns)).distinct()


def route_to_shard(
    records: DataFrame, shards: DataFrame, open_only: bool = True, hex_listing: bool = False
) -> DataFrame:
    """Add ``hash_key`` and ``shard_id`` to records that carry ``stream_name``
    and ``partition_key``; ``shard_id`` is NULL where no shard covers the key.

    A range test alone would compare every record with every shard.  Instead
    the hash space of a stream is divided by leading hex digits into cells,
    longer where ranges are dense, and a cell lists the few ranges that touch
    it.  A record finds its cell by equality, with one join for each length that
    cells have, and the range by binary search in the cell.  Only open shards
    receive records, and their ranges do not overlap; with ``open_only`` off
    the first of the ranges that cover a key is taken.  ``hex_listing`` says the
    ranges already are 32 hex digits.
    """
    ranges = shards if hex_listing else hex_ranges(shards)
    if open_only:
        ranges = ranges.where(F.col("seq_end").isNull())
    ranges = ranges.select("stream_name", "shard_id", "hash_start", "hash_end")
    per_stream = ranges.groupBy("stream_name").count()
    most = per_stream.agg(F.max("count").alias("most")).first()["most"] or 1
    dense = most >= RANGES_PER_CELL
    if dense:
        in_cells = cut_lineage(_cells(ranges, disjoint=open_only))
        per_cell = in_cells.groupBy("stream_name", "_cell").count()
        found = per_cell.groupBy(F.length("_cell")).agg(F.sum("count"), F.max("count")).collect()
        lengths = sorted(r[0] for r in found)  # at most 33
        entries, most = sum(r[1] for r in found), max(r[2] for r in found)
        fits = entries <= MAX_BROADCAST_ROWS
    else:
        # the one cell is told from the hash, as a constant is no key to join by
        in_cells, lengths, fits = ranges.withColumn("_cell", F.substring("hash_start", 1, 0)), [0], None

    cells = (
        in_cells.groupBy("stream_name", "_cell")
        .agg(F.array_sort(F.collect_list(F.struct("hash_start", "hash_end", "shard_id"))).alias("_r"))
    )
    joined = records.withColumn("hash_key", hash_key("partition_key"))
    for n in lengths:
        of_length = cells.where(F.length("_cell") == n).withColumnRenamed("_r", f"_r{n}")
        joined = lookup_join(
            joined.withColumn("_cell", F.substring("hash_key", 1, n)),
            of_length,
            ["stream_name", "_cell"],
            salt_by=records.columns,
            fits=fits,
        )
    held = F.coalesce(*[F.col(f"_r{n}") for n in lengths])
    key = F.col("hash_key")
    if open_only:
        found = F.get(held, count_at_or_below(F.transform(held, lambda r: r["hash_start"]), key, most) - 1)
    else:
        found = F.get(
            F.filter(held, lambda r: (r["hash_start"] <= key) & (key <= r["hash_end"])), 0
        )
    shard_id = F.when(key <= found["hash_end"], found["shard_id"])
    return joined.withColumn("shard_id", shard_id).drop("_cell", *[f"_r{n}" for n in lengths])
