"""Records: encoding rows as payloads, tables of records, positioned reads."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import seq_after, seq_at_or_after, seq_order
from ..plans import number_rows
from ..plans.numbering import SLICE_ROWS
from .folders import Folder
from .zones import POOLED, SHARD, shard_of, unread_by_start

POSITIONS = ("trim_horizon", "at_sequence_number", "after_sequence_number", "latest")
POLL_INTERVAL_MS = 5_000

# a write with more shards than this puts them into common files
MAX_FOLDERS = 1_000

# Spark limits each map task's rows per group before the shuffle up to this rank
_GROUP_LIMIT_RANK = 1_000


def encode_records(df: DataFrame, key_col: str) -> DataFrame:
    """Each row as a payload: ``data`` is the row as JSON with all its fields,
    null ones included; ``partition_key`` is the text of ``key_col``."""
    return df.select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("data"),
        F.col(key_col).cast("string").alias("partition_key"),
    )


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """Write records as parquet, one folder per shard; of a write with more than
    ``MAX_FOLDERS`` shards all go to one common folder, as files by ranges of shard
    and sequence number, with the shard as a column.  A shard may have records in both.

    ``seq_len`` is stored beside the sequence number so that a read position
    reaches the scan as a pushed filter.  The rows are rebalanced by shard:
    adaptive execution splits what a hot shard sends over many tasks and packs
    small shards together, so files are neither huge nor tiny.
    """
    sized = records.withColumn("seq_len", F.length("sequence_number"))
    if records.agg(F.approx_count_distinct("shard_id")).first()[0] > MAX_FOLDERS:
        order = [SHARD, "seq_len", "sequence_number"]
        named = F.when(F.col("shard_id") != "", F.col("shard_id"))  # folders tell no empty name from null
        sized = sized.withColumn(SHARD, named).repartitionByRange(*order)
        sized = sized.withColumn("shard_id", F.when(F.col(SHARD).isNotNull(), POOLED))
    else:
        order = ["seq_len", "sequence_number"]
        sized = sized.hint("rebalance", "shard_id")
    sized.sortWithinPartitions("shard_id", *order).write.mode(mode).partitionBy("shard_id").parquet(path)


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a table written by :func:`write_records`, in which a shard id
    stays text even where the folder names look like numbers."""
    found = spark.read.parquet(path).schema
    fields = [
        T.StructField(f.name, T.StringType()) if f.name == "shard_id" else f for f in found if f.name != SHARD
    ]
    return T.StructType(fields)


def with_pooled(schema: T.StructType) -> T.StructType:
    """A table's schema with the column that common files keep the shard in."""
    return T.StructType([T.StructField(SHARD, T.StringType()), *schema])


def read_table(
    spark: SparkSession, path: str, lowest: str | None = None, files: Sequence[str] | None = None
) -> DataFrame:
    """Read a table written by :func:`write_records`, or the given files of it.
    ``lowest`` is a sequence number no wanted record is at or below; it is pushed
    to the scan."""
    schema, folder = table_schema(spark, path), f"shard_id={POOLED}"
    pooled = folder in Folder(spark, path).names() if files is None else any(f"/{folder}/" in f for f in files)
    reader = spark.read.schema(with_pooled(schema) if pooled else schema)
    df = reader.parquet(path) if files is None else reader.option("basePath", path).parquet(*files)
    if pooled:  # apart, so that a wanted shard still picks its folder
        common = df.where(F.col("shard_id") == POOLED).withColumn("shard_id", shard_of())
        df = df.where(~F.col("shard_id").eqNullSafe(POOLED)).unionByName(common).select(*schema.names)
    if lowest is not None:
        df = df.where(
            (F.col("seq_len") > len(lowest))
            | ((F.col("seq_len") == len(lowest)) & (F.col("sequence_number") > lowest))
        )
    return df


def read_unread(spark: SparkSession, path: str, leases: DataFrame, app_name: str) -> DataFrame:
    """The part of a table written by :func:`write_records` in which unread
    records of ``app_name`` can be; :func:`resume_read` then picks them.

    Each shard is read from its own checkpoint on: the zone map
    (:func:`index_zones`) names the files that reach beyond it, and no other is
    opened.  The least checkpoint of all is pushed to the scan as well.
    """
    mine = leases.where(F.col("app_name") == app_name)
    files = unread_by_start(spark, path, mine, app_name)
    begun = F.col("checkpoint").isNotNull()
    lowest = mine.agg(F.min_by("checkpoint", F.when(begun, seq_order("checkpoint")))).first()[0]
    parts = [
        read_table(spark, path, low, names).join(mine.where(held).select("shard_id"), "shard_id", "left_semi")
        for held, low, names in ((begun, lowest, files[True]), (~begun, None, files[False]))
        if names
    ]
    return reduce(DataFrame.unionByName, parts) if parts else read_table(spark, path).where(F.lit(False))


def read_records(
    records: DataFrame, position: str, seq: str | None = None, newest: DataFrame | None = None
) -> DataFrame:
    """The records of each shard from a position on.

    ``trim_horizon``: all; ``at_sequence_number`` / ``after_sequence_number``:
    from ``seq`` inclusive / exclusive; ``latest``: what came after the reader
    began, when the shards ended at ``newest`` (``shard_id`` and ``newest``, as
    ``newest_records`` gives them); all of a shard that did not exist then.
    Without ``newest`` the reader begins now: there is nothing yet.
    """
    if position not in POSITIONS:
        raise ValueError(f"position must be one of {POSITIONS}, not {position!r}")
    if position == "trim_horizon":
        return records
    if position == "latest":
        if newest is None:
            return records.where(F.lit(False))
        began = newest.select("shard_id", F.col("newest").alias("_began"))
        later = F.col("_began").isNull() | seq_after("sequence_number", "_began")
        return records.join(began, "shard_id", "left").where(later).select(*records.columns)
    if seq is None:
        raise ValueError(f"{position} needs a sequence number")
    test = seq_at_or_after if position == "at_sequence_number" else seq_after
    return records.where(test(F.col("sequence_number"), F.lit(seq)))


def read_limited(
    records: DataFrame, n: int, by: Sequence[str] = ("shard_id",), slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """At most ``n`` records of each shard, oldest first.

    Up to rank 1,000 Spark keeps only the first ``n`` rows per shard of every
    map task before it shuffles.  For larger ``n`` the shards are cut into
    slices and slices that begin beyond ``n`` are dropped before the shuffle, so
    no task sees a whole hot shard.
    """
    order = seq_order("sequence_number")
    if n > _GROUP_LIMIT_RANK:
        ranked = number_rows(records, by, [order], "_rn", slice_rows, first=n)
        return ranked.drop("_rn")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return records.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def poll_pacing(
    read: DataFrame, shards: DataFrame, limit: int, poll_interval_ms: int = POLL_INTERVAL_MS
) -> DataFrame:
    """When to read each listed shard again after a read of at most ``limit``:
    after the poll interval if nothing came, not by itself (NULL) if exactly
    ``limit`` records came, at once (0) otherwise."""
    counts = read.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_read"))
    n_read = F.coalesce("n_read", F.lit(0)).cast("long")
    return (
        shards.select("shard_id")
        .join(counts, "shard_id", "left")
        .select("shard_id", n_read.alias("n_read"))
        .withColumn(
            "next_poll_ms",
            F.when(F.col("n_read") == 0, F.lit(poll_interval_ms))
            .when(F.col("n_read") == limit, F.lit(None))
            .otherwise(F.lit(0))
            .cast("long"),
        )
    )
