"""Shard listings that arrive in pages."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import LISTING_PAGE

RETRY_TIMEOUT_MS = 30_000


def listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """Listing pages kept as JSON lines, read with their fixed schema."""
    return spark.read.schema(LISTING_PAGE).json(path)


def _read_pages(pages: DataFrame) -> DataFrame:
    """Pages up to and including the first that says there are no more."""
    ends = pages.groupBy("stream_name").agg(
        F.min(F.when(~F.col("has_more"), F.col("page_no"))).alias("_last"),
    )
    return (
        pages.join(ends, ["stream_name"], "left")
        .where(F.col("_last").isNull() | (F.col("page_no") <= F.col("_last")))
        .drop("_last")
    )


def stream_status(pages: DataFrame) -> DataFrame:
    """Per stream the status given by the last page read."""
    return (
        _read_pages(pages.drop("shards"))
        .groupBy("stream_name")
        .agg(F.max_by("stream_status", "page_no").alias("stream_status"))
    )


def active_streams(pages: DataFrame, retry_timeout_ms: int = RETRY_TIMEOUT_MS) -> DataFrame:
    """Per stream its status, whether it is processed now, and if not, after
    how many milliseconds to list it again."""
    active = F.col("stream_status") == "ACTIVE"
    return stream_status(pages).select(
        "stream_name",
        "stream_status",
        active.alias("active"),
        F.when(~active, F.lit(retry_timeout_ms)).cast("long").alias("retry_after_ms"),
    )


def shard_listing(pages: DataFrame, active_only: bool = False) -> DataFrame:
    """The shards of each stream, one row per shard.

    Later pages stand before earlier ones and the last entry of a shard counts,
    so of several entries the one on the lowest page is kept, and within a page
    the one furthest down.  Copies are reduced before the shuffle.
    """
    read = _read_pages(pages)
    if active_only:
        wanted = active_streams(pages).where("active").select("stream_name")
        read = read.join(wanted, ["stream_name"], "left_semi")
    entries = read.select("stream_name", "page_no", F.posexplode("shards").alias("pos", "s")).select(
        "stream_name",
        "page_no",
        "pos",
        F.col("s.ShardId").alias("shard_id"),
        F.struct(
            F.col("s.ParentShardId").alias("parent_shard_id"),
            F.col("s.AdjacentParentShardId").alias("adjacent_parent_shard_id"),
            F.col("s.HashKeyRange.StartingHashKey").alias("hash_start"),
            F.col("s.HashKeyRange.EndingHashKey").alias("hash_end"),
            F.col("s.SequenceNumberRange.StartingSequenceNumber").alias("seq_start"),
            F.col("s.SequenceNumberRange.EndingSequenceNumber").alias("seq_end"),
        ).alias("entry"),
    )
    return (
        entries.groupBy("stream_name", "shard_id")
        .agg(F.min_by("entry", F.struct("page_no", -F.col("pos"))).alias("entry"))
        .select("stream_name", "shard_id", "entry.*")
    )


def paged(shards: DataFrame, page_size: int) -> DataFrame:
    """A listing as pages of ``page_size`` shards: the inverse of
    :func:`shard_listing`, for tests and for exporting a listing."""
    position = F.row_number().over(Window.partitionBy("stream_name").orderBy("shard_id")) - 1
    entry = F.struct(
        F.col("shard_id").alias("ShardId"),
        F.col("parent_shard_id").alias("ParentShardId"),
        F.col("adjacent_parent_shard_id").alias("AdjacentParentShardId"),
        F.struct(
            F.col("hash_start").alias("StartingHashKey"), F.col("hash_end").alias("EndingHashKey")
        ).alias("HashKeyRange"),
        F.struct(
            F.col("seq_start").alias("StartingSequenceNumber"),
            F.col("seq_end").alias("EndingSequenceNumber"),
        ).alias("SequenceNumberRange"),
    )
    numbered = shards.withColumn("_pos", position).withColumn(
        "page_no", (F.floor(F.col("_pos") / page_size) + 1).cast("int")
    )
    last = F.max("page_no").over(Window.partitionBy("stream_name"))
    return (
        numbered.withColumn("_last", last)
        .groupBy("stream_name", "page_no", "_last")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", entry.alias("s")))).alias("_l"))
        .select(
            "stream_name",
            "page_no",
            F.lit("ACTIVE").alias("stream_status"),
            (F.col("page_no") < F.col("_last")).alias("has_more"),
            F.transform("_l", lambda x: x["s"]).alias("shards"),
        )
    )
