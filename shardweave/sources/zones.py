"""Zone map of a table of records: which files can hold unread records.

Beside the table lies one row per data file and shard in it: the shard, its number of records and
its least and greatest sequence number.  A read that goes on from the checkpoints
of leases joins the map with them and opens only files whose greatest sequence
number is after the checkpoint of their shard.  Files the map does not know yet
are read, so a map that is behind costs time and never records.
"""

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq_after, seq_order

ZONES = (
    "file STRING, shard_id STRING, n BIGINT, "
    "least STRUCT<digits: INT, seq: STRING>, greatest STRUCT<digits: INT, seq: STRING>"
)
_FOLDER = "_zones"  # tables pass over names that begin so
POOLED = "__pooled__"  # the folder of files that many shards have in common
SHARD = "_shard"  # the column with the shard in these files


def shard_of() -> Column:
    """The shard of a row of a table: its column in common files, else its folder."""
    return F.coalesce(F.col(SHARD), F.col("shard_id"))


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """The table's files, as Spark lists them to read it."""
    return spark.read.schema("shard_id STRING, sequence_number STRING").parquet(path).inputFiles()


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone map of the table at ``path``; empty if there is none."""
    try:
        zones = spark.read.schema(ZONES).parquet(f"{path.rstrip('/')}/{_FOLDER}")
    except AnalysisException:
        zones = spark.createDataFrame([], ZONES)
    return zones.dropDuplicates(["file", "shard_id"])


def paths_of(files: Iterable[str]) -> list[str]:
    """Files as Spark takes them; it tells them with escapes, as in an address."""
    return [unquote(f) for f in files]


def _rows(spark: SparkSession, path: str, files: Iterable[str]) -> DataFrame:
    reader = spark.read.schema(f"shard_id STRING, {SHARD} STRING, sequence_number STRING").option("basePath", path)
    return reader.parquet(*paths_of(files)).withColumn("shard_id", shard_of()).drop(SHARD)


def _unknown(spark: SparkSession, path: str, zones: DataFrame) -> list[str]:
    files = _data_files(spark, path)
    known = spark.createDataFrame([(f,) for f in files], "file STRING").join(zones, "file", "left_semi")
    return sorted(set(files) - {r.file for r in known.collect()}) if files else []


def index_zones(spark: SparkSession, path: str) -> int:
    """Add the files the zone map does not know, reading these alone; returns how
    many there were.  Two that index at once may add a file twice, which is as good."""
    new = _unknown(spark, path, read_zones(spark, path))
    if new:
        rows = _rows(spark, path, new)
        key = seq_order("sequence_number")
        zones = rows.groupBy(F.input_file_name().alias("file"), "shard_id").agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("least"), F.max(key).alias("greatest")
        )
        zones.write.mode("append").parquet(f"{path.rstrip('/')}/{_FOLDER}")
    return len(new)


def unread_files(spark: SparkSession, path: str, leases: DataFrame, app_name: str) -> list[str]:
    """The files in which unread records of the leases of ``app_name`` can be:
    those of shards that were not begun or with a record after the checkpoint, and
    those the map does not know."""
    return sorted({f for files in unread_by_start(spark, path, leases, app_name).values() for f in files})


def unread_by_start(spark: SparkSession, path: str, leases: DataFrame, app_name: str) -> dict[bool, list[str]]:
    """:func:`unread_files` of shards with a checkpoint (True) and without one;
    files the map does not know are in both."""
    zones = read_zones(spark, path)
    mine = leases.where(F.col("app_name") == app_name).select("shard_id", "checkpoint")
    begun = F.col("checkpoint").isNotNull()
    after = ~begun | seq_after("greatest.seq", "checkpoint")
    wanted = zones.join(mine, "shard_id").where(after).select("file", begun.alias("begun")).distinct().collect()
    unknown = _unknown(spark, path, zones)
    return {b: paths_of(sorted({r.file for r in wanted if r.begun == b}.union(unknown))) for b in (True, False)}


def newest_records(spark: SparkSession, path: str) -> DataFrame:
    """Per shard the greatest sequence number, from the map and the files it does not know."""
    known = read_zones(spark, path).select("shard_id", "greatest")
    if new := _unknown(spark, path, read_zones(spark, path)):
        rows = _rows(spark, path, new)
        known = known.unionByName(rows.select("shard_id", seq_order("sequence_number").alias("greatest")))
    return known.groupBy("shard_id").agg(F.max("greatest").alias("greatest")).select("shard_id", F.col("greatest.seq").alias("newest"))
