"""Reading on from the checkpoint of a lease."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import seq_after
from ..plans import lookup_join


def _after_checkpoint():
    return F.col("checkpoint").isNull() | seq_after("sequence_number", "checkpoint")


def _salt_columns(records: DataFrame) -> list[str]:
    return [c for c in records.columns if c not in ("app_name", "shard_id")]


def resume_read(
    records: DataFrame, leases: DataFrame, app_name: str, fits: bool | None = None
) -> DataFrame:
    """The records ``app_name`` has not read: all of a shard whose lease has no
    checkpoint, those strictly after the checkpoint otherwise.  Records of
    shards without a lease are in :func:`missing_leases`.  ``fits`` as in
    :func:`lookup_join`."""
    mine = leases.where(F.col("app_name") == app_name).select("shard_id", "checkpoint")
    return (
        lookup_join(
            records, mine, ["shard_id"], "inner", salt_by=_salt_columns(records), fits=fits
        )
        .where(_after_checkpoint())
        .select(F.lit(app_name).alias("app_name"), *records.columns)
    )


def missing_leases(records: DataFrame, leases: DataFrame, app_name: str) -> DataFrame:
    """The records of shards for which ``app_name`` has no lease."""
    mine = leases.where(F.col("app_name") == app_name).select("shard_id")
    return lookup_join(
        records, mine, ["shard_id"], "left_anti", salt_by=_salt_columns(records)
    ).select(F.lit(app_name).alias("app_name"), *records.columns)


def multi_app_resume(records: DataFrame, leases: DataFrame) -> DataFrame:
    """:func:`resume_read` for all applications at once: a record appears once
    per application that has a lease on its shard and has not read it."""
    held = leases.select("app_name", "shard_id", "checkpoint")
    return (
        lookup_join(records, held, ["shard_id"], "inner", salt_by=_salt_columns(records))
        .where(_after_checkpoint())
        .select("app_name", *records.columns)
    )
