"""Schemas of the tables the operators work on."""

from pyspark.sql import types as T

_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()

HASH_KEY_RANGE = T.StructType(
    [T.StructField("StartingHashKey", _S), T.StructField("EndingHashKey", _S)]
)
SEQUENCE_NUMBER_RANGE = T.StructType(
    [
        T.StructField("StartingSequenceNumber", _S),
        T.StructField("EndingSequenceNumber", _S),
    ]
)
# one shard of a listing page, as the stream service spells it
LISTED_SHARD = T.StructType(
    [
        T.StructField("ShardId", _S),
        T.StructField("ParentShardId", _S),
        T.StructField("AdjacentParentShardId", _S),
        T.StructField("HashKeyRange", HASH_KEY_RANGE),
        T.StructField("SequenceNumberRange", SEQUENCE_NUMBER_RANGE),
    ]
)
LISTING_PAGE = T.StructType(
    [
        T.StructField("stream_name", _S),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("stream_status", _S),
        T.StructField("has_more", _B),
        T.StructField("shards", T.ArrayType(LISTED_SHARD)),
    ]
)
SHARDS = T.StructType(
    [
        T.StructField("stream_name", _S),
        T.StructField("shard_id", _S),
        T.StructField("parent_shard_id", _S),
        T.StructField("adjacent_parent_shard_id", _S),
        T.StructField("hash_start", _S),
        T.StructField("hash_end", _S),
        T.StructField("seq_start", _S),
        T.StructField("seq_end", _S),
    ]
)
RECORDS = T.StructType(
    [
        T.StructField("stream_name", _S),
        T.StructField("shard_id", _S),
        T.StructField("sequence_number", _S),
        T.StructField("partition_key", _S),
        T.StructField("data", _S),
        T.StructField("arrival_ts", T.TimestampNTZType()),
    ]
)
LEASES = T.StructType(
    [
        T.StructField("app_name", _S),
        T.StructField("shard_id", _S),
        T.StructField("checkpoint", _S),
        T.StructField("lease_owner", _S),
        T.StructField("lease_count", _L),
        T.StructField("completed", _B),
    ]
)
ACKS = T.StructType(
    [
        T.StructField("app_name", _S),
        T.StructField("shard_id", _S),
        T.StructField("ack_id", _L),
        T.StructField("position", _L),
        T.StructField("sequence_number", _S),
        T.StructField("status", _S),
        T.StructField("attempt", _L),
        T.StructField("ack_ts", T.TimestampNTZType()),
    ]
)
# ordered log of lease commands; ``checkpoint`` is read by op 'checkpoint' only
LEASE_COMMANDS = T.StructType(
    [
        T.StructField("app_name", _S),
        T.StructField("shard_id", _S),
        T.StructField("seq", _L),
        T.StructField("op", _S),
        T.StructField("worker", _S),
        T.StructField("expected_count", _L),
        T.StructField("checkpoint", _S),
    ]
)
