"""Inputs of the registered queries, derived from whole given tables.

Every input is one SQL text that means the same in Spark and in DuckDB.
``{name}`` stands for another input or for a given table.
"""

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = {"events", "customer", "orders", "lineitem"}

# rows of a table that a task makes wide rows of at a time
SLICE_ROWS = 100_000
_WIDENED = {"listing": "events"}

SEQ = "'49606519' || lpad(CAST({} AS STRING), 48, '0')"
SHARD = "'shardId-' || lpad(CAST({} AS STRING), 12, '0')"


def seq(expr) -> str:
    """A 56-digit sequence number as SQL."""
    return "(" + SEQ.replace("{}", str(expr)) + ")"


def shard(expr) -> str:
    return "(" + SHARD.replace("{}", str(expr)) + ")"


# bounds of the four quarters of the hash key space, as listings spell them
_Q = [i * 2**126 for i in range(5)]


def _span(lo: int, hi: int) -> str:
    return f"'{_Q[lo]}', '{_Q[hi] - 1}'"


_BLOCK = "CAST(floor(event_id / 16) AS BIGINT)"

INPUTS = {
    # one record per event, in four shards by the hash of the user
    "records": f"""
        SELECT 'events' AS stream_name,
               CASE WHEN h < '4' THEN {shard(0)} WHEN h < '8' THEN {shard(1)}
                    WHEN h < 'c' THEN {shard(2)} ELSE {shard(3)} END AS shard_id,
               {seq("event_id")} AS sequence_number,
               CAST(user_id AS STRING) AS partition_key,
               CAST(event_id AS STRING) || '|' || event_type AS data,
               ts AS arrival_ts, event_type
        FROM (SELECT *, md5(CAST(user_id AS STRING)) AS h FROM {{events}}) e
    """,
    # four shards that cover the hash key space, the second one closed and split
    "shards": f"""
        SELECT 'events' AS stream_name, {shard("k")} AS shard_id,
               CASE WHEN p >= 0 THEN {shard("p")} END AS parent_shard_id,
               CAST(NULL AS STRING) AS adjacent_parent_shard_id,
               hash_start, hash_end, {seq(0)} AS seq_start,
               CASE WHEN closed THEN {seq(999999999999)} END AS seq_end
        FROM (VALUES (0, -1, {_span(0, 1)}, false), (1, -1, {_span(1, 2)}, true),
                     (2, -1, {_span(2, 3)}, false), (3, -1, {_span(3, 4)}, false),
                     (4, 1, {_span(1, 2)}, false))
             AS t(k, p, hash_start, hash_end, closed)
    """,
    "leases": f"""
        SELECT app_name, {shard("k")} AS shard_id,
               CASE WHEN cp >= 0 THEN {seq("cp")} END AS checkpoint,
               lease_owner, CAST(n AS BIGINT) AS lease_count, completed
        FROM (VALUES ('app-a', 0, -1, 'worker-0', 1, false), ('app-a', 1, 500, 'worker-1', 12, false),
                     ('app-a', 2, 250, 'worker-1', 3, true), ('app-b', 0, 100, 'worker-2', 7, false),
                     ('app-b', 1, -1, 'worker-2', 7, false))
             AS t(app_name, k, cp, lease_owner, n, completed)
    """,
    # one shard per event, in streams of sixteen shards, whose ids begin anew in
    # every stream, with one reshard history:
    # splits (2-5), merges (6, 8, 15), an unlisted parent (10), an adjacent parent
    # alone (11), a cycle (12, 13) and a shard below it (14)
    "listing": f"""
        SELECT 'stream-' || lpad(CAST({_BLOCK} AS STRING), 9, '0') AS stream_name,
               {shard("k")} AS shard_id,
               CASE WHEN p = -2 THEN 'shardId-9' || lpad(CAST(k AS STRING), 11, '0')
                    WHEN p >= 0 THEN {shard("p")} END AS parent_shard_id,
               CASE WHEN a >= 0 THEN {shard("a")} END AS adjacent_parent_shard_id,
               hash_start, hash_end, {seq("event_id")} AS seq_start,
               CASE WHEN closed THEN {seq("event_id + 1000000000")} END AS seq_end,
               {_BLOCK} AS block, k, event_type
        FROM {{events}} e
        JOIN (VALUES (0, -1, -1, {_span(0, 2)}, true), (1, -1, -1, {_span(2, 4)}, true),
                     (2, 0, -1, {_span(0, 1)}, true), (3, 0, -1, {_span(1, 2)}, true),
                     (4, 1, -1, {_span(2, 3)}, true), (5, 1, -1, {_span(3, 4)}, false),
                     (6, 3, 4, {_span(1, 3)}, true), (7, 2, -1, {_span(0, 1)}, true),
                     (8, 7, 6, {_span(0, 3)}, true), (9, 8, -1, {_span(0, 1)}, false),
                     (10, -2, -1, {_span(1, 3)}, false), (11, -1, 5, {_span(0, 1)}, true),
                     (12, 13, -1, {_span(0, 1)}, true), (13, 12, -1, {_span(0, 1)}, true),
                     (14, 12, -1, {_span(0, 1)}, true), (15, 5, 11, {_span(0, 1)}, true))
             AS t(k, p, a, hash_start, hash_end, closed)
          ON e.event_id - 16 * CAST(floor(e.event_id / 16) AS BIGINT) = t.k
    """,
    # every shard stands on two pages; some streams stop early, some are not active
    "page_entries": f"""
        SELECT stream_name, page_no, c,
               CASE WHEN block % 5 = 4 AND page_no > 1 THEN 'UPDATING' ELSE 'ACTIVE' END
                 AS stream_status,
               page_no < 5 AND NOT (block % 3 = 2 AND page_no = 2) AS has_more,
               shard_id, parent_shard_id, adjacent_parent_shard_id, hash_start, hash_end,
               seq_start || CAST(c AS STRING) AS seq_start, seq_end
        FROM (SELECT l.*, 0 AS c, CAST(floor(k / 4) AS INT) + 1 AS page_no FROM {{listing}} l
              UNION ALL
              SELECT l.*, 1 AS c, CAST(floor(k / 4) AS INT) + 2 AS page_no FROM {{listing}} l) x
    """,
    "listing_leases": """
        SELECT 'app-a' AS app_name, stream_name, shard_id, CAST(NULL AS STRING) AS checkpoint,
               'worker-0' AS lease_owner, CAST(1 AS BIGINT) AS lease_count,
               event_type IN ('purchase', 'view') AS completed
        FROM {listing} l WHERE event_type <> 'signup'
    """,
    # records of orders over the listing; the last shards are not listed
    "replay_records": f"""
        SELECT 'stream-' || lpad(CAST(CAST(floor(o_orderkey * 3 / 64) AS BIGINT) AS STRING), 9, '0')
                 AS stream_name,
               {shard("CAST(floor(o_orderkey * 3 / 4) AS BIGINT) % 16")} AS shard_id,
               CAST(o_orderkey AS STRING) AS sequence_number,
               CAST(o_custkey AS STRING) AS partition_key, o_orderpriority AS data
        FROM {{orders}} o
    """,
    # one shard per user
    "user_records": f"""
        SELECT {shard("user_id")} AS shard_id, {seq("event_id")} AS sequence_number,
               CAST(user_id AS STRING) AS partition_key, event_type AS data, ts AS arrival_ts
        FROM {{events}} e
    """,
    "user_shards": f"""
        SELECT 'events' AS stream_name, {shard("user_id")} AS shard_id,
               CASE WHEN user_id % 2 = 0 THEN {seq("last_id + 1")} END AS seq_end
        FROM (SELECT user_id, max(event_id) AS last_id FROM {{events}} e GROUP BY user_id) u
    """,
    # users whose first event is a sign-up have no lease yet
    "user_leases": f"""
        SELECT 'app-a' AS app_name, {shard("u.user_id")} AS shard_id,
               CASE WHEN u.user_id % 3 = 0 THEN NULL
                    WHEN u.user_id % 3 = 1 THEN {seq("u.last_id")}
                    ELSE {seq("u.first_id")} END AS checkpoint,
               'worker-' || CAST(u.user_id % 3 AS STRING) AS lease_owner,
               1 + u.user_id % 2 AS lease_count, u.user_id % 7 = 0 AS completed
        FROM (SELECT user_id, min(event_id) AS first_id, max(event_id) AS last_id
              FROM {{events}} e GROUP BY user_id) u
        JOIN {{events}} f ON f.event_id = u.first_id
        WHERE f.event_type <> 'signup'
    """,
    "user_acks": f"""
        SELECT 'app-a' AS app_name, {shard("user_id")} AS shard_id,
               {seq("CAST(floor(event_id / 3) AS BIGINT)")} AS sequence_number,
               event_id % 3 AS attempt, ts AS ack_ts,
               CASE WHEN event_type = 'error' AND value > 190 THEN 'failed' ELSE 'ok' END AS status
        FROM {{events}} e
    """,
    "retry_acks": f"""
        SELECT 'app-a' AS app_name,
               {shard("CAST(floor(event_id / 3) AS BIGINT) % 64")} AS shard_id,
               {seq("CAST(floor(event_id / 3) AS BIGINT)")} AS sequence_number,
               event_id % 3 AS attempt,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status
        FROM {{events}} e
    """,
    "requests": f"""
        SELECT 'app-a' AS app_name, {shard("user_id")} AS shard_id, event_id AS request_seq,
               'worker-' || CAST(event_id % 3 AS STRING) AS worker,
               1 + event_id % 2 AS expected_count, {seq("event_id")} AS checkpoint, event_type
        FROM {{events}} e
    """,
    "observations": f"""
        SELECT 'app-a' AS app_name, {shard("user_id")} AS shard_id,
               'worker-' || CAST(event_id % 4 AS STRING) AS worker, event_id * 1000 AS now_ms,
               CASE WHEN event_type <> 'view' THEN 1 + event_id % 2 END AS tracked_count,
               event_id * 1000 - (event_id * 37 % 181) * 1000 AS counted_at_ms
        FROM {{events}} e
    """,
    # an ordered log of commands on fifty leases
    "lease_commands": f"""
        SELECT 'app-a' AS app_name, {shard("user_id % 50")} AS shard_id, event_id AS seq,
               CASE event_type WHEN 'signup' THEN 'create' WHEN 'view' THEN 'renew'
                               WHEN 'click' THEN 'take' WHEN 'purchase' THEN 'checkpoint'
                               ELSE 'close' END AS op,
               'worker-' || CAST(event_id % 3 AS STRING) AS worker,
               CASE WHEN event_id % 5 = 0 THEN CAST(1 + event_id % 4 AS BIGINT) END
                 AS expected_count,
               {seq("event_id")} AS checkpoint
        FROM {{events}} e
    """,
    # a lease count per user that moves every few days, as observed at each event
    "lease_history": f"""
        SELECT {shard("user_id")} AS shard_id, event_id AS obs_id, ts AS obs_ts,
               CAST(1 + floor((EXTRACT(DAY FROM ts) + user_id % 5) / 5) AS BIGINT) AS lease_count
        FROM {{events}} e
    """,
    "redelivered": f"""
        SELECT {shard("l_suppkey")} AS shard_id,
               CAST(l_orderkey * 10 + l_linenumber AS STRING) AS sequence_number
        FROM {{lineitem}} l
    """,
}


def _needs(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"{(\w+)}", INPUTS[name])))


def _in_slices(df: DataFrame) -> DataFrame:
    """Dealt over tasks of some ``SLICE_ROWS`` rows, however large the files: a few
    bytes a row here become hundreds, and a task sorts what it makes of its rows."""
    n = -(-df.count() // SLICE_ROWS)
    return df.repartition(n, df.columns[0]) if n > 1 else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input, or a given table, as DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = {n: table(spark, sf_dir, n) for n in _needs(name)}
    if given := _WIDENED.get(name):
        parts[given] = _in_slices(parts[given])
    return spark.sql(INPUTS[name], **parts)


def with_inputs(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause that defines the inputs for an SQL query."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for n in _needs(name):
            visit(n)
        ordered.append(name)

    for n in names:
        visit(n)
    texts = [f"{n} AS ({re.sub(r'{(\w+)}', r'\1', INPUTS[n])})" for n in ordered]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(texts)
