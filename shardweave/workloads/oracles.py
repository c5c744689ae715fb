"""Each registered query as SQL for DuckDB over the given tables."""

from .inputs import seq, with_inputs

_ORD = "length(sequence_number), sequence_number"
_LEASE_COLS = "app_name, shard_id, checkpoint, lease_owner, lease_count, completed"
_RECORD = "shard_id, sequence_number, partition_key, data, arrival_ts"
_AFTER = (
    "(l.checkpoint IS NULL OR length(r.sequence_number) > length(l.checkpoint) OR "
    "(length(r.sequence_number) = length(l.checkpoint) AND r.sequence_number > l.checkpoint))"
)
_AFTER_500 = (
    f"(length(sequence_number) > 56 OR "
    f"(length(sequence_number) = 56 AND sequence_number > {seq(500)}))"
)
_BATCHER = "CASE WHEN data LIKE '%|purchase' THEN 'orders' ELSE 'default' END"
_R = ", ".join("r." + c.strip() for c in _RECORD.split(","))


def _with(*names: str, more: str = "", recursive: bool = False) -> str:
    head = with_inputs(*names, recursive=recursive)
    return f"{head}, {more}\n" if more else head + "\n"


_UNREAD = f"""unread AS (
    SELECT l.app_name, {_R} FROM records r JOIN leases l USING (shard_id)
    WHERE l.app_name = 'app-a' AND {_AFTER})"""

_ACKS = f"""numbered AS (
    SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY {_ORD}) - 1 AS i FROM records),
  acks AS (
    SELECT 'app-a' AS app_name, shard_id, CAST(floor(i / 20) AS BIGINT) AS ack_id,
           i % 20 AS position, sequence_number,
           CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status
    FROM numbered)"""

_PAGES = """ends AS (
    SELECT stream_name, min(page_no) FILTER (WHERE NOT has_more) AS last_page
    FROM page_entries GROUP BY stream_name),
  pages_read AS (
    SELECT p.* FROM page_entries p JOIN ends USING (stream_name)
    WHERE last_page IS NULL OR page_no <= last_page),
  status AS (
    SELECT stream_name, arg_max(stream_status, page_no) AS stream_status
    FROM pages_read GROUP BY stream_name),
  picked AS (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY stream_name, shard_id ORDER BY page_no) AS rn
      FROM pages_read) x WHERE rn = 1)"""

_GRAPH = """edges AS (
    SELECT DISTINCT stream_name, parent_shard_id AS parent, shard_id AS child, 'parent' AS kind
    FROM listing WHERE parent_shard_id IS NOT NULL
    UNION
    SELECT DISTINCT stream_name, adjacent_parent_shard_id, shard_id, 'adjacent'
    FROM listing WHERE parent_shard_id IS NOT NULL AND adjacent_parent_shard_id IS NOT NULL),
  vertices AS (
    SELECT stream_name, shard_id, bool_or(in_listing) AS in_listing FROM (
      SELECT stream_name, shard_id, true AS in_listing FROM listing
      UNION ALL SELECT stream_name, parent, false FROM edges) x GROUP BY stream_name, shard_id)"""

_GATES = """gates AS (
    SELECT e.stream_name, e.child AS shard_id, count(*) AS n, count(l.shard_id) AS n_leased,
           count(*) FILTER (WHERE l.completed) AS n_done,
           count(*) FILTER (WHERE NOT v.in_listing) AS n_unlisted,
           count(*) FILTER (WHERE l.completed OR NOT v.in_listing) AS n_free,
           count(*) FILTER (WHERE l.shard_id IS NULL AND v.in_listing) AS n_missing
    FROM edges e JOIN vertices v ON v.stream_name = e.stream_name AND v.shard_id = e.parent
    LEFT JOIN listing_leases l ON l.stream_name = e.stream_name AND l.shard_id = e.parent
    GROUP BY e.stream_name, e.child),
  facts AS (
    SELECT stream_name, shard_id, v.in_listing, COALESCE(g.n, 0) AS n, n_leased, n_done, n_unlisted,
           n_free, n_missing, COALESCE(l.completed, false) AS done
    FROM vertices v LEFT JOIN gates g USING (stream_name, shard_id)
    LEFT JOIN listing_leases l USING (stream_name, shard_id))"""

_GENERATIONS = """gen AS (
    SELECT stream_name, shard_id, 0 AS g FROM vertices
    WHERE (stream_name, shard_id) NOT IN (SELECT (stream_name, child) FROM edges)
    UNION
    SELECT e.stream_name, e.child, gen.g + 1 FROM gen
    JOIN edges e ON e.stream_name = gen.stream_name AND e.parent = gen.shard_id),
  generations AS (
    SELECT stream_name, shard_id, CAST(max(g) AS INT) AS generation, max(g) IS NULL AS in_cycle
    FROM vertices v LEFT JOIN gen USING (stream_name, shard_id) GROUP BY stream_name, shard_id)"""


def _outcomes(kind: str, holds: str, failure: str, extra: str, one_winner: bool) -> str:
    win = "AND request_seq = won" if one_winner else ""
    return _with(
        "requests",
        "user_leases",
        more=f"""judged AS (
    SELECT r.*, COALESCE({holds}, false) AS holds
    FROM requests r LEFT JOIN user_leases l USING (app_name, shard_id)
    WHERE r.event_type = '{kind}'),
  firsts AS (SELECT shard_id, min(request_seq) AS won FROM judged WHERE holds GROUP BY shard_id)""",
    ) + f"""SELECT app_name, shard_id, request_seq, worker{extra},
           CASE WHEN holds {win} THEN 'ok' ELSE '{failure}' END AS outcome
    FROM judged LEFT JOIN firsts USING (shard_id)"""


def _table(kind: str, holds: str, pick: str, value: str, replace: str) -> str:
    """The lease table after the requests: ``won`` carries the winning value."""
    return _with(
        "requests",
        "user_leases",
        more=f"""won AS (
    SELECT l.shard_id, {pick}({value}, r.request_seq) AS v
    FROM requests r JOIN user_leases l USING (app_name, shard_id)
    WHERE r.event_type = '{kind}' AND {holds} GROUP BY l.shard_id)""",
    ) + f"SELECT {replace} FROM user_leases l LEFT JOIN won USING (shard_id)"


_OWN = "l.lease_owner = r.worker"
_RENEWS = f"{_OWN} AND l.lease_count = r.expected_count"
_TAKES = "l.lease_owner <> r.worker AND l.lease_count = r.expected_count"
_L = "l.app_name, shard_id"

# one step of the consumer over the records of the shards it may read
_HELD = """held AS (
    SELECT * FROM leases WHERE app_name = 'app-a' AND lease_owner = 'worker-1' AND NOT completed
    UNION ALL
    SELECT 'app-a', s.shard_id, NULL, 'worker-1', 1, false FROM shards s
    WHERE s.parent_shard_id IS NULL AND s.shard_id NOT IN
      (SELECT shard_id FROM leases WHERE app_name = 'app-a')),
  fresh AS (
    SELECT r.*, row_number() OVER (PARTITION BY r.shard_id ORDER BY length(r.sequence_number),
           r.sequence_number) AS rn, data LIKE '%|error' AS bad
    FROM records r JOIN held l USING (shard_id) WHERE """ + _AFTER + ")"


ORACLES = {
    "next_batches": _with(
        "records",
        "leases",
        more=_UNREAD
        + f""",
  numbered AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY {_ORD}) - 1 AS i
               FROM unread)""",
    )
    + """SELECT app_name, shard_id, CAST(floor(i / 40) AS BIGINT) AS ack_id,
           arg_max(sequence_number, i) AS checkpoint, count(*) AS n_ok,
           CAST(0 AS BIGINT) AS n_failed
    FROM numbered WHERE i < 100 GROUP BY ALL""",
    "encode_records": """SELECT CAST(c_custkey AS VARCHAR) AS partition_key, * FROM customer""",
    "shard_listing": _with("page_entries", more=_PAGES)
    + """SELECT stream_name, shard_id, parent_shard_id, adjacent_parent_shard_id, hash_start,
           hash_end, seq_start, seq_end FROM picked""",
    "shard_listing_active": _with("page_entries", more=_PAGES)
    + """SELECT stream_name, shard_id, parent_shard_id, adjacent_parent_shard_id, hash_start,
           hash_end, seq_start, seq_end FROM picked
    WHERE stream_name IN (SELECT stream_name FROM status WHERE stream_status = 'ACTIVE')""",
    "active_streams": _with("page_entries", more=_PAGES)
    + """SELECT stream_name, stream_status, stream_status = 'ACTIVE' AS active,
           CASE WHEN stream_status <> 'ACTIVE' THEN CAST(30000 AS BIGINT) END AS retry_after_ms
    FROM status""",
    "read_trim_horizon": _with("records") + f"SELECT {_RECORD} FROM records",
    "read_after_sequence": _with("records") + f"SELECT {_RECORD} FROM records WHERE {_AFTER_500}",
    "read_at_sequence": _with("records")
    + f"SELECT {_RECORD} FROM records WHERE {_AFTER_500} OR sequence_number = {seq(500)}",
    "read_limited": _with("records")
    + f"""SELECT {_RECORD} FROM records
    QUALIFY row_number() OVER (PARTITION BY shard_id ORDER BY {_ORD}) <= 100""",
    "read_limited_large": _with("records")
    + f"""SELECT shard_id, sequence_number FROM records
    QUALIFY row_number() OVER (PARTITION BY shard_id ORDER BY {_ORD}) <= 2000""",
    "poll_pacing": _with(
        "user_records",
        "user_shards",
        more="""counts AS (
    SELECT shard_id, least(count(*), 70) AS n FROM user_records GROUP BY shard_id)""",
    )
    + """SELECT shard_id, COALESCE(n, 0) AS n_read,
           CASE WHEN n IS NULL THEN 5000 WHEN n = 70 THEN NULL ELSE 0 END::BIGINT AS next_poll_ms
    FROM user_shards LEFT JOIN counts USING (shard_id)""",
    "lease_lookup": _with("requests", "user_leases")
    + """SELECT r.app_name, r.shard_id, r.request_seq, l.checkpoint, l.lease_owner, l.lease_count,
           l.completed, l.shard_id IS NOT NULL AS found
    FROM requests r LEFT JOIN user_leases l USING (app_name, shard_id)""",
    "route_to_shard": _with("records")
    + """SELECT sequence_number, md5(partition_key) AS hash_key,
           CASE WHEN shard_id = 'shardId-000000000001' THEN 'shardId-000000000004'
                ELSE shard_id END AS shard_id
    FROM records""",
    "route_streams": _with(
        "listing",
        more="""targets AS (
    SELECT e.event_id, 'stream-' || lpad(CAST(CAST(floor(event_id / 16) AS BIGINT) AS VARCHAR), 9, '0')
             AS stream_name,
           CASE WHEN md5(CAST(user_id AS VARCHAR)) < '4' THEN 9
                WHEN md5(CAST(user_id AS VARCHAR)) < 'c' THEN 10 ELSE 5 END AS k
    FROM events e)""",
    )
    + """SELECT t.event_id, t.stream_name, l.shard_id
    FROM targets t LEFT JOIN listing l ON l.stream_name = t.stream_name AND l.k = t.k""",
    "wrap_messages": _with("records") + f"SELECT {_RECORD} FROM records",
    "map_messages": _with("records")
    + """SELECT sequence_number, CASE WHEN data LIKE '%|error' THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN data LIKE '%|error' THEN 'bad record ' || data END AS error FROM records""",
    "dead_letters": _with("records")
    + """SELECT shard_id, sequence_number, 'bad record ' || data AS error
    FROM records WHERE data LIKE '%|error'""",
    "route_batchers": _with("records")
    + f"SELECT shard_id, {_BATCHER} AS batcher, count(*) AS n FROM records GROUP BY ALL",
    "micro_batches": _with(
        "records",
        more=f"""numbered AS (
    SELECT shard_id, {_BATCHER} AS batcher, sequence_number,
           row_number() OVER (PARTITION BY shard_id, {_BATCHER} ORDER BY {_ORD}) - 1 AS i,
           CASE WHEN data LIKE '%|purchase' THEN 10 ELSE 20 END AS size FROM records)""",
    )
    + """SELECT shard_id, batcher, CAST(floor(i / size) AS BIGINT) AS batch_no, i % size AS position,
           sequence_number FROM numbered""",
    "map_batches": _with(
        "records",
        more=f"""numbered AS (
    SELECT shard_id, {_BATCHER} AS batcher, sequence_number, partition_key,
           row_number() OVER (PARTITION BY shard_id, {_BATCHER} ORDER BY {_ORD}) - 1 AS i,
           CASE WHEN data LIKE '%|purchase' THEN 10 ELSE 20 END AS size FROM records)""",
    )
    + """SELECT shard_id, batcher, CAST(floor(i / size) AS BIGINT) AS batch_no, 'batch' AS label,
           count(*) AS n, arg_min(sequence_number, i) AS first_seq,
           arg_max(sequence_number, i) AS last_seq, count(DISTINCT partition_key) AS n_keys
    FROM numbered GROUP BY ALL""",
    "partition_by": _with(
        "records",
        more="""assigned AS (
    SELECT *, CAST(CAST('0x' || substr(md5(partition_key), 1, 8) AS BIGINT) % 7 AS INT) AS processor
    FROM records)""",
    )
    + f"""SELECT partition_key, sequence_number, processor,
           row_number() OVER (PARTITION BY processor ORDER BY {_ORD}, shard_id) AS processor_pos
    FROM assigned""",
    "resume_read": _with("records", "leases", more=_UNREAD)
    + f"SELECT app_name, {_RECORD} FROM unread",
    "missing_leases": _with("records", "leases")
    + f"""SELECT 'app-a' AS app_name, {_RECORD} FROM records
    WHERE shard_id NOT IN (SELECT shard_id FROM leases WHERE app_name = 'app-a')""",
    "multi_app_resume": _with("records", "leases")
    + f"""SELECT l.app_name, r.shard_id, r.sequence_number
    FROM records r JOIN leases l USING (shard_id) WHERE {_AFTER}""",
    "checkpoints_from_acks": _with("records", more=_ACKS)
    + """SELECT app_name, shard_id, ack_id,
           arg_max(sequence_number, position) FILTER (WHERE status = 'ok') AS checkpoint,
           count(*) FILTER (WHERE status = 'ok') AS n_ok,
           count(*) FILTER (WHERE status = 'failed') AS n_failed
    FROM acks GROUP BY ALL""",
    "checkpoints_contiguous": _with("records", more=_ACKS)
    + """, bad AS (
    SELECT shard_id, ack_id, min(position) AS b FROM acks WHERE status = 'failed' GROUP BY ALL)
    SELECT app_name, shard_id, ack_id,
           arg_max(sequence_number, position)
             FILTER (WHERE status = 'ok' AND (b IS NULL OR position < b)) AS checkpoint,
           count(*) FILTER (WHERE status = 'ok') AS n_ok,
           count(*) FILTER (WHERE status = 'failed') AS n_failed
    FROM acks LEFT JOIN bad USING (shard_id, ack_id) GROUP BY ALL""",
    "pending_retries": _with("retry_acks")
    + """SELECT app_name, shard_id, sequence_number, max(attempt) AS attempt, false AS exhausted
    FROM retry_acks GROUP BY ALL HAVING arg_max(status, attempt) = 'failed'""",
    "exhausted_retries": _with("retry_acks")
    + """SELECT app_name, shard_id, sequence_number, max(attempt) AS attempt,
           max(attempt) + 1 >= 3 AS exhausted
    FROM retry_acks GROUP BY ALL HAVING arg_max(status, attempt) = 'failed'""",
    "completed_shards": _with(
        "user_shards",
        "user_leases",
        "user_records",
        "user_acks",
        more="""newest AS (
    SELECT shard_id, max(sequence_number) AS newest FROM user_records GROUP BY shard_id),
  pending AS (
    SELECT shard_id, count(*) AS n FROM (
      SELECT shard_id, sequence_number FROM user_acks GROUP BY ALL
      HAVING arg_max(status, attempt) = 'failed') x GROUP BY shard_id),
  oks AS (SELECT shard_id, max(ack_ts) AS ts FROM user_acks WHERE status = 'ok' GROUP BY shard_id),
  found AS (
    SELECT l.app_name, shard_id, l.lease_owner,
           newest IS NOT NULL AND (l.checkpoint IS NULL OR newest > l.checkpoint) AS has_unread,
           COALESCE(p.n, 0) AS n_pending,
           COALESCE(o.ts + INTERVAL 1 DAY <= TIMESTAMP '2024-01-30 12:00:00', false) AS quiet
    FROM user_shards s JOIN user_leases l USING (shard_id) LEFT JOIN newest USING (shard_id)
    LEFT JOIN pending p USING (shard_id) LEFT JOIN oks o USING (shard_id)
    WHERE s.seq_end IS NOT NULL AND NOT l.completed)""",
    )
    + "SELECT *, NOT has_unread AND n_pending = 0 AND quiet AS completed FROM found",
    "drop_redelivered": _with("redelivered") + "SELECT DISTINCT * FROM redelivered",
    "consumer_lag": _with(
        "user_records",
        "user_leases",
        more="""totals AS (
    SELECT shard_id, count(*) AS n, min(arrival_ts) AS oldest, max(arrival_ts) AS newest
    FROM user_records GROUP BY shard_id),
  done AS (
    SELECT l.app_name, l.shard_id, count(*) AS n_read, max(arrival_ts) AS read_to
    FROM user_leases l JOIN user_records r USING (shard_id)
    WHERE r.sequence_number <= l.checkpoint GROUP BY ALL)""",
    )
    + """SELECT l.app_name, l.shard_id, COALESCE(n, 0) - COALESCE(n_read, 0) AS n_unread,
           CAST(floor(date_diff('microsecond', COALESCE(read_to, oldest), newest) / 1000) AS BIGINT)
             AS behind_ms
    FROM user_leases l LEFT JOIN totals USING (shard_id)
    LEFT JOIN done USING (app_name, shard_id)""",
    "shard_edges": _with("listing", more=_GRAPH) + "SELECT stream_name, parent, child, kind FROM edges",
    "shard_vertices": _with("listing", more=_GRAPH) + "SELECT stream_name, shard_id, in_listing FROM vertices",
    "shard_parents": _with("listing", more=_GRAPH)
    + """SELECT v.stream_name, v.shard_id, v.in_listing,
           COALESCE(string_agg(DISTINCT e.parent, ',' ORDER BY e.parent), '') AS parents,
           CAST(count(DISTINCT e.parent) AS INT) AS n_parents
    FROM vertices v LEFT JOIN edges e ON e.stream_name = v.stream_name AND e.child = v.shard_id
    GROUP BY v.stream_name, v.shard_id, v.in_listing""",
    "ready_shards": _with("listing", "listing_leases", more=f"{_GRAPH}, {_GATES}")
    + """SELECT stream_name, shard_id, in_listing, CAST(n AS INT) AS n_parents,
           CASE WHEN NOT in_listing OR done THEN 'skip' WHEN n = 0 OR n_free = n THEN 'start'
                ELSE 'wait' END AS action,
           CASE WHEN NOT in_listing THEN 'not_listed' WHEN done THEN 'completed'
                WHEN n = 0 THEN 'root' WHEN n_free = n AND n_unlisted > 0 THEN 'parent_not_listed'
                WHEN n_free = n THEN 'parent_done' WHEN n_missing > 0 THEN 'parent_lease_missing'
                ELSE 'parent_open' END AS reason
    FROM facts""",
    "ready_shards_reference": _with("listing", "listing_leases", more=f"{_GRAPH}, {_GATES}")
    + """SELECT stream_name, shard_id, in_listing, CAST(n AS INT) AS n_parents,
           CASE WHEN n = 0 AND done THEN 'skip' WHEN n = 0 THEN 'start'
                WHEN n = 1 AND n_leased = 0 THEN 'error' WHEN n_done = n THEN 'start'
                ELSE 'wait' END AS action,
           CASE WHEN n = 0 AND done THEN 'completed' WHEN n = 0 THEN 'root'
                WHEN n = 1 AND n_leased = 0 THEN 'parent_lease_missing'
                WHEN n_done = n THEN 'parent_done' ELSE 'parent_open' END AS reason
    FROM facts""",
    "shard_generations": _with("listing", more=f"{_GRAPH}, {_GENERATIONS}", recursive=True)
    + "SELECT stream_name, shard_id, generation, in_cycle FROM generations",
    "lineage_cycles": _with("listing", more=f"{_GRAPH}, {_GENERATIONS}", recursive=True)
    + "SELECT stream_name, shard_id, in_cycle FROM generations WHERE in_cycle",
    "ordered_replay": _with(
        "listing", "replay_records", more=f"{_GRAPH}, {_GENERATIONS}", recursive=True
    )
    + f"""SELECT partition_key, row_number() OVER (PARTITION BY partition_key
             ORDER BY generation NULLS LAST, {_ORD}, stream_name, shard_id) AS replay_no,
           generation, stream_name, shard_id, sequence_number
    FROM replay_records LEFT JOIN generations USING (stream_name, shard_id)""",
    "create_leases": _outcomes("signup", "l.shard_id IS NULL", "already_exists", "", True),
    "create_leases_table": _with("requests", "user_leases")
    + f"""SELECT {_LEASE_COLS} FROM user_leases UNION ALL
    SELECT app_name, shard_id, NULL, arg_min(worker, request_seq), 1, false FROM requests
    WHERE event_type = 'signup' AND shard_id NOT IN (SELECT shard_id FROM user_leases)
    GROUP BY app_name, shard_id""",
    "renew_leases": _outcomes("view", _RENEWS, "lease_renew_failed", ", expected_count", True),
    "renew_leases_table": _table(
        "view",
        _RENEWS,
        "arg_min",
        "r.expected_count",
        f"{_L}, checkpoint, lease_owner, COALESCE(v + 1, lease_count) AS lease_count, completed",
    ),
    "take_leases": _outcomes("click", _TAKES, "lease_take_failed", ", expected_count", True),
    "take_leases_table": _table(
        "click",
        _TAKES,
        "arg_min",
        "r.worker",
        f"""{_L}, checkpoint, COALESCE(v, lease_owner) AS lease_owner,
        lease_count + CASE WHEN v IS NULL THEN 0 ELSE 1 END AS lease_count, completed""",
    ),
    "apply_checkpoints": _outcomes(
        "purchase", _OWN, "lease_owner_match", ", checkpoint", False
    ),
    "apply_checkpoints_table": _table(
        "purchase",
        _OWN,
        "arg_max",
        "r.checkpoint",
        f"{_L}, COALESCE(v, checkpoint) AS checkpoint, lease_owner, lease_count, completed",
    ),
    "apply_checkpoints_monotonic": _table(
        "purchase",
        _OWN,
        "arg_max",
        "r.checkpoint",
        f"""{_L}, CASE WHEN v IS NOT NULL AND (checkpoint IS NULL OR v > checkpoint) THEN v
        ELSE checkpoint END AS checkpoint, lease_owner, lease_count, completed""",
    ),
    "close_shards": _outcomes("error", _OWN, "lease_owner_match", "", False),
    "close_shards_table": _table(
        "error",
        _OWN,
        "arg_max",
        "true",
        f"{_L}, checkpoint, lease_owner, lease_count, completed OR v IS NOT NULL AS completed",
    ),
    "lease_actions": _with(
        "observations",
        "user_leases",
        more="""seen AS (
    SELECT o.*, l.lease_count, CASE WHEN l.shard_id IS NULL THEN 'create'
             WHEN l.lease_owner = o.worker THEN 'renew'
             WHEN o.now_ms - o.counted_at_ms > 90001 THEN 'take' ELSE 'track' END AS action
    FROM observations o LEFT JOIN user_leases l USING (app_name, shard_id)),
  marked AS (
    SELECT *, action = 'track' AND lease_count IS DISTINCT FROM tracked_count AS moved FROM seen)""",
    )
    + """SELECT app_name, shard_id, worker, now_ms, tracked_count, counted_at_ms, action,
           CASE action WHEN 'renew' THEN lease_count WHEN 'take' THEN tracked_count END
             AS expected_count,
           CASE WHEN moved THEN lease_count ELSE tracked_count END AS next_count,
           CASE WHEN moved THEN now_ms ELSE counted_at_ms END AS next_counted_at_ms
    FROM marked""",
    "fold_leases": _with(
        "lease_commands",
        more="""log AS (
    SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY seq) AS i FROM lease_commands),
  run AS (
    SELECT DISTINCT app_name, shard_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS o,
           CAST(NULL AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS cp, false AS done FROM log
    UNION ALL
    SELECT r.app_name, r.shard_id, c.i,
           CASE WHEN c.op = 'create' AND r.o IS NULL THEN c.worker
                WHEN c.op = 'take' AND r.o <> c.worker AND COALESCE(c.expected_count, r.n) = r.n
                  THEN c.worker ELSE r.o END,
           CASE WHEN c.op = 'create' AND r.o IS NULL THEN 1
                WHEN c.op = 'renew' AND r.o = c.worker AND COALESCE(c.expected_count, r.n) = r.n
                  THEN r.n + 1
                WHEN c.op = 'take' AND r.o <> c.worker AND COALESCE(c.expected_count, r.n) = r.n
                  THEN r.n + 1 ELSE r.n END,
           CASE WHEN c.op = 'checkpoint' AND r.o = c.worker THEN c.checkpoint ELSE r.cp END,
           r.done OR COALESCE(c.op = 'close' AND r.o = c.worker, false)
    FROM run r JOIN log c ON c.shard_id = r.shard_id AND c.i = r.i + 1)""",
        recursive=True,
    )
    + """SELECT app_name, shard_id, arg_max(o, i) AS lease_owner, arg_max(n, i) AS lease_count,
           max_by(cp, i) FILTER (WHERE cp IS NOT NULL) AS checkpoint, bool_or(done) AS completed
    FROM run GROUP BY app_name, shard_id HAVING arg_max(o, i) IS NOT NULL""",
    "stale_leases": _with(
        "lease_history",
        more="""steps AS (
    SELECT *, lag(lease_count) OVER (PARTITION BY shard_id ORDER BY obs_ts, obs_id) AS prev
    FROM lease_history),
  clocked AS (
    SELECT shard_id, obs_id, obs_ts, lease_count,
           max(CASE WHEN prev IS NULL OR prev <> lease_count THEN obs_ts END)
             OVER (PARTITION BY shard_id ORDER BY obs_ts, obs_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS counted_at
    FROM steps)""",
    )
    + """SELECT *, COALESCE(obs_ts > counted_at + INTERVAL 3 DAY, false) AS stale FROM clocked""",
    "consume": _with("records", "leases", "shards", more=_HELD)
    + """, numbered AS (
    SELECT *, """ + _BATCHER + """ AS batcher,
           CASE WHEN data LIKE '%|purchase' THEN 10 ELSE 20 END AS size,
           row_number() OVER (PARTITION BY shard_id, bad, """ + _BATCHER + """ ORDER BY rn) - 1 AS i
    FROM fresh WHERE rn <= 500)
    SELECT 'app-a' AS app_name, shard_id, sequence_number, CAST(0 AS BIGINT) AS attempt,
           CASE WHEN NOT bad THEN batcher END AS batcher,
           CASE WHEN NOT bad THEN CAST(floor(i / size) AS BIGINT) END AS batch_no,
           CASE WHEN NOT bad THEN i % size END AS position,
           CASE WHEN bad THEN 'failed' ELSE 'ok' END AS status
    FROM numbered""",
    "consume_pending": _with("records", "leases", "shards", more=_HELD)
    + """SELECT shard_id, sequence_number, CAST(0 AS BIGINT) AS attempt
    FROM fresh WHERE rn <= 500 AND bad""",
    "consume_leases": _with("records", "leases", "shards", more=_HELD)
    + """, marks AS (
    SELECT shard_id, arg_max(sequence_number, rn) AS cp FROM fresh GROUP BY shard_id),
  every AS (
    SELECT * FROM leases UNION ALL
    SELECT * FROM held WHERE shard_id NOT IN (SELECT shard_id FROM leases WHERE app_name = 'app-a')),
  newest AS (SELECT shard_id, max(sequence_number) AS top FROM records GROUP BY shard_id),
  moved AS (
    SELECT e.app_name, e.shard_id, COALESCE(m.cp, e.checkpoint) AS checkpoint, e.lease_owner,
           e.lease_count, e.completed, m.cp
    FROM every e LEFT JOIN marks m ON m.shard_id = e.shard_id AND e.app_name = 'app-a'
      AND e.lease_owner = 'worker-1' AND NOT e.completed)
    SELECT v.app_name, v.shard_id, v.checkpoint, v.lease_owner, v.lease_count,
           v.completed OR (v.app_name = 'app-a' AND v.lease_owner = 'worker-1'
             AND s.seq_end IS NOT NULL
             AND COALESCE(NOT n.top > v.checkpoint, n.top IS NULL)) AS completed
    FROM moved v LEFT JOIN shards s USING (shard_id) LEFT JOIN newest n USING (shard_id)""",
}
ORACLES["map_messages_pandas"] = ORACLES["map_messages"]

ORACLES["encode_payload"] = """SELECT '{"c_custkey":' || c_custkey || ',"c_mktsegment":'
      || CASE WHEN c_custkey % 2 = 0 THEN '"' || c_mktsegment || '"' ELSE 'null' END || '}' AS data,
    CAST(c_custkey AS VARCHAR) AS partition_key
  FROM customer"""
ORACLES["write_records"] = _with("user_records") + f"SELECT {_RECORD} FROM user_records"
ORACLES["consume_takeover"] = _with("records") + """SELECT shard_id, sequence_number, 'ok' AS status
    FROM records WHERE shard_id = 'shardId-000000000000'"""
ORACLES["consume_dead_letters"] = (
    _with("records", "leases", "shards", more=_HELD)
    + """SELECT shard_id, sequence_number, CAST(0 AS BIGINT) AS attempt FROM fresh WHERE bad"""
)
ORACLES["read_latest"] = _with("records") + f"""SELECT {_RECORD} FROM (
    SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY sequence_number) AS rn FROM records)
  WHERE rn > 70"""
ORACLES["resume_read_zones"] = _with("user_records", "user_leases") + f"""SELECT l.app_name, {_R}
  FROM user_records r JOIN user_leases l USING (shard_id)
  WHERE l.checkpoint IS NULL OR r.sequence_number > l.checkpoint"""
ORACLES["consume_batch_failures"] = _with("records", "leases", "shards", more=_HELD) + """SELECT shard_id, sequence_number,
    CASE WHEN data LIKE '%|error' OR data LIKE '%|signup' THEN 'failed' ELSE 'ok' END AS status,
    CASE WHEN data LIKE '%|signup' THEN 'dropped by a callback' END AS error
  FROM fresh WHERE rn <= 500"""
ORACLES["read_source"] = _with("records", "leases") + f"""SELECT {_RECORD} FROM (
    SELECT r.*, row_number() OVER (PARTITION BY r.shard_id ORDER BY r.sequence_number) AS rn
    FROM records r LEFT JOIN leases l ON l.shard_id = r.shard_id AND l.app_name = 'app-a'
    WHERE l.checkpoint IS NULL OR r.sequence_number > l.checkpoint)
  WHERE rn <= 100"""
# the same results by the plans that large tables get
for plain, twin in {
    "lease_lookup": "lookup_salted",
    "consumer_lag": "consumer_lag_sliced",
    "micro_batches": "micro_batches_sliced",
    "partition_by": "partition_by_sliced",
    "resume_read": "resume_read_shuffled",
    "fold_leases": "fold_leases_sliced",
    "stale_leases": "stale_leases_sliced",
}.items():
    ORACLES[twin] = ORACLES[plain]
