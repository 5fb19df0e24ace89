"""The same results as SQL over the same tables, for DuckDB."""

from __future__ import annotations

from tuplefeed.operators.stats import DURATION_BOUNDS
from tuplefeed.plans.queries import NOW, SINCE
from tuplefeed.sources.derived import DUCKDB_WIRE, INGEST_TS

FEED = f"feed AS (SELECT event_id AS seq, {DUCKDB_WIRE} AS wire FROM events)"

EVENTS = f"""{FEED},
docs AS (SELECT seq, CASE WHEN json_valid(wire) THEN CAST(wire AS JSON) END AS j FROM feed),
fields AS (
  SELECT seq,
    coalesce(json_extract_string(j, '$.operation'), '') AS operation,
    coalesce(json_extract_string(j, '$.tuple_key.user'), '') AS user_ref,
    coalesce(json_extract_string(j, '$.tuple_key.relation'), '') AS relation,
    coalesce(json_extract_string(j, '$.tuple_key.object'), '') AS object_ref,
    try_cast(json_extract_string(j, '$.timestamp') AS TIMESTAMP) AS event_ts,
    CASE WHEN json_type(j, '$.tuple_key.condition') = 'OBJECT'
      THEN CAST(json_extract(j, '$.tuple_key.condition') AS VARCHAR) END AS condition,
    CAST(json_extract(j, '$') AS VARCHAR) AS raw_json
  FROM docs WHERE j IS NOT NULL),
cuts AS (
  SELECT *, instr(object_ref, ':') AS oc, instr(user_ref, ':') AS uc,
    (instr(user_ref, ':') > 1 OR (instr(user_ref, ':') = 1 AND instr(user_ref, '#') > 0)) AS typed
  FROM fields),
ev AS (
  SELECT seq,
    CASE WHEN oc > 1 THEN substr(object_ref, 1, oc - 1) ELSE 'object' END AS object_type,
    CASE WHEN oc > 1 THEN substr(object_ref, oc + 1) ELSE object_ref END AS object_id,
    relation,
    CASE WHEN typed THEN substr(user_ref, 1, uc - 1) ELSE 'user' END AS user_type,
    CASE WHEN typed THEN substr(user_ref, uc + 1) ELSE user_ref END AS user_id,
    CASE WHEN upper(operation) IN ('WRITE', 'TUPLE_TO_USERSET_WRITE') THEN 'tuple_write'
      WHEN upper(operation) IN ('DELETE', 'TUPLE_TO_USERSET_DELETE') THEN 'tuple_delete'
      ELSE 'tuple_change' END AS change_type,
    coalesce(event_ts, TIMESTAMP '{INGEST_TS}') AS ts,
    event_ts IS NULL AS ts_defaulted,
    condition, raw_json, user_ref, object_ref, operation,
    CASE WHEN upper(operation) IN ('WRITE', 'TUPLE_TO_USERSET_WRITE', 'TUPLE_OPERATION_WRITE') THEN 'W'
      WHEN upper(operation) IN ('DELETE', 'TUPLE_TO_USERSET_DELETE', 'TUPLE_OPERATION_DELETE') THEN 'D'
      ELSE 'U' END AS op,
    CASE upper(operation) WHEN 'TUPLE_OPERATION_WRITE' THEN 'W'
      WHEN 'TUPLE_OPERATION_DELETE' THEN 'D' ELSE 'U' END AS sink_op,
    seq // 100 AS page_no
  FROM cuts)"""

KEY = "object_type, object_id, relation, user_type, user_id"
EVENT_COLUMNS = (
    f"seq, {KEY}, change_type, ts, ts_defaulted, condition, raw_json, user_ref, object_ref, operation"
)


def _state(source: str = "ev", op: str = "op", name: str = "state") -> str:
    """CTEs for the tuples after all changes of ``source``."""
    return f"""{name}_live AS (
  SELECT * FROM (SELECT *, max(CASE WHEN {op} = 'D' THEN seq END) OVER (PARTITION BY {KEY}) AS cut
    FROM {source} WHERE {op} <> 'U') WHERE {op} = 'W' AND (cut IS NULL OR seq > cut)),
{name} AS (
  SELECT {KEY}, arg_max_null(condition, seq) AS condition, arg_min(ts, seq) AS created_at,
    arg_max(ts, seq) AS updated_at, max(seq) AS last_seq
  FROM {name}_live GROUP BY {KEY})"""


STATE = f"{EVENTS}, {_state()}"
STATE_COLUMNS = f"{KEY}, condition, created_at, updated_at, last_seq"

HISTORY = f"""{EVENTS},
known AS (SELECT *, lead(seq) OVER (PARTITION BY {KEY} ORDER BY seq) AS valid_to,
    count(*) FILTER (WHERE op = 'D') OVER (PARTITION BY {KEY} ORDER BY seq) AS life
  FROM ev WHERE op <> 'U'),
history AS (SELECT *, first_value(ts) OVER (PARTITION BY {KEY}, life ORDER BY seq) AS created_at,
    ts AS updated_at, seq AS valid_from
  FROM known WHERE op = 'W')"""
HISTORY_COLUMNS = f"{KEY}, condition, created_at, updated_at, valid_from, valid_to"

CHANGELOG = f"""{EVENTS},
stamped AS (SELECT *, concat(regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', ''), 'Z')
  AS stamp FROM ev),
log AS (
  SELECT seq AS id, operation AS change_type, change_type AS change_kind, object_type, object_id,
    relation, user_type, user_id, ts, condition,
    concat('{{"object_type":', to_json(object_type), ',"object_id":', to_json(object_id),
      ',"relation":', to_json(relation), ',"user_type":', to_json(user_type),
      ',"user_id":', to_json(user_id), ',"change_type":', to_json(change_type),
      ',"timestamp":', to_json(stamp),
      CASE WHEN condition IS NULL THEN '' ELSE concat(',"condition":', to_json(condition)) END,
      ',"raw_json":', to_json(raw_json),
      ',"tuple_key":{{"user":', to_json(user_ref), ',"user_type":', to_json(user_type),
      ',"user_id":', to_json(user_id), ',"relation":', to_json(relation),
      ',"object":', to_json(object_ref), ',"object_type":', to_json(object_type),
      ',"object_id":', to_json(object_id), '}},"operation":', to_json(operation), '}}') AS raw_event
  FROM stamped)"""
LOG_COLUMNS = (
    "id, change_type, change_kind, object_type, object_id, relation, user_type, user_id, ts, condition, "
    f"raw_event, TIMESTAMP '{INGEST_TS}' AS created_at"
)

MIDDLE = "(SELECT max(event_id) // 2 FROM events)"

PAGES = f"""{FEED},
pages AS (
  SELECT seq // 100 AS page_no,
    count(*) AS total_fetched, count(*) FILTER (WHERE json_valid(wire)) AS processed, max(seq) AS last_seq
  FROM feed GROUP BY 1),
page_summary AS (
  SELECT page_no, total_fetched, processed,
    CASE WHEN last_seq < (SELECT max(event_id) FROM events) THEN CAST(last_seq AS VARCHAR) ELSE '' END
      AS next_token,
    last_seq < (SELECT max(event_id) FROM events) AS has_more
  FROM pages)"""

CAPPED = f"""{EVENTS},
counted AS (SELECT page_no, count(*) AS n FROM ev GROUP BY page_no),
running AS (SELECT page_no, coalesce(sum(n) OVER (ORDER BY page_no
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM counted),
fetched AS (SELECT * FROM ev WHERE page_no IN (SELECT page_no FROM running WHERE before < {MIDDLE}))"""

CONDITIONS = """conds AS (
  SELECT *, json_type(CAST(condition AS JSON), '$.name') = 'VARCHAR'
      AND json_extract_string(CAST(condition AS JSON), '$.name') <> '' AS named
  FROM ev),
parts AS (
  SELECT *, CASE WHEN named THEN json_extract_string(CAST(condition AS JSON), '$.name') END AS condition_name,
    CASE WHEN named AND json_type(CAST(condition AS JSON), '$.context') = 'OBJECT'
      THEN nullif(CAST(json_extract(CAST(condition AS JSON), '$.context') AS VARCHAR), '{}') END
      AS condition_context
  FROM conds)"""


# The part of the feed that each batch of the streams gets.
BATCH = "seq * 3 // (SELECT max(event_id) + 1 FROM events)"


def _chunks(where: str = "TRUE", size: int = 100, batch: str = "CAST(0 AS BIGINT)") -> str:
    """CTEs for events with their position and chunk, and conditions taken apart."""
    return f"""{EVENTS}, {CONDITIONS},
placed AS (
  SELECT *, {batch} AS batch_id, row_number() OVER (PARTITION BY {batch} ORDER BY seq) - 1 AS position,
    CASE WHEN user_type <> '' THEN concat(user_type, ':', user_id) ELSE user_id END AS usr,
    CASE WHEN object_type <> '' THEN concat(object_type, ':', object_id) ELSE object_id END AS obj
  FROM parts WHERE {where}),
chunks AS (SELECT *, position // {size} AS chunk FROM placed)"""


REQUESTS = """entries AS (
  SELECT *, concat('{"user":', to_json(usr), ',"relation":', to_json(relation), ',"object":', to_json(obj),
      CASE WHEN op = 'W' AND condition_name IS NOT NULL THEN concat(',"condition":{"name":',
        to_json(condition_name), CASE WHEN condition_context IS NULL THEN ''
          ELSE concat(',"context":', condition_context) END, '}') ELSE '' END, '}') AS entry
  FROM chunks WHERE op <> 'U'),
lists AS (
  SELECT chunk, count(*) FILTER (WHERE op = 'W') AS n_writes, count(*) FILTER (WHERE op = 'D') AS n_deletes,
    string_agg(entry, ',' ORDER BY seq) FILTER (WHERE op = 'W') AS writes,
    string_agg(entry, ',' ORDER BY seq) FILTER (WHERE op = 'D') AS deletes
  FROM entries GROUP BY chunk),
requests AS (
  SELECT chunk, n_writes, n_deletes, concat('{', concat_ws(',',
    CASE WHEN n_writes > 0 THEN concat('"writes":[', writes, ']') END,
    CASE WHEN n_deletes > 0 THEN concat('"deletes":[', deletes, ']') END), '}') AS body
  FROM lists)"""

BATCH_REQUESTS = REQUESTS.replace("SELECT chunk,", "SELECT batch_id, chunk,").replace(
    "GROUP BY chunk", "GROUP BY batch_id, chunk"
)

_LAG = f"(epoch_us(TIMESTAMP '{NOW}') - epoch_us(latest_ts)) / CAST(1000000 AS DOUBLE)"

_RUNS = """runs AS (SELECT event_type AS operation,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
  value / 10 AS duration_s, ts FROM events)"""

_BOUNDS = ", ".join(f"('{bound!r}', CAST({bound!r} AS DOUBLE))" for bound in DURATION_BOUNDS)

_REQUIRED = ("object_type", "object_id", "relation", "user_type", "user_id", "change_type")
_PROBLEMS = "concat_ws(', ', {})".format(
    ", ".join(f"CASE WHEN {c} = '' THEN '{c} is required' END" for c in _REQUIRED)
)
_LIMITS = (
    ("change_type", 20), ("object_type", 100), ("object_id", 255),
    ("relation", 100), ("user_type", 100), ("user_id", 255),
)
_VIOLATIONS = "concat_ws(', ', {})".format(
    ", ".join(f"CASE WHEN length({c}) > {n} THEN '{c} exceeds {n}' END" for c, n in _LIMITS)
)


def all_oracles() -> dict[str, str]:
    events = f"WITH {EVENTS} SELECT"
    return {
        "feed_pages_explode": f"{events} seq, page_no, seq % 100 AS pos, {KEY}, operation FROM ev",
        "feed_page_tokens": f"WITH {PAGES} SELECT page_no, next_token, has_more FROM page_summary",
        "feed_resume": f"WITH {FEED} SELECT seq, wire FROM feed WHERE seq > {MIDDLE}",
        "feed_page": f"WITH {FEED} SELECT seq, wire FROM feed WHERE seq > {MIDDLE} ORDER BY seq LIMIT 100",
        "feed_paginate": f"""WITH {FEED}, n AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS p FROM feed)
            SELECT seq, wire, p // 100 AS page_no, p % 100 AS pos FROM n""",
        "feed_page_summary": f"WITH {PAGES} SELECT * FROM page_summary",
        "feed_fetch_all_capped": f"WITH {CAPPED} SELECT seq, page_no, {KEY} FROM fetched",
        "feed_shredded_since": f"{events} seq, operation, ts FROM ev WHERE ts >= TIMESTAMP '{SINCE}' AND op = 'W'",
        "feed_changes_since": f"{events} seq, ts FROM ev WHERE ts >= TIMESTAMP '{SINCE}'",
        "feed_changes_since_capped": f"""WITH {CAPPED} SELECT seq, page_no, ts FROM fetched
            WHERE ts >= TIMESTAMP '2024-01-05 00:00:00'""",
        "cursor_latest": f"""WITH {PAGES} SELECT coalesce(arg_max(next_token, page_no), '')
            AS continuation_token FROM page_summary WHERE has_more""",
        "parse_event": f"{events} {EVENT_COLUMNS} FROM ev",
        "parse_rejects": f"WITH {FEED} SELECT seq, wire FROM feed WHERE NOT json_valid(wire)",
        "parse_user_ref": f"{events} seq, user_ref, user_type, user_id FROM ev",
        "parse_object_ref": f"{events} seq, object_ref, object_type, object_id FROM ev",
        "change_type_map": f"{events} seq, operation, change_type, op, sink_op FROM ev",
        "ts_parse_default": f"{events} seq, ts, ts_defaulted FROM ev",
        "condition_extract": f"{events} seq, condition FROM ev",
        "condition_parse": f"""WITH {EVENTS}, {CONDITIONS} SELECT seq, condition_name, condition_context,
            CASE WHEN condition IS NOT NULL AND condition_name IS NULL
              THEN 'condition name is required and must be a string' END AS condition_error FROM parts""",
        "tuple_key_struct": f"""{events} seq, user_ref AS key_user, user_type AS key_user_type,
            user_id AS key_user_id, relation AS key_relation, object_ref AS key_object,
            object_type AS key_object_type, object_id AS key_object_id FROM ev""",
        "tuple_key_rebuild": f"""{events} seq,
            CASE WHEN user_type <> '' THEN concat(user_type, ':', user_id) ELSE user_id END AS "user",
            relation,
            CASE WHEN object_type <> '' THEN concat(object_type, ':', object_id) ELSE object_id END
              AS "object" FROM ev""",
        "tuple_display": f"""{events} seq, concat(object_type, ':', object_id, '#', relation, '@',
            user_type, ':', user_id) AS "tuple" FROM ev""",
        "changelog_rows": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log",
        "changelog_ts_text": f"""{events} seq AS id, substr(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 1, 23)
            AS ts_text FROM ev""",
        "changelog_append": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log",
        "audit_filter": f"""WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log
            WHERE ts >= TIMESTAMP '{SINCE}' AND ts < TIMESTAMP '2024-01-22 00:00:00'
            AND object_type = 'document' AND relation = 'viewer'""",
        "audit_by_user_type": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log WHERE user_type = 'team'",
        "audit_by_change_type": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log WHERE change_type = 'DELETE'",
        "audit_by_object_type": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log WHERE object_type = 'folder'",
        "audit_by_relation": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log WHERE relation = 'editor'",
        "audit_clustered": f"""WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log WHERE ts >= TIMESTAMP '{SINCE}'
            AND object_type = 'document' AND relation = 'viewer' AND user_type = 'user'""",
        "state_by_user_type": f"WITH {STATE} SELECT * FROM state WHERE user_type = 'org'",
        "state_by_object_type": f"WITH {STATE} SELECT * FROM state WHERE object_type = 'table'",
        "state_by_relation": f"WITH {STATE} SELECT * FROM state WHERE relation = 'viewer'",
        "state_updated_since": f"WITH {STATE} SELECT * FROM state WHERE updated_at >= TIMESTAMP '{SINCE}'",
        "validate_event": f"""{events} seq, CASE WHEN {_PROBLEMS} <> ''
            THEN concat('change event validation failed: ', {_PROBLEMS}) END AS validation_error FROM ev""",
        "validate_strict": f"{events} seq, {KEY} FROM ev WHERE {_PROBLEMS} = ''",
        "unknown_ops": f"{events} seq, operation FROM ev WHERE op = 'U'",
        "constraint_violations": f"""WITH {CHANGELOG}, bad AS (SELECT id, change_type, {_VIOLATIONS}
            AS violations FROM log) SELECT * FROM bad WHERE violations <> ''""",
        "state_current": f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state",
        "state_sink_vocabulary": f"WITH {EVENTS}, {_state(op='sink_op')} SELECT {STATE_COLUMNS} FROM state",
        "state_incremental": f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state",
        "state_as_of": f"""WITH {EVENTS}, past AS (SELECT * FROM ev WHERE seq <= {MIDDLE}),
            {_state('past')} SELECT {STATE_COLUMNS} FROM state""",
        "state_current_sparse": f"""WITH {STATE} SELECT {KEY}, condition, created_at, updated_at,
            last_seq * 2147483648 AS last_seq FROM state""",
        "state_history": f"WITH {HISTORY} SELECT {HISTORY_COLUMNS} FROM history",
        "state_at_many": f"""WITH {HISTORY}, points AS (SELECT event_id AS position FROM events WHERE event_id % 977 = 976)
            SELECT position, {HISTORY_COLUMNS} FROM points JOIN history
            ON valid_from <= position AND (valid_to IS NULL OR valid_to > position)""",
        "state_table_lookup": f"""WITH {STATE} SELECT {STATE_COLUMNS} FROM state
            WHERE object_type = 'folder' AND relation = 'viewer'""",
        "stream_stats_by_object_type": f"""WITH {EVENTS}, numbered AS (SELECT *, {BATCH} AS batch_id FROM ev),
            {', '.join(f"past{b} AS (SELECT * FROM numbered WHERE batch_id <= {b}), " + _state(f'past{b}', name=f'state{b}') for b in range(3))}
            {' UNION ALL '.join(f"SELECT CAST({b} AS BIGINT) AS version, object_type, count(*) AS tuples FROM state{b} GROUP BY 2" for b in range(3))}""",
        "dedupe_stream_any_age": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log",
        "conditional_tuples": f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state WHERE condition IS NOT NULL",
        "tuple_lookup": f"""WITH {STATE} SELECT {STATE_COLUMNS} FROM state
            WHERE object_type = 'document' AND object_id = '0' AND relation = 'viewer'""",
        "tuple_lookup_many": f"""WITH {STATE}, keys AS (SELECT DISTINCT {KEY} FROM ev)
            SELECT {', '.join('k.' + c for c in KEY.split(', '))}, s.last_seq IS NOT NULL AS found, s.condition
            FROM keys k LEFT JOIN state s USING ({KEY})""",
        "apply_counts": f"""{events} page_no, count(*) FILTER (WHERE op = 'W') AS inserts,
            count(*) FILTER (WHERE op = 'D') AS deletes, count(*) FILTER (WHERE op = 'U') AS skipped
            FROM ev GROUP BY page_no""",
        "apply_effects": f"""WITH {EVENTS}, past AS (SELECT * FROM ev WHERE seq <= {MIDDLE}),
            {_state('past', name='before')}, {_state(name='after')},
            batch AS (SELECT {KEY}, bool_or(op = 'D') AS deleted FROM ev
              WHERE seq > {MIDDLE} AND op <> 'U' GROUP BY {KEY}),
            sides AS (SELECT deleted, b.last_seq IS NOT NULL AS existed,
                coalesce(a.last_seq > {MIDDLE}, FALSE) AS written
              FROM batch LEFT JOIN before b USING ({KEY}) LEFT JOIN after a USING ({KEY}))
            SELECT count(*) FILTER (WHERE written AND NOT existed) AS inserted,
              count(*) FILTER (WHERE written AND existed AND NOT deleted) AS updated,
              count(*) FILTER (WHERE written AND existed AND deleted) AS replaced,
              count(*) FILTER (WHERE NOT written AND existed AND deleted) AS removed FROM sides""",
        "dedupe_changes": f"{events} seq, {KEY}, operation FROM ev",
        "replicate_chunks": f"""WITH {_chunks()} SELECT seq, position, chunk, op, usr AS "user", relation,
            obj AS "object" FROM chunks""",
        "replicate_requests": f"WITH {_chunks()}, {REQUESTS} SELECT * FROM requests",
        "replicate_net": f"""WITH {_chunks(size=1000)}, kept AS (SELECT * FROM (SELECT *, max(seq) OVER
            (PARTITION BY chunk, usr, relation, obj) AS last_seq FROM chunks WHERE op <> 'U')
            WHERE seq = last_seq), {REQUESTS.replace("FROM chunks", "FROM kept")} SELECT * FROM requests""",
        "replicate_net_changes": f"""WITH {EVENTS}, last AS (SELECT *, max(seq) OVER (PARTITION BY {KEY})
            AS last_seq FROM ev WHERE op <> 'U')
            SELECT {KEY}, seq, operation, condition FROM last WHERE seq = last_seq""",
        "replicate_selected": f"""WITH {_chunks("object_type IN ('document', 'table') AND relation IN ('viewer', 'editor')")},
            {REQUESTS} SELECT * FROM requests""",
        "stats_changelog_entries": f"{events} count(*) AS changelog_entries FROM ev",
        "stats_by_change_type": f"{events} operation AS change_type, count(*) AS entries FROM ev GROUP BY 1",
        "stats_current_tuples": f"WITH {STATE} SELECT count(*) AS current_tuples FROM state",
        "stats_by_object_type": f"WITH {STATE} SELECT object_type, count(*) AS tuples FROM state GROUP BY 1",
        "lag_seconds": f"""WITH {EVENTS}, newest AS (SELECT max(CASE WHEN NOT ts_defaulted THEN ts END) AS latest_ts,
            count(*) FILTER (WHERE ts_defaulted) AS defaulted FROM ev)
            SELECT *, {_LAG} AS lag_seconds FROM newest""",
        "lag_by_batch": f"""WITH {EVENTS}, newest AS (SELECT page_no, max(ts) AS latest_ts,
            count(*) FILTER (WHERE ts_defaulted) AS defaulted FROM ev GROUP BY page_no)
            SELECT *, {_LAG} AS lag_seconds FROM newest""",
        "fetch_stats": """SELECT count(*) AS total_requests,
            count(*) FILTER (WHERE event_type <> 'error') AS success_requests,
            count(*) FILTER (WHERE event_type = 'error') AS failed_requests,
            CAST(sum(user_id % 10) AS BIGINT) AS total_changes,
            avg(floor(value)) AS average_latency_ms, max(ts) AS last_fetch_time FROM events""",
        "batch_summary": f"""WITH {EVENTS}, {PAGES.removeprefix(FEED + ',')},
            newest AS (SELECT page_no, max(ts) AS latest_ts FROM ev GROUP BY page_no)
            SELECT p.page_no, p.total_fetched, p.processed, p.next_token, p.has_more, latest_ts,
              {_LAG} AS lag_seconds FROM page_summary p LEFT JOIN newest USING (page_no)""",
        "run_op_counts": f"WITH {_RUNS} SELECT operation, status, count(*) AS runs FROM runs GROUP BY 1, 2",
        "run_duration_hist": f"""WITH {_RUNS}, bounds(le, bound) AS (VALUES {_BOUNDS},
            ('+Inf', CAST('infinity' AS DOUBLE)))
            SELECT operation, le, count(*) FILTER (WHERE duration_s <= bound) AS runs
            FROM runs CROSS JOIN bounds GROUP BY 1, 2""",
        "run_duration_totals": f"""WITH {_RUNS} SELECT operation,
            CAST(sum(CAST(duration_s AS DECIMAL(18, 6))) AS DOUBLE) AS total_s, count(*) AS runs
            FROM runs GROUP BY 1""",
        "run_last_success": f"""WITH {_RUNS} SELECT operation,
            max(CASE WHEN status = 'success' THEN ts END) AS last_success,
            count(*) FILTER (WHERE status <> 'success') AS errors FROM runs GROUP BY 1""",
        "stream_changelog": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log",
        "stream_state": f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state",
        "stream_replicate": f"""WITH {_chunks(batch=BATCH)}, {BATCH_REQUESTS} SELECT * FROM requests""",
        "stream_delivery_log": f"""WITH {EVENTS}, last AS (SELECT *, {BATCH} AS batch_id,
              max(seq) OVER (PARTITION BY {BATCH}, {KEY}) AS last_seq FROM ev WHERE op <> 'U'),
            placed AS (SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY seq) - 1 AS position
              FROM last WHERE seq = last_seq)
            SELECT DISTINCT batch_id, position // 100 AS chunk, TRUE AS delivered, CAST(NULL AS VARCHAR) AS error,
              CAST(0 AS INTEGER) AS try FROM placed""",
        "stream_restart": f"WITH {CHANGELOG} SELECT {LOG_COLUMNS} FROM log",
        "stream_restart_errors": """SELECT 'changelog' AS stream, CAST(n AS INTEGER) AS failure, CAST(n AS INTEGER) AS in_a_row,
            0.05 * power(2, n) AS pause_s, TRUE AS of_sink FROM range(1, 3) AS r(n)""",
        "feed_live_pages": f"{events} seq, {KEY}, operation, ts FROM ev",
        "stream_delivery_state": f"""WITH {_chunks()}, last AS (SELECT *, max(seq) OVER (PARTITION BY usr, relation, obj) AS last_seq
            FROM chunks WHERE op <> 'U') SELECT usr AS "user", relation, obj AS "object", condition_name,
            CASE WHEN condition_name IS NOT NULL THEN condition_context END AS condition_context
            FROM last WHERE seq = last_seq AND op = 'W'""",
        "stream_delivery_commits": f"""WITH {EVENTS} SELECT {BATCH} AS batch_id, count(*) AS changes, TRUE AS at_once
            FROM ev WHERE op <> 'U' GROUP BY 1""",
        "stream_rejects": f"""WITH {FEED} SELECT {BATCH} AS batch_id, seq AS position,
            CAST(NULL AS BIGINT) AS pos, wire AS text FROM feed WHERE NOT json_valid(wire)""",
        "stream_reports": f"""WITH {EVENTS}, counts AS (SELECT {BATCH} AS batch_id, count(*) AS processed,
              count(*) FILTER (WHERE {_PROBLEMS} <> '') AS invalid,
              count(*) FILTER (WHERE op = 'W') AS writes, count(*) FILTER (WHERE op = 'D') AS deletes,
              count(*) FILTER (WHERE op = 'U') AS unknown_operations,
              count(*) FILTER (WHERE ts_defaulted) AS defaulted, max(ts) AS latest_ts FROM ev GROUP BY 1),
            bad AS (SELECT {BATCH} AS batch_id, count(*) AS rejected FROM feed WHERE NOT json_valid(wire) GROUP BY 1)
            SELECT batch_id, processed, coalesce(rejected, 0) AS rejected,
              processed + coalesce(rejected, 0) AS total_fetched, invalid, writes, deletes,
              unknown_operations, defaulted, latest_ts FROM counts LEFT JOIN bad USING (batch_id)""",
        "dedupe_stream": f"{events} seq, {KEY}, operation FROM ev",
        "page_item_rejects": f"""WITH {FEED} SELECT seq // 100 AS page_no, seq % 100 AS pos,
            CAST(to_json(wire) AS VARCHAR) AS item FROM feed WHERE NOT json_valid(wire)""",
        "cursor_round_trip": f"""WITH {PAGES} SELECT '' AS first_token,
            arg_max(next_token, page_no) AS continuation_token FROM page_summary WHERE has_more""",
        "replicate_chunks_sparse": f"""WITH {_chunks()} SELECT seq * 2147483648 AS seq, position, chunk, op,
            usr AS "user", relation, obj AS "object" FROM chunks""",
    }
