"""SQL of the derived input tables, for DuckDB."""

from __future__ import annotations

from vaultrail.plans.inputs import INGEST_AGENT, KEYRING, USER_AGENTS


def _pads(key_id: str) -> tuple[str, str]:
    key = KEYRING.data_key(key_id).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def hmac(expression: str, key_id: str = "v2") -> str:
    inner, outer = _pads(key_id)
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({expression}))))"


def sealed_length(payload: str, key_id: str = "v2") -> str:
    return f"({len(key_id) + 1} + 4 * ((octet_length(encode({payload})) + 28 + 2) // 3))"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


AUDIT = """audit AS (
  SELECT event_id, ts AS created_at, epoch_us(ts) // 1000 AS created_ms, user_id,
    CASE WHEN event_id % 97 <> 0 THEN 'usr_' || user_id END AS actor,
    CASE WHEN event_id % 194 = 0 THEN 'svc_' || user_id END AS actor_id,
    'event.' || event_type AS action,
    json_extract_string(props, '$.k') AS k,
    'obj_' || json_extract_string(props, '$.k') AS target,
    't_' || (user_id % 5) AS tenant,
    CASE WHEN event_id % 3 <> 0 THEN 'tr_' || (event_id // 7) END AS trace_id,
    CASE WHEN event_id % 2 = 0 THEN 'sp_' || event_id END AS span_id,
    CASE WHEN event_id % 4 = 0 THEN 'sp_' || (event_id - 1) END AS parent_span_id,
    'r_' || (event_id // 7) AS request_id,
    'run_' || user_id AS run_id,
    'b_' || (event_id // 130) AS batch_id,
    '{"k":' || json_extract_string(props, '$.k') || '}' AS metadata,
    CASE WHEN event_type = 'error' THEN 'because ' || json_extract_string(props, '$.k') END AS rationale,
    CASE WHEN event_type = 'purchase' THEN 'checkout' END AS tool_name,
    CASE WHEN event_id % 6 = 0 THEN event_id % 40 END AS logical_clock
  FROM events)"""

IDENTITIES = """ids AS (
  SELECT *, COALESCE(actor, actor_id, 'unknown') AS who FROM audit)"""

# The payload text of an audit event under the standard policy.
PAYLOAD = (
    """'{"actor":"' || who || '","action":"' || action || '","target":"' || target || '","metadata":' || metadata """
    """|| ',"tenant":"' || tenant || '","context":{"location":{}}' """
    """|| CASE WHEN span_id IS NULL THEN '' ELSE ',"spanId":"' || span_id || '"' END """
    """|| CASE WHEN parent_span_id IS NULL THEN '' ELSE ',"parentSpanId":"' || parent_span_id || '"' END || '}'"""
)

REQUESTS = f"""requests AS (
  SELECT 'r_' || r AS request_id, r,
    '10.' || (r % 256) || '.' || ((r * 3) % 256) || '.' || ((r * 7) % 256) AS ip,
    ({", ".join(["SELECT list_value(" + ", ".join(literal(u) for u in USER_AGENTS) + ")"])})[r % 10 + 1] AS ua,
    CASE WHEN r % 8 <> 7 THEN '192.168.0.' || (r % 256) END AS socket_addr
  FROM (SELECT DISTINCT event_id // 7 AS r FROM events)),
clients AS (
  SELECT request_id, r, ua,
    CASE WHEN r % 4 = 3 THEN COALESCE(socket_addr, '') ELSE ip END AS ip,
    CASE r % 4 WHEN 0 THEN 'DE' WHEN 2 THEN 'FR' ELSE '' END AS country,
    CASE r % 4 WHEN 0 THEN 'R' || (r % 9) WHEN 2 THEN 'IDF' ELSE '' END AS region,
    CASE r % 4 WHEN 0 THEN 'Berlin' WHEN 2 THEN 'Paris' ELSE '' END AS city,
    CASE WHEN r % 11 <> 0 AND r % 5 <> 0 THEN 'trace' || r END AS trace_id,
    CASE WHEN r % 11 <> 0 AND r % 5 <> 0 THEN 'span' || r END AS span_id,
    CASE WHEN r % 13 <> 0 AND r % 2 = 0 THEN r % 50 END AS logical_clock
  FROM requests)"""


def device(ua: str) -> dict[str, str]:
    """Device columns of a user-agent expression."""
    own = f"regexp_matches({ua}, '(?i){INGEST_AGENT[0]}')"

    def has(pattern: str) -> str:
        return f"regexp_matches({ua}, '(?i){pattern}')"

    browser = f"""CASE WHEN {own} THEN '{INGEST_AGENT[1]}'
      WHEN {has('chrome|crios')} AND NOT {has('edge|edg')} AND NOT {has('opr')}
        THEN trim('Chrome ' || split_part(regexp_extract({ua}, '(?i)(?:chrome|crios)/([0-9.]+)', 1), '.', 1))
      WHEN {has('safari')} AND NOT {has('chrome|crios')} AND NOT {has('android')}
        THEN CASE WHEN {has('mobile')} THEN 'Safari Mobile' ELSE 'Safari' END
      WHEN {has('firefox|fxios')} THEN 'Firefox' WHEN {has('edge|edg')} THEN 'Edge' ELSE 'Unknown Browser' END"""
    system = f"""CASE WHEN {own} THEN 'Linux Server' WHEN {has('windows')} THEN 'Windows'
      WHEN {has('macintosh|mac os x')} THEN 'macOS' WHEN {has('iphone|ipad|ipod')} THEN 'iOS'
      WHEN {has('android')} THEN 'Android' WHEN {has('linux')} THEN 'Linux' ELSE 'Unknown OS' END"""
    kind = f"""CASE WHEN {own} THEN 'Server' WHEN {has('mobile')} THEN 'Mobile' WHEN {has('tablet|ipad')} THEN 'Tablet'
      WHEN {has('server|bot')} THEN 'Server' ELSE 'Desktop' END"""
    return {"browser": browser, "os": system, "type": kind}


TOOL_EVENTS = """tool_events AS (
  SELECT conv_id AS run_id, turn,
    CASE WHEN role = 'user' THEN 'start' WHEN conv_id % 13 = 0 THEN 'error' ELSE 'end' END AS phase,
    CASE WHEN role = 'user' AND conv_id % 3 <> 0 THEN 'tool_' || (conv_id % 5) END AS tool,
    text, turn * 1000 + length(text) AS ts_ms
  FROM conversations WHERE role IN ('user', 'assistant') AND (role = 'user' OR conv_id % 17 <> 0))"""

RUN_DAYS = """run_days AS (
  SELECT 'p_' || (user_id % 5) AS project_id, user_id, day,
    sha256('{"user":' || user_id || ',"day":' || day || ',"n":' || n || '}') AS payload_hash
  FROM (SELECT user_id, epoch_us(ts) // 86400000000 AS day, count(*) AS n FROM events GROUP BY ALL)),
entries AS (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY day, user_id) AS seq FROM run_days)"""

MEMORY = """changes AS (
  SELECT vec_id AS id, 'upsert' AS op, vec_id * 1000 AS ts, NULL AS reason, embedding AS values_, label FROM embeddings
  UNION ALL SELECT vec_id, 'upsert', vec_id * 1000 + 500000, NULL, embedding, label FROM embeddings WHERE vec_id % 4 = 0
  UNION ALL SELECT vec_id, 'delete', vec_id * 1000 + 900000, CASE WHEN vec_id % 20 = 0 THEN 'gdpr' END, NULL, label
    FROM embeddings WHERE vec_id % 10 = 0),
versions AS (
  SELECT id, label, values_, ts AS valid_from, next_ts AS valid_to,
    CASE next_op WHEN 'delete' THEN COALESCE(next_reason, 'soft_delete') WHEN 'upsert' THEN 'superseded' END AS closed_by
  FROM (SELECT *, lead(ts) OVER w AS next_ts, lead(op) OVER w AS next_op, lead(reason) OVER w AS next_reason
        FROM changes WINDOW w AS (PARTITION BY id ORDER BY ts))
  WHERE op = 'upsert')"""


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"
