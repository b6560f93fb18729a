"""Tool runs, evidence bundles, proofs and chains."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from vaultrail.functions.jsontext import object_of, quote
from vaultrail.functions.metadata import canonical_json, select_arguments
from vaultrail.functions.numbers import floor_div
from vaultrail.operators import agents, proofs
from vaultrail.operators.ordered import int_chunk, number_rows
from vaultrail.plans import inputs
from vaultrail.plans.oracle import AUDIT, RUN_DAYS, TOOL_EVENTS, with_
from vaultrail.plans.registry import registrar
from vaultrail.session import materialise, work_folder
from vaultrail.sources import ledger as store

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)


def paired(spark, folder):
    return agents.pair_tool_events(inputs.tool_events(spark, folder), ["turn"], [int_chunk("turn", 1000)])


PAIRS = """pairs AS (
  SELECT run_id, COALESCE(lag(tool) OVER w, 'unnamed_tool') AS tool, lag(text) OVER w AS input, phase = 'end' AS success,
    CASE WHEN phase = 'end' THEN text ELSE 'Division by zero' END AS result, ts_ms - lag(ts_ms) OVER w AS latency_ms, ts_ms AS completed_ms,
    phase, lag(phase) OVER w AS before
  FROM tool_events WINDOW w AS (PARTITION BY run_id ORDER BY turn)
  QUALIFY phase <> 'start' AND before = 'start')"""


@query(
    with_(TOOL_EVENTS, PAIRS)
    + """SELECT run_id, tool, input, success, result, latency_ms,
      'Executing tool ' || tool || ' with input: ' || substr(input, 1, 100) AS rationale FROM pairs"""
)
def tool_pairing(spark, folder):
    return paired(spark, folder).select("run_id", "tool", "input", "success", "result", "latency_ms", "rationale")


@query(
    with_(TOOL_EVENTS, PAIRS)
    + """SELECT run_id, completed_ms, tool, CASE WHEN success THEN input END AS input, success,
      'agent.tool_call' AS action, 'Article 12' AS eu_ai_act, 'CC6.6' AS soc2_control, latency_ms FROM pairs"""
)
def tool_run_events(spark, folder):
    """Paired runs as tagged audit events; their metadata is read back."""
    rows = agents.tool_run_events(paired(spark, folder), "research-agent")
    part = lambda path: F.get_json_object("metadata", f"$.{path}")
    return rows.select(
        "run_id",
        "completed_ms",
        part("toolName").alias("tool"),
        F.when(part("success") == "true", part("toolInput.input")).alias("input"),
        (part("success") == "true").alias("success"),
        "action",
        part("eu_ai_act").alias("eu_ai_act"),
        part("soc2_control").alias("soc2_control"),
        part("latencyMs").cast("bigint").alias("latency_ms"),
    )


@query(
    """SELECT l_orderkey AS step_id, l_partkey AS call_id, l_returnflag <> 'N' AS success,
      CASE WHEN l_returnflag <> 'N' THEN '{"q":' || CAST(l_quantity AS BIGINT) || '}' END AS result
      FROM lineitem l WHERE l_returnflag <> 'N' OR NOT EXISTS (
        SELECT 1 FROM lineitem r WHERE r.l_orderkey = l.l_orderkey AND r.l_partkey = l.l_partkey AND r.l_returnflag <> 'N')"""
)
def tool_call_reconcile(spark, folder):
    """Results of agent steps, and the calls no result answers: orders as steps, lines as calls."""
    lines = inputs.table(spark, folder, "lineitem")
    base = lines.select(
        F.col("l_orderkey").alias("step_id"),
        F.col("l_partkey").alias("call_id"),
        inputs.text("tool_", F.col("l_suppkey") % 5).alias("tool"),
        inputs.text('{"part":', F.col("l_partkey"), "}").alias("args"),
        inputs.text('{"q":', F.col("l_quantity").cast("bigint"), "}").alias("result"),
        "l_returnflag",
    )
    results = base.where(F.col("l_returnflag") != "N").drop("l_returnflag")
    outcomes = agents.reconcile_calls(base.drop("result", "l_returnflag"), results)
    return outcomes.select("step_id", "call_id", "success", "result")


@query(
    """SELECT l_orderkey AS step_id, json_extract_string(m, '$.toolName') AS tool, json_extract_string(m, '$.toolOutput.error') AS error,
      json_extract_string(m, '$.nist_ai_rmf') AS nist_ai_rmf, count(*) AS n
      FROM (SELECT l_orderkey, '{"toolName":"tool_' || (l_suppkey % 5) || '","toolOutput":{' ||
          CASE WHEN l_returnflag = 'N' THEN '"error":"Execution failed or returned no result"' ELSE '"result":1' END || '},"nist_ai_rmf":"MANAGE 2.2"}' AS m
        FROM lineitem l WHERE l_returnflag <> 'N' OR NOT EXISTS (
          SELECT 1 FROM lineitem r WHERE r.l_orderkey = l.l_orderkey AND r.l_partkey = l.l_partkey AND r.l_returnflag <> 'N'))
      GROUP BY ALL"""
)
def tool_call_events(spark, folder):
    """Reconciled calls as tagged audit events."""
    lines = inputs.table(spark, folder, "lineitem")
    base = lines.select(
        F.col("l_orderkey").alias("step_id"),
        F.col("l_partkey").alias("call_id"),
        inputs.text("tool_", F.col("l_suppkey") % 5).alias("tool"),
        F.lit("{}").alias("args"),
        F.lit("1").alias("result"),
        "l_returnflag",
    )
    outcomes = agents.reconcile_calls(base.drop("result", "l_returnflag"), base.where(F.col("l_returnflag") != "N").drop("l_returnflag"))
    rows = agents.step_events(outcomes, "assistant")
    part = lambda path, name: F.get_json_object("metadata", f"$.{path}").alias(name)
    named = rows.select("step_id", part("toolName", "tool"), part("toolOutput.error", "error"), part("nist_ai_rmf", "nist_ai_rmf"))
    return named.groupBy("step_id", "tool", "error", "nist_ai_rmf").agg(F.count(F.lit(1)).alias("n"))


# --- recorded calls ----------------------------------------------------------------------------------------------------


def call_rows(spark, folder):
    """Turns as tool calls; the whole turn is the argument, a secret is not kept."""
    turns = inputs.table(spark, folder, "conversations")
    args = object_of(("secret", F.lit('"s3"')), ("input", quote("text")), ("turn", F.col("turn").cast("string")))
    return turns.select(F.col("conv_id").alias("run_id"), F.col("turn").alias("call_id"), args.alias("args"))


CALLS = """calls AS (SELECT conv_id AS run_id, turn AS call_id, text,
    '{"turn":' || turn || ',"input":' || to_json(text)::VARCHAR || '}' AS scrubbed FROM conversations)"""


@query(with_(CALLS) + "SELECT run_id, call_id, scrubbed, sha256('lookup' || scrubbed) AS args_hash FROM calls")
def args_digest(spark, folder):
    """Listed arguments in list order, and the replay key over them."""
    rows = call_rows(spark, folder).withColumn("scrubbed", select_arguments("args", ["turn", "input", "missing"]))
    return rows.select("run_id", "call_id", "scrubbed", agents.args_hash(F.lit("lookup"), "scrubbed").alias("args_hash"))


def count_words(args: str) -> str:
    """A tool: number of blank-separated words; it fails on one kind of input."""
    import json

    given = json.loads(args)
    if given["turn"] == 4:
        raise ValueError("turn four")
    return json.dumps({"words": given["input"].count(" ") + 1}, separators=(",", ":"))


def recorded(spark, folder):
    rows = call_rows(spark, folder).withColumn("scrubbed", select_arguments("args", ["turn", "input"]))
    return agents.record_calls(rows, "lookup", count_words, [int_chunk("call_id", 1000)])


@query(
    with_(CALLS)
    + """SELECT run_id, call_id, row_number() OVER (PARTITION BY run_id ORDER BY call_id) AS seq, sha256('lookup' || scrubbed) AS args_hash,
      '{"words":' || (length(text) - length(replace(text, ' ', '')) + 1) || '}' AS output, NULL::VARCHAR AS error FROM calls WHERE call_id <> 4
      UNION ALL SELECT run_id, call_id, NULL, NULL, NULL, 'turn four' FROM calls WHERE call_id = 4"""
)
def record_calls(spark, folder):
    """Run a tool over call rows: records with sequence numbers, and the failures, which leave none."""
    records, failed = recorded(spark, folder)
    done = records.select("run_id", "call_id", "seq", "args_hash", "output", F.lit(None).cast("string").alias("error"))
    none = F.lit(None)
    return done.unionByName(
        failed.select("run_id", "call_id", none.cast("bigint").alias("seq"), none.cast("string").alias("args_hash"), none.cast("string").alias("output"), "error")
    )


REPLAY = """recorded AS (
    SELECT l_partkey % 50 AS a, l_suppkey % 5 AS t, max_by(l_orderkey, l_orderkey * 1000000 + l_partkey) AS output
    FROM lineitem GROUP BY ALL)"""


@query(
    with_(REPLAY)
    + """SELECT p_partkey AS call_id, tool, args_hash, CASE WHEN output IS NOT NULL THEN '{"order":' || output || '}' END AS recorded_output,
      CASE WHEN output IS NULL THEN 'no recorded output for tool "' || tool || '" with args hash "' || args_hash || '"' END AS replay_error
      FROM (SELECT p_partkey, 'tool_' || (p_partkey % 6) AS tool, sha256('tool_' || (p_partkey % 6) || '{"a":' || (p_partkey % 50) || '}') AS args_hash,
          output FROM part LEFT JOIN recorded ON a = p_partkey % 50 AND t = p_partkey % 6)"""
)
def replay_lookup(spark, folder):
    """Calls answered from records: the output captured last per key, or an error row."""
    lines = inputs.table(spark, folder, "lineitem")
    records = lines.select(
        agents.args_hash(inputs.text("tool_", F.col("l_suppkey") % 5), inputs.text('{"a":', F.col("l_partkey") % 50, "}")).alias("args_hash"),
        inputs.text('{"order":', F.col("l_orderkey"), "}").alias("output"),
        (F.col("l_orderkey") * 1_000_000 + F.col("l_partkey")).alias("captured_at"),
        F.col("l_partkey").alias("call_id"),
    )
    tool = inputs.text("tool_", F.col("p_partkey") % 6)
    calls = inputs.table(spark, folder, "part").select(
        F.col("p_partkey").alias("call_id"),
        tool.alias("tool"),
        agents.args_hash(tool, inputs.text('{"a":', F.col("p_partkey") % 50, "}")).alias("args_hash"),
    )
    return agents.replay(calls, agents.replay_store(records)).select("call_id", "tool", "args_hash", "recorded_output", "replay_error")


@query(
    with_(CALLS)
    + """SELECT run_id, call_id, '{"words":' || (length(text) - length(replace(text, ' ', '')) + 1) || '}' AS recorded_output, call_id = 4 AS missed FROM (
      SELECT * FROM calls) WHERE call_id <> 4
      UNION ALL SELECT run_id, call_id, NULL, true FROM calls WHERE call_id = 4"""
)
def replay_from_bundles(spark, folder):
    """Recorded runs stored as bundles, loaded as a replay store and used to answer the same calls."""
    rows = call_rows(spark, folder).withColumn("scrubbed", select_arguments("args", ["turn", "input"]))
    records, _ = agents.record_calls(rows, "lookup", count_words, [int_chunk("call_id", 1000)])
    run = F.col("run_id")
    runs = rows.select("run_id").dropDuplicates().select(
        "run_id", (run % 5).alias("project_id"), F.lit(None).cast("string").alias("system_prompt"), run.alias("committed_at")
    )
    path = work_folder(spark, "bundles")
    store.write_bundles(agents.evidence_pieces(records, runs), path)
    kept = store.bundle_records(store.read_bundles(spark, path)).withColumn("call_id", F.col("seq"))
    asked = rows.withColumn("tool", F.lit("lookup")).withColumn("args_hash", agents.args_hash("tool", "scrubbed"))
    answers = agents.replay(asked, agents.replay_store(kept))
    return answers.select("run_id", "call_id", "recorded_output", F.col("replay_error").isNotNull().alias("missed"))


# --- bundles -----------------------------------------------------------------------------------------------------------


def event_records(spark, folder):
    """Events as tool records of one run per user."""
    e = F.col("event_id")
    rows = inputs.audit(spark, folder).select(
        "run_id",
        "event_id",
        F.col("action").alias("tool"),
        F.col("metadata").alias("args"),
        quote("target").alias("output"),
        (e % 90).alias("latency_ms"),
        F.col("created_ms").alias("captured_at"),
        agents.args_hash("action", "metadata").alias("args_hash"),
    )
    return number_rows(rows, ["run_id"], ["event_id"], [int_chunk("event_id")], "seq")


def run_heads(spark, folder):
    user = F.col("user_id")
    return inputs.users(spark, folder).select(
        inputs.text("run_", user).alias("run_id"),
        inputs.text("p_", user % 5).alias("project_id"),
        F.when(user % 3 != 0, inputs.text("prompt of ", user)).alias("system_prompt"),
        (F.lit(1_706_000_000_000) + user).alias("committed_at"),
    )


def run_alibis(spark, folder):
    """Every event reports a model; the last report of a run counts."""
    rows = inputs.table(spark, folder, "events")
    e = F.col("event_id")
    return rows.select(
        inputs.text("run_", F.col("user_id")).alias("run_id"),
        e.alias("captured_at"),
        inputs.text("model-", e % 4).alias("model_id"),
        F.when(e % 2 == 0, inputs.text("fp_", e)).alias("system_fingerprint"),
        (e % 10).alias("seed"),
        F.lit(None).cast("double").alias("temperature"),
    )


BUNDLES = """records AS (
    SELECT run_id, user_id, event_id, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS seq,
      action, metadata, target, event_id % 90 AS latency, created_ms FROM audit),
  texts AS (
    SELECT run_id, user_id, string_agg('{"seq":' || seq || ',"toolName":"' || action || '","argsHash":"' || sha256(action || metadata)
      || '","args":' || metadata || ',"output":"' || target || '","latencyMs":' || latency || ',"capturedAt":' || created_ms || '}', ',' ORDER BY seq) AS tools
    FROM records GROUP BY ALL),
  alibis AS (
    SELECT user_id, '{"modelId":"model-' || (max(event_id) % 4) || '"' || CASE WHEN max(event_id) % 2 = 0 THEN ',"systemFingerprint":"fp_' || max(event_id) || '"' ELSE '' END
      || ',"seed":' || (max(event_id) % 10) || '}' AS alibi FROM events GROUP BY user_id),
  bundles AS (
    SELECT run_id, user_id, '{"version":1,"runId":"' || run_id || '","projectId":"p_' || (user_id % 5) || '"'
      || CASE WHEN user_id % 3 <> 0 THEN ',"systemPromptHash":"' || sha256('prompt of ' || user_id) || '","systemPrompt":"prompt of ' || user_id || '"' ELSE '' END
      || CASE WHEN alibi IS NULL THEN '' ELSE ',"providerAlibi":' || alibi END
      || ',"tools":[' || tools || '],"committedAt":' || (1706000000000 + user_id) || '}' AS bundle
    FROM texts LEFT JOIN alibis USING (user_id))"""


@query(
    """SELECT 'run_' || user_id AS run_id, 'model-' || (max(event_id) % 4) AS model_id,
      CASE WHEN max(event_id) % 2 = 0 THEN 'fp_' || max(event_id) END AS system_fingerprint, max(event_id) % 10 AS seed
      FROM events GROUP BY user_id"""
)
def provider_alibi(spark, folder):
    """Last model report of every run."""
    last = agents.last_alibi(run_alibis(spark, folder))
    return last.select("run_id", "alibi.model_id", "alibi.system_fingerprint", "alibi.seed")


def pieces(spark, folder):
    return agents.evidence_pieces(event_records(spark, folder), run_heads(spark, folder), run_alibis(spark, folder), piece_records=40)


@query(with_(AUDIT, BUNDLES) + "SELECT run_id, bundle, sha256(bundle) AS payload_hash FROM bundles")
def tool_seq_bundle(spark, folder):
    """One evidence bundle per run, with the digest carried through its pieces of forty records."""
    parts = pieces(spark, folder)
    digests = agents.bundle_digests(parts).select("run_id", "payload_hash")
    return agents.whole_bundles(parts).select("run_id", "bundle").join(digests, "run_id")


@query(
    with_(AUDIT, BUNDLES)
    + """SELECT run_id, seq, action AS tool, sha256(action || metadata) AS args_hash, metadata AS args, target AS output FROM records"""
)
def bundle_sink(spark, folder):
    """Bundles stored as gzipped lines, one per run, and read back into tool records."""
    path = work_folder(spark, "bundles")
    store.write_bundles(pieces(spark, folder), path)
    rows = store.bundle_records(store.read_bundles(spark, path))
    return rows.select("run_id", "seq", "tool", "args_hash", "args", "output")


@query(with_(AUDIT, BUNDLES) + "SELECT run_id, sha256(bundle) AS unzipped_hash, true AS smaller FROM bundles")
def bundle_gzip(spark, folder):
    """Gzip files of bundles, a member per piece; unpacked they hash to the bundle's own hash."""
    @F.arrow_udf("string")
    def unpacked_hash(batch: pa.Array) -> pa.Array:
        import gzip
        import hashlib

        return pa.array([hashlib.sha256(gzip.decompress(b)).hexdigest() for b in batch.to_pylist()], pa.string())

    parts = pieces(spark, folder)
    packed = agents.zipped_bundles(parts).join(agents.bundle_digests(parts).select("run_id", "n_bytes"), "run_id")
    return packed.select("run_id", unpacked_hash("packed").alias("unzipped_hash"), (F.octet_length("packed") < F.col("n_bytes")).alias("smaller"))


# --- proofs and chains -------------------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey AS proof_id, o_orderkey % 10 <> 0 AND o_orderkey % 25 <> 0 AND o_orderkey % 15 <> 0 AS valid FROM orders"""
)
def merkle_verify(spark, folder):
    """Proofs over orders; tampered payloads, wrong roots and unreadable paths fail."""
    return proofs.verify_proofs(inputs.proofs(spark, folder)).select("proof_id", "valid")


@query(
    """SELECT o_orderkey AS proof_id, o_orderkey % 10 <> 0 AND o_orderkey % 25 <> 0 AND o_orderkey % 15 <> 0 AS valid FROM orders"""
)
def merkle_positions(spark, folder):
    """The same proofs, checked on the sides that the place of the leaf tells."""
    placed = inputs.proofs(spark, folder).withColumn("leaf", F.col("proof_id") % 8)
    return proofs.verify_proofs(placed, position="leaf").select("proof_id", "valid")


BLOCK = 128


def entries(spark, folder):
    """Ledger entries numbered per project by day and user."""
    order_chunk = [F.col("day"), floor_div("user_id", 100_000)]
    return number_rows(inputs.run_days(spark, folder), ["project_id"], ["day", "user_id"], order_chunk, "seq")


GENESIS = "repeat('0', 64)"
CHAIN = f"""chain AS (
    SELECT project_id, seq, payload_hash, sha256({GENESIS} || payload_hash) AS chain_hash FROM entries WHERE seq = 1
    UNION ALL
    SELECT e.project_id, e.seq, e.payload_hash, sha256(c.chain_hash || e.payload_hash)
    FROM chain c JOIN entries e ON e.project_id = c.project_id AND e.seq = c.seq + 1)"""


@query(with_(RUN_DAYS, CHAIN, recursive=True) + "SELECT project_id, seq, payload_hash, chain_hash FROM chain")
def chain_build(spark, folder):
    """One chain per project, built by three appends, each from the stored heads of the one before."""
    path = work_folder(spark, "chain")
    rows = materialise(entries(spark, folder), "entries")
    for commit in range(3):
        last = F.col("seq") <= 50 * (commit + 1) ** 2 if commit < 2 else F.lit(True)
        store.append_chain(rows.where(last), path, commit)
    return store.read_chain(spark, path)


@query(
    with_(
        RUN_DAYS,
        CHAIN,
        f"""heads AS (SELECT project_id, (seq - 1) // {BLOCK} AS pos, max_by(chain_hash, seq) AS hash FROM chain GROUP BY ALL)""",
        f"""anchors AS (
          SELECT project_id, pos, hash, sha256({GENESIS} || hash) AS chain FROM heads WHERE pos = 0
          UNION ALL SELECT h.project_id, h.pos, h.hash, sha256(a.chain || h.hash) FROM anchors a
          JOIN heads h ON h.project_id = a.project_id AND h.pos = a.pos + 1)""",
        recursive=True,
    )
    + "SELECT project_id, pos, hash, chain FROM anchors"
)
def chain_anchors(spark, folder):
    """Chain over the ends of blocks of each project, an index beside the chain itself."""
    chain = proofs.build_chain(entries(spark, folder), block_size=BLOCK)
    return proofs.build_anchors(chain, BLOCK)


@query(
    with_(RUN_DAYS)
    + """SELECT project_id, count(*) AS entries, min(seq) FILTER (seq % 200 = 150) AS first_broken, count(*) FILTER (seq % 200 = 150) AS broken
      FROM entries GROUP BY project_id"""
)
def chain_verify(spark, folder):
    """Every two-hundredth entry has its payload hash changed after the chain was built."""
    chain = proofs.build_chain(entries(spark, folder), block_size=BLOCK)
    changed = F.when(F.col("seq") % 200 == 150, F.sha2("payload_hash", 256)).otherwise(F.col("payload_hash"))
    return proofs.check_chain(chain.withColumn("payload_hash", changed), BLOCK)


@query(
    with_(AUDIT)
    + """SELECT event_id, sha256(encode('ch_' || event_id || ':') || unhex(sha256('{"action":"' || action || '","metadata":{"a":[1.5,{"x":null,"y":"b"}],"k":'
      || k || '},"target":"' || target || '"}'))) AS computed, event_id % 8 <> 0 AS matches FROM audit"""
)
def attestation_digest(spark, folder):
    """Digests over the canonical form of what was confirmed, compared with the stored ones."""
    k = F.get_json_object("metadata", "$.k")
    loose = inputs.text('{"k": ', k, ', "a":[1.50, {"y":"b", "x":null}]}')
    events = inputs.audit(spark, folder).withColumn("metadata", loose).select("event_id", "action", "target", "metadata")
    canonical = inputs.text('{"action":"', F.col("action"), '","metadata":{"a":[1.5,{"x":null,"y":"b"}],"k":', k, '},"target":"', F.col("target"), '"}')
    challenge = inputs.text("ch_", F.col("event_id"))
    digest = proofs.attestation_digest(challenge, canonical)
    stored = events.select(
        "event_id", challenge.alias("challenge"), F.when(F.col("event_id") % 8 == 0, F.sha2("target", 256)).otherwise(digest).alias("digest")
    )
    return proofs.check_attestations(events, stored, canonical_json("metadata")).select("event_id", "computed", "matches")
