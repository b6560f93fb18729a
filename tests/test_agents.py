import gzip
import hashlib
import json

from pyspark.sql import functions as F

from vaultrail.functions.metadata import select_arguments
from vaultrail.operators import agents
from vaultrail.operators.ordered import int_chunk
from vaultrail.sources import ledger as store


def test_pairing_follows_the_order_of_a_run(spark):
    rows = [
        ("r1", 1, "start", "calc", "1/0", None, None, 1000), ("r1", 2, "error", None, None, None, "Division by zero", 1250),
        ("r2", 1, "end", None, None, "lost", None, 10),
        ("r3", 1, "start", "", "a", None, None, 0), ("r3", 2, "start", "second", "b" * 150, None, None, 5),
        ("r3", 3, "end", None, None, "done", None, 30), ("r3", 4, "end", None, None, "again", None, 40),
        ("r4", 1, "start", "open", "x", None, None, 0),
        ("r5", 1, "start", None, "x", None, None, 1), ("r5", 9, "end", None, None, "ok", None, 2),
    ]
    frame = spark.createDataFrame(rows, "run_id string, n int, phase string, tool string, input string, output string, error string, ts_ms bigint")
    for width in (1, 2, 100):
        runs = agents.pair_tool_events(frame, ["n"], [int_chunk("n", width)])
        found = {r.run_id: (r.tool, r.success, r.result, r.latency_ms) for r in runs.collect()}
        assert found == {"r1": ("calc", False, "Division by zero", 250), "r3": ("second", True, "done", 25), "r5": ("unnamed_tool", True, "ok", 1)}
    events = {r.run_id: r for r in agents.tool_run_events(runs, "bot", "acme").collect()}
    first = json.loads(events["r1"].metadata)
    assert events["r1"].action == "agent.tool_call" and first["toolOutput"] == {"error": "Division by zero"} and first["success"] is False
    assert list(first) == ["toolName", "toolInput", "toolOutput", "latencyMs", "success", "eu_ai_act", "nist_ai_rmf", "soc2_control", "iso27001"]
    assert events["r3"].rationale == "Executing tool second with input: " + "b" * 100


def test_reconciliation_by_table_and_by_row(spark):
    call = "struct<call_id:string,tool:string,args:string>"
    result = "struct<call_id:string,tool:string,args:string,result:string>"
    steps = spark.createDataFrame(
        [("s1", [("c1", "t", "{}"), ("c2", None, "{}")], [("c1", "t", "{}", "5")]), ("s2", [("c1", "t", "{}")], []), ("s3", [], [("c9", "t", "{}", "null")])],
        f"step_id string, tool_calls array<{call}>, tool_results array<{result}>",
    )
    by_row = agents.reconcile_steps(steps)
    calls = steps.select("step_id", F.explode("tool_calls").alias("c")).select("step_id", "c.*")
    results = steps.select("step_id", F.explode("tool_results").alias("c")).select("step_id", "c.*")
    by_table = agents.reconcile_calls(calls, results)
    key = lambda frame: sorted(tuple(r) for r in frame.select("step_id", "call_id", "success", F.coalesce("result", F.lit("-"))).collect())
    assert key(by_row) == key(by_table) == [("s1", "c1", True, "5"), ("s1", "c2", False, "-"), ("s2", "c1", False, "-"), ("s3", "c9", True, "null")]
    events = {(r.step_id, r.call_id): json.loads(r.metadata) for r in agents.step_events(by_row, "bot").collect()}
    assert events["s1", "c2"]["toolName"] == "unnamed_tool"
    assert events["s1", "c2"]["toolOutput"] == {"error": "Execution failed or returned no result"}
    assert events["s1", "c1"]["toolOutput"] == {"result": 5}


def test_recording_and_replay(spark):
    def price(args):
        given = json.loads(args)
        if given["input"] == "bad":
            raise ValueError("no such ticker")
        return json.dumps({"price": len(given["input"])})

    rows = [("r1", 3, '{"secret":"k","input":"abc"}'), ("r1", 1, '{"input":"z"}'), ("r1", 2, '{"input":"bad"}'), ("r2", 1, '{"input":"abc"}')]
    calls = spark.createDataFrame(rows, "run_id string, call_id bigint, args string").withColumn("scrubbed", select_arguments("args", ["input"]))
    records, failed = agents.record_calls(calls, "fetch", price, [int_chunk("call_id", 2)])
    found = {(r.run_id, r.call_id): r for r in records.collect()}
    assert found["r1", 1].seq == 1 and found["r1", 3].seq == 2 and found["r2", 1].seq == 1
    assert found["r1", 3].args == '{"input":"abc"}' and "secret" not in found["r1", 3].args
    assert found["r1", 3].args_hash == hashlib.sha256(b'fetch{"input":"abc"}').hexdigest() and found["r1", 3].latency_ms >= 0
    assert [(r.run_id, r.error) for r in failed.collect()] == [("r1", "no such ticker")]
    asked = spark.createDataFrame([(1, '{"input":"abc"}'), (2, '{"input":"new"}')], "n int, a string")
    asked = asked.select("n", F.lit("fetch").alias("tool"), agents.args_hash(F.lit("fetch"), "a").alias("args_hash"))
    answers = {r.n: r for r in agents.replay(asked, agents.replay_store(records)).collect()}
    assert answers[1].recorded_output == '{"price": 3}' and answers[1].replay_error is None
    assert answers[2].recorded_output is None and "fetch" in answers[2].replay_error and answers[2].args_hash in answers[2].replay_error


def test_one_bundle_per_run(spark, tmp_path):
    records = spark.range(1, 8).select(
        F.lit("r1").alias("run_id"), F.col("id").alias("seq"), F.lit("t").alias("tool"), F.lit("h").alias("args_hash"), F.lit('{"a":1}').alias("args"),
        F.lit('"o"').alias("output"), F.lit(5).cast("bigint").alias("latency_ms"), F.col("id").alias("captured_at"),
    )
    runs = spark.createDataFrame([("r1", "p", "be kind", 99), ("r2", "p", None, 100)], "run_id string, project_id string, system_prompt string, committed_at bigint")
    alibis = spark.createDataFrame([("r1", 1, "old", None, None, None), ("r1", 2, "new", "fp", 7, 0.5)],
                                   "run_id string, captured_at bigint, model_id string, system_fingerprint string, seed bigint, temperature double")
    for size in (1000, 3, 1):
        pieces = agents.evidence_pieces(records, runs, alibis, piece_records=size)
        bundles = {r.run_id: r.bundle for r in agents.whole_bundles(pieces).collect()}
        body = {k: json.loads(v) for k, v in bundles.items()}
        assert list(body["r1"]) == ["version", "runId", "projectId", "systemPromptHash", "systemPrompt", "providerAlibi", "tools", "committedAt"]
        assert [t["seq"] for t in body["r1"]["tools"]] == list(range(1, 8))
        assert body["r1"]["providerAlibi"] == {"modelId": "new", "systemFingerprint": "fp", "seed": 7, "temperature": 0.5}
        assert body["r1"]["systemPromptHash"] == hashlib.sha256(b"be kind").hexdigest()
        assert body["r2"] == {"version": 1, "runId": "r2", "projectId": "p", "tools": [], "committedAt": 100}
        digests = {r.run_id: (r.payload_hash, r.n_bytes, r.project_id, r.committed_at) for r in agents.bundle_digests(pieces).collect()}
        assert digests == {k: (hashlib.sha256(v.encode()).hexdigest(), len(v.encode()), "p", body[k]["committedAt"]) for k, v in bundles.items()}
        assert {r.run_id: gzip.decompress(r.packed).decode() for r in agents.zipped_bundles(pieces).collect()} == bundles
        store.write_bundles(pieces, f"{tmp_path}/bundles{size}")
        assert sorted(r.bundle for r in store.read_bundles(spark, f"{tmp_path}/bundles{size}").collect()) == sorted(bundles.values())
    back = store.bundle_records(store.read_bundles(spark, f"{tmp_path}/bundles3")).orderBy("seq").collect()
    assert [(r.seq, r.args, r.output) for r in back] == [(i, '{"a":1}', "o") for i in range(1, 8)]


def test_a_long_run_is_one_bundle(spark, tmp_path):
    n = 100_000
    many = spark.range(n).repartition(16).select(F.lit("long").alias("run_id"), "id").unionByName(spark.range(300).select(F.format_string("run%s", F.col("id") % 40).alias("run_id"), (F.col("id") / 40).cast("bigint").alias("id")))
    records = many.select(
        "run_id", (F.col("id") + 1).alias("seq"), F.lit("t").alias("tool"), F.lit("h").alias("args_hash"), F.lit("{}").alias("args"), F.lit('"}"').alias("output"),
        F.lit(5).cast("bigint").alias("latency_ms"), "id", F.col("id").alias("captured_at"),
    )
    runs = records.select("run_id").distinct().withColumns({"project_id": F.when(F.col("run_id") != "run7", F.concat(F.lit("p"), F.length("run_id"))), "system_prompt": F.lit("é"), "committed_at": F.lit(1).cast("bigint")})
    pieces = agents.evidence_pieces(records, runs)
    store.write_bundles(pieces, f"{tmp_path}/b")
    lines = {json.loads(r.bundle)["runId"]: r.bundle for r in store.read_bundles(spark, f"{tmp_path}/b").collect()}
    digests = {r.run_id: r.payload_hash for r in agents.bundle_digests(pieces).collect()}
    assert digests == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in lines.items()} and len(lines) == 41
    assert [t["seq"] for t in json.loads(lines["long"])["tools"]] == list(range(1, n + 1))
