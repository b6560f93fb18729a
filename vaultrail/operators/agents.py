"""Agent tool runs: pairing, reconciliation, recording, replay and evidence bundles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultrail.functions.crypto import sha256_hex
from vaultrail.functions.jsontext import object_of, quote
from vaultrail.functions.numbers import floor_div
from vaultrail.functions.text import first_present
from vaultrail.operators.enrich import tag_agent_events
from vaultrail.operators.ordered import neighbour, number_rows
from vaultrail.session import materialise

# Texts of tool events.
UNNAMED_TOOL = "unnamed_tool"
NO_RESULT = "Execution failed or returned no result"
RATIONALE_INPUT = 100
BUNDLE_VERSION = 1

# Tool records in one piece of a bundle's text.
PIECE_RECORDS = 1000


def tool_name(name: Column | str) -> Column:
    return first_present(name, F.lit(UNNAMED_TOOL))


def json_bool(value: Column) -> Column:
    return value.cast("string")


def json_number(value: Column) -> Column:
    return value.cast("string")


def tool_call_fields(tool: Column, input_json: Column, output_json: Column, latency: Column | None, success: Column) -> Column:
    """The ``toolCall`` fields of an agent event as JSON."""
    latency_json = F.lit(None).cast("string") if latency is None else json_number(latency)
    return object_of(
        ("toolName", quote(tool)),
        ("toolInput", input_json),
        ("toolOutput", output_json),
        ("latencyMs", latency_json),
        ("success", json_bool(success)),
    )


# --- start and end -------------------------------------------------------------------------------------------------


def pair_tool_events(events: DataFrame, order: list[str], chunk: list[Column]) -> DataFrame:
    """Completed tool runs from ``(run_id, phase, tool, input, output, error, ts_ms)`` rows.

    A start opens its run, replacing an open one; the next end or error closes it. Hence a closing row completes a run
    exactly if the row before it in the run is a start; other closing rows are ignored.
    """
    opened = F.when(F.col("phase") == "start", F.struct("tool", "input", "ts_ms"))
    seen = neighbour(events, ["run_id"], order, chunk, opened, "_start", -1)
    closed = seen.where((F.col("phase") != "start") & F.col("_start").isNotNull())
    failed = F.col("phase") == "error"
    tool = tool_name("_start.tool")
    return closed.select(
        "run_id",
        tool.alias("tool"),
        F.col("_start.input").alias("input"),
        (~failed).alias("success"),
        F.when(failed, F.col("error")).otherwise(F.col("output")).alias("result"),
        (F.col("ts_ms") - F.col("_start.ts_ms")).alias("latency_ms"),
        F.col("ts_ms").alias("completed_ms"),
        tool_rationale(tool, F.col("_start.input")).alias("rationale"),
    )


def tool_rationale(tool: Column, given: Column) -> Column:
    return F.concat(F.lit("Executing tool "), tool, F.lit(" with input: "), F.substring(given, 1, RATIONALE_INPUT))


def tool_run_events(runs: DataFrame, actor: str, tenant: str | None = None) -> DataFrame:
    """Completed runs as agent events with control tags."""
    output = F.when(F.col("success"), object_of(("output", quote("result")))).otherwise(object_of(("error", quote("result"))))
    fields = tool_call_fields(
        F.col("tool"), object_of(("input", quote("input"))), output, F.col("latency_ms"), F.col("success")
    )
    rows = runs.withColumns(
        {
            "kind": F.lit("toolCall"),
            "actor": F.lit(actor),
            "tenant": F.lit(tenant).cast("string"),
            "metadata": F.lit(None).cast("string"),
            "fields": fields,
            "trace_id": F.col("run_id").cast("string"),
            "tool_name": F.col("tool"),
        }
    )
    return tag_agent_events(rows)


# --- calls and results -----------------------------------------------------------------------------------------------


def reconcile_calls(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Outcome rows of agent steps: every result, and every call no result answers.

    ``calls(step_id, call_id, tool, args)`` and ``results(step_id, call_id, tool, args, result)``; ``args`` and
    ``result`` are JSON text.
    """
    answered = results.select("step_id", "call_id").dropDuplicates()
    done = results.select("step_id", "call_id", "tool", "args", "result", F.lit(True).alias("success"))
    lost = calls.join(answered, ["step_id", "call_id"], "left_anti").select(
        "step_id", "call_id", "tool", "args", F.lit(None).cast("string").alias("result"), F.lit(False).alias("success")
    )
    return done.unionByName(lost)


def reconcile_steps(steps: DataFrame) -> DataFrame:
    """The same for rows that hold a step's calls and results as arrays; needs no shuffle."""
    answered = F.transform("tool_results", lambda r: r["call_id"])
    lost = F.filter("tool_calls", lambda c: ~F.array_contains(F.col("_answered"), c["call_id"]))
    none = F.lit(None).cast("string")

    def outcome(item, result, success):
        return F.struct(
            item["call_id"].alias("call_id"),
            item["tool"].alias("tool"),
            item["args"].alias("args"),
            result.alias("result"),
            F.lit(success).alias("success"),
        )

    outcomes = F.concat(
        F.transform("tool_results", lambda r: outcome(r, r["result"], True)),
        F.transform(lost, lambda c: outcome(c, none, False)),
    )
    return steps.withColumn("_answered", answered).select("step_id", F.explode(outcomes).alias("o")).select("step_id", "o.*")


def step_events(outcomes: DataFrame, actor: str, tenant: str | None = None) -> DataFrame:
    """Reconciled outcomes as agent events with control tags."""
    output = F.when(F.col("success"), object_of(("result", F.col("result")))).otherwise(
        object_of(("error", quote(F.lit(NO_RESULT))))
    )
    fields = tool_call_fields(tool_name("tool"), object_of(("args", F.col("args"))), output, None, F.col("success"))
    rows = outcomes.withColumns(
        {
            "kind": F.lit("toolCall"),
            "actor": F.lit(actor),
            "tenant": F.lit(tenant).cast("string"),
            "metadata": F.lit(None).cast("string"),
            "fields": fields,
        }
    )
    return tag_agent_events(rows)


# --- recording and replay --------------------------------------------------------------------------------------------


def args_hash(tool: Column | str, scrubbed_args: Column | str) -> Column:
    """Replay key of a call: SHA-256 over tool name and scrubbed argument JSON."""
    return sha256_hex(tool, scrubbed_args)


def record_calls(calls: DataFrame, tool: str, run: Callable[[str], str], chunk: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Run a function over call rows and record what it did.

    ``calls(run_id, call_id, args, scrubbed)``: the function gets ``args``; only ``scrubbed`` is kept. Returns records
    with a sequence number per run, and failed calls, which leave no record. The function's results are written to the
    shared folder before anything reads them, so later steps never run it again.
    """
    def execute(batches):
        import time

        for frame in batches:
            outputs, errors, started, latency = [], [], [], []
            for args in frame["args"]:
                begin, failure, output = time.time(), None, None
                try:
                    output = run(args)
                except Exception as problem:
                    failure = str(problem) or type(problem).__name__
                outputs.append(output)
                errors.append(failure)
                started.append(int(begin * 1000))
                latency.append(int((time.time() - begin) * 1000))
            yield frame.drop(columns="args").assign(output=outputs, error=errors, captured_at=started, latency_ms=latency)

    schema = T.StructType(calls.select("run_id", "call_id", "scrubbed").schema.fields)
    for name, kind in (("output", T.StringType()), ("error", T.StringType()), ("captured_at", T.LongType()), ("latency_ms", T.LongType())):
        schema = schema.add(name, kind)
    ran = calls.select("run_id", "call_id", "scrubbed", "args").mapInPandas(execute, schema)
    ran = materialise(ran, "recorded")
    done = ran.where(F.col("error").isNull()).drop("error")
    done = done.withColumns({"tool": F.lit(tool), "args_hash": args_hash(F.lit(tool), "scrubbed")})
    records = number_rows(done, ["run_id"], ["call_id"], chunk, "seq").withColumnRenamed("scrubbed", "args")
    return records, ran.where(F.col("error").isNotNull()).select("run_id", "call_id", "error")


def replay_store(records: DataFrame) -> DataFrame:
    """Recorded output per replay key; of several records the one captured last counts."""
    last = F.struct("captured_at", "call_id")
    return records.groupBy("args_hash").agg(F.max_by("output", last).alias("recorded_output"))


def replay(calls: DataFrame, store: DataFrame) -> DataFrame:
    """Answer calls ``(tool, args_hash, ...)`` from recorded outputs; a miss names the tool and the key."""
    found = calls.join(store.withColumn("_hit", F.lit(True)), "args_hash", "left")
    miss = F.concat(F.lit('no recorded output for tool "'), F.col("tool"), F.lit('" with args hash "'), F.col("args_hash"), F.lit('"'))
    return found.withColumn("replay_error", F.when(F.col("_hit").isNull(), miss)).drop("_hit")


# --- evidence bundles ------------------------------------------------------------------------------------------------


def last_alibi(alibis: DataFrame) -> DataFrame:
    """Last provider alibi of each run, from ``(run_id, captured_at, model_id, system_fingerprint, seed, temperature)``."""
    body = F.struct("model_id", "system_fingerprint", "seed", "temperature")
    return alibis.groupBy("run_id").agg(F.max_by(body, "captured_at").alias("alibi"))


def record_json() -> Column:
    """One tool record as JSON, in the order of the bundle format."""
    return object_of(
        ("seq", json_number(F.col("seq"))),
        ("toolName", quote("tool")),
        ("argsHash", quote("args_hash")),
        ("args", F.col("args")),
        ("output", F.col("output")),
        ("latencyMs", json_number(F.col("latency_ms"))),
        ("capturedAt", json_number(F.col("captured_at"))),
    )


def evidence_pieces(records: DataFrame, runs: DataFrame, alibis: DataFrame | None = None, piece_records: int = PIECE_RECORDS) -> DataFrame:
    """Bundle JSON per run in pieces of text: ``(run_id, project_id, committed_at, piece, text)``.

    ``records`` carry ``seq`` (unique per run); ``runs(run_id, project_id, system_prompt, committed_at)`` has each run once. A run of any
    length has one bundle: its pieces in their order, each followed by a closing brace. No step needs all pieces of a run at
    once; see :func:`bundle_digests`, :func:`whole_bundles` and :func:`vaultrail.sources.ledger.write_bundles`.
    """
    piece = floor_div(F.col("seq") - 1, piece_records)
    texts = (
        records.select("run_id", piece.alias("piece"), "seq", record_json().alias("text"))
        .groupBy("run_id", "piece")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("items"))
        .select("run_id", "piece", F.concat_ws(",", F.transform("items", lambda i: i["text"])).alias("tools"))
    )
    ranges = records.groupBy("run_id").agg(F.min(piece).alias("first"), F.max(piece).alias("last"))
    head = runs.join(ranges, "run_id", "left")
    if alibis is not None:
        head = head.join(last_alibi(alibis), "run_id", "left")
        alibi = object_of(
            ("modelId", quote("alibi.model_id")),
            ("systemFingerprint", quote("alibi.system_fingerprint")),
            ("seed", json_number(F.col("alibi.seed"))),
            ("temperature", json_number(F.col("alibi.temperature"))),
        )
        alibi = F.when(F.col("alibi").isNotNull(), alibi)
    else:
        alibi = F.lit(None).cast("string")
    prompt = F.col("system_prompt")
    front = object_of(
        ("version", F.lit(str(BUNDLE_VERSION))),
        ("runId", quote(F.col("run_id").cast("string"))),
        ("projectId", quote(F.col("project_id").cast("string"))),
        ("systemPromptHash", quote(sha256_hex(prompt))),
        ("systemPrompt", quote(prompt)),
        ("providerAlibi", alibi),
    )
    front = F.concat(_unclosed(front), F.lit(',"tools":['))
    back = F.concat(F.lit("]"), F.coalesce(F.concat(F.lit(',"committedAt":'), json_number(F.col("committed_at"))), F.lit("")))
    keys = ["run_id", "project_id", "committed_at"]
    heads = head.select(*keys, "first", "last", front.alias("front"), back.alias("back"))
    begun = F.when(F.col("piece") == F.col("first"), F.col("front")).otherwise(F.lit(","))
    # Every piece ends before a closing brace: that of its last record, or the bundle's own.
    middle = texts.join(heads, "run_id").select(*keys, "piece", F.concat(begun, _unclosed(F.col("tools"))).alias("text"))
    closing = F.when(F.col("last").isNull(), F.concat("front", "back")).otherwise(F.col("back"))
    return middle.unionByName(heads.select(*keys, (F.coalesce("last", F.lit(-1)) + 1).alias("piece"), closing.alias("text")))


def _unclosed(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - 1)


def bundle_digests(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each bundle, carried through its pieces in order: ``(run_id, project_id, committed_at, payload_hash, n_bytes)``."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        run, state, size = None, None, 0

        def row() -> pa.RecordBatch:
            keys = [c.slice(0, 1) for c in run]
            return pa.RecordBatch.from_arrays([*keys, pa.array([state.hexdigest()]), pa.array([size], pa.int64())], names=["run_id", "project_id", "committed_at", "payload_hash", "n_bytes"])

        for batch in batches:
            ids, texts = batch.column("run_id").to_pylist(), batch.column("text").to_pylist()
            for i, (own, text) in enumerate(zip(ids, texts, strict=True)):
                if run is None or own != run[0][0].as_py():
                    if run is not None:
                        yield row()
                    run, state, size = [batch.column(n).slice(i, 1) for n in ("run_id", "project_id", "committed_at")], hashlib.sha256(), 0
                data = f"{text}}}".encode()
                state.update(data)
                size += len(data)
        if run is not None:
            yield row()

    types = dict(pieces.dtypes)
    ordered = pieces.select("run_id", "project_id", "committed_at", "piece", "text").repartition("run_id").sortWithinPartitions("run_id", "piece").drop("piece")
    return ordered.mapInArrow(fold, ", ".join(f"{n} {types[n]}" for n in ("run_id", "project_id", "committed_at")) + ", payload_hash string, n_bytes bigint")


def whole_bundles(pieces: DataFrame) -> DataFrame:
    """One row per run: ``(run_id, project_id, committed_at, bundle, payload_hash)``; a bundle must fit a value (2 GB)."""
    parts = pieces.groupBy("run_id", "project_id", "committed_at").agg(F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("parts"))
    bundle = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "}"), F.lit("}"))
    whole = parts.select("run_id", "project_id", "committed_at", bundle.alias("bundle"))
    return whole.withColumn("payload_hash", sha256_hex("bundle"))


def zipped_bundles(pieces: DataFrame) -> DataFrame:
    """``(run_id, packed)``: each piece is a gzip member of its own, packed where it is; the members in order are one gzip file."""
    members = pieces.select("run_id", "piece", F.hex(gzip_bytes(F.concat("text", F.lit("}")))).alias("member"))
    parts = members.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("piece", "member"))).alias("parts"))
    return parts.select("run_id", F.unhex(F.array_join(F.transform("parts", lambda p: p["member"]), "")).alias("packed"))


def gzip_bytes(text: Column | str) -> Column:
    """Gzip bytes of a text, equal on every run (no time stamp in the header)."""

    @F.arrow_udf("binary")
    def run(batch: pa.Array) -> pa.Array:
        import gzip

        return pa.array([None if t is None else gzip.compress(t.encode(), mtime=0) for t in batch.to_pylist()], pa.binary())

    return run(F.col(text) if isinstance(text, str) else text)
