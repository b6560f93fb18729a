"""Audit-shaped input tables derived from the star-schema tables.

Every rule is integer or string arithmetic over whole tables. ``SQL`` states the same rules for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.functions.crypto import Keyring
from vaultrail.functions.numbers import floor_div
from vaultrail.functions.text import epoch_micros, epoch_millis
from vaultrail.operators.access import checksum
from vaultrail.session import spread

KEYRING = Keyring({"v1": "k-one", "v2": "k-two"}, "v2")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audit events, one per row of ``events``."""
    e, user, k = F.col("event_id"), F.col("user_id"), F.get_json_object("props", "$.k")
    return table(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("created_at"),
        epoch_millis("ts").alias("created_ms"),
        "user_id",
        F.when(e % 97 != 0, text("usr_", user)).alias("actor"),
        F.when(e % 194 == 0, text("svc_", user)).alias("actor_id"),
        text("event.", F.col("event_type")).alias("action"),
        text("obj_", k).alias("target"),
        text("t_", user % 5).alias("tenant"),
        F.when(e % 3 != 0, text("tr_", floor_div(e, 7))).alias("trace_id"),
        F.when(e % 2 == 0, text("sp_", e)).alias("span_id"),
        F.when(e % 4 == 0, text("sp_", e - 1)).alias("parent_span_id"),
        text("r_", floor_div(e, 7)).alias("request_id"),
        text("run_", user).alias("run_id"),
        text("b_", floor_div(e, 130)).alias("batch_id"),
        text('{"k":', k, "}").alias("metadata"),
        F.when(F.col("event_type") == "error", text("because ", k)).alias("rationale"),
        F.when(F.col("event_type") == "purchase", F.lit("checkout")).alias("tool_name"),
        F.when(e % 6 == 0, e % 40).alias("logical_clock"),
    )


USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.6099.109 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.0.0",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.6045.66 Mobile Safari/537.36",
    "Mozilla/5.0 (iPad; CPU OS 16_6) AppleWebKit/605.1.15 Safari/604.1",
    "ExampleBot/2.1 (+http://bot.example/)",
    "Ledger-Ingest-Worker/1.0",
    "",
]
INGEST_AGENT = ("ledger-ingest-worker", "Ledger Ingest Worker")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per seven events, with headers by modular rules."""
    numbers = table(spark, folder, "events").select(floor_div("event_id", 7).alias("r")).dropDuplicates()
    r = F.col("r")
    ip = text("10.", r % 256, ".", (r * 3) % 256, ".", (r * 7) % 256)
    cf, vercel = r % 4 == 0, r % 4 == 2
    pairs = [
        ("cf-connecting-ip", F.when(cf, ip)),
        ("X-Real-IP", F.when(r % 4 == 1, ip)),
        ("x-forwarded-for", F.when(vercel, text(ip, " , 13.14.15.16"))),
        ("cf-ipcountry", F.when(cf, F.lit("DE"))),
        ("cf-region-code", F.when(cf, text("R", r % 9))),
        ("cf-ipcity", F.when(cf, F.lit("Berlin"))),
        ("x-vercel-ip-country", F.when(vercel, F.lit("FR"))),
        ("x-vercel-ip-country-region", F.when(vercel, F.lit("IDF"))),
        ("x-vercel-ip-city", F.when(vercel, F.lit("Paris"))),
        ("User-Agent", _pick(USER_AGENTS, r % 10)),
        (
            "traceparent",
            F.when(r % 11 == 0, F.lit("invalid-trace-parent")).when(r % 5 != 0, text("00-trace", r, "-span", r, "-01")),
        ),
        ("x-logical-clock", F.when(r % 13 == 0, F.lit("abc")).when(r % 2 == 0, text(" ", r % 50, "x"))),
    ]
    every = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[v for _, v in pairs]))
    return numbers.select(
        text("r_", r).alias("request_id"),
        "r",
        F.map_filter(every, lambda _, v: v.isNotNull()).alias("headers"),
        F.when(r % 8 != 7, text("192.168.0.", r % 256)).alias("socket_addr"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("user_id").dropDuplicates()


def tool_events(spark: SparkSession, folder: str) -> DataFrame:
    """Tool starts and ends from conversation turns: a user turn starts, an assistant turn ends or fails."""
    c, t = F.col("conv_id"), F.col("turn")
    start, failed = F.col("role") == "user", c % 13 == 0
    return (
        table(spark, folder, "conversations")
        .where(F.col("role").isin("user", "assistant"))
        .where(start | (c % 17 != 0))
        .select(
            c.alias("run_id"),
            t.alias("turn"),
            F.when(start, "start").when(failed, "error").otherwise("end").alias("phase"),
            F.when(start & (c % 3 != 0), text("tool_", c % 5)).alias("tool"),
            F.when(start, F.col("text")).alias("input"),
            F.when(~start & ~failed, F.col("text")).alias("output"),
            F.when(~start & failed, F.lit("Division by zero")).alias("error"),
            (t * 1000 + F.length("text")).alias("ts_ms"),
        )
    )


def spans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as spans: chains of up to fifty, some with annotated attributes."""
    o = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    named = [
        ("audit.action", F.when(status == "F", text("order.", status))),
        ("audit.actor", F.when(status == "F", text("cust_", F.col("o_custkey")))),
        ("vaultrail.action", F.when(status == "O", text("order.", status))),
        ("vaultrail.target", F.when(status == "O", text("ord_", o))),
        ("priority", F.col("o_orderpriority")),
    ]
    every = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in named]), F.array(*[v for _, v in named]))
    return table(spark, folder, "orders").select(
        text("tr_", floor_div(o, 50)).alias("trace_id"),
        text("sp_", o).alias("span_id"),
        F.when(o % 50 != 0, text("sp_", o - 1)).alias("parent_span_id"),
        F.map_filter(every, lambda _, v: v.isNotNull()).alias("attributes"),
        o.alias("order_key"),
    )


def span_events(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as span events: readable payloads, broken ones and other events, by return flag."""
    o, flag = F.col("l_orderkey"), F.col("l_returnflag")
    good = text('{"action":"line.', flag, '","actor":"supp_', F.col("l_suppkey"), '","target":{"id":"p_', F.col("l_partkey"),
                '","pii":"part ', F.col("l_partkey"), '"},"traceId":"tr_', floor_div(o, 50), '","metadata":{"line":', F.col("l_linenumber"), "}}")
    payload = F.when(flag == "R", good).otherwise(text('{"action":"line.', flag))
    return table(spark, folder, "lineitem").select(
        text("tr_", floor_div(o, 50)).alias("trace_id"),
        text("sp_", o).alias("span_id"),
        F.when(flag == "N", "log").otherwise("vaultrail.audit").alias("name"),
        F.create_map(F.lit("vaultrail.payload"), payload).alias("attributes"),
    )


def timed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with service and time in microseconds, for the search of the active span."""
    return table(spark, folder, "events").select(
        "event_id",
        text("svc_", F.col("user_id") % 5).alias("service"),
        epoch_micros("ts").alias("at"),
        F.when(F.col("event_id") % 10 == 0, F.lit("own")).alias("trace_id"),
        F.lit(None).cast("string").alias("span_id"),
        F.lit(None).cast("string").alias("parent_span_id"),
    )


def timed_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Events open spans of one to six hundred minutes in their service."""
    e, begin = F.col("event_id"), epoch_micros("ts")
    return table(spark, folder, "events").select(
        text("svc_", F.col("user_id") % 5).alias("service"),
        begin.alias("start"),
        (begin + ((e * 37) % 600 + 1) * 60_000_000).alias("end"),
        text("tr_", e).alias("trace_id"),
        text("sp_", e).alias("span_id"),
        text("sp_", floor_div(e, 2)).alias("parent_span_id"),
    )


def memory_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change log of vector memory: one or two upserts per vector, some deletes with or without a reason."""
    v = F.col("vec_id")
    base = table(spark, folder, "embeddings")

    def change(op: str, offset: int, reason: Column) -> list[Column]:
        return [
            v.alias("id"),
            F.lit(op).alias("op"),
            (v * 1000 + offset).alias("ts"),
            reason.cast("string").alias("reason"),
            F.col("embedding").alias("values") if op == "upsert" else F.lit(None).cast("array<float>").alias("values"),
            "label",
        ]

    none = F.lit(None)
    first = base.select(*change("upsert", 0, none))
    second = base.where(v % 4 == 0).select(*change("upsert", 500_000, none))
    deleted = base.where(v % 10 == 0).select(*change("delete", 900_000, F.when(v % 20 == 0, "gdpr")))
    return first.unionByName(second).unionByName(deleted)


def grants(spark: SparkSession, folder: str) -> DataFrame:
    """Grant requests, one per customer."""
    c = F.col("c_custkey")
    durations = ["30s", "30m", "2h", "1d", "2x", ""]
    scopes = ["actor", "target", "tenant", "auditor", ""]
    return table(spark, folder, "customer").select(
        text("g_", c).alias("grant_id"),
        F.when(c % 7 != 0, text("usr_", c % 150)).alias("actor_id"),
        F.when(c % 3 == 0, text("obj_", c % 100)).alias("target_id"),
        F.when(c % 2 == 0, text("t_", c % 5)).alias("tenant_id"),
        _pick(scopes, c % 5).alias("scope"),
        _pick(durations, c % 6).alias("expires_in"),
        (F.lit(1_700_000_000) + c).alias("iat"),
    )


def proofs(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle proofs of order payloads in trees of eight leaves; every tenth payload is tampered with."""
    o = F.col("o_orderkey")
    payload = text('{"o":', o, ',"c":', F.col("o_custkey"), "}")
    leaves = table(spark, folder, "orders").select(
        o.alias("proof_id"), floor_div(o, 8).alias("tree"), (o % 8).cast("int").alias("leaf"), payload.alias("payload")
    )
    # A tree holds at most eight leaves, since it is the key divided by eight.
    trees = leaves.groupBy("tree").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("leaf", "payload"))), lambda x: F.sha2(x["payload"], 256)).alias("l0")
    )

    def above(level: str) -> Column:
        # An odd node is paired with itself.
        pairs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
        left = lambda i: F.get(level, i * 2)
        right = lambda i: F.coalesce(F.get(level, i * 2 + 1), F.get(level, i * 2))
        return F.transform(pairs, lambda i: F.sha2(F.concat(left(i), right(i)), 256))

    trees = trees.withColumn("l1", above("l0")).withColumn("l2", above("l1")).withColumn("l3", above("l2"))

    def sibling(level: str, shift: int) -> Column:
        at = F.shiftright("leaf", shift)
        other = at.bitwiseXOR(F.lit(1))
        return F.coalesce(F.get(level, other), F.get(level, at))

    joined = leaves.join(trees, "tree")
    path = F.array(sibling("l0", 0), sibling("l1", 1), sibling("l2", 2))
    return joined.select(
        "proof_id",
        F.when(F.col("proof_id") % 10 == 0, F.concat("payload", F.lit(" "))).otherwise(F.col("payload")).alias("payload"),
        F.when(F.col("proof_id") % 25 != 0, F.get("l3", F.lit(0))).otherwise(F.lit("0" * 64)).alias("merkle_root"),
        F.when(F.col("proof_id") % 15 == 0, F.lit("not json")).otherwise(F.to_json(path)).alias("merkle_path_json"),
    )


def run_days(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger entries: one bundle hash per user and day, in five projects."""
    day = floor_div(epoch_millis("ts"), 86_400_000)
    return (
        table(spark, folder, "events")
        .groupBy("user_id", day.alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))
        .select(
            text("p_", F.col("user_id") % 5).alias("project_id"),
            "user_id",
            "day",
            F.sha2(text('{"user":', F.col("user_id"), ',"day":', F.col("day"), ',"n":', F.col("n"), "}"), 256).alias("payload_hash"),
        )
    )


def credentials(spark: SparkSession, folder: str) -> DataFrame:
    """Credentials of customers; their checksum is taken from the account balance, so that it is rarely right."""
    c = F.col("c_custkey")
    body = F.substring(F.sha2(c.cast("string"), 256), 1, 20)
    tail = F.substring(F.sha2(F.col("c_name"), 256), 1, 6)
    good = F.concat(F.lit("val_live_"), body, checksum(body))
    return table(spark, folder, "customer").select(
        c.alias("credential_id"),
        F.when(c % 7 == 0, F.concat(F.lit("val_live_"), body, tail)).when(c % 11 == 0, F.concat(F.lit("val_test_"), body)).otherwise(good).alias("key"),
        F.when(c % 2 == 0, "agent").otherwise("app").alias("context"),
        _pick(["human", "agent", "service", "robot"], c % 4).alias("owner_class"),
    )
