import datetime
import json
import zlib

from pyspark.sql import functions as F

from vaultrail.functions.crypto import blind_index
from vaultrail.operators import access, ingest, search
from vaultrail.operators.ordered import int_chunk
from vaultrail.sources import ledger as store


def test_lifetimes(spark):
    cases = {"30s": 30, "30m": 1800, "2h": 7200, "1d": 86400, "7d": 604800, "invalid": 7200, "": 7200, "2x": 7200, "-1h": 7200, "1h ": 7200}
    frame = spark.createDataFrame([(c,) for c in cases], "d string")
    assert {r.d: r.s for r in frame.select("d", access.lifetime_seconds("d").alias("s")).collect()} == cases


def grants(spark, ring, rows):
    schema = "grant_id string, actor_id string, target_id string, tenant_id string, scope string, expires_in string, iat bigint"
    return access.access_grants(spark.createDataFrame(rows, schema), ring)


def test_grants(spark, ring):
    rows = [
        ("a", "usr", None, None, None, None, 100), ("b", None, None, "t", None, "30m", 100), ("c", None, None, None, "auditor", "7d", 100),
        ("d", None, None, None, None, "1h", 100), ("e", None, "tgt", None, None, "7d", 100), ("f", "usr", None, "t", "actor", "30s", 100),
    ]
    found = {r.grant_id: r for r in grants(spark, ring, rows).collect()}
    assert {k: (r.scope, r.exp - r.iat) for k, r in found.items()} == {
        "a": ("actor", 3600), "b": ("tenant", 1800), "c": ("auditor", 604800), "d": ("actor", 3600), "e": ("actor", 3600), "f": ("actor", 30),
    }
    assert [k for k, r in found.items() if r.reject_reason] == ["d"]
    assert found["a"].actor_indexes == ring.tokens("usr") and found["a"].tenant_indexes is None and found["b"].tenant_indexes == ring.tokens("t")


def ledger(spark, ring):
    rows = [(i, f"u{i % 3}", f"o{i % 4}", None if i % 5 == 0 else f"t{i % 2}", i) for i in range(60)]
    frame = ring.attach(spark.createDataFrame(rows, "event_id int, actor string, target string, tenant string, logical_clock bigint"))
    named = {f"{n}_index": blind_index(n, F.col("_key")) for n in ("actor", "target", "tenant")}
    at = F.timestamp_seconds(F.col("event_id") * 3600)
    return frame.withColumns(named).withColumn("created_at", at).drop("_key"), rows


def test_coverage_and_visibility(spark, ring):
    frame, rows = ledger(spark, ring)
    given = grants(spark, ring, [
        ("actor", "u1", None, None, None, "1h", 100), ("tenant", None, None, "t1", None, "1h", 100), ("target", None, "o2", None, "target", "1h", 100),
        ("all", "x", None, None, "all", "1h", 100), ("nothing", "nobody", None, None, None, "1h", 100), ("over", "u1", None, None, None, "30s", 100),
        ("mixed", None, "o1", None, None, "1h", 100),
    ])
    live = access.live_grants(given, F.lit(200))
    found = {r.grant_id: (r.rows, r.first_clock, r.last_clock) for r in access.grant_coverage(frame, live).collect()}
    size = lambda test: (len(c := [r[4] for r in rows if test(r)]), min(c), max(c))
    assert found == {
        "actor": size(lambda r: r[1] == "u1"), "tenant": size(lambda r: r[3] == "t1"), "target": size(lambda r: r[2] == "o2"),
        "all": size(lambda r: True), "nothing": (0, None, None), "mixed": (0, None, None),
    }
    assert access.rows_visible_to(frame, live, "actor").count() == found["actor"][0]


def test_purge(spark, ring):
    frame, rows = ledger(spark, ring)
    bound = datetime.datetime(1970, 1, 2)
    schema = "actor string, max_created_at timestamp"
    wanted = spark.createDataFrame([("u1", bound), ("u1", datetime.datetime(1970, 1, 1, 3)), ("u2", None), ("u2", bound), ("zz", None)], schema)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    limit = wanted.where("actor = 'u1'").agg(F.max(F.unix_seconds("max_created_at"))).first()[0]
    marked = access.mark_purged(frame, wanted, ring)
    gone = {r.event_id for r in access.tombstones(marked).collect()}
    assert gone == {r[0] for r in rows if r[1] == "u2" or (r[1] == "u1" and r[0] * 3600 <= limit)}
    assert access.kept_rows(marked).count() == 60 - len(gone)
    assert sum(r.deleted_count for r in access.purge_counts(marked).collect()) == len(gone)
    old = type(ring)(ring.keys, "v1")
    assert access.mark_purged(frame, wanted, old, active_only=True).where("purged").count() == 0
    assert access.mark_purged(frame, wanted, old).where("purged").count() == len(gone)


def test_credentials(spark):
    body = "0123456789abcdef0123"
    good = "val_live_" + body + f"{zlib.crc32(body.encode()):08x}"[:6]
    rows = [(good, "app", "human"), (good, "agent", "human"), (good, "agent", "agent"), (good[:-1] + "g", "app", "service"), ("val_live_" + body + "000000", "app", "robot"), ("", "app", "human")]
    frame = spark.createDataFrame(rows, "key string, context string, owner_class string")
    found = [(r.well_formed, r.checksum_ok, r.known_class, r.handover) for r in access.audit_credentials(frame).collect()]
    assert found == [(True, True, True, False), (True, True, True, True), (True, True, True, False), (False, False, True, False), (True, False, False, False), (False, False, True, False)]


def test_scoped_view_and_hydration(spark, ring):
    rows = [(i, "login" if i % 2 else "logout", f"u{i % 3}", "acme" if i < 6 else "other", json.dumps({"region": f"r{i}"})) for i in range(10)]
    events = ingest.with_event_columns(spark.createDataFrame(rows, "event_id bigint, action string, actor string, tenant string, metadata string"))
    policy = ingest.IngestPolicy(reference=("actor",))
    sealed = ingest.accepted_rows(ingest.seal_events(ingest.guard_events(events, policy), ring, policy))
    view = search.scoped_view(sealed, ring, "tenant", ["acme"], ["actor", "action", "metadata.region"], search="R3", action="login")
    assert [tuple(r) for r in view.collect()] == [(3, "[REF:u0]", "login", "r3")] and view.columns == ["event_id", "act", "acn", "m.region"]
    assert search.scoped_view(sealed, ring, "auditor", [], ["action"]).count() == 10
    people = spark.createDataFrame([("u0", "Zero")], "ref_id string, name string")
    named = {r.event_id: r.name for r in search.hydrate(search.scoped_view(sealed, ring, "all", [], ["actor"]), "act", people).collect()}
    assert named[0] == "Zero" and named[1] is None and len(named) == 10


def test_causality(spark):
    edges = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "gone"), ("f", "e"), ("x", "y"), ("y", "x"), ("z", "x"), ("s", "s")]
    edges += [(f"n{i}", f"n{i - 1}" if i else None) for i in range(40)]
    frame = spark.createDataFrame(edges, "span_id string, parent_span_id string")
    found = {r.span_id: (r.root_span_id, r.depth) for r in search.causality(frame).collect()}
    expected = {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("a", 3), "e": ("e", 0), "f": ("e", 1)}
    expected |= {k: (None, None) for k in "xyzs"} | {f"n{i}": ("n0", i) for i in range(40)}
    assert found == expected


def test_causality_within_traces(spark):
    edges = [("t", "a", None), ("t", "b", "a"), ("t", "b", "a"), ("u", "b", None), ("u", "c", "b"), ("t", "d", "c"), (None, "e", "b"), ("u", None, "b")]
    frame = spark.createDataFrame(edges, "trace_id string, span_id string, parent_span_id string")
    rows = search.causality(frame, ["trace_id"]).collect()
    expected = {("t", "a"): ("a", 0), ("t", "b"): ("a", 1), ("u", "b"): ("b", 0), ("u", "c"): ("b", 1), ("t", "d"): ("d", 0)}
    expected |= {(None, "e"): (None, None), ("u", None): (None, None)}
    assert len(rows) == len(edges) and {(r.trace_id, r.span_id): (r.root_span_id, r.depth) for r in rows} == expected


def test_purge_leaves_no_blob(spark, ring, tmp_path):
    """Rows, blobs and counts after a purge; the blob of an erased row is not in the snapshot."""
    large = "x" * 40_000
    events = [(1, "ann", '{"a":"' + large + '"}'), (2, "bob", '{"b":"' + large + '"}'), (3, "ann", "{}")]
    frame = ingest.with_event_columns(spark.createDataFrame(events, "event_id bigint, actor string, metadata string").withColumn("action", F.lit("put")))
    sealed = ingest.seal_events(frame.withColumn("reject_reason", F.lit(None).cast("string")), ring)
    old, new, last = (f"{tmp_path}/{n}" for n in ("old", "new", "last"))
    store.append(sealed, old)
    requests = lambda *names: spark.createDataFrame([(n, None) for n in names], "actor string, max_created_at timestamp")
    counts = store.purge(spark, old, new, requests("ann", "nobody"), ring)
    assert [r.deleted_count for r in counts.collect()] == [2]
    rows, blobs = store.read_rows(spark, new), store.read_blobs(spark, new)
    assert [r.event_id for r in rows.collect()] == [2] and {r.hash for r in blobs.collect()} == {r.payload for r in rows.collect()}
    assert sorted(r.event_id for r in store.read_tombstones(spark, new).collect()) == [1, 3]
    store.purge(spark, new, last, requests("bob"), ring)
    assert store.read_rows(spark, last).count() == store.read_blobs(spark, last).count() == 0


def test_stored_search_is_pushed_and_sealed(spark, ring, tmp_path, capsys):
    """The index filter reaches the scan, and no file of a ledger has a plaintext column."""
    frame = spark.createDataFrame([(1, "ann", "put"), (2, "bob", "put")], "event_id bigint, actor string, action string")
    store.ingest_events(frame.withColumn("metadata", F.lit("{}")), f"{tmp_path}/ledger", ring, [int_chunk("event_id")])
    rows = store.read_rows(spark, f"{tmp_path}/ledger")
    assert set(spark.read.parquet(f"{tmp_path}/ledger/rows").columns) == {*ingest.ENVELOPE, "day", "batch"}
    found = search.search_literals(rows, ring, "actor_index", ["ann"])
    found.explain("formatted")
    assert "PushedFilters: [In(actor_index" in capsys.readouterr().out
    assert [r.event_id for r in found.collect()] == [1]


def test_grants_reach_rows_of_their_project(spark, ring):
    ledger = spark.createDataFrame(
        [(1, "p", "a", "t", None), (2, "p", "b", "t", "x"), (3, "q", "a", "t", "x"), (40_000, "p", "a", "u", "x"), (5, None, "a", "t", None)],
        "event_id bigint, project_id string, actor_index string, target_index string, tenant_index string",
    )
    grants = spark.createDataFrame(
        [("g1", "p", "actor", ["a", "b"], None, None), ("g2", "p", "all", ["a"], None, None), ("g3", "q", "auditor", None, None, None), ("g4", "p", "target", ["a"], ["t"], None),
         ("g5", "q", "tenant", None, None, ["x", "y"]), ("g6", "p", "actor", None, None, None), ("g7", None, "all", None, None, None), ("g8", "z", "all", None, None, None)],
        "grant_id string, project_id string, scope string, actor_indexes array<string>, target_indexes array<string>, tenant_indexes array<string>",
    )
    bitmaps = access.grant_bitmaps(ledger, grants)
    assert {r.grant_id: r.rows for r in access.reach(bitmaps).collect()} == {"g1": 3, "g2": 3, "g3": 1, "g4": 2, "g5": 1, "g7": 1}
    together = access.reach(bitmaps, grants.selectExpr("grant_id", "project_id AS p"), ["p"]).collect()
    assert {r.p: r.rows for r in together} == {"p": 3, "q": 1, None: 1}
    seen = lambda g, scope=None: sorted(r.event_id for r in access.rows_visible_to(ledger, g, scope).collect())
    assert seen(grants) == [1, 2, 3, 5, 40_000] and seen(grants, "tenant") == [3] and seen(grants, "target") == [1, 2] and seen(grants.where("grant_id = 'g2'")) == [1, 2, 40_000]
    # Without projects everything is one.
    assert seen(grants.where("grant_id = 'g3'").drop("project_id")) == [5]
    assert sorted(r.event_id for r in access.rows_visible_to(ledger.drop("project_id"), grants.where("grant_id = 'g3'").drop("project_id")).collect()) == [1, 2, 3, 5, 40_000]


def test_counts_of_grants_hold_no_bitmaps(spark, ring):
    """Counts of single and joint grants equal sets of ids, for repeated ids, null names and overlapping scopes too, without a row per bucket."""
    pick = lambda i, n, prefix: None if i % 11 == n else f"{prefix}{i * (n + 3) // 7 % (n + 4)}"
    rows = [(i - 3 if i % 23 else 7, "pq"[i % 2] if i % 13 else None, pick(i, 1, "a"), pick(i, 2, "b"), pick(i, 3, "c")) for i in range(400)]
    rows.append((None, "p", "a1", "b1", "c1"))
    names = "event_id bigint, project_id string, actor_index string, target_index string, tenant_index string"
    ledger = spark.createDataFrame(rows, names)
    scopes = ["actor", "target", "tenant", "all", "auditor"]
    held = [(f"g{i}", [None, "p", "q"][i % 3], scopes[i % (5 if i % 4 == 0 else 3)], [f"a{i % 6}", f"a{i % 4}"], [f"b{i % 7}"], [f"c{i % 5}", "c0"], [None, "x", "y", "z"][i % 4] if i % 5 else "w") for i in range(40)]
    grants = spark.createDataFrame(held, "grant_id string, project_id string, scope string, actor_indexes array<string>, target_indexes array<string>, tenant_indexes array<string>, owner string")
    sees = lambda g, r: r[0] is not None and (r[1] or "") == (g[1] or "") and (g[2] in ("all", "auditor") or r[2 + scopes.index(g[2])] in g[3 + scopes.index(g[2])])
    single = {g[0]: len({r[0] for r in rows if sees(g, r)}) for g in held}
    assert {r.grant_id: r.rows for r in access.grant_counts(ledger, grants).collect()} == {g: n for g, n in single.items() if n}
    for by in (["owner"], ["owner", "project_id"]):
        key = lambda g: tuple({"owner": g[6], "project_id": g[1]}[c] for c in by)
        joint = {k: len({r[0] for g in held if key(g) == k for r in rows if sees(g, r)}) for k in map(key, held)}
        counted = access.group_counts(ledger, grants, grants.select("grant_id", *by), by)
        assert {tuple(r[c] for c in by): r.rows for r in counted.collect()} == {k: n for k, n in joint.items() if n}
        assert "bitmap" not in counted._jdf.queryExecution().optimizedPlan().toString()
