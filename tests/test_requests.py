import pytest
from pyspark.sql import functions as F

from vaultrail.functions.devices import classify
from vaultrail.functions.requests import apply_policy, client_context, event_policy, normalise_headers, telemetry_policy, trace_context


def one(spark, headers, socket=None):
    frame = spark.createDataFrame([(headers, socket)], "h map<string,string>, s string")
    frame = frame.withColumn("h", normalise_headers("h"))
    return frame.select(client_context("h", "s").alias("c"), trace_context("h").alias("t")).first()


@pytest.mark.parametrize(
    "headers, socket, ip",
    [
        ({"CF-Connecting-IP": "1.2.3.4", "x-real-ip": "5.6.7.8"}, None, "1.2.3.4"),
        ({"X-Real-IP": "5.6.7.8"}, "9.9.9.9", "5.6.7.8"),
        ({"x-forwarded-for": " 9.10.11.12 , 13.14.15.16"}, None, "9.10.11.12"),
        ({"cf-connecting-ip": "", "x-real-ip": "5.6.7.8"}, None, "5.6.7.8"),
        ({}, "9.9.9.9", "9.9.9.9"),
        ({}, None, ""),
    ],
)
def test_address(spark, headers, socket, ip):
    assert one(spark, headers, socket).c.ip == ip


def test_location_falls_back_between_providers(spark):
    place = one(spark, {"x-vercel-ip-country": "FR", "cf-region-code": "BE", "x-vercel-ip-city": "Paris"}).c.location
    assert (place.country, place.region, place.city) == ("FR", "BE", "Paris")
    place = one(spark, {}).c.location
    assert (place.country, place.region, place.city) == ("", "", "")


@pytest.mark.parametrize(
    "value, trace, span",
    [("00-abc-def-01", "abc", "def"), ("invalid-traceparent-format", None, None), ("", None, None), ("a-b-c-d-e", None, None)],
)
def test_trace_parent(spark, value, trace, span):
    found = one(spark, {"traceparent": value}).t
    assert (found.trace_id, found.span_id) == (trace, span)


@pytest.mark.parametrize("value, clock", [("10", 10), (" 7x", 7), ("-3", -3), ("abc", None), ("", None), ("99999999999999999999", None)])
def test_clock_header(spark, value, clock):
    assert one(spark, {"X-Logical-Clock": value}).t.logical_clock == clock


def policy(spark, *values):
    frame = spark.createDataFrame([values], "p string, ip string, ua string, l boolean")
    found = frame.select(telemetry_policy(F.col("p"), F.col("ip"), F.col("ua"), F.col("l")).alias("x")).first().x
    return tuple(found)


@pytest.mark.parametrize(
    "given, expected",
    [
        (("strict", None, None, None), ("skip", "skip", False)),
        (("standard", None, None, None), ("anonymize", "parse", True)),
        (("full", None, None, None), ("track", "track", True)),
        ((None, None, None, None), ("anonymize", "parse", True)),
        (("strict", "track", None, None), ("track", "skip", False)),
        (("full", "skip", "parse", False), ("skip", "parse", False)),
    ],
)
def test_presets(spark, given, expected):
    assert policy(spark, *given) == expected


def stored(spark, ring, context, preset, full=False, base=("anonymize", "parse", True)):
    schema = "c struct<ip:string,userAgent:string,location:struct<country:string,region:string,city:string>,device:struct<browser:string,os:string,type:string>>"
    frame = ring.attach(spark.createDataFrame([(context,)], schema))
    b = F.struct(*[F.lit(v).alias(n) for n, v in zip(("ip", "user_agent", "location"), base)])
    none = F.lit(None)
    p = event_policy(b, F.lit(preset), none.cast("string"), none.cast("string"), none.cast("boolean"))
    return frame.select(apply_policy(F.col("c"), p, F.col("_key"), F.lit(full)).alias("k")).first().k


def test_policy_outcomes(spark, ring):
    context = ("1.2.3.4", "Firefox/1", ("DE", None, "Berlin"), None)
    kept = stored(spark, ring, context, None)
    assert kept.ip == ring.tokens("1.2.3.4")[1] and kept.userAgent is None and kept.device.browser == "Firefox"
    assert (kept.location.country, kept.location.region, kept.location.city) == ("DE", "", None)
    assert stored(spark, ring, context, "full", full=True).location.city == "Berlin"
    assert stored(spark, ring, context, "full").ip != "1.2.3.4"
    tracked = stored(spark, ring, context, None, base=("track", "track", True))
    assert tracked.ip == "1.2.3.4" and tracked.userAgent == "Firefox/1" and tracked.location.city == "Berlin"
    assert stored(spark, ring, context, None, base=("skip", "skip", False)) is None
    own_device = stored(spark, ring, ("", "", None, ("B", "O", "T")), None)
    assert tuple(own_device.device) == ("B", "O", "T") and own_device.location.country is None


@pytest.mark.parametrize(
    "ua, expected",
    [
        ("Mozilla/5.0 (Windows NT 10.0) Chrome/120.0.1 Safari/537.36", ("Chrome 120", "Windows", "Desktop")),
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15) Version/17 Safari/605", ("Safari", "macOS", "Desktop")),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 17 like Mac OS X) Version/17 Mobile/15E Safari/604", ("Safari Mobile", "macOS", "Mobile")),
        ("Mozilla/5.0 (iPad; CPU OS 16) Safari/604", ("Safari", "iOS", "Tablet")),
        ("Mozilla/5.0 (Linux; Android 14) Chrome/119.0 Mobile Safari/537", ("Chrome 119", "Android", "Mobile")),
        ("Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537 Edg/120", ("Edge", "Windows", "Desktop")),
        ("Mozilla/5.0 (X11; Linux) Gecko Firefox/121", ("Firefox", "Linux", "Desktop")),
        ("Mozilla/5.0 Chrome/1 OPR/2", ("Unknown Browser", "Unknown OS", "Desktop")),
        ("CriOS/ no version", ("Chrome", "Unknown OS", "Desktop")),
        ("GoodBot/1", ("Unknown Browser", "Unknown OS", "Server")),
        ("my-worker/1", ("My Worker", "Linux Server", "Server")),
    ],
)
def test_devices(spark, ua, expected):
    frame = spark.createDataFrame([(ua,)], "ua string")
    assert tuple(frame.select(classify("ua", ("my-worker", "My Worker")).alias("d")).first().d) == expected
