"""Client and trace context from request headers, and the telemetry policy applied to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultrail.functions.crypto import blind_index
from vaultrail.functions.devices import classify
from vaultrail.functions.text import USER_AGENT_LIMIT, col, first_present, present, truncate

# Header names in order of preference.
IP_HEADERS = ["cf-connecting-ip", "x-real-ip", "x-forwarded-for"]
COUNTRY_HEADERS = ["cf-ipcountry", "x-vercel-ip-country"]
REGION_HEADERS = ["cf-region-code", "x-vercel-ip-country-region"]
CITY_HEADERS = ["cf-ipcity", "x-vercel-ip-city"]
USER_AGENT_HEADER = "user-agent"
TRACE_HEADER = "traceparent"
CLOCK_HEADER = "x-logical-clock"

# Telemetry presets as (ip, user agent, location).
PRESETS = {
    "strict": ("skip", "skip", False),
    "standard": ("anonymize", "parse", True),
    "full": ("track", "track", True),
}
DEFAULT_PRESET = "standard"


def normalise_headers(headers: Column | str) -> Column:
    """Header map with lower-case names; of names that differ only in case the last one counts."""
    lowered = F.transform(
        F.map_entries(col(headers)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return F.aggregate(
        lowered,
        F.create_map().cast("map<string,string>"),
        lambda seen, e: F.map_concat(
            F.map_filter(seen, lambda k, _: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))
        ),
    )


def _header(headers: Column, names: list[str]) -> Column:
    return first_present(*[headers[name] for name in names])


def client_context(headers: Column | str, socket_address: Column | str) -> Column:
    """``struct<ip, userAgent, location<country, region, city>>``; absent values are empty strings."""
    headers = col(headers)
    forwarded = F.trim(F.split(_header(headers, IP_HEADERS), ",")[0])
    empty = F.lit("")
    return F.struct(
        F.coalesce(forwarded, col(socket_address), empty).alias("ip"),
        F.coalesce(headers[USER_AGENT_HEADER], empty).alias("userAgent"),
        F.struct(
            F.coalesce(_header(headers, COUNTRY_HEADERS), empty).alias("country"),
            F.coalesce(_header(headers, REGION_HEADERS), empty).alias("region"),
            F.coalesce(_header(headers, CITY_HEADERS), empty).alias("city"),
        ).alias("location"),
    )


def trace_context(headers: Column | str, clock_header: str = CLOCK_HEADER) -> Column:
    """``struct<trace_id, span_id, logical_clock>``; a trace parent must have exactly four parts."""
    headers = col(headers)
    parts = F.split(present(headers[TRACE_HEADER]), "-")
    four = F.size(parts) == 4
    clock = F.regexp_extract(headers[clock_header], r"^\s*([+-]?\d+)", 1).try_cast("bigint")
    return F.struct(
        F.when(four, parts[1]).alias("trace_id"),
        F.when(four, parts[2]).alias("span_id"),
        clock.alias("logical_clock"),
    )


def telemetry_policy(preset: Column, ip: Column, user_agent: Column, location: Column) -> Column:
    """Preset values with each given field on top, as ``struct<ip, user_agent, location>``."""

    def from_preset(position: int) -> Column:
        choice = F.coalesce(preset, F.lit(DEFAULT_PRESET))
        return (
            F.when(choice == "strict", F.lit(PRESETS["strict"][position]))
            .when(choice == "full", F.lit(PRESETS["full"][position]))
            .otherwise(F.lit(PRESETS[DEFAULT_PRESET][position]))
        )

    return F.struct(
        F.coalesce(ip, from_preset(0)).alias("ip"),
        F.coalesce(user_agent, from_preset(1)).alias("user_agent"),
        F.coalesce(location, from_preset(2)).alias("location"),
    )


def event_policy(base: Column, preset: Column, ip: Column, user_agent: Column, location: Column) -> Column:
    """Policy of one event: its own fields over the base policy.

    A per-event preset changes no field, because the base fields count as given; it only matters for the city
    (see :func:`apply_policy`).
    """
    return telemetry_policy(
        preset,
        F.coalesce(ip, base["ip"]),
        F.coalesce(user_agent, base["user_agent"]),
        F.coalesce(location, base["location"]),
    )


def apply_policy(context: Column, policy: Column, key: Column, full_detail: Column, ingest_agent=None) -> Column:
    """What of a client context is stored, field by field, in storage order; null when nothing is.

    ``context`` is ``struct<ip, userAgent, location, device>``; ``full_detail`` tells whether the city may be kept
    although the address is not.
    """
    ip, ua, location = present(context["ip"]), present(context["userAgent"]), context["location"]
    known = location.isNotNull()

    def place(name: str) -> Column:
        return F.when(known, F.coalesce(location[name], F.lit(""))).alias(name)

    city = F.when(
        known & ((policy["ip"] == "track") | F.coalesce(full_detail, F.lit(False))),
        F.coalesce(location["city"], F.lit("")),
    )
    stored_location = F.when(policy["location"], F.struct(place("country"), place("region"), city.alias("city")))
    stored_ip = F.when(policy["ip"] == "anonymize", blind_index(ip, key)).when(policy["ip"] == "track", ip)
    device = F.when(
        policy["user_agent"] != "skip", F.when(ua.isNotNull(), classify(ua, ingest_agent)).otherwise(context["device"])
    )
    stored_ua = F.when(policy["user_agent"] == "track", truncate(ua, USER_AGENT_LIMIT))
    kept = [stored_location.alias("location"), stored_ip.alias("ip"), device.alias("device"), stored_ua.alias("userAgent")]
    nothing = ~policy["location"] & stored_ip.isNull() & device.isNull() & stored_ua.isNull()
    return F.when(~nothing, F.struct(*kept))
