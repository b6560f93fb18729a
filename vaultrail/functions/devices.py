"""Device columns from a user-agent column. Rules are ordered; the first that matches wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultrail.functions.text import col

# Device type, browser and system patterns (case is ignored).
TYPE_RULES = [
    ("Mobile", "mobile"),
    ("Tablet", "tablet|ipad"),
    ("Server", "server|bot"),
]
DEFAULT_TYPE = "Desktop"
CHROME, EDGE, OPERA = "chrome|crios", "edge|edg", "opr"
SAFARI, FIREFOX, ANDROID = "safari", "firefox|fxios", "android"
CHROME_MAJOR = "(?i)(?:chrome|crios)/(?=[0-9.])([0-9]*)"
DEFAULT_BROWSER = "Unknown Browser"
OS_RULES = [
    ("Windows", "windows"),
    ("macOS", "macintosh|mac os x"),
    ("iOS", "iphone|ipad|ipod"),
    ("Android", "android"),
    ("Linux", "linux"),
]
DEFAULT_OS = "Unknown OS"
AGENT_OS, AGENT_TYPE = "Linux Server", "Server"


def _has(ua: Column, pattern: str) -> Column:
    return ua.rlike(f"(?i){pattern}")


def _first_match(ua: Column, rules: list[tuple[str, str]], default: str) -> Column:
    branches = None
    for label, pattern in rules:
        branches = F.when(_has(ua, pattern), label) if branches is None else branches.when(_has(ua, pattern), label)
    return branches.otherwise(default)


def _browser(ua: Column) -> Column:
    chrome = _has(ua, CHROME)
    version = F.regexp_extract(ua, CHROME_MAJOR, 1)
    return (
        F.when(chrome & ~_has(ua, EDGE) & ~_has(ua, OPERA), F.trim(F.concat(F.lit("Chrome "), version)))
        .when(
            _has(ua, SAFARI) & ~chrome & ~_has(ua, ANDROID),
            F.when(_has(ua, "mobile"), "Safari Mobile").otherwise("Safari"),
        )
        .when(_has(ua, FIREFOX), "Firefox")
        .when(_has(ua, EDGE), "Edge")
        .otherwise(DEFAULT_BROWSER)
    )


def classify(user_agent: Column | str, ingest_agent: tuple[str, str] | None = None) -> Column:
    """``struct<browser, os, type>`` of a user agent.

    ``ingest_agent`` is ``(pattern, label)`` of the caller's own ingestion worker, which counts as a server.
    """
    ua = col(user_agent)
    browser, system, kind = _browser(ua), _first_match(ua, OS_RULES, DEFAULT_OS), _first_match(ua, TYPE_RULES, DEFAULT_TYPE)
    if ingest_agent:
        pattern, label = ingest_agent
        own = _has(ua, pattern)
        browser = F.when(own, label).otherwise(browser)
        system = F.when(own, AGENT_OS).otherwise(system)
        kind = F.when(own, AGENT_TYPE).otherwise(kind)
    return F.struct(browser.alias("browser"), system.alias("os"), kind.alias("type"))
