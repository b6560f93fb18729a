"""Text rules shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the audit model.
IDENTITY_LIMIT = 255
TEXT_LIMIT = 1000
USER_AGENT_LIMIT = 1000


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def present(value: Column | str) -> Column:
    """The value, or null when it is the empty string."""
    return F.nullif(col(value), F.lit(""))


def first_present(*values: Column | str) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[present(v) for v in values])


def truncate(value: Column | str, limit: int) -> Column:
    """Cut after ``limit`` characters and mark the cut with an ellipsis."""
    value = col(value)
    return F.when(F.length(value) > limit, F.concat(F.substring(value, 1, limit), F.lit("..."))).otherwise(value)


def utf16_length(value: Column | str) -> Column:
    """Length in UTF-16 code units, the unit of the metadata limit."""
    return (F.octet_length(F.encode(col(value), "UTF-16BE")) / 2).cast("bigint")


def utf8_length(value: Column | str) -> Column:
    return F.octet_length(col(value)).cast("bigint")


def base64_line(value: Column) -> Column:
    """Base64 without the line breaks Spark puts after every 76 characters."""
    return F.replace(F.base64(value), F.lit("\r\n"), F.lit(""))


def epoch_micros(value: Column | str) -> Column:
    return F.unix_micros(col(value).cast("timestamp"))


def epoch_millis(value: Column | str) -> Column:
    return F.unix_millis(col(value).cast("timestamp"))
