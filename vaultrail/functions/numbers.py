"""Integer arithmetic that stays exact for large values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultrail.functions.text import col


def floor_div(value: Column | str, by: int) -> Column:
    """Integer division rounded down, also for negative values."""
    value, by = col(value).cast("bigint"), F.lit(by).cast("bigint")
    return F.call_function("div", value - F.pmod(value, by), by)
