"""Ordered computation over keys of any size.

A plain window over a key puts all rows of the key into one task. Here keys with more than ``hot_rows`` rows are found
by a count first, and only their rows are divided by the caller's ``chunk`` columns: values that never decrease along
the order, such as ``event_id div 100000`` or an hour. Windows then run over (key, chunk); for hot keys one summary row
per chunk is combined per key and carried back to the rows. A chunk made of a unique integer divided by ``w`` holds at
most ``w`` rows, whatever the key's share of the table. Where no key is hot, the adaptive planner drops the summaries
and their joins.

Key columns must not be null; a row with a null key is kept, with a null result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.functions.numbers import floor_div

# Rows per chunk when an order column is a unique integer, and rows from which a key is divided.
CHUNK_ROWS = 100_000
HOT_ROWS = 1_000_000


def int_chunk(name: str, rows: int = CHUNK_ROWS) -> Column:
    return floor_div(name, rows)


def _equal(keys: list[str], prefix: str) -> Column:
    return reduce(and_, [F.col(k) == F.col(prefix + k) for k in keys])


def _with_chunks(df: DataFrame, keys: list[str], chunk: list[Column], hot_rows: int) -> tuple[DataFrame, list[str]]:
    """Add ``_hot`` and, for rows of hot keys, the chunk columns; they are null in all other rows.

    There are at most rows / ``hot_rows`` hot keys. Whether their list is broadcast is left to its size at run time.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > hot_rows)
    hot = sizes.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias("_hot"))
    marked = df.join(hot, _equal(keys, "_h_"), "left").drop(*[f"_h_{k}" for k in keys])
    names = [f"_chunk{i}" for i in range(len(chunk))]
    return marked.withColumns({n: F.when(F.col("_hot"), c) for n, c in zip(names, chunk)}), names


def _attach(rows: DataFrame, summary: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Bring per-chunk values to the rows of hot keys.

    Plain equality keeps the rows where the window put them; only the summary moves.
    """
    renamed = summary.select(*[F.col(c).alias(f"_s_{c}") for c in on], *values)
    return rows.join(renamed, _equal(on, "_s_"), "left").drop(*[f"_s_{c}" for c in on])


def number_rows(
    df: DataFrame, keys: list[str], order: list[str], chunk: list[Column], out: str = "position", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number the rows of each key from 1 in the given order."""
    data, names = _with_chunks(df, keys, chunk, hot_rows)
    number = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*order)).cast("bigint")
    local = data.withColumn(out, F.when(_given(keys), number))
    before = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        data.where("_hot")
        .groupBy(*keys, *names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.sum("_n").over(before))
    )
    joined = _attach(local, offsets, keys + names, ["_offset"])
    return joined.withColumn(out, F.col(out) + F.coalesce("_offset", F.lit(0))).drop("_offset", "_hot", *names)


def _given(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    chunk: list[Column],
    value: Column,
    out: str,
    step: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``value`` of the row before (``step=-1``) or after (``step=1``) within the key."""
    back = step < 0
    data, names = _with_chunks(df.withColumn("_value", value), keys, chunk, hot_rows)
    inside = Window.partitionBy(*keys, *names).orderBy(*order)
    shift = F.lag if back else F.lead
    marked = data.withColumns(
        {
            out: F.when(_given(keys), shift("_value").over(inside)),
            "_edge": shift(F.lit(1)).over(inside).isNull(),
        }
    )
    rank = F.struct(*order)
    pick = F.max_by if back else F.min_by
    edges = data.where("_hot").groupBy(*keys, *names).agg(pick(F.struct("_value"), rank).alias("_end"))
    along = Window.partitionBy(*keys).orderBy(*names)
    edges = edges.withColumn("_carried", shift("_end").over(along))
    joined = _attach(marked, edges, keys + names, ["_carried"])
    carried = F.when(F.col("_edge"), F.col("_carried._value")).otherwise(F.col(out))
    return joined.withColumn(out, carried).drop("_value", "_edge", "_carried", "_hot", *names)


def clock_terms(
    df: DataFrame, scope: list[str], order: list[str], chunk: list[Column], incoming: Column, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``clock_position`` and ``clock_lift``, from which :func:`clock_value` gives the Lamport clock of a row.

    The fold ``clock = max(clock, incoming or 0) + 1`` from ``base`` has the closed form
    ``n + max(base, max over j <= n of (incoming_j - j + 1))`` for the n-th row, which needs running maxima only.
    """
    received = F.coalesce(incoming, F.lit(0)).cast("bigint")
    data, names = _with_chunks(df.withColumn("_in", received), scope, chunk, hot_rows)
    inside = Window.partitionBy(*scope, *names).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)

    def local_terms(rows: DataFrame) -> DataFrame:
        numbered = rows.withColumn("_n", F.row_number().over(inside).cast("bigint"))
        return numbered.withColumn("_lift", F.col("_in") - F.col("_n") + 1)

    local = local_terms(data).withColumn("_high", F.max("_lift").over(upto))
    narrow = data.where("_hot").select(*scope, *names, *[c for c in order if c not in scope + names], "_in")
    parts = local_terms(narrow).groupBy(*scope, *names).agg(F.count(F.lit(1)).alias("_rows"), F.max("_lift").alias("_top"))
    before = Window.partitionBy(*scope).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    parts = parts.withColumn("_prior", F.max(F.col("_top") - F.col("_offset")).over(before))
    joined = _attach(local, parts, scope + names, ["_offset", "_prior"])
    offset = F.coalesce("_offset", F.lit(0))
    return joined.withColumns(
        {
            "clock_position": F.when(_given(scope), offset + F.col("_n")),
            "clock_lift": F.greatest(F.col("_prior"), F.col("_high") - offset),
        }
    ).drop("_in", "_n", "_lift", "_high", "_offset", "_prior", "_hot", *names)


def clock_value(base: Column) -> Column:
    """Lamport clock of a row with clock terms; ``base`` must be the same for all rows of a scope."""
    start = F.coalesce(base, F.lit(0)).cast("bigint")
    return F.col("clock_position") + F.greatest(start, F.col("clock_lift"))


def logical_clock(
    df: DataFrame,
    scope: list[str],
    order: list[str],
    chunk: list[Column],
    incoming: Column,
    base: Column,
    out: str = "logical_clock",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Lamport clock per scope, starting at ``base``."""
    terms = clock_terms(df.withColumn("_base", base), scope, order, chunk, incoming, hot_rows)
    return terms.withColumn(out, clock_value(F.col("_base"))).drop("_base", "clock_position", "clock_lift")
