"""JSON text assembled around fragments whose bytes must stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultrail.functions.text import col


def _inner(text: Column) -> Column:
    """What stands between the outer brackets of a JSON object or array."""
    body = F.trim(text)
    return F.trim(F.substring(body, F.lit(2), F.length(body) - 2))


def quote(value: Column | str) -> Column:
    """JSON string literal of a value; null stays null."""
    value = col(value)
    return F.when(value.isNotNull(), _inner(F.to_json(F.array(value))))


def splice(*objects: Column | str) -> Column:
    """Members of several JSON objects in one object, left to right; null objects add nothing.

    A name that occurs twice is kept twice. Readers that keep the last one, and
    :func:`vaultrail.functions.metadata.guard`, which every stored metadata text passes, then see the right-most
    value in the place of the first: the order an object merge gives.
    """
    members = [F.when(col(o).isNotNull(), F.nullif(_inner(col(o)), F.lit(""))) for o in objects]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def object_of(*members: tuple[str, Column]) -> Column:
    """JSON object from ``(name, JSON fragment)`` pairs; pairs with a null fragment are left out."""
    pairs = [F.when(fragment.isNotNull(), F.concat(F.lit(f'"{name}":'), fragment)) for name, fragment in members]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def member(text: Column | str, name: str) -> Column:
    """One member of a JSON object as text; strings lose their quotes."""
    return F.get_json_object(col(text), f"$.{name}")
