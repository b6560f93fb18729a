"""Redaction and size rules for metadata.

Metadata of a known schema is handled by Catalyst expressions built from its type. Metadata that is free JSON text
passes one Arrow-batched function, the only Python step of the batch path: Spark has no expression that walks JSON of
unknown shape.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultrail.functions.text import TEXT_LIMIT, col, truncate

# Metadata rules.
MAX_DEPTH = 5
DEPTH_MARK = "[Truncated - Depth Exceeded]"
HARD_LIMIT_BYTES = 5 * 1024 * 1024
DEFAULT_LIMIT_CHARS = 10240
PREFIX = "metadata."

GUARDED = "struct<metadata string, truncated_depth boolean, truncated_string boolean, oversize boolean, invalid boolean>"


@dataclass(frozen=True)
class MetadataRules:
    """Names are given as ``metadata.<top-level key>``.

    With ``strings_only`` a redacted key that holds something else than a string is kept as it is.
    """

    redact: tuple[str, ...] = field(default=())
    reference: tuple[str, ...] = field(default=())
    strings_only: bool = False

    def redacts(self, key: str) -> bool:
        return PREFIX + key in self.redact

    def references(self, key: str) -> bool:
        return PREFIX + key in self.reference


# --- free JSON text -------------------------------------------------------------------------------------------------


class _Number(str):
    """Source text of a number, written back in its shortest double form."""


def number_text(source: str) -> str:
    if source.lstrip("-").isdigit() and len(source) < 16:
        return str(int(source))
    value = float(source)
    if value in (float("inf"), float("-inf")):
        return "null"
    if value == 0:
        return "0"
    sign, digits, exponent = Decimal(repr(value)).normalize().as_tuple()
    text, point = "".join(map(str, digits)), len(digits) + exponent
    if len(text) <= point <= 21:
        body = text + "0" * (point - len(text))
    elif 0 < point <= 21:
        body = f"{text[:point]}.{text[point:]}"
    elif -6 < point <= 0:
        body = "0." + "0" * -point + text
    else:
        fraction = f".{text[1:]}" if len(text) > 1 else ""
        body = f"{text[0]}{fraction}e{point - 1:+d}"
    return ("-" if sign else "") + body


def _refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


_LONE = re.compile("[\ud800-\udfff]")


def parse(text: str):
    return json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_refuse)


def _quoted(text: str) -> str:
    """JSON string; a surrogate without its other half is no character and stays an escape."""
    quoted = json.dumps(text, ensure_ascii=False)
    return quoted if text.isascii() else _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", quoted)


def _scalar(value) -> str:
    if isinstance(value, _Number):
        return number_text(value)
    if isinstance(value, str):
        return _quoted(value)
    return {None: "null", True: "true", False: "false"}[value]


def _is_index(name: str) -> bool:
    return name.isascii() and name.isdigit() and (name == "0" or name[0] != "0") and int(name) < 2**32 - 1


def _members(value: dict):
    """Members in storage order: index-like names by number, then the others as they came."""
    indexed = sorted((k for k in value if _is_index(k)), key=int)
    if not indexed:
        return value.items()
    return [(k, value[k]) for k in indexed] + [(k, v) for k, v in value.items() if not _is_index(k)]


def compact(value) -> str:
    """Parsed JSON as text without blanks."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{_quoted(k)}:{compact(v)}" for k, v in _members(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(compact, value)) + "]"
    return _scalar(value)


def canonical(value) -> str:
    """Like :func:`compact`, with members sorted by name (UTF-16 order)."""
    if isinstance(value, dict):
        names = sorted(value, key=lambda name: name.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{_quoted(k)}:{canonical(value[k])}" for k in names) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    return _scalar(value)


class _Limiter:
    """Writes one document with the depth and string limits and remembers what was cut."""

    def __init__(self):
        self.depth = self.string = False

    def write(self, value, depth: int = 1) -> str:
        if depth > MAX_DEPTH:
            self.depth = True
            return _quoted(DEPTH_MARK)
        if isinstance(value, dict):
            return "{" + ",".join(f"{_quoted(k)}:{self.write(v, depth + 1)}" for k, v in _members(value)) + "}"
        if isinstance(value, list):
            return "[" + ",".join(self.write(v, depth + 1) for v in value) + "]"
        if isinstance(value, str) and not isinstance(value, _Number) and len(value) > TEXT_LIMIT:
            self.string = True
            return _quoted(value[:TEXT_LIMIT] + "...")
        return _scalar(value)


def _as_object(value) -> dict:
    if isinstance(value, dict):
        return value
    if isinstance(value, list):
        return {str(i): v for i, v in enumerate(value)}
    return {}


def _redacted(value: dict, rules: MetadataRules) -> dict:
    out = {}
    for key, item in value.items():
        if rules.references(key) and isinstance(item, dict) and "id" in item:
            shown = item["id"]
            plain = shown if isinstance(shown, str) and not isinstance(shown, _Number) else compact(shown)
            out[key] = f"[REF:{plain}]"
        elif rules.redacts(key) and (not rules.strings_only or (isinstance(item, str) and not isinstance(item, _Number))):
            out[key] = f"[REDACTED:{key}]"
        else:
            out[key] = item
    return out


def guard_text(text: str | None, rules: MetadataRules = MetadataRules()) -> dict:
    """All metadata rules on one document."""
    try:
        value = _as_object(parse(text)) if text else {}
    except (ValueError, RecursionError):
        return {"metadata": None, "truncated_depth": False, "truncated_string": False, "oversize": False, "invalid": True}
    limiter = _Limiter()
    # A number may grow when written out, at most from four characters to 21.
    oversize = len(text or "") * 6 > HARD_LIMIT_BYTES and len(compact(value).encode()) > HARD_LIMIT_BYTES
    return {
        "metadata": limiter.write(_redacted(value, rules)),
        "truncated_depth": limiter.depth,
        "truncated_string": limiter.string,
        "oversize": oversize,
        "invalid": False,
    }


_GUARDED_ARROW = pa.struct(
    [
        ("metadata", pa.string()),
        ("truncated_depth", pa.bool_()),
        ("truncated_string", pa.bool_()),
        ("oversize", pa.bool_()),
        ("invalid", pa.bool_()),
    ]
)


def guard(metadata: Column | str, rules: MetadataRules = MetadataRules()) -> Column:
    """Redaction, references, depth and string limits on JSON text, with flags; see ``GUARDED``."""

    @F.arrow_udf(GUARDED)
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([guard_text(text, rules) for text in batch.to_pylist()], _GUARDED_ARROW)

    # A later filter on the flags must not be pushed down together with a second run of the function.
    return run.asNondeterministic()(col(metadata))


def canonical_json(metadata: Column | str) -> Column:
    """Canonical text of JSON; null for null or for text that is not JSON."""

    def one(text):
        try:
            return None if text is None else canonical(parse(text))
        except (ValueError, RecursionError):
            return None

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([one(text) for text in batch.to_pylist()], pa.string())

    return run(col(metadata))


def select_arguments(arguments: Column | str, allow: list[str] | None) -> Column:
    """Listed members of a JSON object in list order; without a list all members are kept.

    A null or empty text is an object without members; a text that is no JSON object gives null.
    """

    def one(text):
        try:
            value = parse(text) if text else {}
            if not isinstance(value, dict):
                return None
            return compact({k: value[k] for k in allow if k in value} if allow else value)
        except (ValueError, RecursionError):
            return None

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([one(text) for text in batch.to_pylist()], pa.string())

    return run(col(arguments))


# --- known schema ---------------------------------------------------------------------------------------------------


def _limited(value: Column, kind: T.DataType, depth: int) -> Column:
    if depth > MAX_DEPTH:
        return F.when(value.isNotNull(), F.lit(DEPTH_MARK))
    if isinstance(kind, T.StructType):
        fields = [_limited(value[f.name], f.dataType, depth + 1).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _limited(item, kind.elementType, depth + 1))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, item: _limited(item, kind.valueType, depth + 1))
    if isinstance(kind, T.StringType):
        return truncate(value, TEXT_LIMIT)
    return value


def _any_long(value: Column, kind: T.DataType, depth: int) -> Column | None:
    """Whether any string the limit reaches is too long; null where the type holds no such string."""
    if depth > MAX_DEPTH:
        return None
    if isinstance(kind, T.StringType):
        return F.coalesce(F.length(value) > TEXT_LIMIT, F.lit(False))
    if isinstance(kind, T.StructType):
        found = [_any_long(value[f.name], f.dataType, depth + 1) for f in kind.fields]
        found = [f for f in found if f is not None]
        return F.greatest(*found, F.lit(False)) if found else None
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else None
    if inner is None or _any_long(F.lit(None), inner, depth + 1) is None:
        return None
    items = value if isinstance(kind, T.ArrayType) else F.map_values(value)
    return F.coalesce(F.exists(items, lambda item: _any_long(item, inner, depth + 1)), F.lit(False))


def _any_deep(value: Column, kind: T.DataType, depth: int) -> Column | None:
    """Whether anything lies below the depth limit; null where the type cannot reach it."""
    if depth > MAX_DEPTH:
        return value.isNotNull()
    if isinstance(kind, T.StructType):
        found = [_any_deep(value[f.name], f.dataType, depth + 1) for f in kind.fields]
        found = [f for f in found if f is not None]
        return F.coalesce(F.greatest(*found, F.lit(False)), F.lit(False)) if found else None
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else None
    if inner is None or _any_deep(F.lit(None), inner, depth + 1) is None:
        return None
    items = value if isinstance(kind, T.ArrayType) else F.map_values(value)
    return F.coalesce(F.exists(items, lambda item: _any_deep(item, inner, depth + 1)), F.lit(False))


def guard_struct(metadata: Column | str, kind: T.StructType, rules: MetadataRules = MetadataRules()) -> Column:
    """The same rules for metadata of a known type, in Catalyst expressions only."""
    metadata = col(metadata)
    fields, long, deep = [], [], []
    for f in kind.fields:
        value, is_struct = metadata[f.name], isinstance(f.dataType, T.StructType)
        if rules.references(f.name) and is_struct and "id" in f.dataType.names:
            shown = F.when(value.isNotNull(), F.concat(F.lit("[REF:"), value["id"].cast("string"), F.lit("]")))
        elif rules.redacts(f.name) and (not rules.strings_only or isinstance(f.dataType, T.StringType)):
            shown = F.when(value.isNotNull(), F.lit(f"[REDACTED:{f.name}]"))
        else:
            shown = _limited(value, f.dataType, 2)
            long.append(_any_long(value, f.dataType, 2))
            deep.append(_any_deep(value, f.dataType, 2))
        fields.append(shown.alias(f.name))
    no = F.lit(False)
    long, deep = [x for x in long if x is not None], [x for x in deep if x is not None]
    raw = F.to_json(metadata)
    return F.struct(
        F.coalesce(F.to_json(F.struct(*fields)), F.lit("{}")).alias("metadata"),
        (F.greatest(*deep, no) if deep else no).alias("truncated_depth"),
        (F.greatest(*long, no) if long else no).alias("truncated_string"),
        F.coalesce(F.octet_length(raw) > HARD_LIMIT_BYTES, no).alias("oversize"),
        no.alias("invalid"),
    )
