import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vaultrail.functions.metadata import (
    select_arguments,
    DEPTH_MARK,
    MetadataRules,
    canonical,
    canonical_json,
    compact,
    guard,
    guard_struct,
    guard_text,
    number_text,
    parse,

)


@pytest.mark.parametrize(
    "source, expected",
    [
        ("1", "1"), ("-0", "0"), ("1.0", "1"), ("1.50", "1.5"), ("1e3", "1000"), ("1e21", "1e+21"), ("123456789012345680000", "123456789012345680000"),
        ("0.000001", "0.000001"), ("1e-7", "1e-7"), ("1.5e-10", "1.5e-10"), ("9007199254740993", "9007199254740992"), ("1e400", "null"), ("-2.5E2", "-250"),
    ],
)
def test_number_text(source, expected):
    assert number_text(source) == expected


def test_redaction_and_reference():
    rules = MetadataRules(redact=("metadata.email", "metadata.count"), reference=("metadata.user",))
    out = guard_text('{"email":"a@b.c","plan":"pro","count":3,"user":{"id":"u1","pii":"x"}}', rules)
    assert json.loads(out["metadata"]) == {"email": "[REDACTED:email]", "plan": "pro", "count": "[REDACTED:count]", "user": "[REF:u1]"}
    kept = guard_text('{"count":3}', MetadataRules(redact=("metadata.count",), strings_only=True))
    assert kept["metadata"] == '{"count":3}'
    plain = guard_text('{"user":"u1"}', MetadataRules(reference=("metadata.user",)))
    assert plain["metadata"] == '{"user":"u1"}'


def test_depth_limit_reaches_scalars_and_lists():
    out = guard_text('{"a":{"b":{"c":{"d":1,"e":[1]}}},"l":[[[[1]]]]}')
    assert json.loads(out["metadata"]) == {"a": {"b": {"c": {"d": 1, "e": [DEPTH_MARK]}}}, "l": [[[[DEPTH_MARK]]]]}
    assert out["truncated_depth"] and not out["truncated_string"]


def test_string_limit():
    out = guard_text(json.dumps({"s": "x" * 1005, "t": "y" * 1000}))
    value = json.loads(out["metadata"])
    assert len(value["s"]) == 1003 and value["s"].endswith("...") and len(value["t"]) == 1000
    assert out["truncated_string"]


def test_invalid_empty_and_oversize():
    assert guard_text("{broken")["invalid"] and guard_text("NaN")["invalid"]
    assert guard_text(None)["metadata"] == "{}" and guard_text("[1]")["metadata"] == '{"0":1}'
    assert guard_text(json.dumps({f"k{i}": "x" * 1000 for i in range(5500)}))["oversize"]
    assert not guard_text(json.dumps({f"k{i}": "x" * 1000 for i in range(250)}))["oversize"]


def test_members_keep_order_with_indexes_first():
    assert compact(parse('{"b":1,"10":2,"2":3,"a":4,"b":5}')) == '{"2":3,"10":2,"b":5,"a":4}'
    assert canonical(parse('{"b":[1.0,{"z":null,"y":true}],"a":"q"}')) == '{"a":"q","b":[1,{"y":true,"z":null}]}'


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**50), 2**50) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=20),
    lambda c: st.lists(c, max_size=4) | st.dictionaries(st.text(max_size=5), c, max_size=4),
    max_leaves=15,
)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text(max_size=5), JSON, max_size=5))
def test_guard_is_stable_and_canonical_ignores_order(value):
    once = guard_text(json.dumps(value))["metadata"]
    assert guard_text(once)["metadata"] == once
    shuffled = dict(sorted(value.items(), reverse=True))
    assert canonical(parse(json.dumps(value))) == canonical(parse(json.dumps(shuffled)))
    read = lambda text: json.loads(text, parse_int=float)
    assert read(compact(parse(json.dumps(value)))) == read(json.dumps(value))


def test_guard_column_equals_guard_text(spark):
    texts = ['{"a": 1.0}', "{bad", None, json.dumps({"s": "é" * 1200}), '{"email":"x","n":{"id":5}}']
    rules = MetadataRules(redact=("metadata.email",), reference=("metadata.n",))
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r.i: r.g.asDict() for r in frame.select("i", guard("t", rules).alias("g")).collect()}
    assert found == {i: guard_text(t, rules) for i, t in enumerate(texts)}


def test_typed_guard_equals_text_guard(spark):
    schema = (
        "i int, m struct<email:string,owner:struct<id:string,pii:string>,body:string,tags:array<string>,"
        "attrs:map<string,string>,deep:struct<a:struct<b:struct<c:struct<d:int>>>>>"
    )
    rows = [
        (1, ("e", ("o1", "p"), "x" * 1500, ["a", "b" * 1001], {"k": "v"}, (((((1,),),),),))),
        (2, (None, None, "short", [], {"k": "w" * 2000}, None)),
        (3, ("e", None, None, None, None, ((((None,),),),))),
    ]
    rules = MetadataRules(redact=("metadata.email",), reference=("metadata.owner",))
    rows[0] = (1, ("e", ("o1", "p"), "x" * 1500, ["a", "b" * 1001], {"k": "v"}, ((((1,),),),)))
    frame = spark.createDataFrame(rows, schema)
    typed = guard_struct("m", frame.schema["m"].dataType, rules)
    both = frame.select("i", typed.alias("t"), guard(F.to_json("m"), rules).alias("g")).collect()
    for r in both:
        assert json.loads(r.t.metadata) == json.loads(r.g.metadata), r.i
        assert (r.t.truncated_string, r.t.truncated_depth) == (r.g.truncated_string, r.g.truncated_depth), r.i


def test_canonical_and_selected_arguments(spark):
    frame = spark.createDataFrame([('{"b":1,"a":[2.50],"secret":"s"}',), (None,)], "t string")
    rows = frame.select(
        canonical_json("t").alias("c"), select_arguments("t", ["a", "zz", "b"]).alias("s"), select_arguments("t", []).alias("all")
    ).collect()
    assert rows[0].c == '{"a":[2.5],"b":1,"secret":"s"}' and rows[0].s == '{"a":[2.5],"b":1}'
    assert rows[0]["all"] == '{"b":1,"a":[2.5],"secret":"s"}' and rows[1].c is None


def test_arguments_that_are_no_object(spark):
    texts = ["", None, "{", "[1]", '"x"', '{"b":1,"a":"\\ud800"}', "[" * 5000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r.a for r in rows.orderBy("i").select(select_arguments("t", None).alias("a")).collect()]
    assert found == ["{}", "{}", None, None, None, '{"b":1,"a":"\\ud800"}', None]
