import json
from datetime import datetime

from pyspark.sql import functions as F

from helpers import feed_of, plan, wire
from tuplefeed.functions import changes as C
from tuplefeed.operators.parse import parse_feed, with_tuple_key
from tuplefeed.sources.feed import rejects

INGEST = datetime(2030, 1, 1)


def parsed(spark, wires):
    return parse_feed(feed_of(spark, wires), F.lit(INGEST)).orderBy("seq").collect()


def test_full_event(spark):
    condition = {"name": "ip", "context": {"cidr": ["10.0.0.0/8"], "n": 1}}
    [row] = parsed(
        spark, [wire("WRITE", "employee:bob", "editor", "folder:src", condition=condition, metadata={"a": 1})]
    )
    assert (row.object_type, row.object_id, row.relation) == ("folder", "src", "editor")
    assert (row.user_type, row.user_id) == ("employee", "bob")
    assert (row.change_type, row.operation) == ("tuple_write", "WRITE")
    assert (row.ts, row.ts_defaulted) == (datetime(2024, 1, 1), False)
    assert json.loads(row.condition) == condition
    assert json.loads(row.raw_json)["metadata"] == {"a": 1}
    assert (row.user_ref, row.object_ref) == ("employee:bob", "folder:src")


def test_times(spark):
    cases = {
        "2024-06-15T10:00:00Z": datetime(2024, 6, 15, 10),
        "2024-06-15T10:00:00.123456789Z": datetime(2024, 6, 15, 10, 0, 0, 123456),
        "2024-06-15T12:00:00+02:00": datetime(2024, 6, 15, 10),
        "2024-06-15": None,
        "2024-06-15 10:00:00": None,
        "2024-13-15T10:00:00Z": None,
        "0001-01-01T00:00:00Z": None,
        "soon": None,
    }
    rows = parsed(spark, [wire("WRITE", "u:1", "r", "o:1", ts=t) for t in cases] + [wire("WRITE", "u:1", "r", "o:1", ts=None)])
    expected = list(cases.values()) + [None]
    for row, want in zip(rows, expected, strict=True):
        assert (row.ts, row.ts_defaulted) == ((want, False) if want else (INGEST, True))


def test_conditions_only_as_objects(spark):
    values = [{}, {"name": "a"}, "oops", '{"name":"text"}', 5, [1], True]
    rows = parsed(spark, [wire("WRITE", "u:1", "r", "o:1", condition=v) for v in values])
    assert [r.condition for r in rows] == ["{}", '{"name":"a"}', None, None, None, None, None]


def test_missing_members(spark):
    rows = parsed(spark, ["{}", '{"tuple_key":"x"}', '{"operation":null,"tuple_key":{"user":null}}'])
    for row in rows:
        assert (row.operation, row.user_type, row.user_id, row.object_type, row.object_id) == (
            "", "user", "", "object", "",
        )


def test_malformed_rows_are_left_out_and_kept_apart(spark):
    good = [wire("WRITE", "u:1", "r", "o:1"), " \n" + wire("DELETE", "u:1", "r", "o:1")]
    bad = ['{"tuple_key":{"user":', "", "[1]", '"text"', "7", "null", "{} {}"]
    feed = feed_of(spark, good + bad)
    assert [r.seq for r in parsed(spark, good + bad)] == [0, 1]
    assert sorted(r.wire for r in rejects(feed).collect()) == sorted(bad)


def test_null_text_is_rejected(spark):
    feed = spark.createDataFrame([(1, None)], "seq BIGINT, wire STRING")
    assert parse_feed(feed).count() == 0
    assert rejects(feed).count() == 1


def test_last_of_two_equal_members_counts(spark):
    [row] = parsed(spark, ['{"operation":"WRITE","operation":"DELETE","tuple_key":{}}'])
    assert row.operation == "DELETE"


def test_tuple_key(spark):
    df = with_tuple_key(parse_feed(feed_of(spark, [wire("WRITE", "bob", "r", "f:1")])))
    key = df.first().tuple_key
    assert (key.user, key.user_type, key.object_type, key.object_id) == ("bob", "user", "f", "1")


def test_condition_parts(spark):
    missing = "condition name is required and must be a string"
    names = {None: None, '""': None, "7": None, "null": None, "[]": None, '"gate"': "gate", '"a\\"b"': 'a"b'}
    contexts = {None: None, "{}": None, '"text"': None, "null": None, '{"x":[1,{"y":2}]}': '{"x":[1,{"y":2}]}'}
    cases = [("", None, None, None), (None, None, None, None), ("{", None, None, "invalid condition JSON"), ("3", None, None, missing)]
    for name, read in names.items():
        for context, kept in contexts.items():
            members = [f'"{k}":{v}' for k, v in (("context", context), ("name", name)) if v is not None]
            text = "{" + ",".join(members) + "}"
            cases.append((text, read, kept, None) if read else (text, None, None, missing))
    df = spark.createDataFrame(cases, "condition STRING, n STRING, c STRING, e STRING")
    for row in C.with_condition_parts(df).collect():
        got = (row.condition_name, row.condition_context, row.condition_error)
        assert got == (row.n, row.c, row.e), row.condition


def test_text_times(spark):
    rows = [(datetime(2024, 1, 1, 10, 0, 0, 999999),), (datetime(2024, 1, 1, 10, 0, 0),), (datetime(2024, 1, 1, 10, 0, 0, 120000),)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP").orderBy("ts")
    got = df.select(C.millis_text(F.col("ts")), C.rfc3339(F.col("ts"))).collect()
    assert [tuple(r) for r in got] == [
        ("2024-01-01 10:00:00.000", "2024-01-01T10:00:00Z"),
        ("2024-01-01 10:00:00.120", "2024-01-01T10:00:00.12Z"),
        ("2024-01-01 10:00:00.999", "2024-01-01T10:00:00.999999Z"),
    ]


def test_text_is_parsed_once(spark):
    events = parse_feed(feed_of(spark, ["{}"])).where("operation = 'WRITE' AND user_type = 'user'")
    physical = plan(events).split("== Physical Plan ==")[1]
    assert physical.count("parseJson") == 1
    assert "Python" not in physical
