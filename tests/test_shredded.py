import json
import re

from pyspark.sql import functions as F

from helpers import feed_of, plan, wire
from tuplefeed.operators.parse import parse_changes, parse_feed
from tuplefeed.sources import shredded

# One change per line; later ones have members of other types, none or more than the others.
WIRES = [wire("WRITE", f"user:u{i}", "viewer", f"doc:{i}", ts=f"2024-01-{1 + i % 28:02}T00:00:00Z") for i in range(200)] + [
    json.dumps(change)
    for change in [
        {},
        {"operation": 7, "timestamp": 12, "tuple_key": "none"},
        {"operation": None, "timestamp": None, "tuple_key": None},
        {"operation": "DELETE", "tuple_key": {"user": ["a"], "object": {"b": 1}, "relation": 2.5}, "more": {"x": [1, None]}},
        {"operation": "WRITE", "timestamp": "2024-01-09T00:00:00+02:00", "tuple_key": {"user": "é:ß#x", "condition": {"name": "c", "context": {}}}},
    ]
] + ["", "[1]", '{"operation":', '{"a":1} {"b":2}', "x" * 100_000, json.dumps({"operation": "WRITE", "pad": "y" * 300_000})]


def test_reads_back_what_the_text_gives(spark, tmp_path):
    feed, path, now = feed_of(spark, WIRES), str(tmp_path / "feed"), F.lit("2024-02-01").cast("timestamp")
    shredded.land_shredded(feed, path)
    found = parse_changes(shredded.read_shredded(spark, path), now).orderBy("seq").collect()
    assert found == parse_feed(feed, now).orderBy("seq").collect()
    assert len(found) == 206


def test_filters_read_their_members_only(spark, tmp_path):
    path = str(tmp_path / "feed")
    shredded.land_shredded(feed_of(spark, WIRES), path)
    events = parse_changes(shredded.read_shredded(spark, path))
    late = events.where((F.col("ts") >= "2024-01-20") & (F.col("operation") == "WRITE")).select("seq")
    physical = plan(late).split("== Physical Plan ==")[1]
    assert "parse_json" not in physical
    members = re.search(r"ReadSchema: struct<seq:bigint,change:struct<(.*?)>>", physical)[1]
    assert members.count(":") == 2 and "variant" not in members
    assert late.where("seq < 200").count() == sum(i % 28 >= 19 for i in range(200))


def test_settings_of_the_session_stay(spark, tmp_path):
    key = "spark.sql.variant.inferShreddingSchema"
    spark.conf.set(key, "false")
    try:
        shredded.land_shredded(feed_of(spark, WIRES[:3]), str(tmp_path / "feed"))
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)


def test_an_empty_feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    shredded.land_shredded(feed_of(spark, WIRES[:1]).where("false"), path)
    assert parse_changes(shredded.read_shredded(spark, path)).count() == 0
