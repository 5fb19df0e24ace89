import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import feed_of, plan, wire
from tuplefeed.operators import changelog, cursor, quality
from tuplefeed.operators.parse import parse_feed
from tuplefeed.sources import databases

def made(n):
    """``n`` changes, one per day; every third deletes, every fourth has a condition."""
    return [
        wire(
            "DELETE" if i % 3 == 2 else "WRITE", f"{'crew' if i == 3 else 'robot'}:b{i}", "reads" if i % 2 == 0 else "edits",
            f"{'shelf' if i == 3 else 'box'}:{i // 3}", ts=f"2024-03-{i + 1:02}T00:00:{i:02}.50Z",
            condition={"name": "gate"} if i == 3 else None,
        )
        for i in range(n)
    ]


def rows_of(spark, wires=None):
    return changelog.changelog_rows(parse_feed(feed_of(spark, wires or made(4))))


def test_rows(spark):
    rows = rows_of(spark).orderBy("id").collect()
    assert [r.change_type for r in rows] == ["WRITE", "WRITE", "DELETE", "WRITE"]
    assert [r.change_kind for r in rows] == ["tuple_write", "tuple_write", "tuple_delete", "tuple_write"]
    assert [r.condition for r in rows] == [None, None, None, '{"name":"gate"}']
    assert len({r.created_at for r in rows}) == 1
    event = json.loads(rows[1].raw_event)
    assert event["timestamp"] == "2024-03-02T00:00:01.5Z"
    assert event["tuple_key"]["user"] == "robot:b1" and event["tuple_key"]["object_id"] == "0"
    assert "condition" not in event and json.loads(event["raw_json"])["operation"] == "WRITE"
    assert json.loads(rows[3].raw_event)["condition"] == '{"name":"gate"}'


def test_table_prunes_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "log")
    changelog.append_changelog(rows_of(spark), path)
    table = changelog.read_changelog(spark, path)
    found = changelog.audit(
        table, since=datetime(2024, 3, 2), until=datetime(2024, 3, 4), object_type="box", relation="reads"
    ).select("id")
    assert [r.id for r in found.collect()] == [2]
    physical = plan(found).split("== Physical Plan ==")[1]
    assert "EqualTo(object_type,box)" in physical and "EqualTo(relation,reads)" in physical
    assert "PartitionFilters: [isnotnull(event_date" in physical
    assert "raw_event" not in physical.split("ReadSchema")[1]
    assert changelog.audit(table, change_type="DELETE").count() == 1
    assert changelog.audit(table, user_type="crew").count() == 1


def test_streams_and_appends_share_a_table(spark, tmp_path):
    path, target = str(tmp_path / "log"), str(tmp_path / "compact")
    changelog.append_changelog(rows_of(spark), path, 0, "one")
    changelog.append_changelog(rows_of(spark), path, 0, "two")
    changelog.append_changelog(rows_of(spark), path)
    assert changelog.read_changelog(spark, path).count() == 12
    changelog.compact_changelog(spark, path, target)
    assert sorted(changelog.read_changelog(spark, target).collect()) == sorted(changelog.read_changelog(spark, path).collect())


def test_files_follow_dates_not_tasks(spark, tmp_path):
    path = tmp_path / "log"
    changelog.append_changelog(rows_of(spark, made(20) * 50).repartition(8), str(path))
    assert len(list(path.rglob("part-*.parquet"))) == 20


def test_batch_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch in (0, 1, 1):
        changelog.append_changelog(rows_of(spark).withColumn("id", F.col("id") + 10 * batch), path, batch)
    assert changelog.read_changelog(spark, path).count() == 8


def test_append_adds(spark, tmp_path):
    path = str(tmp_path / "log")
    changelog.append_changelog(rows_of(spark), path)
    changelog.append_changelog(rows_of(spark), path)
    assert changelog.read_changelog(spark, path).count() == 8
    changelog.append_changelog(rows_of(spark).where("false"), path)
    assert changelog.read_changelog(spark, path).count() == 8


def test_cursor(spark, tmp_path):
    path = str(tmp_path / "cursor")
    empty = spark.createDataFrame([], cursor.CURSOR_SCHEMA)
    assert cursor.latest_cursor(empty).first()[0] == ""
    assert cursor.latest_cursor(cursor.read_cursor_log(spark, path)).first()[0] == ""
    for batch, token in [(0, "a"), (1, "c"), (2, "b")]:
        cursor.save_cursor(spark, path, batch, token)
    assert cursor.latest_cursor(cursor.read_cursor_log(spark, path)).first()[0] == "b"


@pytest.mark.parametrize(
    "change, missing",
    [
        ({}, []),
        ({"object_type": ""}, ["object_type"]),
        ({"user_type": "", "user_id": None}, ["user_type", "user_id"]),
        ({"ts": None}, ["timestamp"]),
        ({"change_type": "", "object_id": "", "relation": ""}, ["object_id", "relation", "change_type"]),
    ],
)
def test_validation(spark, change, missing):
    good = {
        "object_type": "doc", "object_id": "1", "relation": "r", "user_type": "user", "user_id": "u",
        "change_type": "tuple_write", "ts": datetime(2024, 1, 1),
    }
    row = {**good, **change}
    schema = ", ".join(f"{k} {'TIMESTAMP' if k == 'ts' else 'STRING'}" for k in row)
    df = spark.createDataFrame([tuple(row.values())], schema)
    error = quality.validate(df).first().validation_error
    want = "change event validation failed: " + ", ".join(f"{m} is required" for m in missing)
    assert error == (want if missing else None)
    assert quality.validate(df, strict=True).count() == (0 if missing else 1)


def test_constraints(spark):
    wires = [
        wire("TUPLE_OPERATION_WRITE", "user:" + "u" * 256, "r" * 101, "doc:1"),
        wire("WRITE", "user:u", "r", "doc:1"),
    ]
    [row] = quality.constraint_violations(rows_of(spark, wires)).collect()
    assert row.violations == "change_type exceeds 20, relation exceeds 100, user_id exceeds 255"
    nulls = rows_of(spark, wires[1:]).withColumn("relation", F.lit(None).cast("string"))
    assert quality.constraint_violations(nulls).first().violations == "relation is null"


def test_missing_database_driver_is_reported(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        databases.read_table(spark, "jdbc:none://host/db", "changelog", (0, 10))
