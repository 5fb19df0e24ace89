"""The append-only audit table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.functions.changes import millis_text, rfc3339
from tuplefeed.functions.refs import tuple_key

CHANGELOG_SCHEMA = (
    "id BIGINT, change_type STRING, change_kind STRING, object_type STRING, object_id STRING, "
    "relation STRING, user_type STRING, user_id STRING, ts TIMESTAMP, condition STRING, "
    "raw_event STRING, created_at TIMESTAMP"
)


def raw_event(events: DataFrame):
    """The whole event as JSON text; a missing condition is left out."""
    return F.to_json(
        F.struct(
            "object_type",
            "object_id",
            "relation",
            "user_type",
            "user_id",
            "change_type",
            rfc3339(F.col("ts")).alias("timestamp"),
            "condition",
            "raw_json",
            tuple_key(F.col("user_ref"), F.col("relation"), F.col("object_ref")).alias("tuple_key"),
            "operation",
        )
    )


def changelog_rows(events: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Audit rows. ``change_type`` is the operation as spelled on the wire, ``change_kind`` the
    parsed type, ``created_at`` when the row was made (default: now)."""
    return events.select(
        F.col("seq").alias("id"),
        F.col("operation").alias("change_type"),
        F.col("change_type").alias("change_kind"),
        "object_type",
        "object_id",
        "relation",
        "user_type",
        "user_id",
        "ts",
        "condition",
        raw_event(events).alias("raw_event"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )


def with_text_time(rows: DataFrame) -> DataFrame:
    """For targets that keep times as text."""
    return rows.withColumn("ts_text", millis_text(F.col("ts")))


def by_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", F.to_date("ts"))


def append_changelog(rows: DataFrame, path: str, batch_id: int | None = None, stream: str = "batch") -> None:
    """Append to the table, each append in a folder of its own and in it by date, so that time
    filters skip files.

    With a ``batch_id`` the rows replace those that the same ``stream`` wrote under it, so running a
    batch again after a failure adds nothing twice. Rows of a date are brought together first (a
    large date is split), so the number of files follows the data and not the tasks.
    """
    name = f"append-{uuid.uuid4().hex}" if batch_id is None else f"{stream}-{int(batch_id)}"
    folder = f"{path.rstrip('/')}/batch_id={name}"
    by_date(rows).hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(folder)


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    """All appends, of streams and others."""
    schema = f"{CHANGELOG_SCHEMA}, batch_id STRING, event_date DATE"
    return spark.read.schema(schema).parquet(path).drop("batch_id")


def compact_changelog(spark: SparkSession, path: str, target: str) -> None:
    """Write the whole table anew to ``target``, with few files per date. Streams leave one small
    folder per batch."""
    append_changelog(read_changelog(spark, path).drop("event_date"), target)


def audit(
    rows: DataFrame,
    since=None,
    until=None,
    time_column: str = "ts",
    **equal: str,
) -> DataFrame:
    """Rows by time range [since, until) and equal columns.

    On a table written by ``append_changelog`` the range also prunes the date folders.
    """
    dated = "event_date" in rows.columns and time_column == "ts"
    if since is not None:
        rows = rows.where(F.col(time_column) >= F.lit(since))
        if dated:
            rows = rows.where(F.col("event_date") >= F.to_date(F.lit(since)))
    if until is not None:
        rows = rows.where(F.col(time_column) < F.lit(until))
        if dated:
            rows = rows.where(F.col("event_date") <= F.to_date(F.lit(until)))
    for name, value in equal.items():
        rows = rows.where(F.col(name) == value)
    return rows
