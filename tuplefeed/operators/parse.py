"""Decoded changes to flat events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuplefeed.functions import changes as C
from tuplefeed.functions import refs
from tuplefeed.sources.feed import decode, decode_pages


def parse_changes(decoded: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Flat events from a VARIANT column ``change``; all other columns stay in front.

    ``ingest_ts`` stands in for a missing or malformed time, by default the current time.
    """
    if ingest_ts is None:
        ingest_ts = F.current_timestamp()
    change = F.col("change")
    keep = [c for c in decoded.columns if c != "change"]
    fields = decoded.select(
        *keep,
        C.text_at(change, "$.operation").alias("operation"),
        C.text_at(change, "$.tuple_key.user").alias("user_ref"),
        C.text_at(change, "$.tuple_key.relation").alias("relation"),
        C.text_at(change, "$.tuple_key.object").alias("object_ref"),
        F.try_variant_get(change, "$.timestamp", "string").alias("time_text"),
        C.json_at(change, "$.tuple_key.condition").alias("condition_json"),
        F.to_json(change).alias("raw_json"),
    ).withColumn("event_ts", C.parse_time(F.col("time_text")))
    user_type, user_id = refs.split_user_ref(F.col("user_ref"))
    object_type, object_id = refs.split_object_ref(F.col("object_ref"))
    return fields.select(
        *keep,
        object_type.alias("object_type"),
        object_id.alias("object_id"),
        "relation",
        user_type.alias("user_type"),
        user_id.alias("user_id"),
        C.change_type(F.col("operation")).alias("change_type"),
        F.coalesce("event_ts", ingest_ts).alias("ts"),
        F.col("event_ts").isNull().alias("ts_defaulted"),
        C.only_object(F.col("condition_json")).alias("condition"),
        "raw_json",
        "user_ref",
        "object_ref",
        "operation",
    )


def parse_pages(
    pages: DataFrame, ingest_ts: Column | None = None, page_rows: int = 1000
) -> DataFrame:
    """Events of pages of (page_no, body), with the position made of page and place in it."""
    return parse_changes(decode_pages(pages, page_rows), ingest_ts)


def parse_feed(feed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Events of a feed of (seq, wire); rows that are no JSON object are left out."""
    return parse_changes(decode(feed), ingest_ts)


def with_tuple_key(events: DataFrame) -> DataFrame:
    """Add the nested key of references and parts."""
    key = refs.tuple_key(F.col("user_ref"), F.col("relation"), F.col("object_ref"))
    return events.withColumn("tuple_key", key)
