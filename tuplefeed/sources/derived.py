"""A change feed, page files and logs derived from the ``events`` table.

The text of the feed is one SQL statement that Spark and DuckDB both run; only the names of the
text type and of the time format differ.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.operators.ordering import block_of

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
PAGE_ROWS = 100
INGEST_TS = "2024-02-01 00:00:00"  # stands in for missing times

_WIRE = """
CASE WHEN event_id % 103 = 0 THEN '{{"tuple_key":{{"user":' ELSE concat(
 '{{"operation":"', CASE WHEN event_id % 97 = 0 THEN 'NOOP'
   WHEN event_type = 'signup' THEN 'TUPLE_OPERATION_WRITE'
   WHEN event_type = 'view' THEN 'tuple_operation_write'
   WHEN event_type = 'click' THEN 'WRITE'
   WHEN event_type = 'purchase' THEN 'DELETE'
   ELSE 'TUPLE_OPERATION_DELETE' END, '"',
 CASE WHEN event_id % 89 = 0 THEN '' ELSE concat(',"timestamp":"', {time_text}, '"') END,
 ',"tuple_key":{{',
 CASE WHEN event_type = 'view' THEN concat('"condition":{{"context":', props, ',"name":"limit"}},')
   WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '"condition":{{"name":"time_based"}},'
   WHEN event_type = 'click' AND event_id % 5 = 0 THEN '"condition":{{"context":{{"k":1}}}},'
   WHEN event_type = 'click' AND event_id % 5 = 1 THEN '"condition":{{"context":{{}},"name":""}},'
   WHEN event_type = 'click' AND event_id % 5 = 2 THEN '"condition":{{"context":{{}},"name":"c"}},'
   WHEN event_type = 'click' AND event_id % 5 = 3 THEN '"condition":"oops",' ELSE '' END,
 '"object":"', CASE event_id % 4
   WHEN 0 THEN concat('document:', cast(event_id % 8 AS {text}))
   WHEN 1 THEN concat('folder:src/', cast(event_id % 6 AS {text}))
   WHEN 2 THEN concat('readme-', cast(event_id % 4 AS {text}))
   ELSE concat('table:', cast(event_id % 12 AS {text})) END,
 '","relation":"', CASE WHEN event_id % 101 = 0 THEN '' WHEN event_id % 2 = 0 THEN 'viewer'
   ELSE 'editor' END,
 '","user":"', CASE user_id % 7
   WHEN 0 THEN concat('team:', cast(user_id AS {text}), '#member')
   WHEN 1 THEN cast(user_id AS {text})
   WHEN 2 THEN concat('org:acme:', cast(user_id AS {text}))
   WHEN 3 THEN concat(':', cast(user_id AS {text}), '#m')
   WHEN 4 THEN concat(':', cast(user_id AS {text}))
   WHEN 5 THEN concat(cast(user_id AS {text}), '#m')
   ELSE concat('employee:', cast(user_id AS {text})) END,
 '"}}}}') END"""

SPARK_WIRE = _WIRE.format(
    text="STRING", time_text="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
)
DUCKDB_WIRE = _WIRE.format(text="VARCHAR", time_text="strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')")


def ingest_ts() -> Column:
    return F.lit(INGEST_TS).cast("timestamp")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def to_feed(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("seq"), F.expr(SPARK_WIRE).alias("wire"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed that ``land_feed`` has put beside the events, or else one made of them."""
    try:
        return spark.read.schema("seq BIGINT, wire STRING").parquet(f"{sf_dir}/feed.parquet")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return to_feed(raw_events(spark, sf_dir))


def land_feed(spark: SparkSession, sf_dir: str, path: str, files: int) -> None:
    """Write events and feed to a folder of their own, in so many files by position. A feed at hand
    is in many files, while the given events are one row group, which only one task can read."""
    raw_events(spark, sf_dir).repartitionByRange(files, "event_id").sortWithinPartitions("event_id").write.parquet(f"{path}/events.parquet")
    to_feed(raw_events(spark, path)).write.parquet(f"{path}/feed.parquet")


BATCHES = 3
LANDED_ROWS = 1 << 16  # of a landed file, which one task parses


def land(spark: SparkSession, sf_dir: str, path: str, batch: int) -> None:
    """Write one of ``BATCHES`` equal ranges of the feed as a part of a landing folder.

    Files are ranges of positions with so many rows, however few row groups the events are in: a
    stream's batch has no more tasks than there are row groups in the files it reads.
    """
    events = raw_events(spark, sf_dir)
    end = events.agg(F.max("event_id") + 1).scalar()
    mine = events.where(block_of(F.col("event_id") * BATCHES, end) == batch)
    files = max(1, -(-mine.count() // LANDED_ROWS))
    to_feed(mine.repartitionByRange(files, "event_id")).write.parquet(f"{path}/part={batch}")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as page bodies of ``PAGE_ROWS`` changes. A change that is no JSON stands in its
    page as a JSON string, so that the page itself can be read."""
    as_string = F.concat(F.lit('"'), F.replace("wire", F.lit('"'), F.lit('\\"')), F.lit('"'))
    rows = feed(spark, sf_dir).select(
        block_of(F.col("seq"), PAGE_ROWS).alias("page_no"),
        "seq",
        F.when(F.try_parse_json("wire").isNotNull(), F.col("wire")).otherwise(as_string).alias("item"),
    )
    last = raw_events(spark, sf_dir).agg(F.max("event_id")).scalar()
    grouped = rows.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("seq", "item"))).alias("items"),
        F.max("seq").alias("last_seq"),
    )
    token = F.when(F.col("last_seq") < last, F.col("last_seq").cast("string")).otherwise("")
    return grouped.select(
        "page_no",
        F.concat(
            F.lit('{"changes":['),
            F.array_join(F.transform("items", lambda i: i["item"]), ","),
            F.lit('],"continuation_token":"'),
            token,
            F.lit('"}'),
        ).alias("body"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetch per event."""
    return raw_events(spark, sf_dir).select(
        F.col("event_id").alias("request_no"),
        (F.col("event_type") != "error").alias("success"),
        (F.col("user_id") % 10).alias("changes"),
        F.col("value").alias("latency_ms"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event."""
    return raw_events(spark, sf_dir).select(
        F.col("event_type").alias("operation"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") / 10).alias("duration_s"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
