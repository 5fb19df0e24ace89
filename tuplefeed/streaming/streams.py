"""The sync loop as streaming queries: a feed to a changelog, a state table or requests.

The feed comes as rows of (seq, wire) or as pages of (page_no, body).

Spark keeps the cursor in the checkpoint: a batch that fails is retried from the same offsets,
and a restarted query goes on after the last finished batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tuplefeed.functions.changes import DELETE, UNKNOWN, WRITE, op_code
from tuplefeed.operators.changelog import append_changelog, changelog_rows
from tuplefeed.operators.parse import parse_feed, parse_pages
from tuplefeed.operators.quality import validate
from tuplefeed.operators.replicate import BATCH_SIZE, bodies, deliver, net_changes, requests
from tuplefeed.session import folders_removed
from tuplefeed.sources.feed import page_item_rejects, rejects
from tuplefeed.streaming.counts import TupleCounts
from tuplefeed.streaming.seen import SeenPositions
from tuplefeed.streaming.state_table import BUCKETS, MERGE_EVERY, StateTable
from tuplefeed.streaming.target import by_key

PAGE_ROWS = 1000  # at least the size of the largest page
RUN_LOG_SCHEMA = "query STRING, batch_id BIGINT, input_rows BIGINT, duration_ms BIGINT"


def _start(writer: DataStreamWriter, checkpoint: str, poll_interval: str | None) -> StreamingQuery:
    """Poll every ``poll_interval`` (such as ``5 seconds``), or read what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    if poll_interval:
        return writer.trigger(processingTime=poll_interval).start()
    return writer.trigger(availableNow=True).start()


def _stamped(feed: DataFrame, ingest_ts: Column | None) -> DataFrame:
    """Fix the time that stands in for missing ones here: in the streaming plan the current time
    is that of the batch, the same in every pass over it and in every retry."""
    return feed.withColumn("_ingest", F.current_timestamp() if ingest_ts is None else ingest_ts)


def _events(batch: DataFrame, page_rows: int) -> DataFrame:
    ingest = F.col("_ingest")
    if "body" in batch.columns:
        return parse_pages(batch, ingest, page_rows).drop("_ingest", "page_no", "pos")
    return parse_feed(batch, ingest).drop("_ingest")


def _stream_of(batch: DataFrame) -> str:
    """The id of the running query; its checkpoint keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def batch_rejects(batch: DataFrame) -> DataFrame:
    """(position, pos, text) of what parsing leaves out: whole rows, and items of pages."""
    nothing = F.lit(None).cast("bigint").alias("pos")
    if "body" not in batch.columns:
        return rejects(batch).select(F.col("seq").alias("position"), nothing, F.col("wire").alias("text"))
    position = F.col("page_no").alias("position")
    whole = rejects(batch, "body").select(position, nothing, F.col("body").alias("text"))
    return whole.unionByName(page_item_rejects(batch).select(position, "pos", F.col("item").alias("text")))


def observed(events: DataFrame, metrics: Observation) -> DataFrame:
    """The same events; what passes is counted into ``metrics`` by whatever reads them first."""
    return validate(events).observe(
        metrics,
        F.count("*").alias("processed"),
        F.count_if(F.col("validation_error").isNotNull()).alias("invalid"),
        F.count_if(op_code(F.col("operation")) == WRITE).alias("writes"),
        F.count_if(op_code(F.col("operation")) == DELETE).alias("deletes"),
        F.count_if(op_code(F.col("operation")) == UNKNOWN).alias("unknown_operations"),
        F.count_if("ts_defaulted").alias("defaulted"),
        F.max(F.unix_micros("ts")).alias("latest_us"),
    ).drop("validation_error")


def batch_report(spark: SparkSession, metrics: dict, rejected: int, seconds: float) -> DataFrame:
    """One row: what a batch held, how much of it is odd, and how far behind it is."""
    names = ("processed", "invalid", "writes", "deletes", "unknown_operations", "defaulted", "latest_us")
    row = (*(metrics[n] for n in names), rejected, float(seconds))
    made = spark.createDataFrame([row], ", ".join([*(f"{n} BIGINT" for n in names), "rejected BIGINT", "duration_s DOUBLE"]))
    behind = F.unix_micros(F.current_timestamp()) - F.col("latest_us")
    return made.select(
        "processed", "rejected", (F.col("processed") + F.col("rejected")).alias("total_fetched"), "invalid",
        "writes", "deletes", "unknown_operations", "defaulted", F.timestamp_micros("latest_us").alias("latest_ts"),
        (behind / 1e6).alias("lag_seconds"), "duration_s",
    )


REPORT_SCHEMA = (
    "batch_id BIGINT, processed BIGINT, rejected BIGINT, total_fetched BIGINT, invalid BIGINT, "
    "writes BIGINT, deletes BIGINT, unknown_operations BIGINT, defaulted BIGINT, latest_ts TIMESTAMP, lag_seconds DOUBLE, duration_s DOUBLE"
)
REJECT_SCHEMA = "batch_id BIGINT, position BIGINT, pos BIGINT, text STRING"


def read_reports(spark: SparkSession, side: str) -> DataFrame:
    """One row per batch of a stream with this ``side`` folder."""
    return spark.read.schema(REPORT_SCHEMA).parquet(f"{side.rstrip('/')}/reports")


def read_rejects(spark: SparkSession, side: str) -> DataFrame:
    """What the batches of a stream with this ``side`` folder could not parse."""
    return spark.read.schema(REJECT_SCHEMA).parquet(f"{side.rstrip('/')}/rejects")


def _new_pages(batch: DataFrame, path: str, batch_id: int) -> None:
    """An error if a page number comes twice, in this batch or since the stream began: the changes of
    the two pages would have the same positions."""
    numbers = batch.select(F.col("page_no").alias("seq")).persist()
    try:
        pages = SeenPositions(batch.sparkSession, path)
        again = numbers.groupBy("seq").count().where("count > 1").select("seq").first()
        if not again:
            fresh = pages.fresh(numbers, batch_id)
            again = numbers.exceptAll(fresh).first()
            fresh.unpersist()
    finally:
        numbers.unpersist()
    if again:
        raise ValueError(f"page number {again.seq} comes twice")


def sync(
    feed: DataFrame,
    work: Callable[[DataFrame, DataFrame, int], None],
    checkpoint: str,
    ingest_ts: Column | None = None,
    poll_interval: str | None = None,
    page_rows: int = PAGE_ROWS,
    side: str | None = None,
    seen: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Run ``work(batch, events, batch_id)`` on every batch.

    With ``seen``, a folder of ``SeenPositions``, changes whose positions came before, however long
    ago, are left out of ``events``; reports count them. Without it, a page number that comes twice is
    an error. Folders that ``work`` makes for itself in the shared folder go when it is done.

    A batch is parsed once: its events are kept for the passes of ``work``. With ``once``, ``work`` promises
    to read them in one pass, and they are not kept, which takes longer than parsing them. With ``seen``, what
    is left of them is kept, and a first pass parses for positions only. With ``side``, their numbers
    are observed while they are parsed, and each batch leaves a report of these in ``<side>/reports``
    and what could not be parsed in ``<side>/rejects``.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        spark = batch.sparkSession
        batch = batch.persist() if side else batch  # read by the parser and for the rejects
        metrics = Observation()
        events = _events(batch, page_rows)
        events = observed(events, metrics) if side else events
        given = events = events if (once or seen) and not side else events.persist()
        try:
            if "body" in batch.columns and not seen:
                _new_pages(batch, f"{checkpoint.rstrip('/')}/page_numbers", batch_id)
            if side:  # parse and keep; plans of ``work`` may leave the observing step out
                events.write.format("noop").mode("overwrite").save()
            with folders_removed(spark):
                given = SeenPositions(spark, seen).fresh(events, batch_id) if seen else events
                work(batch, given, batch_id)
            if side:
                folder, rejected = side.rstrip("/"), Observation()
                left_out = batch_rejects(batch).observe(rejected, F.count("*").alias("rejected"))
                left_out.write.mode("overwrite").parquet(f"{folder}/rejects/batch_id={batch_id}")
                report = batch_report(spark, metrics.get, rejected.get["rejected"], time.monotonic() - began)
                report.coalesce(1).write.mode("overwrite").parquet(f"{folder}/reports/batch_id={batch_id}")
        finally:
            given.unpersist()
            events.unpersist()
            batch.unpersist()

    return _start(_stamped(feed, ingest_ts).writeStream.foreachBatch(each), checkpoint, poll_interval)


def sync_changelog(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    ingest_ts: Column | None = None,
    poll_interval: str | None = None,
    page_rows: int = PAGE_ROWS,
    side: str | None = None,
    seen: str | None = None,
) -> StreamingQuery:
    """Append every change to the audit table, exactly once."""

    def append(batch: DataFrame, events: DataFrame, batch_id: int) -> None:
        append_changelog(changelog_rows(events, ingest_ts), path, batch_id, _stream_of(batch))

    return sync(feed, append, checkpoint, ingest_ts, poll_interval, page_rows, side, seen, once=True)


def sync_state(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    ingest_ts: Column | None = None,
    poll_interval: str | None = None,
    vocab: str = "union",
    buckets: int = BUCKETS,
    merge_every: int = MERGE_EVERY,
    page_rows: int = PAGE_ROWS,
    side: str | None = None,
    seen: str | None = None,
    counts: str | None = None,
) -> StreamingQuery:
    """Keep the current tuples, one table version per batch. With ``counts``, a folder of
    ``TupleCounts``, each version also has its numbers per object type."""

    def apply(batch: DataFrame, events: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, path, buckets, merge_every)
        table.apply(events, batch_id, vocab, _stream_of(batch))
        if counts:
            TupleCounts(batch.sparkSession, counts).add(table, batch_id)

    return sync(feed, apply, checkpoint, ingest_ts, poll_interval, page_rows, side, seen, once=True)


def sync_requests(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    ingest_ts: Column | None = None,
    poll_interval: str | None = None,
    batch_size: int = BATCH_SIZE,
    vocab: str = "union",
    net: bool = False,
    page_rows: int = PAGE_ROWS,
    side: str | None = None,
    send: Callable[[str], None] | None = None,
    log: str | None = None,
    tries: int = 3,
    first_pause: float = 1.0,
) -> StreamingQuery:
    """Write the requests of each batch to its own folder, ``batch_id=<n>``.

    With ``send``, a batch's requests are also delivered, and each try's report goes to ``log`` as
    ``batch_id=<n>/try=<k>``. Requests are sent at the same time, so the whole batch is first reduced to
    the last change of each key, and no order can leave the target wrong. What was delivered is not
    sent again, also after a restart. Pauses between tries double from ``first_pause`` seconds. A batch
    with requests left after ``tries`` fails, and the query stops with it. To send all changes in the
    order of each key, see ``sync_target``.
    """
    if send is not None and log is None:
        raise ValueError("send needs log, the folder of the delivery reports")

    def write(batch: DataFrame, events: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path.rstrip('/')}/batch_id={batch_id}"
        changes = events if send is None else net_changes(events, vocab)
        made = bodies(requests(changes, batch_size, vocab, net))
        made.write.mode("overwrite").parquet(folder)
        if send is not None:
            written = spark.read.schema(made.schema).parquet(folder)
            _deliver_batch(spark, written, send, f"{log.rstrip('/')}/batch_id={batch_id}", tries, first_pause)

    return sync(feed, write, checkpoint, ingest_ts, poll_interval, page_rows, side)


def sync_target(
    feed: DataFrame,
    target: str,
    options: dict[str, str],
    checkpoint: str,
    ingest_ts: Column | None = None,
    poll_interval: str | None = None,
    batch_size: int = BATCH_SIZE,
    vocab: str = "union",
    tries: int = 3,
    first_pause: float = 1.0,
    page_rows: int = PAGE_ROWS,
    side: str | None = None,
) -> StreamingQuery:
    """Send every change to a target, those of a key in the order of the feed; keys in parallel.

    ``target`` is the name of a registered ``ChangeTarget``, ``options`` are its own. A batch that
    fails is sent again as a whole, so the target must accept repeated requests; as the changes of a key
    come again in their order, it ends in the same state.
    """

    def send(batch: DataFrame, events: DataFrame, batch_id: int) -> None:
        given = {**options, "batch_id": batch_id, "batch_size": batch_size, "tries": tries, "first_pause": first_pause}
        by_key(events, vocab).write.format(target).mode("append").options(**given).save()

    return sync(feed, send, checkpoint, ingest_ts, poll_interval, page_rows, side, once=True)


def _deliver_batch(
    spark: SparkSession, made: DataFrame, send: Callable[[str], None], log: str, tries: int, first_pause: float
) -> None:
    done = _delivered(spark, log)
    first = 0 if done is None else 1 + (done.agg(F.max("try")).first()[0] or 0)
    for k in range(first, first + tries):
        if k > first:
            time.sleep(first_pause * 2 ** (k - first - 1))
        deliver(made, send, done).write.mode("overwrite").parquet(f"{log}/try={k}")
        done = _delivered(spark, log)
        left = made.join(done.where("delivered").select("chunk"), "chunk", "left_anti").count()
        if not left:
            return
    raise RuntimeError(f"{left} requests could not be delivered, see {log}")


def _delivered(spark: SparkSession, log: str) -> DataFrame | None:
    """The reports of a batch's earlier tries."""
    try:
        return spark.read.schema("chunk BIGINT, delivered BOOLEAN, error STRING, try INT").parquet(log)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def delivery_log(spark: SparkSession, log: str) -> DataFrame:
    """All reports: (batch_id, chunk, delivered, error, try)."""
    schema = "chunk BIGINT, delivered BOOLEAN, error STRING, batch_id BIGINT, try INT"
    return spark.read.schema(schema).parquet(log).select("batch_id", "chunk", "delivered", "error", "try")


def finish(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query; its error is raised here."""
    query.awaitTermination(timeout)
    return query


class RunLog(StreamingQueryListener):
    """Keeps every batch of every query, where Spark itself remembers the last few.

        spark.streams.addListener(RunLog(spark, path))
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (str(p.id), p.batchId, p.numInputRows, p.durationMs.get("triggerExecution", 0))
        made = self.spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1)
        made.write.mode("overwrite").parquet(f"{self.path}/{p.id}-{p.batchId}")

    def onQueryTerminated(self, event) -> None:
        pass


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(f"{path.rstrip('/')}/*")


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent batches of a query: (batch_id, input_rows, duration_ms). Spark keeps a fixed
    number of them."""
    rows = [
        (p["batchId"], p["numInputRows"], p["durationMs"].get("triggerExecution", 0))
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, "batch_id BIGINT, input_rows BIGINT, duration_ms BIGINT")
