"""Every operator as a query over the derived feed of a table folder."""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tuplefeed.functions import changes as C
from tuplefeed.functions import refs
from tuplefeed.operators import (
    changelog,
    clustering,
    cursor,
    dedupe,
    history,
    quality,
    replicate,
    state,
    stats,
)
from tuplefeed.operators.ordering import block_of
from tuplefeed.operators.parse import parse_changes, parse_feed, with_tuple_key
from tuplefeed.session import configure, shared_folder
from tuplefeed.sources import derived
from tuplefeed.sources import feed as source
from tuplefeed.sources import files, live, shredded
from tuplefeed.streaming import streams
from tuplefeed.streaming.counts import TupleCounts
from tuplefeed.streaming.state_table import StateTable
from tuplefeed.streaming.supervise import Supervisor, read_errors
from tuplefeed.streaming.target import ChangeTarget, read_commits

Query = Callable[[SparkSession, str], DataFrame]

NOW = "2024-02-02 00:00:00"
SINCE = "2024-01-15 00:00:00"

_QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """UTC wall-clock times instead of instants, so that other engines compare equal."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(configure(spark), sf_dir))

    _QUERIES[build.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_feed(derived.feed(spark, sf_dir), derived.ingest_ts())


def _paged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their page; positions of the derived feed have no gaps."""
    page = block_of(F.col("seq"), derived.PAGE_ROWS)
    return _events(spark, sf_dir).withColumn("page_no", page)


def _middle(spark: SparkSession, sf_dir: str) -> Column:
    """The position in the middle of the feed."""
    last = derived.raw_events(spark, sf_dir)
    return last.agg(block_of(F.max("event_id"), 2)).scalar()


def _changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.changelog_rows(_events(spark, sf_dir), derived.ingest_ts())


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.fold(_events(spark, sf_dir))


# Sources


@query
def feed_pages_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = source.decode_pages(derived.pages(spark, sf_dir), derived.PAGE_ROWS)
    return parse_changes(decoded, derived.ingest_ts()).select(
        "seq", "page_no", "pos", *state.KEY, "operation"
    )


@query
def feed_page_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.page_tokens(derived.pages(spark, sf_dir))


@query
def feed_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = _middle(spark, sf_dir).cast("string")
    return source.resume(derived.feed(spark, sf_dir), token)


@query
def feed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = _middle(spark, sf_dir).cast("string")
    return source.read_page(derived.feed(spark, sf_dir), token, derived.PAGE_ROWS)


@query
def feed_paginate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.paginate(derived.feed(spark, sf_dir), derived.PAGE_ROWS)


@query
def feed_page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.page_summary(derived.feed(spark, sf_dir), derived.PAGE_ROWS)


@query
def feed_fetch_all_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = source.fetch_all(_paged_events(spark, sf_dir), _middle(spark, sf_dir))
    return fetched.select("seq", "page_no", *state.KEY)


@query
def feed_shredded_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "shredded")
    shredded.land_shredded(derived.feed(spark, sf_dir), path)
    events = parse_changes(shredded.read_shredded(spark, path), derived.ingest_ts())
    return source.changes_since(events, _at(SINCE)).where(C.op_code(F.col("operation")) == C.WRITE).select("seq", "operation", "ts")


@query
def feed_changes_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.changes_since(_paged_events(spark, sf_dir), _at(SINCE)).select("seq", "ts")


@query
def feed_changes_since_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _paged_events(spark, sf_dir)
    return source.changes_since(events, _at("2024-01-05 00:00:00"), _middle(spark, sf_dir)).select(
        "seq", "page_no", "ts"
    )


@query
def cursor_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = source.page_tokens(derived.pages(spark, sf_dir)).where("has_more")
    return cursor.latest_cursor(
        log.select(F.col("page_no").alias("batch_id"), F.col("next_token").alias("token"))
    )


# Projections


@query
def parse_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


@query
def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.rejects(derived.feed(spark, sf_dir))


@query
def parse_user_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("seq", "user_ref", "user_type", "user_id")


@query
def parse_object_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("seq", "object_ref", "object_type", "object_id")


@query
def change_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    operation = F.col("operation")
    return _events(spark, sf_dir).select(
        "seq",
        "operation",
        "change_type",
        C.op_code(operation).alias("op"),
        C.op_code(operation, "sink").alias("sink_op"),
    )


@query
def ts_parse_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("seq", "ts", "ts_defaulted")


@query
def condition_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("seq", "condition")


@query
def condition_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_condition_parts(_events(spark, sf_dir)).select(
        "seq", "condition_name", "condition_context", "condition_error"
    )


@query
def tuple_key_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["user", "user_type", "user_id", "relation", "object", "object_type", "object_id"]
    return with_tuple_key(_events(spark, sf_dir)).select(
        "seq", *[F.col(f"tuple_key.{f}").alias(f"key_{f}") for f in fields]
    )


@query
def tuple_key_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate.rebuild_keys(_events(spark, sf_dir)).select("seq", "user", "relation", "object")


@query
def tuple_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = refs.display(*[F.col(name) for name in state.KEY])
    return _events(spark, sf_dir).select("seq", text.alias("tuple"))


@query
def page_item_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.page_item_rejects(derived.pages(spark, sf_dir))


@query
def cursor_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token before any is saved, and after those of a page and of the last but one."""
    path = shared_folder(spark, "cursor")
    first = cursor.latest_cursor(cursor.read_cursor_log(spark, path)).first()[0]
    pages = source.page_tokens(derived.pages(spark, sf_dir)).where("has_more")
    saved = pages.agg(F.min_by("next_token", "page_no"), F.max_by("next_token", "page_no")).first()
    for batch, token in enumerate(saved):
        cursor.save_cursor(spark, path, batch, token)
    latest = cursor.latest_cursor(cursor.read_cursor_log(spark, path))
    return latest.select(F.lit(first).alias("first_token"), "continuation_token")


# Changelog


@query
def changelog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changelog(spark, sf_dir)


@query
def changelog_ts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.with_text_time(_changelog(spark, sf_dir)).select("id", "ts_text")


@query
def changelog_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "changelog")
    changelog.append_changelog(_changelog(spark, sf_dir), path)
    return changelog.read_changelog(spark, path).drop("event_date")


@query
def audit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(
        _changelog(spark, sf_dir), since=_at(SINCE), until=_at("2024-01-22 00:00:00"),
        object_type="document", relation="viewer",
    )


@query
def audit_by_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_changelog(spark, sf_dir), user_type="team")


@query
def audit_by_change_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_changelog(spark, sf_dir), change_type="DELETE")


@query
def audit_by_object_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_changelog(spark, sf_dir), object_type="folder")


@query
def audit_by_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_changelog(spark, sf_dir), relation="editor")


@query
def audit_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "clustered")
    clustering.write_clustered(_changelog(spark, sf_dir), path)
    table = clustering.read_clustered(spark, path)
    return changelog.audit(table, since=_at(SINCE), object_type="document", relation="viewer", user_type="user").drop("event_date")


@query
def state_by_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_state(spark, sf_dir), user_type="org")


@query
def state_by_object_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_state(spark, sf_dir), object_type="table")


@query
def state_by_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_state(spark, sf_dir), relation="viewer")


@query
def state_updated_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.audit(_state(spark, sf_dir), since=_at(SINCE), time_column="updated_at")


# Quality


@query
def validate_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(_events(spark, sf_dir)).select("seq", "validation_error")


@query
def validate_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(_events(spark, sf_dir), strict=True).select("seq", *state.KEY)


@query
def unknown_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unknown_operations(_events(spark, sf_dir)).select("seq", "operation")


@query
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.constraint_violations(_changelog(spark, sf_dir)).select(
        "id", "change_type", "violations"
    )


# State


@query
def state_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir)


@query
def state_sink_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.fold(_events(spark, sf_dir), vocab="sink")


@query
def state_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, middle = _events(spark, sf_dir), _middle(spark, sf_dir)
    before = state.fold(events.where(F.col("seq") <= middle))
    return state.apply_changes(before, events.where(F.col("seq") > middle))


@query
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.state_as_of(_events(spark, sf_dir), _middle(spark, sf_dir))


@query
def state_current_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with gaps of 2**31 between them."""
    events = _events(spark, sf_dir).withColumn("seq", F.col("seq") * (1 << 31))
    return state.fold(events, segment_rows=1 << 10, by_rows=True)


@query
def state_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history(_events(spark, sf_dir), segment_rows=1 << 10)


@query
def state_at_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after each 977th change."""
    # The history reads its changes twice: they are parsed once. Times are made plain before rows are repeated.
    path = shared_folder(spark, "changes")
    _events(spark, sf_dir).select(*state.KEY, "seq", "ts", "condition", "operation").write.parquet(path)
    points = derived.raw_events(spark, sf_dir).where(F.col("event_id") % 977 == 976).select(F.col("event_id").alias("position"))
    return history.valid_at_many(_plain(history.history(spark.read.parquet(path))), points)


@query
def conditional_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.conditional_tuples(_state(spark, sf_dir))


@query
def tuple_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.lookup(
        _state(spark, sf_dir), object_type="document", object_id="0", relation="viewer"
    )


@query
def tuple_lookup_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up every key the feed ever names."""
    events = _events(spark, sf_dir)
    return state.lookup_many(state.fold(events), events).select(*state.KEY, "found", "condition")


@query
def apply_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.apply_counts(_paged_events(spark, sf_dir), ["page_no"])


@query
def apply_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the feed on the state of the first."""
    events, middle = _events(spark, sf_dir), _middle(spark, sf_dir)
    before = state.fold(events.where(F.col("seq") <= middle))
    return state.row_effects(before, events.where(F.col("seq") > middle))


@query
def dedupe_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed delivered twice, as after a crash before the token is saved."""
    events = _events(spark, sf_dir)
    return dedupe.drop_repeats(events.unionByName(events)).select("seq", *state.KEY, "operation")


# Replication


@query
def replicate_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate.chunk(_events(spark, sf_dir)).select(
        "seq", "position", "chunk", "op", "user", "relation", "object"
    )


@query
def replicate_chunks_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with gaps of 2**31 between them."""
    events = _events(spark, sf_dir).withColumn("seq", F.col("seq") * (1 << 31))
    return replicate.chunk(events).select(
        "seq", "position", "chunk", "op", "user", "relation", "object"
    )


@query
def replicate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate.bodies(replicate.requests(_events(spark, sf_dir)))


@query
def replicate_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = replicate.requests(_events(spark, sf_dir), batch_size=1000, net=True)
    return replicate.bodies(made)


@query
def replicate_net_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate.net_changes(_events(spark, sf_dir))


@query
def replicate_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = replicate.select_changes(_events(spark, sf_dir), ["document", "table"], ["viewer", "editor"])
    return replicate.bodies(replicate.requests(chosen))


# Statistics


@query
def stats_changelog_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.changelog_entries(_changelog(spark, sf_dir))


@query
def stats_by_change_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_change_type(_changelog(spark, sf_dir))


@query
def stats_current_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.current_tuples(_state(spark, sf_dir))


@query
def stats_by_object_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_object_type(_state(spark, sf_dir))


@query
def lag_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.lag(_events(spark, sf_dir), _at(NOW), include_defaulted=False)


@query
def lag_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.lag(_paged_events(spark, sf_dir), _at(NOW), by=["page_no"])


@query
def fetch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.fetch_stats(derived.fetch_log(spark, sf_dir))


@query
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = source.page_summary(derived.feed(spark, sf_dir), derived.PAGE_ROWS)
    return stats.batch_summary(_paged_events(spark, sf_dir), pages, _at(NOW))


@query
def run_op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.operation_counts(derived.run_log(spark, sf_dir))


@query
def run_duration_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.duration_histogram(derived.run_log(spark, sf_dir))


@query
def run_duration_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.duration_totals(derived.run_log(spark, sf_dir))


@query
def run_last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sync_metrics(derived.run_log(spark, sf_dir))


# Streams: the feed lands in three parts, and the stream is started anew for each


def _in_batches(spark: SparkSession, sf_dir: str, start, run=lambda start: streams.finish(start())) -> None:
    """Run ``start(feed, checkpoint)`` to its end after each part that lands."""
    landed, checkpoint = shared_folder(spark, "landed"), shared_folder(spark, "checkpoint")
    for batch in range(derived.BATCHES):
        derived.land(spark, sf_dir, landed, batch)
        run(lambda: start(source.stream_feed(spark, f"{landed}/*"), checkpoint))


def _supervised(spark: SparkSession, sf_dir: str, path: str, errors: str) -> None:
    """The changelog by a sink that fails twice in the second batch, after it has written."""
    failures = iter(range(2))

    def append(batch: DataFrame, events: DataFrame, batch_id: int) -> None:
        rows = changelog.changelog_rows(events, derived.ingest_ts())
        changelog.append_changelog(rows, path, batch_id, "supervised")
        if batch_id == 1 and next(failures, None) is not None:
            raise OSError("the sink broke down")

    def run(start) -> None:
        Supervisor(spark, start, errors, "changelog", first_pause=0.1, most_in_a_row=5).run()

    _in_batches(spark, sf_dir, lambda feed, c: streams.sync(feed, append, c, derived.ingest_ts(), once=True), run)


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "changelog")
    _supervised(spark, sf_dir, path, shared_folder(spark, "errors"))
    return changelog.read_changelog(spark, path).drop("event_date")


@query
def stream_restart_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = shared_folder(spark, "errors")
    _supervised(spark, sf_dir, shared_folder(spark, "changelog"), errors)
    sink = F.contains("error", F.lit("the sink broke down")).alias("of_sink")
    return read_errors(spark, errors).select("stream", "failure", "in_a_row", "pause_s", sink)


@query
def feed_live_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed out of saved pages, which tasks fetch by token."""
    saved, out = shared_folder(spark, "pages"), shared_folder(spark, "live")
    pages = derived.pages(spark, sf_dir)
    live.save_pages(pages, source.page_tokens(pages), saved)
    spark.dataSource.register(live.SavedChangeApi)
    feed = spark.readStream.format("saved_change_api").option("path", saved).option("pages_per_task", "4").load()
    events = parse_feed(feed, derived.ingest_ts()).select("seq", *state.KEY, "operation", "ts")
    writer = events.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_folder(spark, "checkpoint"))
    streams.finish(writer.trigger(availableNow=True).start())
    return spark.read.schema(events.schema).parquet(out)


@query
def stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "changelog")
    _in_batches(spark, sf_dir, lambda feed, c: streams.sync_changelog(feed, path, c, derived.ingest_ts()))
    return changelog.read_changelog(spark, path).drop("event_date")


@query
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "state")
    _in_batches(
        spark, sf_dir,
        lambda feed, c: streams.sync_state(feed, path, c, derived.ingest_ts(), buckets=16, merge_every=2),
    )
    return StateTable(spark, path, 16).read()


@query
def state_table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of one part of the feed in the stored state."""
    path = shared_folder(spark, "state")
    _in_batches(
        spark, sf_dir,
        lambda feed, c: streams.sync_state(feed, path, c, derived.ingest_ts(), buckets=16, merge_every=2),
    )
    keys = _events(spark, sf_dir).where((F.col("object_type") == "folder") & (F.col("relation") == "viewer"))
    return StateTable(spark, path, 16).with_keys(keys)


@query
def stream_stats_by_object_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuples per object type after each batch, kept by differences."""
    path, counts = shared_folder(spark, "state"), shared_folder(spark, "counts")
    _in_batches(
        spark, sf_dir,
        lambda feed, c: streams.sync_state(feed, path, c, derived.ingest_ts(), buckets=16, merge_every=2, counts=counts),
    )
    return TupleCounts(spark, counts).read_all().select("version", "object_type", "tuples").where("tuples > 0")


@query
def dedupe_stream_any_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in parts, then all parts again."""
    path, seen, checkpoint = shared_folder(spark, "changelog"), shared_folder(spark, "seen"), shared_folder(spark, "checkpoint")
    landed = [shared_folder(spark, "landed") for _ in range(2)]
    for folder in landed:
        for batch in range(derived.BATCHES):
            derived.land(spark, sf_dir, folder, batch)
            feed = source.stream_feed(spark, f"{folder.rsplit('/', 1)[0]}/{{{','.join(f.rsplit('/', 1)[1] for f in landed)}}}/*")
            streams.finish(streams.sync_changelog(feed, path, checkpoint, derived.ingest_ts(), seen=seen))
    return changelog.read_changelog(spark, path).drop("event_date")


@query
def stream_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "requests")
    _in_batches(spark, sf_dir, lambda feed, c: streams.sync_requests(feed, path, c, derived.ingest_ts()))
    made = spark.read.schema("batch_id BIGINT, chunk BIGINT, n_writes BIGINT, n_deletes BIGINT, body STRING")
    return made.parquet(path).select("batch_id", "chunk", "n_writes", "n_deletes", "body")


def _accept(body: str) -> None:
    """A target that takes every request."""


@query
def stream_delivery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, log = shared_folder(spark, "requests"), shared_folder(spark, "delivery")
    _in_batches(
        spark, sf_dir,
        lambda feed, c: streams.sync_requests(feed, path, c, derived.ingest_ts(), send=_accept, log=log),
    )
    return streams.delivery_log(spark, log)


class _RequestFile:
    """The requests of a task as lines of one file, with their places; it is there once closed."""

    def __init__(self, options: dict[str, str]):
        self.batch_id, self.folder = int(options["batch_id"]), files.open_folder(options["path"])
        self.name, self.places = f"{self.batch_id}-{uuid.uuid4().hex}.json", itertools.count()
        self.file = None

    def __call__(self, body: str) -> None:
        self.file = self.file or self.folder.begin(self.name)
        request = {"batch_id": self.batch_id, "at": next(self.places), "body": body}
        self.file.write(f"{json.dumps(request)}\n".encode())

    def close(self) -> None:
        if self.file:
            self.file.close()
            self.folder.show(self.name)


class _FolderTarget(ChangeTarget):
    """A target that keeps the requests of each task in a file."""

    connect = staticmethod(_RequestFile)

    @classmethod
    def name(cls) -> str:
        return "folder_target"


def _sent(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    target, log = shared_folder(spark, "target"), shared_folder(spark, "commits")
    spark.dataSource.register(_FolderTarget)
    options = {"path": target, "log": log}
    _in_batches(
        spark, sf_dir, lambda feed, c: streams.sync_target(feed, "folder_target", options, c, derived.ingest_ts(), batch_size=1000)
    )
    return target, log


@query
def stream_delivery_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a target holds that applied all requests in the order they came in."""
    target, _ = _sent(spark, sf_dir)
    entry = "STRUCT<user: STRING, relation: STRING, object: STRING, condition: STRUCT<name: STRING, context: VARIANT>>"
    body = F.from_json("body", f"STRUCT<writes: ARRAY<{entry}>, deletes: ARRAY<{entry}>>")
    requests = spark.read.schema("batch_id BIGINT, at BIGINT, body STRING").json(target).select("batch_id", "at", body.alias("body"))
    came = F.struct("batch_id", "at").alias("came")
    changes = [
        requests.select(came, F.lit(name == "writes").alias("write"), F.inline(f"body.{name}")) for name in ("writes", "deletes")
    ]
    last = F.max_by(F.struct("write", "condition"), "came").alias("last")
    held = changes[0].unionByName(changes[1]).groupBy("user", "relation", "object").agg(last).where("last.write")
    name, context = F.col("last.condition.name"), F.to_json(F.col("last.condition.context"))
    return held.select("user", "relation", "object", name.alias("condition_name"), context.alias("condition_context"))


@query
def stream_delivery_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, log = _sent(spark, sf_dir)
    return read_commits(spark, log).select("batch_id", "changes", (F.col("requests") == F.col("tries")).alias("at_once"))


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, side = shared_folder(spark, "changelog"), shared_folder(spark, "side")
    _in_batches(
        spark, sf_dir, lambda feed, c: streams.sync_changelog(feed, path, c, derived.ingest_ts(), side=side)
    )
    return streams.read_rejects(spark, side)


@query
def stream_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, side = shared_folder(spark, "state"), shared_folder(spark, "side")
    _in_batches(
        spark, sf_dir, lambda feed, c: streams.sync_state(feed, path, c, derived.ingest_ts(), buckets=4, side=side)
    )
    return streams.read_reports(spark, side).drop("lag_seconds", "duration_s")  # differ from run to run


@query
def dedupe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in parts, then all of it again."""
    out = shared_folder(spark, "deduplicated")

    def start(feed: DataFrame, checkpoint: str):
        twice = feed.select("seq", F.explode(F.array(F.lit(0), F.lit(1))), "wire").drop("col")
        events = dedupe.drop_repeats_within(parse_feed(twice, derived.ingest_ts()), "1 hour")
        writer = events.select("seq", *state.KEY, "operation").writeStream.format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _in_batches(spark, sf_dir, start)
    return spark.read.parquet(out)
