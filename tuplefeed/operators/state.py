"""Folding a feed to the current set of tuples.

State follows feed order (``seq``), never event time. Per key: a write sets the condition and
the update time, a delete removes the tuple, and a write after a delete starts a new tuple.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuplefeed.functions.changes import DELETE, UNKNOWN, WRITE, op_code
from tuplefeed.operators.ordering import block_of, dense_position

KEY = ["object_type", "object_id", "relation", "user_type", "user_id"]
# The same columns, those that differ most first: sorting by them compares less.
_GROUP = ["user_id", "object_id", "relation", "object_type", "user_type"]
STATE_SCHEMA = (
    "object_type STRING, object_id STRING, relation STRING, user_type STRING, user_id STRING, "
    "condition STRING, created_at TIMESTAMP, updated_at TIMESTAMP, last_seq BIGINT"
)
SUMMARY_SCHEMA = (
    "object_type STRING, object_id STRING, relation STRING, user_type STRING, user_id STRING, "
    "last_delete BIGINT, first_seq BIGINT, first_ts TIMESTAMP, last_seq BIGINT, last_ts TIMESTAMP, "
    "condition STRING, from_seq BIGINT, to_seq BIGINT"
)

# Feed positions per segment: the most changes of one key that meet in one group.
FOLD_SEGMENT_ROWS = 1 << 18


def _live(seq: Column, last_delete: Column) -> Column:
    return last_delete.isNull() | (seq > last_delete)


def segmented(events: DataFrame, columns: list, segment_rows: int, by_rows: bool) -> DataFrame:
    """The known changes with ``segment``, a number that ascends with the feed.

    By default a segment is a range of ``segment_rows`` positions, which costs nothing and is right
    for positions with few gaps. ``by_rows`` counts rows instead, whatever the gaps: rows are dealt
    into ranges and written once more.
    """
    rows = events.select(*KEY, "seq", *columns).where(F.col("op") != UNKNOWN)
    if not by_rows:
        return rows.withColumn("segment", block_of(F.col("seq"), segment_rows))
    placed = dense_position(rows, "seq", "place")
    return placed.withColumn("segment", block_of(F.col("place"), segment_rows)).drop("place")


def summarize(
    events: DataFrame, vocab: str = "union", segment_rows: int = FOLD_SEGMENT_ROWS, by_rows: bool = False
) -> DataFrame:
    """Net effect of a run of changes: one row per key, as in ``SUMMARY_SCHEMA``.

    first_* and last_*, condition describe the writes after the last delete and are NULL if there
    are none; from_seq and to_seq are the positions of the key's first and last change.

    Two steps keep a hot key out of one task. First each key is reduced within segments of the
    feed, whose length bounds the group; a map task holds few segments, so most of a hot key
    is combined before the shuffle. Then the segments of each key are put together. On positions
    with large gaps, ``by_rows`` makes segments of so many rows.
    """
    op = op_code(F.col("operation"), vocab)
    rows = segmented(events, ["ts", "condition", op.alias("op")], segment_rows, by_rows).select(
        *KEY,
        "seq",
        "segment",
        F.when(F.col("op") == DELETE, F.col("seq")).alias("delete"),
        F.when(F.col("op") == WRITE, F.struct("seq", "ts")).alias("write"),
        F.when(F.col("op") == WRITE, F.struct("seq", "ts", "condition")).alias("last"),
    )
    segments = rows.groupBy(*_GROUP, "segment").agg(
        F.max("delete").alias("last_delete"),
        F.collect_list("write").alias("writes"),
        F.max_by("last", F.col("last.seq")).alias("last"),
        F.min("seq").alias("from_seq"),
        F.max("seq").alias("to_seq"),
    )
    first = F.array_min(F.filter("writes", lambda w: _live(w["seq"], F.col("last_delete"))))
    return merge_summaries(_flat(segments.withColumn("first", first)))


def merge_summaries(parts: DataFrame) -> DataFrame:
    """Put together summaries of runs of the feed that do not overlap, in the order of their
    positions. Each key has one row per run."""
    first = F.struct(F.col("first_seq").alias("seq"), F.col("first_ts").alias("ts"))
    last = F.struct(F.col("last_seq").alias("seq"), F.col("last_ts").alias("ts"), "condition")
    cut = F.max("last_delete").over(Window.partitionBy(*_GROUP))
    placed = parts.withColumn("cut", cut)
    starts = F.col("first_seq").isNotNull() & _live(F.col("first_seq"), F.col("cut"))
    ends = F.col("last_seq").isNotNull() & _live(F.col("last_seq"), F.col("cut"))
    merged = placed.groupBy(*_GROUP).agg(
        F.max("last_delete").alias("last_delete"),
        F.min(F.when(starts, first)).alias("first"),
        F.max_by(F.when(ends, last), F.when(ends, F.col("last_seq"))).alias("last"),
        F.min("from_seq").alias("from_seq"),
        F.max("to_seq").alias("to_seq"),
    )
    return _flat(merged)


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        *KEY,
        "last_delete",
        F.col("first.seq").alias("first_seq"),
        F.col("first.ts").alias("first_ts"),
        F.col("last.seq").alias("last_seq"),
        F.col("last.ts").alias("last_ts"),
        F.col("last.condition").alias("condition"),
        "from_seq",
        "to_seq",
    )


def state_of(summary: DataFrame) -> DataFrame:
    """The tuples that exist after a run of changes on an empty state."""
    return summary.where(F.col("last_seq").isNotNull()).select(
        *KEY,
        "condition",
        F.col("first_ts").alias("created_at"),
        F.col("last_ts").alias("updated_at"),
        "last_seq",
    )


def fold(
    events: DataFrame, vocab: str = "union", segment_rows: int = FOLD_SEGMENT_ROWS, by_rows: bool = False
) -> DataFrame:
    """Current tuples of a whole feed."""
    return state_of(summarize(events, vocab, segment_rows, by_rows))


def state_as_of(events: DataFrame, seq: int | Column, vocab: str = "union") -> DataFrame:
    """Tuples as they were just after feed position ``seq``."""
    return fold(events.where(F.col("seq") <= seq), vocab)


def apply_summary(state: DataFrame, summary: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """State after a later run of changes. One row per key on both sides, so no key is hot."""
    keys = KEY + (extra_keys or [])
    old, new = state.alias("old"), summary.alias("new")
    joined = old.join(new, keys, "full_outer")
    written = F.col("new.last_seq").isNotNull()
    deleted = F.col("new.last_delete").isNotNull()
    kept = F.col("old.last_seq").isNotNull() & ~deleted
    created = F.when(kept, F.col("old.created_at")).otherwise(F.col("new.first_ts"))

    def newest(new_name: str, old_name: str) -> Column:
        return F.when(written, F.col(f"new.{new_name}")).otherwise(F.col(f"old.{old_name}"))

    return joined.where(written | kept).select(
        *keys,
        newest("condition", "condition").alias("condition"),
        created.alias("created_at"),
        newest("last_ts", "updated_at").alias("updated_at"),
        newest("last_seq", "last_seq").alias("last_seq"),
    )


def apply_changes(state: DataFrame, events: DataFrame, vocab: str = "union") -> DataFrame:
    """State after a batch of events that all come later in the feed."""
    return apply_summary(state, summarize(events, vocab))


def apply_counts(events: DataFrame, by: list[str], vocab: str = "union") -> DataFrame:
    """Executed upserts and deletes, and skipped changes. Counts events, also those without
    effect on the state."""
    op = op_code(F.col("operation"), vocab)
    return events.groupBy(*by).agg(
        F.count_if(op == WRITE).alias("inserts"),
        F.count_if(op == DELETE).alias("deletes"),
        F.count_if(op == UNKNOWN).alias("skipped"),
    )


def conditional_tuples(state: DataFrame) -> DataFrame:
    """Tuples with a condition by object id. The rest of the key follows in the order, so that
    the sort can split the tuples of one object."""
    rest = [name for name in KEY if name != "object_id"]
    return state.where(F.col("condition").isNotNull()).orderBy("object_id", *rest)


def lookup(state: DataFrame, **key: str) -> DataFrame:
    """Tuples by some or all key columns."""
    for name, value in key.items():
        if name not in KEY:
            raise ValueError(f"{name} is no key column")
        state = state.where(F.col(name) == value)
    return state


def lookup_many(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Each wanted key with ``found`` and the tuple's columns."""
    hits = state.withColumn("_hit", F.lit(True))
    joined = keys.select(*KEY).distinct().join(hits, KEY, "left")
    return joined.withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def key_effects(before: DataFrame, summary: DataFrame) -> DataFrame:
    """What a run of changes does to each key it names: the key and ``effect``.

    ``before`` is the state before the run, or the part of it with the run's keys. The effect is
    inserted, updated, replaced (deleted and written anew) or removed, NULL where nothing changes.
    """
    old = before.select(*KEY, F.lit(True).alias("_old"))
    joined = summary.join(old, KEY, "left")
    existed, written = F.col("_old").isNotNull(), F.col("last_seq").isNotNull()
    deleted = F.col("last_delete").isNotNull()
    effect = (
        F.when(written & ~existed, "inserted")
        .when(written & ~deleted, "updated")
        .when(written, "replaced")
        .when(existed & deleted, "removed")
    )
    return joined.select(*KEY, effect.alias("effect"))


EFFECTS = ("inserted", "updated", "replaced", "removed")


def effect_counts() -> list[Column]:
    return [F.count_if(F.col("effect") == name).alias(name) for name in EFFECTS]


def row_effects(state: DataFrame, events: DataFrame, vocab: str = "union") -> DataFrame:
    """What a batch does to the rows of a state: inserted, updated, replaced (deleted and written
    anew) and removed."""
    return key_effects(state, summarize(events, vocab)).agg(*effect_counts())
