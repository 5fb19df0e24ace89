"""Write and delete requests for a target store."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuplefeed.functions.changes import DELETE, UNKNOWN, WRITE, op_code, with_condition_parts
from tuplefeed.functions.refs import join_ref
from tuplefeed.operators.ordering import block_of, dense_position
from tuplefeed.operators.state import KEY

BATCH_SIZE = 100


def rebuild_keys(events: DataFrame) -> DataFrame:
    """Add ``user`` and ``object`` references made of the parts."""
    return events.withColumns(
        {
            "user": join_ref(F.col("user_type"), F.col("user_id")),
            "object": join_ref(F.col("object_type"), F.col("object_id")),
        }
    )


def select_changes(
    events: DataFrame,
    object_types: list[str] | None = None,
    relations: list[str] | None = None,
) -> DataFrame:
    """Replicate only some object types or relations."""
    if object_types is not None:
        events = events.where(F.col("object_type").isin(object_types))
    if relations is not None:
        events = events.where(F.col("relation").isin(relations))
    return events


def chunk(
    events: DataFrame, batch_size: int = BATCH_SIZE, vocab: str = "union", net: bool = False
) -> DataFrame:
    """Cut the list of events into chunks of ``batch_size``, unknown operations included.

    A request carries its writes and deletes apart, so the order within a chunk is lost.
    ``net`` first reduces each chunk to the last write or delete per key.
    """
    narrow = rebuild_keys(events).select(
        "seq", "operation", "user", "relation", "object", "condition"
    )
    placed = dense_position(narrow, "seq", "position")
    chunks = placed.withColumns(
        {
            "chunk": block_of(F.col("position"), batch_size),
            "op": op_code(F.col("operation"), vocab),
        }
    )
    if net:
        last = Window.partitionBy("chunk", "user", "relation", "object", F.col("op") == UNKNOWN)
        chunks = chunks.withColumn("_last", F.max("seq").over(last))
        chunks = chunks.where((F.col("op") == UNKNOWN) | (F.col("seq") == F.col("_last")))
        chunks = chunks.drop("_last")
    return chunks


def net_changes(events: DataFrame, vocab: str = "union") -> DataFrame:
    """Only the last write or delete of each key, combined before the shuffle.

    The target ends in the same state, and as no key is left twice, requests made of the
    result may be sent in any order and at the same time.
    """
    known = events.where(op_code(F.col("operation"), vocab) != UNKNOWN)
    last = F.max_by(F.struct("seq", "operation", "condition"), "seq")
    return known.groupBy(*KEY).agg(last.alias("_last")).select(*KEY, "_last.*")


def requests(
    events: DataFrame, batch_size: int = BATCH_SIZE, vocab: str = "union", net: bool = False
) -> DataFrame:
    """One row per request: (chunk, writes, deletes), both arrays in feed order.

    A write carries its condition unless that does not parse; a delete never does. Chunks
    with nothing to send have no row. The arrays hold at most ``batch_size`` entries.
    """
    known = chunk(events, batch_size, vocab, net).where(F.col("op") != UNKNOWN)
    key = ("user", "relation", "object")
    parsed = with_condition_parts(known)
    entry = F.struct("seq", *key, "condition_name", "condition_context")
    delete = F.struct("seq", *key)
    return parsed.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.when(F.col("op") == WRITE, entry))).alias("writes"),
        F.array_sort(F.collect_list(F.when(F.col("op") == DELETE, delete))).alias("deletes"),
    )


def condition_entry(name: Column, context: Column) -> Column:
    """The condition of a write as it stands in a request. A missing context is left out of the JSON,
    as is a missing condition."""
    parts = F.struct(name.alias("name"), F.try_parse_json(context).alias("context"))
    return F.when(name.isNotNull(), parts)


def bodies(requests: DataFrame) -> DataFrame:
    """Requests as JSON text: (chunk, n_writes, n_deletes, body). Empty lists are left out."""

    writes = F.transform(
        "writes",
        lambda w: F.struct(
            w["user"].alias("user"),
            w["relation"].alias("relation"),
            w["object"].alias("object"),
            condition_entry(w["condition_name"], w["condition_context"]).alias("condition"),
        ),
    )
    deletes = F.transform(
        "deletes",
        lambda d: F.struct(
            d["user"].alias("user"), d["relation"].alias("relation"), d["object"].alias("object")
        ),
    )
    return requests.select(
        "chunk",
        F.size("writes").cast("bigint").alias("n_writes"),
        F.size("deletes").cast("bigint").alias("n_deletes"),
        F.to_json(
            F.struct(
                F.when(F.size("writes") > 0, writes).alias("writes"),
                F.when(F.size("deletes") > 0, deletes).alias("deletes"),
            )
        ).alias("body"),
    )


def deliver(bodies: DataFrame, send: Callable[[str], None], done: DataFrame | None = None) -> DataFrame:
    """Send request bodies and report (chunk, delivered, error), with ``batch_id`` if there is one.

    ``send`` runs in the tasks and raises when the target refuses. Tasks send at the same time,
    so requests should come from ``net_changes``. Requests in ``done``, the report of an earlier
    try, are not sent again if they were delivered. Chunks are numbered anew in each batch of a stream. The result is lazy and sends each time it
    is computed: write it to the delivery log. A task Spark runs again sends its requests again,
    so the target must accept a repeated request.
    """
    key = [c for c in ("batch_id", "chunk") if c in bodies.columns]
    if done is not None:
        bodies = bodies.join(done.where("delivered").select(*key), key, "left_anti")

    def send_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = []
            for body in batch["body"]:
                try:
                    send(body)
                    errors.append(None)
                except Exception as error:
                    errors.append(str(error))
            yield batch[key].assign(delivered=[e is None for e in errors], error=errors)

    schema = ", ".join([*(f"{c} BIGINT" for c in key), "delivered BOOLEAN, error STRING"])
    return bodies.select(*key, "body").mapInPandas(send_all, schema)
