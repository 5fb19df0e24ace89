"""Small feeds and a plain replay to check against."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "seq BIGINT, object_type STRING, object_id STRING, relation STRING, user_type STRING, "
    "user_id STRING, ts TIMESTAMP, condition STRING, operation STRING"
)
START = datetime(2024, 1, 1)


def wire(operation, user, relation, obj, ts="2024-01-01T00:00:00Z", condition=None, **extra):
    key = {"user": user, "relation": relation, "object": obj}
    if condition is not None:
        key["condition"] = condition
    body = {"operation": operation, "tuple_key": key, **extra}
    if ts is not None:
        body["timestamp"] = ts
    return json.dumps(body)


def feed_of(spark, wires, first=0):
    rows = [(first + i, w) for i, w in enumerate(wires)]
    return spark.createDataFrame(rows, "seq BIGINT, wire STRING")


def event(seq, operation, key="k", condition=None, ts=None):
    ts = ts or START + timedelta(seconds=seq)
    return (seq, "doc", key, "viewer", "user", "u", ts, condition, operation)


def events_of(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def random_events(seed, n, keys=5, hot=0.34, gap=1):
    """Events with gaps in the positions, times out of order and one key with a third of all."""
    rng = random.Random(seed)
    rows, seq = [], 0
    for _ in range(n):
        seq += rng.randint(1, gap)
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        op = rng.choice(["WRITE", "tuple_operation_write", "DELETE", "TUPLE_OPERATION_DELETE", "NOOP"])
        condition = rng.choice([None, '{"name":"a"}', '{"name":"b"}'])
        ts = START + timedelta(seconds=rng.randrange(10_000))
        rows.append(event(seq, op, key, condition, ts))
    return rows


def replay(rows, state=None):
    """Current tuples after applying events one by one."""
    state = dict(state or {})
    for seq, *key, ts, condition, operation in sorted(rows):
        key, name = tuple(key), operation.upper()
        if name in ("WRITE", "TUPLE_OPERATION_WRITE", "TUPLE_TO_USERSET_WRITE"):
            created = state[key][1] if key in state else ts
            state[key] = (condition, created, ts, seq)
        elif name in ("DELETE", "TUPLE_OPERATION_DELETE", "TUPLE_TO_USERSET_DELETE"):
            state.pop(key, None)
    return state


def state_dict(df):
    rows = df.select(
        "object_type", "object_id", "relation", "user_type", "user_id",
        "condition", "created_at", "updated_at", "last_seq",
    ).collect()
    assert len({tuple(r[:5]) for r in rows}) == len(rows)
    return {tuple(r[:5]): tuple(r[5:]) for r in rows}


def plan(df):
    return df._jdf.queryExecution().toString()


def with_page(events, size):
    return events.withColumn("page_no", F.call_function("div", F.col("seq"), F.lit(size)))
