from datetime import datetime, timedelta

import pytest

from helpers import START, event, events_of
from tuplefeed.operators import stats
from tuplefeed.operators.dedupe import drop_repeats

LOG = "request_no BIGINT, success BOOLEAN, changes BIGINT, latency_ms DOUBLE, ts TIMESTAMP"


def test_fetch_stats(spark):
    [row] = stats.fetch_stats(spark.createDataFrame([(1, True, 5, 100.0, START)], LOG)).collect()
    assert tuple(row)[:5] == (1, 1, 0, 5, 100.0)


def test_mean_latency_is_of_whole_milliseconds(spark):
    rows = [(1, True, 5, 100.9, START), (2, False, 0, 50.2, START + timedelta(seconds=1))]
    [row] = stats.fetch_stats(spark.createDataFrame(rows, LOG)).collect()
    assert tuple(row) == (2, 1, 1, 5, 75.0, START + timedelta(seconds=1))


def test_stats_of_no_fetch(spark):
    [row] = stats.fetch_stats(spark.createDataFrame([], LOG)).collect()
    assert tuple(row) == (0, 0, 0, 0, 0.0, None)


def test_lag(spark):
    rows = [event(0, "WRITE", ts=START), event(1, "WRITE", ts=START + timedelta(seconds=9))]
    events = events_of(spark, rows).selectExpr("*", "seq = 1 AS ts_defaulted")
    now = START + timedelta(seconds=10, milliseconds=500)
    assert stats.lag(events, now).first().lag_seconds == pytest.approx(1.5)
    only = stats.lag(events, now, include_defaulted=False).first()
    assert (only.lag_seconds, only.defaulted) == (10.5, 1)
    assert stats.lag(events).first().lag_seconds > 0


def test_histogram(spark):
    rows = [("write", "success", d, START) for d in (0.001, 0.005, 0.3, 20.0)]
    rows.append(("fetch", "error", 1.0, START))
    log = spark.createDataFrame(rows, "operation STRING, status STRING, duration_s DOUBLE, ts TIMESTAMP")
    got = {(r.operation, r.le): r.runs for r in stats.duration_histogram(log).collect()}
    assert len(got) == 24
    assert [got["write", le] for le in ("0.005", "0.25", "0.5", "10.0", "+Inf")] == [2, 2, 3, 3, 4]
    assert (got["fetch", "0.5"], got["fetch", "1.0"]) == (0, 1)
    counts = {tuple(r) for r in stats.operation_counts(log).collect()}
    assert counts == {("write", "success", 4), ("fetch", "error", 1)}
    totals = {r.operation: (r.total_s, r.runs) for r in stats.duration_totals(log).collect()}
    assert totals == {"write": (20.306, 4), "fetch": (1.0, 1)}
    last = {r.operation: (r.last_success, r.errors) for r in stats.sync_metrics(log).collect()}
    assert last == {"write": (datetime(2024, 1, 1), 0), "fetch": (None, 1)}


def test_repeats(spark):
    events = events_of(spark, [event(0, "WRITE"), event(1, "DELETE"), event(0, "WRITE")])
    assert sorted(r.seq for r in drop_repeats(events).collect()) == [0, 1]
