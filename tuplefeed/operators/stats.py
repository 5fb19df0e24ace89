"""Counts, lag, fetch statistics and run histograms."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default upper bounds of duration histograms, in seconds.
DURATION_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def changelog_entries(changelog: DataFrame) -> DataFrame:
    return changelog.agg(F.count("*").alias("changelog_entries"))


def by_change_type(changelog: DataFrame) -> DataFrame:
    return changelog.groupBy("change_type").agg(F.count("*").alias("entries"))


def current_tuples(state: DataFrame) -> DataFrame:
    return state.agg(F.count("*").alias("current_tuples"))


def by_object_type(state: DataFrame) -> DataFrame:
    return state.groupBy("object_type").agg(F.count("*").alias("tuples"))


def seconds_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 1000000.0


def lag(
    events: DataFrame,
    now: datetime | Column | None = None,
    by: list[str] | None = None,
    include_defaulted: bool = True,
) -> DataFrame:
    """Seconds from the latest event to ``now``, and how many times were missing.

    A missing time stands as its ingest time, which hides lag: leave those out with
    ``include_defaulted=False``.
    """
    clock = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    ts = F.col("ts") if include_defaulted else F.when(~F.col("ts_defaulted"), F.col("ts"))
    grouped = events.groupBy(*(by or []))
    newest = grouped.agg(
        F.max(ts).alias("latest_ts"), F.count_if("ts_defaulted").alias("defaulted")
    )
    return newest.withColumn("lag_seconds", seconds_between(F.col("latest_ts"), clock))


def fetch_stats(fetch_log: DataFrame) -> DataFrame:
    """Requests, outcomes, changes and the mean latency in whole milliseconds per request."""
    return fetch_log.agg(
        F.count("*").alias("total_requests"),
        F.count_if("success").alias("success_requests"),
        F.count_if(~F.col("success")).alias("failed_requests"),
        F.coalesce(F.sum("changes"), F.lit(0)).cast("bigint").alias("total_changes"),
        F.coalesce(F.avg(F.floor("latency_ms")), F.lit(0.0)).alias("average_latency_ms"),
        F.max("ts").alias("last_fetch_time"),
    )


def batch_summary(events: DataFrame, pages: DataFrame, now: datetime | Column) -> DataFrame:
    """Per page: what a sync reports after it. ``pages`` come from ``page_summary``.

    ``total_fetched`` is what the page held, ``processed`` what was parsed of it.
    """
    newest = lag(events, now, by=["page_no"]).select("page_no", "latest_ts", "lag_seconds")
    return pages.join(newest, "page_no", "left")


def operation_counts(run_log: DataFrame) -> DataFrame:
    return run_log.groupBy("operation", "status").agg(F.count("*").alias("runs"))


def duration_histogram(
    run_log: DataFrame, bounds: tuple[float, ...] = DURATION_BOUNDS
) -> DataFrame:
    """Runs per operation at or below each bound, cumulative, with the total as ``+Inf``.

    All bounds are counted in one pass and turned to rows after the aggregation.
    """
    counts = [F.count_if(F.col("duration_s") <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    wide = run_log.groupBy("operation").agg(*counts, F.count("*").alias("le_inf"))
    labels = [repr(b) for b in bounds] + ["+Inf"]
    columns = [f"le_{i}" for i in range(len(bounds))] + ["le_inf"]
    cells = F.array(
        *[
            F.struct(F.lit(label).alias("le"), F.col(name).alias("runs"))
            for label, name in zip(labels, columns)
        ]
    )
    return wide.select("operation", F.inline(cells))


def duration_totals(run_log: DataFrame) -> DataFrame:
    """Sum and count of durations per operation; decimal, so the sum has no order."""
    return run_log.groupBy("operation").agg(
        F.sum(F.col("duration_s").cast("decimal(18,6)")).cast("double").alias("total_s"),
        F.count("*").alias("runs"),
    )


def sync_metrics(run_log: DataFrame) -> DataFrame:
    """Last success per operation and error count; failed runs do not move the time."""
    ok = F.col("status") == "success"
    return run_log.groupBy("operation").agg(
        F.max(F.when(ok, F.col("ts"))).alias("last_success"),
        F.count_if(~ok).alias("errors"),
    )
