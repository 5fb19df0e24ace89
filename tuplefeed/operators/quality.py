"""Checks that report on events and, unless told to, drop none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuplefeed.functions.changes import UNKNOWN, op_code

# Required fields in reporting order, and the column lengths of the changelog.
REQUIRED = ("object_type", "object_id", "relation", "user_type", "user_id", "change_type")
LENGTHS = {
    "change_type": 20,
    "object_type": 100,
    "object_id": 255,
    "relation": 100,
    "user_type": 100,
    "user_id": 255,
}


def _joined(problems: list[Column]) -> Column:
    return F.concat_ws(", ", *problems)


def validate(events: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``validation_error``, NULL for a good event. ``strict`` keeps only good events."""
    # The wording of messages, which readers of reports match on.
    missing = [
        F.when(F.coalesce(F.col(name), F.lit("")) == "", f"{name} is required") for name in REQUIRED
    ]
    missing.append(F.when(F.col("ts").isNull(), "timestamp is required"))
    problems = _joined(missing)
    checked = events.withColumn(
        "validation_error",
        F.when(problems != "", F.concat(F.lit("change event validation failed: "), problems)),
    )
    return checked.where(F.col("validation_error").isNull()) if strict else checked


def unknown_operations(events: DataFrame, vocab: str = "union") -> DataFrame:
    """Events that state and replication skip."""
    return events.where(op_code(F.col("operation"), vocab) == UNKNOWN)


def constraint_violations(rows: DataFrame, lengths: dict[str, int] | None = None) -> DataFrame:
    """Rows that a table with NOT NULL and length limits would refuse, with the reasons."""
    limits = LENGTHS if lengths is None else lengths
    problems = []
    for name, limit in limits.items():
        problems.append(F.when(F.col(name).isNull(), f"{name} is null"))
        problems.append(F.when(F.char_length(name) > limit, f"{name} exceeds {limit}"))
    if "ts" in rows.columns:
        problems.append(F.when(F.col("ts").isNull(), "ts is null"))
    return rows.withColumn("violations", _joined(problems)).where(F.col("violations") != "")
