"""Column expressions for one change: operation, time and condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The operation spellings and the change types they map to.
WRITE_NAMES = ("WRITE", "TUPLE_TO_USERSET_WRITE")
DELETE_NAMES = ("DELETE", "TUPLE_TO_USERSET_DELETE")
STORE_WRITE_NAMES = ("TUPLE_OPERATION_WRITE",)
STORE_DELETE_NAMES = ("TUPLE_OPERATION_DELETE",)

# Fixed value: RFC 3339 date-time with an optional fraction.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
ZERO_TIME = "0001-01-01T00:00:00Z"

WRITE, DELETE, UNKNOWN = "W", "D", "U"


def text_at(change: Column, path: str) -> Column:
    """A member as text; absent or null is the empty string."""
    return F.coalesce(F.try_variant_get(change, path, "string"), F.lit(""))


def json_at(change: Column, path: str) -> Column:
    """A member as canonical JSON text; NULL when absent."""
    return F.to_json(F.try_variant_get(change, path, "variant"))


def only_object(json: Column) -> Column:
    """JSON text of an object; NULL for every other JSON."""
    return F.when(json.startswith("{"), json)


def change_type(operation: Column) -> Column:
    name = F.upper(operation)
    return (
        F.when(name.isin(*WRITE_NAMES), "tuple_write")
        .when(name.isin(*DELETE_NAMES), "tuple_delete")
        .otherwise("tuple_change")
    )


def op_code(operation: Column, vocab: str = "union") -> Column:
    """W, D or U. ``union`` takes every known spelling, ``sink`` only the store's own two."""
    writes, deletes = STORE_WRITE_NAMES, STORE_DELETE_NAMES
    if vocab == "union":
        writes, deletes = writes + WRITE_NAMES, deletes + DELETE_NAMES
    elif vocab != "sink":
        raise ValueError(f"vocab must be 'union' or 'sink', not {vocab!r}")
    name = F.upper(operation)
    return F.when(name.isin(*writes), WRITE).when(name.isin(*deletes), DELETE).otherwise(UNKNOWN)


def parse_time(text: Column) -> Column:
    """Timestamp of RFC 3339 text; NULL when absent, malformed or the zero time."""
    parsed = F.when(text.rlike(RFC3339), text.try_cast("timestamp"))
    return F.nullif(parsed, F.lit(ZERO_TIME).cast("timestamp"))


def rfc3339(ts: Column) -> Column:
    """RFC 3339 text in UTC without trailing zeros in the fraction."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("Z"))


def millis_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS.mmm`` in UTC, cut (not rounded) to milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def with_condition_parts(df: DataFrame) -> DataFrame:
    """Add condition_name, condition_context and condition_error from ``condition`` text.

    No text means no condition. A condition needs a non-empty string name; its context
    counts only when it is a non-empty object. On an error name and context are NULL.
    """
    given = F.nullif(F.col("condition"), F.lit(""))
    parsed = df.withColumn("_parsed", F.try_parse_json(given)).withColumns(
        {
            "_name": json_at(F.col("_parsed"), "$.name"),
            "_context": json_at(F.col("_parsed"), "$.context"),
        }
    )
    named = F.col("_name").startswith('"') & (F.col("_name") != '""')
    # The wording of messages, which readers of reports match on.
    error = F.when(F.col("_parsed").isNull(), "invalid condition JSON").when(
        ~F.coalesce(named, F.lit(False)), "condition name is required and must be a string"
    )
    return parsed.withColumns(
        {
            "condition_name": F.when(named, F.try_variant_get("_parsed", "$.name", "string")),
            "condition_context": F.when(
                named & (F.col("_context") != "{}"), only_object(F.col("_context"))
            ),
            "condition_error": F.when(given.isNotNull(), error),
        }
    ).drop("_parsed", "_name", "_context")
