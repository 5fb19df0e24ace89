"""The sync cursor: a log of (batch_id, token) of which the last token counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURSOR_SCHEMA = "batch_id BIGINT, token STRING, updated_at TIMESTAMP"


def save_cursor(spark: SparkSession, path: str, batch_id: int, token: str) -> None:
    row = spark.createDataFrame([(batch_id, token)], "batch_id BIGINT, token STRING")
    row.withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_cursor_log(spark: SparkSession, path: str) -> DataFrame:
    """The log; empty before the first save."""
    try:
        return spark.read.schema(CURSOR_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CURSOR_SCHEMA)


def latest_cursor(log: DataFrame) -> DataFrame:
    """One row with the token to go on from; the empty token before the first save."""
    return log.agg(
        F.coalesce(F.max_by("token", "batch_id"), F.lit("")).alias("continuation_token")
    )
