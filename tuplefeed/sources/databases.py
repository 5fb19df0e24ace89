"""Changelog and state tables in an existing database, over JDBC.

The driver jar of the database must be on Spark's class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CHANGELOG_TABLE_TYPES = (
    "change_type VARCHAR(64), object_type VARCHAR(100), object_id VARCHAR(255), "
    "relation VARCHAR(100), user_type VARCHAR(100), user_id VARCHAR(255)"
)


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    id_bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    **options: str,
) -> DataFrame:
    """A table, read in ``partitions`` ranges of its ``id`` when the bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if id_bounds is not None:
        reader = reader.options(
            partitionColumn="id",
            lowerBound=id_bounds[0],
            upperBound=id_bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def append_changelog(
    rows: DataFrame, url: str, table: str, connections: int = 16, **options: str
) -> None:
    """Append changelog rows through at most ``connections`` connections. The table numbers its
    rows itself, calls the time ``timestamp`` and has no parsed kind."""
    named = rows.withColumnRenamed("ts", "timestamp").drop("id", "change_kind", "event_date", "batch_id")
    writer = named.write.format("jdbc").mode("append")
    writer.options(
        url=url,
        dbtable=table,
        numPartitions=connections,
        createTableColumnTypes=CHANGELOG_TABLE_TYPES,
        **options,
    ).save()
