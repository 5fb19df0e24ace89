"""Positions and running sums over a feed, without one task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuplefeed.session import shared_folder

# Rows whose running sum one task works out.
BLOCK_ROWS = 1 << 16


def block_of(position: Column, size: int | Column) -> Column:
    """Whole-number quotient, exact for every BIGINT."""
    return F.call_function("div", position, F.lit(size))


def dense_position(df: DataFrame, order: str = "seq", out: str = "position") -> DataFrame:
    """Add the 0-based rank of the unique BIGINT ``order`` column over the whole table.

    Rows are dealt into ranges of equal numbers of rows, whatever the gaps between their values,
    sorted, and written once to the shared folder; there each row has its place in its range. The
    driver sees one count per range, and later steps read the written rows.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "positions")
    place = F.monotonically_increasing_id()  # the range in the upper bits, the place below
    ranged = df.repartitionByRange(order).sortWithinPartitions(order)
    ranged.select(
        *df.columns, F.shiftright(place, 33).alias("_range"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")
    ).write.parquet(path)
    written = spark.read.parquet(path)
    before, starts = 0, []
    for number, rows in sorted(written.groupBy("_range").count().collect()):
        starts.append((number, before))
        before += rows
    offsets = spark.createDataFrame(starts, "_range BIGINT, _start BIGINT")
    placed = written.join(F.broadcast(offsets), "_range")  # one row per range
    return placed.select(*df.columns, (F.col("_start") + F.col("_place")).alias(out))


def prefix_sums(df: DataFrame, key: str, value: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``before``: the sum of ``value`` over all smaller values of the unique BIGINT ``key``.

    Sums run inside blocks of rows. Only the block totals, one row per ``block_rows`` rows, are
    summed in one task.
    """
    placed = dense_position(df, key, "_at").withColumn("_block", block_of(F.col("_at"), block_rows))
    totals = placed.groupBy("_block").agg(F.sum(value).alias("_total"))
    earlier = (Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_block",
        F.coalesce(
            F.sum("_total").over(Window.orderBy("_block").rowsBetween(*earlier)), F.lit(0)
        ).alias("_offset"),
    )
    in_block = Window.partitionBy("_block").orderBy("_at").rowsBetween(*earlier)
    within = placed.withColumn("_within", F.coalesce(F.sum(value).over(in_block), F.lit(0)))
    return within.join(offsets, "_block").select(
        *df.columns, (F.col("_offset") + F.col("_within")).alias("before")
    )
