"""The positions a stream has ever had, as ranges: repeats of any age are dropped.

A feed's positions mostly follow one another, so ranges say in a few rows what single positions
would in billions. Positions are cut into blocks, so that ranges of one block are worked out by
themselves: a row is a repeat if a range of its block that begins at or before it reaches it, which is
a running maximum over the block's rows and ranges in order, and no join by inequality.

A batch writes its new ranges to ``new/version=<batch>``; every ``merge_every`` batches all ranges are
merged to ``merged/version=<batch>``. A batch that runs again reads the same earlier versions and
overwrites its own, so the result is the same.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tuplefeed.operators.ordering import block_of

#: Positions of a block, the most rows of one group.
BLOCK = 1 << 16
MERGE_EVERY = 50
_RANGES = "block BIGINT, low BIGINT, high BIGINT"


def ranges_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, low, high) of the distinct positions ``seq``: runs without gaps within blocks."""
    placed = rows.select("seq").distinct().withColumn("block", block_of(F.col("seq"), block))
    run = F.col("seq") - F.row_number().over(Window.partitionBy("block").orderBy("seq"))
    return placed.withColumn("run", run).groupBy("block", "run").agg(F.min("seq").alias("low"), F.max("seq").alias("high")).drop("run")


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Put ranges of a block together that overlap or touch."""
    order = Window.partitionBy("block").orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = reached.isNull() | (F.col("low") > reached + 1)
    numbered = ranges.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("block", "run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("run")


def not_in(rows: DataFrame, ranges: DataFrame, block: int = BLOCK, distinct: bool = False) -> DataFrame:
    """The rows whose position ``seq`` lies in none of the ranges; with ``distinct`` one per position."""
    marked = rows.select(
        block_of(F.col("seq"), block).alias("_block"), F.col("seq").alias("_at"), F.lit(None).cast("bigint").alias("_high"),
        F.struct(*rows.columns).alias("_row"),
    )
    nothing = F.lit(None).cast(marked.schema["_row"].dataType).alias("_row")
    edges = ranges.select(F.col("block").alias("_block"), F.col("low").alias("_at"), F.col("high").alias("_high"), nothing)
    # Ranges of blocks without rows are not needed; a batch has rows in few blocks.
    edges = edges.join(marked.select("_block").distinct(), "_block", "left_semi")
    order = Window.partitionBy("_block").orderBy("_at", F.col("_row").isNotNull())
    reached = F.max("_high").over(order.rowsBetween(Window.unboundedPreceding, 0))
    judged = marked.unionByName(edges).withColumn("_reached", reached)
    new = F.col("_row").isNotNull() & (F.col("_reached").isNull() | (F.col("_reached") < F.col("_at")))
    if distinct:
        # Rows of a position follow one another, behind the ranges that begin there.
        follows = F.lag(F.col("_row").isNotNull(), 1, False).over(order) & F.lag("_at").over(order).eqNullSafe(F.col("_at"))
        judged, new = judged.withColumn("_follows", follows), new & ~F.col("_follows")
    return judged.where(new).select("_row.*")


class SeenPositions:
    def __init__(self, spark: SparkSession, path: str, block: int = BLOCK, merge_every: int = MERGE_EVERY):
        self.spark, self.path, self.block, self.merge_every = spark, path.rstrip("/"), block, merge_every

    def _versions(self, kind: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{_RANGES}, version BIGINT").parquet(f"{self.path}/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{_RANGES}, version BIGINT")

    def before(self, batch_id: int) -> DataFrame:
        """Ranges of all batches before one; they may touch or overlap."""
        merged = self._versions("merged").where(F.col("version") < batch_id)
        last = merged.agg(F.max("version")).first()[0]
        new = self._versions("new").where((F.col("version") < batch_id) & (F.col("version") > (-1 if last is None else last)))
        if last is not None:
            new = new.unionByName(merged.where(F.col("version") == last))
        return new.drop("version")

    def fresh(self, events: DataFrame, batch_id: int) -> DataFrame:
        """The events whose positions no earlier batch had, each position once. Their ranges are
        written first; a batch that fails later comes again with the same id. The events are kept
        from then on, until ``unpersist``."""
        known = self.before(batch_id)
        once = not_in(events, known, self.block, distinct=True).persist()
        ranges_of(once, self.block).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/new/version={batch_id}")
        if batch_id % self.merge_every == self.merge_every - 1:
            mine = self.spark.read.schema(_RANGES).parquet(f"{self.path}/new/version={batch_id}")
            merge_ranges(known.unionByName(mine)).write.mode("overwrite").parquet(f"{self.path}/merged/version={batch_id}")
        return once
