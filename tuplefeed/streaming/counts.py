"""Numbers of the stored state, kept by the differences that batches make.

A batch's changes, joined with the tuples of their own keys before the batch, say which tuples come and
go. Signed by +1 and -1 and summed per object type, they are added to the numbers before. Nothing
else of the state is read, and numbers are read without any of it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.operators.state import EFFECTS, effect_counts, key_effects
from tuplefeed.streaming.state_table import StateTable

COUNT_SCHEMA = ", ".join(["object_type STRING", "tuples BIGINT", *(f"{e} BIGINT" for e in EFFECTS)])


def differences(before: DataFrame, summary: DataFrame) -> DataFrame:
    """Per object type: ``tuples`` that come less those that go, and how many rows had which effect."""
    sign = F.when(F.col("effect") == "inserted", 1).when(F.col("effect") == "removed", -1).otherwise(0)
    effects = key_effects(before, summary).where("effect IS NOT NULL")
    return effects.groupBy("object_type").agg(F.sum(sign).alias("tuples"), *effect_counts())


class TupleCounts:
    """One folder of numbers per version of a state table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, version: int) -> DataFrame:
        """(object_type, tuples, inserted, updated, replaced, removed) at a version: the tuples there
        are, and the effects of all batches up to it."""
        if version < 0:
            return self.spark.createDataFrame([], COUNT_SCHEMA)
        return self.spark.read.schema(COUNT_SCHEMA).parquet(f"{self.path}/version={version}")

    def read_all(self) -> DataFrame:
        """The numbers at all versions, with ``version``."""
        return self.spark.read.schema(f"{COUNT_SCHEMA}, version BIGINT").parquet(self.path)

    def latest(self) -> int:
        """The last version with numbers, -1 for none."""
        try:
            return self.read_all().agg(F.max("version")).first()[0]
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return -1
            raise

    def add(self, table: StateTable, version: int) -> None:
        """Write the numbers of a version that the table has just got; run again, it does the same."""
        summary = table.changes(version)
        new = differences(table.with_keys(summary, version - 1), summary)
        names = ["tuples", *EFFECTS]
        summed = self.read(version - 1).unionByName(new).groupBy("object_type").agg(*[F.sum(n).alias(n) for n in names])
        summed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={version}")
