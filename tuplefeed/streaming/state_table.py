"""The current tuples as Parquet folders, one version per micro-batch.

A batch writes its summary, one row per changed key, to ``changes/version=<batch>``. Tuples live
in buckets by key hash below ``data``. Every ``merge_every`` batches the waiting summaries are put
together; a bucket whose waiting keys reach ``share`` of its tuples is rewritten with them, as
``data/version=<batch>/bucket=<n>``, and what waits for other buckets is written as
``pending/version=<batch>``. So a batch costs what it changes, a merge writes at most ``share`` of
the state besides the buckets that are due, and readers add no more than that. Last, a batch writes
``versions/version=<batch>``: one row per bucket with the version that holds it. Readers see a
batch only once that list is there, and add the summaries still waiting. Running a batch again
reads the same earlier versions and overwrites its own, so the result is the same.

Changes apply in the order of batches, and within a batch in that of positions. A batch that goes back
behind applied positions is merged at once, after all that waited, since waiting summaries are put
together by position. A table belongs to one stream, whose id is kept with each version.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.operators.state import (
    KEY,
    STATE_SCHEMA,
    SUMMARY_SCHEMA,
    apply_summary,
    merge_summaries,
    summarize,
)

BUCKETS = 64
MERGE_EVERY = 10
SHARE = 0.1  # of a bucket's tuples: with so many waiting keys it is rewritten
SMALL = 1000  # a bucket of at most so many tuples is one small file, always rewritten
EMPTY = -1  # the version of a bucket without tuples, or of no pending changes
_VERSION_SCHEMA = "bucket INT, home BIGINT, merged BIGINT, high_seq BIGINT, stream STRING, pending BIGINT, tuples BIGINT"


class Version(NamedTuple):
    homes: dict[int, int]  # bucket to the version that holds it, one entry per bucket
    merged: int  # the last version whose changes are in the buckets or pending
    high_seq: int | None  # the last applied position
    stream: str = ""  # the stream that the table belongs to
    pending: int = EMPTY  # the version that wrote the changes of spared buckets
    tuples: dict[int, int] = {}  # bucket to its tuples when it was written


class StateTable:
    def __init__(
        self, spark: SparkSession, path: str, buckets: int = BUCKETS, merge_every: int = MERGE_EVERY, share: float = SHARE,
        small: int = SMALL,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.merge_every = merge_every
        self.share = share
        self.small = small

    def latest_version(self) -> int | None:
        reader = self.spark.read.schema(f"{_VERSION_SCHEMA}, version BIGINT")
        try:
            return reader.parquet(f"{self.path}/versions").agg(F.max("version")).first()[0]
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _version(self, version: int | None) -> Version:
        if version is None or version < 0:
            return Version({b: EMPTY for b in range(self.buckets)}, -1, None)
        folder = f"{self.path}/versions/version={version}"
        rows = self.spark.read.schema(_VERSION_SCHEMA).parquet(folder).collect()
        self.buckets = len(rows)  # the table's own number counts
        pending = EMPTY if rows[0].pending is None else rows[0].pending
        tuples = {r.bucket: r.tuples or 0 for r in rows}
        return Version({r.bucket: r.home for r in rows}, rows[0].merged, rows[0].high_seq, rows[0].stream, pending, tuples)

    def _merged_tuples(self, homes: dict[int, int]) -> DataFrame:
        """Tuples of these buckets, with ``bucket``; only their folders are listed and read."""
        schema = f"{STATE_SCHEMA}, bucket INT"
        folders = [f"version={v}/bucket={b}" for b, v in homes.items() if v != EMPTY]
        if not folders:
            return self.spark.createDataFrame([], schema)
        data = f"{self.path}/data"
        reader = self.spark.read.schema(schema).option("basePath", data)
        return reader.parquet(*[f"{data}/{folder}" for folder in folders]).drop("version")

    def _waiting(self, after: int, upto: int, pending: int = EMPTY) -> DataFrame:
        """The pending changes and those of versions after one up to another, with ``bucket``."""
        folders = [f"{self.path}/changes/version={v}" for v in range(after + 1, upto + 1)]
        folders += [f"{self.path}/pending/version={pending}"] if pending != EMPTY else []
        changes = self.spark.read.schema(SUMMARY_SCHEMA).parquet(*folders)
        if len(folders) > 1:
            changes = merge_summaries(changes)
        bucket = F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int")
        return changes.withColumn("bucket", bucket)

    def read(self, version: int | None = None) -> DataFrame:
        """Tuples at a version, by default the latest."""
        version = self.latest_version() if version is None else version
        at = self._version(version)
        tuples = self._merged_tuples(at.homes)
        if version is not None and (version > at.merged or at.pending != EMPTY):
            tuples = apply_summary(tuples, self._waiting(at.merged, version, at.pending), ["bucket"])
        return tuples.drop("bucket")

    def changes(self, version: int) -> DataFrame:
        """The summary that a batch wrote."""
        return self.spark.read.schema(SUMMARY_SCHEMA).parquet(f"{self.path}/changes/version={version}")

    def with_keys(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The tuples of these keys at a version. Only the folders of buckets that they fall into are
        opened; the driver sees the numbers of these buckets."""
        version = self.latest_version() if version is None else version
        at = self._version(version)
        bucket = F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int")
        wanted = keys.select(*KEY, bucket.alias("bucket")).distinct()
        touched = {r.bucket for r in wanted.select("bucket").distinct().collect()}
        tuples = self._merged_tuples({b: home for b, home in at.homes.items() if b in touched})
        tuples = tuples.join(wanted, [*KEY, "bucket"], "left_semi")
        if version is not None and (version > at.merged or at.pending != EMPTY):
            waiting = self._waiting(at.merged, version, at.pending).join(wanted, [*KEY, "bucket"], "left_semi")
            tuples = apply_summary(tuples, waiting, ["bucket"])
        return tuples.drop("bucket")

    def apply(self, events: DataFrame, batch_id: int, vocab: str = "union", stream: str = "") -> None:
        """Write version ``batch_id`` from version ``batch_id - 1`` and the batch's events."""
        latest = self.latest_version()
        if latest is not None and self._version(latest).stream != stream:
            raise ValueError(f"{self.path} belongs to another stream")
        if batch_id == 0 and (latest or 0) > 0:
            raise ValueError(f"{self.path} holds later batches of this stream")
        before = self._version(batch_id - 1)
        folder = f"{self.path}/changes/version={batch_id}"
        summarize(events, vocab).write.mode("overwrite").parquet(folder)
        written = self.spark.read.schema(SUMMARY_SCHEMA).parquet(folder)
        first, last = written.agg(F.min("from_seq"), F.max("to_seq")).first()
        late = first is not None and before.high_seq is not None and first <= before.high_seq
        high = max((x for x in (before.high_seq, last) if x is not None), default=None)
        after = before._replace(high_seq=high, stream=stream)
        if late or batch_id - before.merged >= self.merge_every:
            after = self._merge(after, batch_id, late)
        rows = [
            (b, home, after.merged, after.high_seq, stream, after.pending, after.tuples.get(b, 0))
            for b, home in after.homes.items()
        ]
        listing = self.spark.createDataFrame(rows, _VERSION_SCHEMA).coalesce(1)
        listing.write.mode("overwrite").parquet(f"{self.path}/versions/version={batch_id}")

    def _merge(self, at: Version, version: int, late: bool = False) -> Version:
        """Rewrite the buckets with many waiting changes, as ``data/version=<version>``, and keep the
        other changes as ``pending/version=<version>``. A late batch is applied after all that waited,
        so nothing stays pending then."""
        upto = version - 1 if late else version
        runs = [self._waiting(at.merged, upto, at.pending)] if at.merged < upto or at.pending != EMPTY else []
        runs += [self._waiting(version - 1, version)] if late else []
        keys = reduce(DataFrame.unionByName, [run.groupBy("bucket").count() for run in runs]) if runs else None
        waiting = {r.bucket: r.n for r in keys.groupBy("bucket").agg(F.sum("count").alias("n")).collect()} if runs else {}
        size = {b: at.tuples.get(b, 0) for b in waiting}
        due = sorted(b for b, n in waiting.items() if late or size[b] <= self.small or n >= self.share * size[b])
        spared = sorted(waiting.keys() - set(due))
        pending = version if spared else EMPTY
        if spared:
            kept = runs[0].where(F.col("bucket").isin(spared)).drop("bucket")
            kept.write.mode("overwrite").parquet(f"{self.path}/pending/version={version}")
        if not due:
            return at._replace(merged=version, pending=pending)
        new = self._merged_tuples({b: at.homes[b] for b in due})
        for run in runs:
            new = apply_summary(new, run.where(F.col("bucket").isin(due)), ["bucket"])
        data = f"{self.path}/data/version={version}"
        new.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        written = self.spark.read.schema(f"{STATE_SCHEMA}, bucket INT").parquet(data)
        filled = {r.bucket: r["count"] for r in written.groupBy("bucket").count().collect()}
        homes = {b: version if b in filled else EMPTY for b in due}
        tuples = {b: filled.get(b, 0) for b in due}
        return at._replace(homes={**at.homes, **homes}, merged=version, pending=pending, tuples={**at.tuples, **tuples})

    def remove_versions(self, before: int) -> int:
        """Forget the versions before one, and delete the folders that no later one reads.

        Returns how many folders went. No reader may still be at a version that is forgotten.
        """
        latest = self.latest_version()
        if latest is None or before > latest:
            raise ValueError(f"{self.path} has no version {before}")
        versions = [self._version(v) for v in range(before, latest + 1)]
        needed = {(home, bucket) for v in versions for bucket, home in v.homes.items()}
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        files = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

        def numbered(folder: str, name: str) -> list[tuple[int, str]]:
            listed = files.listStatus(path(folder)) if files.exists(path(folder)) else []
            found = [f.getPath() for f in listed if f.getPath().getName().startswith(f"{name}=")]
            return [(int(p.getName().split("=")[1]), p.toString()) for p in found]

        old = [p for v, p in numbered(f"{self.path}/versions", "version") if v < before]
        old += [p for v, p in numbered(f"{self.path}/changes", "version") if v < before and v <= versions[0].merged]
        pending = {v.pending for v in versions}
        old += [p for v, p in numbered(f"{self.path}/pending", "version") if v < before and v not in pending]
        for version, folder in numbered(f"{self.path}/data", "version"):
            if version < before:
                old += [p for b, p in numbered(folder, "bucket") if (version, b) not in needed]
        return sum(files.delete(path(p), True) for p in old)
