"""Helpers that several operators share: tables, tasks over texts, settled results."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.session import shared_folder

# Fixed values of the task's word definitions.
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
LOWERED = bytes.maketrans(UPPER, LOWER)

#: Stands for a null id inside an operator; no id may have this value.
NO_ID = -(2**63)

#: Spark's setting that removes the shuffle files of a query once it has ended.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows that Spark hands to Python at once; with long texts, fewer keep a batch small.
BATCH_ROWS = "500"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Settings of the tasks that work on texts: small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so that other columns cannot clash."""
    prepared(docs.sparkSession)
    return docs.select(docs[key].cast("long").alias(key), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the cluster's shared folder and read it: later steps start from it,
    whatever executors are lost. The shuffles of the step end with it, since nothing reads them again."""
    spark = df.sparkSession
    path = shared_folder(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_END, before) if before is not None else spark.conf.unset(SHUFFLES_END)
    return spark.read.schema(df.schema).parquet(path)


def map_texts(df: DataFrame, make: Callable[[Iterator[tuple[list, list[str]]]], Iterable[dict]], schema: str) -> DataFrame:
    """Run ``make`` over (ids, texts) batches of a task; it yields columns by name."""
    out = schema_of(df.sparkSession, schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)
        for columns in make(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(task, schema)


def packed(numbers: np.ndarray) -> bytes:
    """Counts, most of them small, in as few bytes as tasks should send."""
    small = numbers.max(initial=0) < 1 << 31
    return (b"4" if small else b"8") + zstandard.ZstdCompressor(level=1).compress(numbers.astype("<i4" if small else "<i8").tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<i{data[:1].decode()}").astype(np.int64)


_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
}


def schema_of(spark: SparkSession, ddl: str) -> pa.Schema:
    fields = [part.strip().split(" ") for part in ddl.split(",")]
    return pa.schema([(name, _KINDS[kind]) for name, kind in fields])


def grouped_by_size(pairs: Iterator[tuple[list, list[str]]], chars: int) -> Iterator[tuple[list, list[str]]]:
    """Regroup batches into blocks that close once they hold ``chars`` characters."""
    ids, texts, held = [], [], 0
    for some_ids, some_texts in pairs:
        for i, t in zip(some_ids, some_texts, strict=True):
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= chars:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts
