"""Session settings and the shared folder for tables and checkpoints."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on: event times are UTC, and of two members with the same
# name in one JSON object the last one counts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Building expressions is faster without recording where in the program each one was made.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "tuplefeed", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **BUILD_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a session that is one process, as in tests, may go without that setting and then has a
    temporary folder; a cluster, also one on this machine, may not.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tuplefeed-")
    folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in getattr(_open, "folders", []):
        made.append(folder)
    return folder


_open = threading.local()


@contextmanager
def folders_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shared folders that are made inside, by this thread, when it is left.

    For work that ends inside, such as a batch of a stream: a DataFrame that still reads such a
    folder must not be used afterwards.
    """
    folders: list[str] = []
    _open.folders = [*getattr(_open, "folders", []), folders]
    try:
        yield
    finally:
        _open.folders = _open.folders[:-1]
        for folder in folders:
            remove_folder(spark, folder)


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder of any file system that Spark reaches; false if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
