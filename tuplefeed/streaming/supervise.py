"""Keeping a stream going: an error goes to a table, and the query starts again from its checkpoint.

    keeper = Supervisor(spark, lambda: sync_state(feed, path, checkpoint, poll_interval="5 seconds"), errors)
    keeper.start()      # in a thread of its own; run() waits for the end instead
    ...
    keeper.stop()

A stream's checkpoint has the position of the last finished batch, so a query started anew reads the
failed batch again from the same position. Pauses double from ``first_pause`` to ``longest_pause``
seconds while no batch gets through, and are short again after one has.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

ERROR_SCHEMA = "stream STRING, failure INT, in_a_row INT, at TIMESTAMP, pause_s DOUBLE, error STRING"

log = logging.getLogger(__name__)


class Supervisor:
    """Runs what ``start`` starts until it ends by itself or is stopped.

    ``start`` is called for every attempt and uses one checkpoint. Each failure, also one to start,
    is a row of the table at ``errors``. ``most_in_a_row`` failures without a finished batch between
    them end it with the last error; None goes on for ever.
    """

    def __init__(
        self,
        spark: SparkSession,
        start: Callable[[], StreamingQuery],
        errors: str,
        stream: str = "stream",
        first_pause: float = 1.0,
        longest_pause: float = 300.0,
        most_in_a_row: int | None = None,
    ):
        self.spark = spark
        self.start_query = start
        self.errors = errors.rstrip("/")
        self.stream = stream
        self.first_pause = first_pause
        self.longest_pause = longest_pause
        self.most_in_a_row = most_in_a_row
        self.failures = 0
        self.in_a_row = 0
        self.query: StreamingQuery | None = None
        self.error: Exception | None = None
        self._stopped = threading.Event()
        self._thread: threading.Thread | None = None

    def run(self) -> StreamingQuery | None:
        """Start the query, and again after each failure; returns the one that ended well."""
        while not self._stopped.is_set():
            self.query = None
            try:
                self.query = self.start_query()
                if self._stopped.is_set():  # stop() came while the query started
                    self.query.stop()
                self.query.awaitTermination()
                return self.query
            except Exception as error:
                if self._stopped.is_set():
                    break
                self._failed(error)
        return self.query

    def _failed(self, error: Exception) -> None:
        finished = self.query is not None and any(p["durationMs"].get("walCommit") for p in self.query.recentProgress)
        self.in_a_row = 1 if finished else self.in_a_row + 1
        self.failures += 1
        # No power of a large number: the exponent stops where the pause does not grow any more.
        pause = min(self.first_pause * 2.0 ** min(self.in_a_row - 1, 60), self.longest_pause)
        row = (self.stream, self.failures, self.in_a_row, datetime.now(UTC), float(pause), str(error))
        try:
            self.spark.createDataFrame([row], ERROR_SCHEMA).coalesce(1).write.mode("append").parquet(self.errors)
        except Exception:  # the error table may be what is out of reach
            log.exception("no error row of stream %s", self.stream)
        log.warning("stream %s failed %d times in a row, next try in %.1f s: %s", self.stream, self.in_a_row, pause, error)
        if self.most_in_a_row is not None and self.in_a_row >= self.most_in_a_row:
            raise error
        self._stopped.wait(pause)

    def start(self) -> Supervisor:
        """Run in a thread of its own. An error that ends it is kept in ``error``."""

        def work() -> None:
            try:
                self.run()
            except Exception as error:
                self.error = error

        self._thread = threading.Thread(target=work, name=f"keep {self.stream}", daemon=True)
        self._thread.start()
        return self

    def stop(self, timeout: float | None = None) -> None:
        """Stop the query, and end the pause if it is in one."""
        self._stopped.set()
        if self.query is not None and self.query.isActive:
            self.query.stop()
        if self._thread is not None:
            self._thread.join(timeout)


def read_errors(spark: SparkSession, errors: str) -> DataFrame:
    """The failures so far, none if there has been no failure."""
    try:
        return spark.read.schema(ERROR_SCHEMA).parquet(errors)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ERROR_SCHEMA)
