"""A store that takes write and delete requests, as a Spark sink.

    spark.dataSource.register(ChangeTarget)
    by_key(events).write.format("change_target").mode("append").option("url", "https://host/stores/2/write").save()

Changes are dealt to tasks by key and sorted there by position, so each task sends the changes of
its keys in the order of the feed, and no other task sends any of them. A request carries its writes
and deletes apart, so a task closes one when a key comes up that is in it already. Tasks report to
the driver what they sent; it writes ``commit-<batch>.json`` when all are through, and
``abort-<batch>-<time>.json`` when one failed, to the folder ``log``.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tuplefeed.functions.changes import UNKNOWN, WRITE, op_code, with_condition_parts
from tuplefeed.operators.replicate import BATCH_SIZE, condition_entry, rebuild_keys
from tuplefeed.sources.files import open_folder

Send = Callable[[str], None]


def by_key(events: DataFrame, vocab: str = "union") -> DataFrame:
    """(seq, write, user, relation, object, entry): one row per change, ``entry`` its JSON in a request.

    Dealt by key and sorted by position. A key with a large part of all changes is one task's, since
    its order is to be kept; where only the end counts, reduce with ``net_changes`` first.
    """
    key = ("user", "relation", "object")
    op = op_code(F.col("operation"), vocab)
    known = rebuild_keys(events).where(op != UNKNOWN).select("seq", (op == WRITE).alias("write"), *key, "condition")
    condition = F.when(F.col("write"), condition_entry(F.col("condition_name"), F.col("condition_context")))
    entry = F.to_json(F.struct(*key, condition.alias("condition")))
    made = with_condition_parts(known).select("seq", "write", *key, entry.alias("entry"))
    return made.repartition(*key).sortWithinPartitions("seq")


def request_bodies(rows: Iterator[Row], batch_size: int) -> Iterator[tuple[int, str]]:
    """(changes, body) of requests of at most ``batch_size`` changes, in which no key is twice."""
    writes, deletes, keys = [], [], set()

    def body() -> tuple[int, str]:
        parts = [f'"{name}":[{",".join(of)}]' for name, of in (("writes", writes), ("deletes", deletes)) if of]
        return len(keys), f"{{{','.join(parts)}}}"

    for row in rows:
        key = (row.user, row.relation, row.object)
        if key in keys or len(keys) == batch_size:
            yield body()
            writes, deletes, keys = [], [], set()
        keys.add(key)
        (writes if row.write else deletes).append(row.entry)
    if keys:
        yield body()


def http_target(options: dict[str, str]) -> Send:
    """POST each body to ``url``; a status of 400 or more raises."""

    def send(body: str) -> None:
        request = urllib.request.Request(options["url"], body.encode(), {"Content-Type": "application/json"})
        if options.get("token"):
            request.add_header("Authorization", f"Bearer {options['token']}")
        with urllib.request.urlopen(request, timeout=float(options.get("timeout", "30"))):
            pass

    return send


class ChangeTarget(DataSource):
    """Subclasses may send some other way by overriding ``connect``, which is called once per task. If
    what it returns has a ``close``, that is called after the last request of the task."""

    connect = staticmethod(http_target)

    @classmethod
    def name(cls) -> str:
        return "change_target"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("requests can only be sent, not replaced: use mode append")
        return RequestWriter(self)


@dataclass
class Sent(WriterCommitMessage):
    requests: int
    changes: int
    tries: int


class RequestWriter(DataSourceWriter):
    def __init__(self, target: ChangeTarget):
        self.connect, self.options = target.connect, dict(target.options)
        self.batch_size = int(self.options.get("batch_size", BATCH_SIZE))
        self.tries = int(self.options.get("tries", "3"))
        self.first_pause = float(self.options.get("first_pause", "1"))

    def write(self, iterator: Iterator[Row]) -> Sent:
        send, sent = self.connect(self.options), Sent(0, 0, 0)
        for changes, body in request_bodies(iterator, self.batch_size):
            sent.tries += self._send(send, body)
            sent.requests += 1
            sent.changes += changes
        if hasattr(send, "close"):
            send.close()
        return sent

    def _send(self, send: Send, body: str) -> int:
        """Send until it is accepted, with pauses that double; later requests wait, to keep the order."""
        for k in range(1, self.tries + 1):
            try:
                send(body)
                return k
            except Exception:
                if k == self.tries:
                    raise
                time.sleep(self.first_pause * 2 ** (k - 1))
        raise ValueError("tries must be positive")

    def _note(self, name: str, messages: list[Sent | None]) -> None:
        if self.options.get("log"):
            folder = open_folder(self.options["log"])
            folder.write(name, json.dumps({"batch_id": int(self.options.get("batch_id", "0")), "tasks": [m and asdict(m) for m in messages]}))

    def commit(self, messages: list[Sent | None]) -> None:
        self._note(f"commit-{self.options.get('batch_id', '0')}.json", messages)

    def abort(self, messages: list[Sent | None]) -> None:
        self._note(f"abort-{self.options.get('batch_id', '0')}-{time.time_ns()}.json", messages)


def read_commits(spark, log: str) -> DataFrame:
    """Per batch: tasks, requests, changes and tries that were committed."""
    task = "STRUCT<requests: BIGINT, changes: BIGINT, tries: BIGINT>"
    notes = spark.read.schema(f"batch_id BIGINT, tasks ARRAY<{task}>").json(f"{log.rstrip('/')}/commit-*.json")
    tasks = notes.select("batch_id", F.size("tasks").cast("bigint").alias("tasks"), F.inline_outer("tasks"))
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("requests", "changes", "tries")]
    return tasks.groupBy("batch_id", "tasks").agg(*sums)
