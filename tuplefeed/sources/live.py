"""A change API with pages and continuation tokens as a Spark source, batch and streaming.

    spark.dataSource.register(ChangeApi)
    spark.readStream.format("change_api").option("url", "https://host/stores/1/changes").load()

Rows are (seq, wire), positions counted from the start of the feed. Tokens make pages a chain that
one reader must follow. In a stream the driver does so and keeps, for each run of ``pages_per_task``
pages, its first token and its numbers of changes; the tasks fetch the pages again by token, so no
change ever passes through the driver. A batch of more than ``MAX_RUNS`` runs has longer ones instead,
so tasks and what the driver keeps stay few. A batch goes on until the token is spent: a query that reads
what is there and stops reads up to that end. ``max_pages`` makes batches shorter, and is refused
without ``polled=true``, since such a query would stop after so many pages. With ``start_token``,
``start_seq`` says what position the first change after it has.

``SavedChangeApi`` reads pages that were saved to a folder instead.
"""

from __future__ import annotations

import itertools
import json
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tuplefeed.sources.files import open_folder

Offset = dict
Rows = Iterator[tuple[int, str]]

MAX_RUNS = 1 << 9  # the most tasks of a batch, an even number


def http_page(options: dict, token: str) -> dict:
    """One page: ``changes`` and ``continuation_token``."""
    query = {"page_size": options.get("page_size", "100")}
    if token:
        query["continuation_token"] = token
    request = urllib.request.Request(f"{options['url']}?{urllib.parse.urlencode(query)}")
    if options.get("token"):
        request.add_header("Authorization", f"Bearer {options['token']}")
    with urllib.request.urlopen(request, timeout=float(options.get("timeout", "30"))) as response:
        return json.load(response)


class ChangeApi(DataSource):
    """Subclasses may read pages some other way by overriding ``fetch_page``."""

    fetch_page = staticmethod(http_page)

    @classmethod
    def name(cls) -> str:
        return "change_api"

    def schema(self) -> str:
        return "seq BIGINT, wire STRING"

    def pages(self, offset: Offset) -> Iterator[tuple[list[str], Offset]]:
        """Pages from an offset on, each with the offset after it."""
        for changes, after in self.decoded_pages(offset):
            yield [json.dumps(c, separators=(",", ":")) for c in changes], after

    def decoded_pages(self, offset: Offset) -> Iterator[tuple[list, Offset]]:
        """The same without JSON text, for whoever only counts. An empty page ends it, and
        a page without a token too, which is then read again from its own token later."""
        while True:
            page = self.fetch_page(self.options, offset["token"])
            changes = list(page.get("changes", []))
            fresh = changes[offset["skip"]:]
            token = page.get("continuation_token") or ""
            after = {"token": token, "skip": 0, "seq": offset["seq"] + len(fresh)}
            if not token:
                after = {"token": offset["token"], "skip": len(changes), "seq": after["seq"]}
            if fresh:
                yield fresh, after
            if not token or not changes:
                return
            offset = after

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ChangeApiStream(self)

    def reader(self, schema) -> DataSourceReader:
        return ChangeApiBatch(self)


def start_of(options: dict) -> Offset:
    token, seq = options.get("start_token", ""), options.get("start_seq")
    if token and seq is None:
        raise ValueError("start_token needs start_seq, the position of the first change after it")
    return {"token": token, "skip": 0, "seq": int(seq or 0)}


def _number(changes: list[str], first: int) -> Rows:
    return ((first + i, change) for i, change in enumerate(changes))


@dataclass
class PageRun(InputPartition):
    """Consecutive pages: where they begin, and how many changes they held when they were planned."""

    offset: Offset
    changes: int


class ChangeApiStream(DataSourceStreamReader):
    """The engine asks for the partitions of the last batch before it plans another one after a
    restart; their end is where the next batch begins."""

    def __init__(self, source: ChangeApi):
        self.source = source
        self.max_pages = int(source.options.get("max_pages", "0"))
        if self.max_pages and source.options.get("polled", "") != "true":
            raise ValueError("max_pages needs polled=true and a poll interval")
        self.pages_per_task = int(source.options.get("pages_per_task", "16"))
        self.at: Offset | None = None
        self.planned: list[PageRun] = []

    def initialOffset(self) -> Offset:
        return start_of(self.source.options)

    def _follow(self, start: Offset, max_pages: int = 0, last_seq: int | None = None) -> tuple[list[PageRun], Offset]:
        """Runs of the pages after ``start``, and where they end. Only numbers of changes are kept."""
        runs, end, in_run, per_run = [], start, 0, self.pages_per_task
        for count, (changes, after) in enumerate(self.source.decoded_pages(start), 1):
            held = len(changes) if last_seq is None else min(len(changes), last_seq - end["seq"])
            if in_run % per_run == 0:
                if len(runs) == MAX_RUNS:  # two runs become one
                    runs = [PageRun(a.offset, a.changes + b.changes) for a, b in zip(runs[::2], runs[1::2], strict=True)]
                    per_run *= 2
                runs.append(PageRun(end, 0))
                in_run = 0
            runs[-1].changes += held
            in_run, end = in_run + 1, after
            if count == max_pages or (last_seq is not None and after["seq"] >= last_seq):
                break
        return runs, end

    def latestOffset(self) -> Offset:
        start = self.at if self.at is not None else self.initialOffset()
        runs, self.at = self._follow(start, self.max_pages)
        self.planned += runs
        return self.at

    def partitions(self, start: Offset, end: Offset) -> list[PageRun]:
        if self.at is None:
            self.at = end
        if start["seq"] >= end["seq"]:
            return []
        runs = [r for r in self.planned if start["seq"] <= r.offset["seq"] < end["seq"]]
        if not runs or runs[0].offset != start:
            runs, _ = self._follow(start, last_seq=end["seq"])
        if sum(r.changes for r in runs) != end["seq"] - start["seq"]:
            raise ValueError(f"the feed no longer holds the changes from {start} to {end}")
        return runs

    def read(self, partition: PageRun) -> Rows:
        left, at = partition.changes, partition.offset
        for changes, after in self.source.pages(at):
            yield from _number(changes[:left], at["seq"])
            left, at = left - len(changes), after
            if left <= 0:
                return
        raise ValueError(f"the feed no longer holds {partition.changes} changes after {partition.offset}")

    def commit(self, end: Offset) -> None:
        self.planned = [r for r in self.planned if r.offset["seq"] >= end["seq"]]


class ChangeApiBatch(DataSourceReader):
    """The whole feed from ``start_token``; pages are passed on as they come."""

    def __init__(self, source: ChangeApi):
        self.source = source

    def read(self, partition: InputPartition) -> Rows:
        at = start_of(self.source.options)
        for changes, after in self.source.pages(at):
            yield from _number(changes, at["seq"])
            at = after


def saved_page(options: dict, token: str) -> dict:
    """The page that was saved for a token below ``path``."""
    try:
        return json.loads(open_folder(options["path"]).read(_saved_name(token)))
    except FileNotFoundError:
        return {}


def _saved_name(token: str) -> str:
    return f"after={token.encode().hex().upper() or 'start'}"


class SavedChangeApi(ChangeApi):
    """Pages saved by ``save_pages``, one file per token, as a change API would give them."""

    fetch_page = staticmethod(saved_page)

    @classmethod
    def name(cls) -> str:
        return "saved_change_api"


def save_pages(pages: DataFrame, tokens: DataFrame, path: str) -> None:
    """Write pages of (page_no, body) by the token that leads to them (in hex), the first by none.
    Tasks write the files themselves, since a commit by the driver would move them one by one.

    ``tokens`` come from ``page_tokens``. Page numbers count from 0 without gaps.
    """
    leads = tokens.where("has_more").select((F.col("page_no") + 1).alias("page_no"), F.hex(F.col("next_token").cast("binary")).alias("after"))
    found = pages.join(leads, "page_no", "left").select(F.concat(F.lit("after="), F.coalesce("after", F.lit("start"))).alias("name"), "body")

    def save(rows: Iterator) -> None:
        folder = open_folder(path)
        for name, bodies in itertools.groupby(rows, lambda row: row.name):
            folder.write(name, "".join(f"{row.body or ''}\n" for row in bodies))

    found.repartition("name").sortWithinPartitions("name").foreachPartition(save)
