import os
import time

import pytest
from py4j.protocol import Py4JJavaError

from test_streaming import land, source, wires
from tuplefeed.operators import changelog
from tuplefeed.streaming import streams
from tuplefeed.streaming.supervise import Supervisor, read_errors


class Sink:
    """A changelog whose batches fail as often as ``failures`` says, after they were written."""

    def __init__(self, spark, folder, tmp_path, failures, **options):
        self.spark, self.folder, self.failures, self.options = spark, folder, failures, options
        self.path, self.checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def start(self):
        def append(batch, events, batch_id):
            changelog.append_changelog(changelog.changelog_rows(events), self.path, batch_id, "s")
            if self.failures.get(batch_id, 0):
                self.failures[batch_id] -= 1
                raise OSError(f"no room for batch {batch_id}")

        return streams.sync(source(self.spark, self.folder), append, self.checkpoint, **self.options)

    def ids(self):
        return sorted(r.id for r in changelog.read_changelog(self.spark, self.path).collect())


@pytest.fixture
def landed(spark, tmp_path):
    texts = wires(50)
    folder = str(tmp_path / "feed")
    for part, (low, high) in enumerate([(0, 20), (20, 30), (30, 50)]):
        land(spark, folder, texts[low:high], low, part)
    return folder, texts


def test_a_failed_batch_is_read_again(spark, landed, tmp_path):
    folder, _ = landed
    errors = str(tmp_path / "errors")
    assert read_errors(spark, errors).count() == 0
    sink = Sink(spark, folder, tmp_path, {0: 2, 2: 3})
    keeper = Supervisor(spark, sink.start, errors, "log", first_pause=0.01, longest_pause=0.03)
    keeper.run()
    assert sink.ids() == list(range(50))
    rows = read_errors(spark, errors).orderBy("failure").collect()
    # Batches 0 and 1 get through before batch 2 fails: pauses begin anew.
    assert [(r.failure, r.in_a_row, r.pause_s) for r in rows] == [
        (1, 1, 0.01), (2, 2, 0.02), (3, 1, 0.01), (4, 2, 0.02), (5, 3, 0.03),
    ]
    assert all(r.stream == "log" and "no room for batch" in r.error for r in rows)


def test_it_gives_up_only_when_told(spark, landed, tmp_path):
    folder, _ = landed
    sink = Sink(spark, folder, tmp_path, {1: 99})
    keeper = Supervisor(spark, sink.start, str(tmp_path / "errors"), first_pause=0.01, most_in_a_row=3)
    with pytest.raises(Exception, match="no room for batch 1"):
        keeper.run()
    assert keeper.failures == 3
    sink.failures.clear()
    keeper.run()
    assert sink.ids() == list(range(50))


def test_a_query_that_cannot_start_is_tried_again(spark, landed, tmp_path):
    folder, _ = landed
    sink, missing = Sink(spark, folder, tmp_path, {}), [ValueError("not yet")]

    def start():
        if missing:
            raise missing.pop()
        return sink.start()

    Supervisor(spark, start, str(tmp_path / "errors"), first_pause=0.01).run()
    assert sink.ids() == list(range(50))


def test_a_polling_stream_goes_on_in_a_thread(spark, landed, tmp_path):
    folder, texts = landed
    sink = Sink(spark, folder, tmp_path, {0: 1, 3: 1}, poll_interval="200 milliseconds")
    keeper = Supervisor(spark, sink.start, str(tmp_path / "errors"), first_pause=0.01).start()

    def wait_for(count):
        for _ in range(300):
            try:
                if os.path.exists(sink.path) and keeper.query is not None and len(sink.ids()) >= count:
                    return
            except Py4JJavaError as error:  # files of a batch that is written again meanwhile
                if "FILE_NOT_EXIST" not in str(error):
                    raise
            time.sleep(0.1)
        raise AssertionError(f"{count} rows did not come, {keeper.error}")

    try:
        wait_for(50)
        land(spark, folder, texts[:5], 50, 3)
        wait_for(55)
        for _ in range(100):
            if keeper.failures == 2:
                break
            time.sleep(0.1)
    finally:
        keeper.stop(60)
    assert (keeper.failures, keeper.error, sink.ids()) == (2, None, list(range(55)))
    assert not any(q.isActive for q in spark.streams.active)


def test_a_long_pause_can_be_ended(spark, landed, tmp_path):
    folder, _ = landed
    sink = Sink(spark, folder, tmp_path, {0: 99})
    keeper = Supervisor(spark, sink.start, str(tmp_path / "errors"), first_pause=600).start()
    for _ in range(300):
        if keeper.failures:
            break
        time.sleep(0.1)
    began = time.monotonic()
    keeper.stop(30)
    assert keeper.failures == 1 and time.monotonic() - began < 30
