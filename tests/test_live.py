import json

import pytest
from pyspark.sql import functions as F

from tuplefeed.operators.parse import parse_feed
from tuplefeed.sources import live
from tuplefeed.sources.feed import page_tokens
from tuplefeed.sources.live import ChangeApi, ChangeApiStream, SavedChangeApi, save_pages


def local_page(options, token):
    """Pages of three changes out of a file, in place of the network."""
    with open(options["file"]) as lines:
        changes = [json.loads(line) for line in lines]
    first = int(token or 0)
    page = changes[first : first + 3]
    more = first + 3 < len(changes)
    return {"changes": page, "continuation_token": str(first + 3) if more else ""}


class LocalApi(ChangeApi):
    fetch_page = staticmethod(local_page)

    @classmethod
    def name(cls):
        return "local_change_api"


def write(path, count):
    with open(path, "w") as out:
        for i in range(count):
            out.write(json.dumps({"operation": "WRITE", "tuple_key": {"user": f"u:{i}", "object": "o:1"}}) + "\n")


def users(df):
    return [(r.seq, r.user_id) for r in df.orderBy("seq").select("seq", "user_id").collect()]


def test_batch(spark, tmp_path):
    write(tmp_path / "feed", 8)
    spark.dataSource.register(LocalApi)
    feed = spark.read.format("local_change_api").option("file", str(tmp_path / "feed")).load()
    assert users(parse_feed(feed)) == [(i, str(i)) for i in range(8)]


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    spark.dataSource.register(LocalApi)
    path, out = tmp_path / "feed", str(tmp_path / "out")
    for count in (7, 7, 9, 16):
        write(path, count)
        feed = (
            spark.readStream.format("local_change_api")
            .option("file", str(path)).option("max_pages", "2").option("polled", "true").load()
        )
        query = (
            parse_feed(feed, F.lit("2024-01-01").cast("timestamp"))
            .writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(processingTime="0 seconds").start()
        )
        query.processAllAvailable()
        query.stop()
        assert users(spark.read.parquet(out)) == [(i, str(i)) for i in range(count)]


def test_stream_that_stops_reads_the_whole_feed(spark, tmp_path):
    spark.dataSource.register(LocalApi)
    path, out = tmp_path / "feed", str(tmp_path / "out")
    write(path, 16)
    feed = spark.readStream.format("local_change_api").option("file", str(path)).load()
    query = feed.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 16
    with pytest.raises(ValueError, match="polled"):
        ChangeApiStream(LocalApi({"file": str(path), "max_pages": "2"}))


def test_a_start_token_needs_its_position(spark, tmp_path):
    spark.dataSource.register(LocalApi)
    write(tmp_path / "feed", 8)
    reader = spark.read.format("local_change_api").option("file", str(tmp_path / "feed")).option("start_token", "3")
    with pytest.raises(Exception, match="start_seq"):
        reader.load().collect()
    assert users(parse_feed(reader.option("start_seq", "3").load())) == [(i, str(i)) for i in range(3, 8)]


def test_tasks_fetch_the_pages_of_a_batch(spark, tmp_path):
    """Runs of pages that the driver plans, and the same ones planned anew after a restart."""
    path = tmp_path / "feed"
    write(path, 22)
    options = {"file": str(path), "pages_per_task": "2", "max_pages": "5", "polled": "true"}
    reader = ChangeApiStream(LocalApi(options))
    start = reader.initialOffset()
    middle = reader.latestOffset()
    end = reader.latestOffset()
    assert (middle["seq"], end["seq"], reader.latestOffset()) == (15, 22, end)
    runs = reader.partitions(start, middle)
    assert [(r.offset["seq"], r.changes) for r in runs] == [(0, 6), (6, 6), (12, 3)]
    assert [seq for r in runs + reader.partitions(middle, end) for seq, _ in reader.read(r)] == list(range(22))
    reader.commit(middle)
    assert all(r.offset["seq"] >= 15 for r in reader.planned)
    write(path, 30)
    anew = ChangeApiStream(LocalApi(options))
    again = anew.partitions(middle, end)
    assert [seq for r in again for seq, _ in anew.read(r)] == list(range(15, 22))
    last = anew.latestOffset()
    assert [seq for r in anew.partitions(end, last) for seq, _ in anew.read(r)] == list(range(22, 30))
    assert anew.partitions(last, last) == []
    write(path, 20)
    with pytest.raises(ValueError, match="no longer holds"):
        list(anew.read(again[-1]))
    with pytest.raises(ValueError, match="no longer holds"):
        ChangeApiStream(LocalApi(options)).partitions(middle, end)


def test_saved_pages(spark, tmp_path):
    bodies = [(0, [1, 2], "a/b"), (1, [3], ""), ]
    rows = [(n, json.dumps({"changes": [{"tuple_key": {"user": f"u:{c}"}} for c in of], "continuation_token": t})) for n, of, t in bodies]
    pages = spark.createDataFrame(rows, "page_no BIGINT, body STRING")
    path = f"file:{tmp_path}/saved"
    save_pages(pages, page_tokens(pages), path)
    spark.dataSource.register(SavedChangeApi)
    feed = spark.read.format("saved_change_api").option("path", path).load()
    assert users(parse_feed(feed)) == [(0, "1"), (1, "2"), (2, "3")]


def test_long_batches_have_longer_runs(spark, tmp_path, monkeypatch):
    """The number of tasks of a batch is bounded, whatever its number of pages."""
    monkeypatch.setattr(live, "MAX_RUNS", 4)
    path = tmp_path / "feed"
    write(path, 100)  # 34 pages
    reader = ChangeApiStream(LocalApi({"file": str(path), "pages_per_task": "2"}))
    start, end = reader.initialOffset(), reader.latestOffset()
    runs = reader.partitions(start, end)
    assert [(r.offset["seq"], r.changes) for r in runs] == [(0, 48), (48, 48), (96, 4)]
    assert [seq for r in runs for seq, _ in reader.read(r)] == list(range(100))
    assert ChangeApiStream(LocalApi({"file": str(path), "pages_per_task": "2"})).partitions(start, end) == runs


def test_two_pages_after_one_token_are_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(0, '{"changes":[{}]}'), (None, '{"changes":[{}]}')], "page_no BIGINT, body STRING")
    save_pages(pages, page_tokens(pages), f"{tmp_path}/saved")
    assert (tmp_path / "saved" / "after=start").read_text().count("changes") == 2
    with pytest.raises(json.JSONDecodeError):
        live.saved_page({"path": f"{tmp_path}/saved"}, "")
    assert live.saved_page({"path": f"{tmp_path}/saved"}, "x") == {}
