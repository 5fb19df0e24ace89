import json
import os
import random
import time

import pytest

from helpers import event, events_of, feed_of, random_events, replay, state_dict, wire
from tuplefeed.operators import changelog, dedupe, replicate, state
from tuplefeed.operators.parse import parse_feed, parse_pages
from tuplefeed.sources.feed import read_page_files, stream_feed
from tuplefeed.streaming import streams
from tuplefeed.streaming.counts import TupleCounts
from tuplefeed.streaming.state_table import StateTable



def wires(n, seed=0):
    rows = random_events(seed, n)
    return [
        wire(r[8], "user:u", "viewer", f"doc:{r[2]}", condition=json.loads(r[7]) if r[7] else None) for r in rows
    ]


def land(spark, folder, texts, first, part):
    """One file of the feed; files are read in the order of their times."""
    path = f"{folder}/part={part}"
    feed_of(spark, texts, first).coalesce(1).write.parquet(path)
    for name in os.listdir(path):
        stamp = time.time() - 1000 + part
        os.utime(os.path.join(path, name), (stamp, stamp))


@pytest.fixture
def landed(spark, tmp_path):
    texts = wires(120)
    texts[50] = "broken"
    folder = str(tmp_path / "feed")
    for part, (low, high) in enumerate([(0, 40), (40, 60), (60, 120)]):
        land(spark, folder, texts[low:high], low, part)
    return folder, texts


def source(spark, folder):
    return stream_feed(spark, f"{folder}/*", max_files=1)


def batch_events(spark, texts):
    return parse_feed(feed_of(spark, texts))


def test_changelog(spark, landed, tmp_path):
    folder, texts = landed
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    side = str(tmp_path / "side")
    query = streams.finish(streams.sync_changelog(source(spark, folder), path, checkpoint, side=side))
    assert [r.input_rows for r in streams.progress(spark, query).collect() if r.input_rows] == [40, 20, 60]
    reports = streams.read_reports(spark, side).orderBy("batch_id").collect()
    assert [(r.processed, r.rejected, r.total_fetched) for r in reports] == [(40, 0, 40), (19, 1, 20), (60, 0, 60)]
    assert all(r.duration_s > 0 and r.lag_seconds > 0 for r in reports)
    rejected = streams.read_rejects(spark, side).select("batch_id", "position", "pos", "text")
    assert [tuple(r) for r in rejected.collect()] == [(1, 50, None, "broken")]
    table = changelog.read_changelog(spark, path).drop("event_date", "created_at")
    expected = changelog.changelog_rows(batch_events(spark, texts)).drop("created_at")
    assert sorted(table.collect()) == sorted(expected.collect())
    streams.finish(streams.sync_changelog(source(spark, folder), path, checkpoint))
    assert changelog.read_changelog(spark, path).count() == 119
    land(spark, folder, texts[:10], 120, 3)
    streams.finish(streams.sync_changelog(source(spark, folder), path, checkpoint))
    assert changelog.read_changelog(spark, path).count() == 129


@pytest.mark.parametrize("merge_every", [1, 2, 10])
def test_state(spark, landed, tmp_path, merge_every):
    folder, texts = landed
    path, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    streams.finish(
        streams.sync_state(source(spark, folder), path, checkpoint, buckets=4, merge_every=merge_every)
    )
    table = StateTable(spark, path, 4)
    assert table.latest_version() == 2
    assert state_dict(table.read()) == state_dict(state.fold(batch_events(spark, texts)))
    assert state_dict(table.read(0)) == state_dict(state.fold(batch_events(spark, texts[:40])))
    streams.finish(streams.sync_state(source(spark, folder), path, checkpoint, buckets=4))
    assert table.latest_version() == 2
    with pytest.raises(Exception, match="another stream"):
        streams.finish(streams.sync_state(source(spark, folder), path, str(tmp_path / "new"), buckets=4))


@pytest.mark.parametrize("merge_every", [1, 2, 10])
def test_state_table_versions(spark, tmp_path, merge_every):
    table = StateTable(spark, str(tmp_path / "state"), 3, merge_every)
    assert table.latest_version() is None
    rows = random_events(4, 90, keys=12)
    parts = [rows[:30], rows[30:31], rows[31:]]
    for batch, part in enumerate(parts):
        table.apply(events_of(spark, part), batch)
        if batch == 1:
            table.apply(events_of(spark, part), batch)
    done = []
    for batch, part in enumerate(parts):
        done += part
        assert state_dict(table.read(batch)) == replay(done)
    table.apply(events_of(spark, [(10_000 + i, *key[1:6], key[6], None, "DELETE") for i, key in enumerate(rows)]), 3)
    assert table.read().count() == 0
    table.apply(events_of(spark, [event(20_000, "NOOP")]), 4)
    assert table.read().count() == 0
    table.apply(events_of(spark, [event(20_001, "WRITE", "back")]), 5)
    assert [r.object_id for r in table.read().collect()] == ["back"]


@pytest.mark.parametrize("merge_every", [1, 10])
def test_a_late_batch_applies_when_it_arrives(spark, tmp_path, merge_every):
    table = StateTable(spark, str(tmp_path / "state"), 3, merge_every)
    rows = random_events(9, 90, keys=12)
    order = [rows[:20], rows[40:60], rows[20:40], rows[60:]]
    applied = {}
    for batch, part in enumerate(order):
        table.apply(events_of(spark, part), batch)
        applied = replay(part, applied)
        assert state_dict(table.read()) == applied


def test_a_small_batch_spares_most_of_the_state(spark, tmp_path):
    path = tmp_path / "state"
    table = StateTable(spark, str(path), 16, merge_every=1, small=0)
    rows = [event(i, "WRITE", f"k{i}") for i in range(4000)]
    table.apply(events_of(spark, rows), 0)
    done, rng = rows, random.Random(7)
    size = lambda v: sum(f.stat().st_size for k in ("data", "pending") for f in (path / k / f"version={v}").rglob("*.parquet"))
    rewritten = []
    for batch in range(1, 7):
        part = [event(4000 * batch + i, rng.choice(["WRITE", "DELETE"]), f"k{rng.randrange(4000)}") for i in range(80 if batch > 1 else 40)]
        table.apply(events_of(spark, part), batch)
        done = done + part
        assert state_dict(table.read()) == replay(done)
        rewritten.append(len(list((path / "data" / f"version={batch}").glob("bucket=*"))))
    assert rewritten[0] == 0 and size(1) < size(0) / 10
    assert 0 < sum(rewritten) < 2 * 16
    expected = state_dict(table.read(4))
    hot = [event(40_000 + i, "WRITE", f"k{i}") for i in range(1000)]
    table.apply(events_of(spark, hot), 7)
    late = [event(5, "DELETE", "k6"), event(6, "WRITE", "k7")]
    table.apply(events_of(spark, late), 8)
    assert state_dict(table.read()) == replay(late, replay(done + hot))
    assert table.remove_versions(4) > 0 and state_dict(table.read(4)) == expected
    assert table.remove_versions(8) > 0 and not list((path / "pending").glob("version=*"))
    assert state_dict(table.read()) == replay(late, replay(done + hot))


def test_another_stream_is_refused_and_old_versions_go(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), 3, merge_every=1)
    rows = random_events(4, 60, keys=12)
    for batch in range(6):
        table.apply(events_of(spark, rows[10 * batch : 10 * batch + 10]), batch, stream="a")
    with pytest.raises(ValueError, match="another stream"):
        table.apply(events_of(spark, rows[:1]), 0, stream="b")
    other = StateTable(spark, str(tmp_path / "one"), 3)
    other.apply(events_of(spark, rows[:10]), 0, stream="a")
    with pytest.raises(ValueError, match="another stream"):
        other.apply(events_of(spark, rows[10:11]), 0, stream="b")
    assert StateTable(spark, str(tmp_path / "state"), 99).read().count() == len(replay(rows))
    assert table.remove_versions(5) > 5
    assert state_dict(table.read()) == state_dict(table.read(5)) == replay(rows)
    assert sorted(p.name for p in (tmp_path / "state/versions").iterdir() if "=" in p.name and not p.name.endswith("crc")) == ["version=5"]


def test_delivery_goes_on_after_a_refusal(spark, landed, tmp_path):
    folder, texts = landed
    target, broken = str(tmp_path / "target"), tmp_path / "broken"

    def send(body):
        import os

        if os.path.exists(str(broken)) and '"doc:hot"' in body:
            raise OSError("refused")
        with open(target, "a") as out:
            out.write(body + "\n")

    broken.touch()
    arguments = (str(tmp_path / "requests"), str(tmp_path / "checkpoint"))

    def sync():
        return streams.sync_requests(source(spark, folder), *arguments, batch_size=2, send=send, log=str(tmp_path / "log"), tries=2)

    with pytest.raises(Exception, match="could not be delivered"):
        streams.finish(sync())
    broken.rename(tmp_path / "mended")
    streams.finish(sync())
    made = [r.body for r in spark.read.parquet(str(tmp_path / "requests")).collect()]
    assert sorted(line.rstrip("\n") for line in open(target)) == sorted(made)
    log = streams.delivery_log(spark, str(tmp_path / "log"))
    assert log.where("delivered").count() == len(made)
    assert {r["try"] for r in log.where("NOT delivered").collect()} == {0, 1}


def test_late_changes_are_no_repeats(spark, tmp_path):
    folder, out = str(tmp_path / "feed"), str(tmp_path / "out")
    old = wire("WRITE", "user:u", "viewer", "doc:old", ts="1999-01-01T00:00:00Z")
    land(spark, folder, wires(5), 0, 0)
    land(spark, folder, [old, wire("WRITE", "user:u", "viewer", "doc:now", ts=None)], 5, 1)
    land(spark, folder, [old, old], 7, 2)
    events = dedupe.drop_repeats_within(parse_feed(source(spark, folder)), "1 minute")
    writer = events.select("seq").writeStream.format("parquet").option("path", out)
    streams.finish(writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(9))


def test_long_pages_need_only_a_number(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "2024-page-1.json").write_text(json.dumps({"changes": [json.loads(t) for t in wires(1001)]}))
    stream = read_page_files(spark, str(folder), stream=True)
    with pytest.raises(Exception, match="page_rows=1000"):
        streams.finish(streams.sync_changelog(stream, str(tmp_path / "a"), str(tmp_path / "ca")))
    streams.finish(streams.sync_changelog(stream, str(tmp_path / "b"), str(tmp_path / "cb"), page_rows=2000))
    assert changelog.read_changelog(spark, str(tmp_path / "b")).count() == 1001
    (folder / "2024-page-2.json").write_text("{}")
    assert sorted(r.page_no for r in read_page_files(spark, str(folder)).collect()) == [1, 2]
    (folder / "2025-page-02.json").write_text("{}")
    with pytest.raises(ValueError, match="page number 2"):
        read_page_files(spark, str(folder))


def test_a_page_number_comes_once(spark, tmp_path):
    """Two files of one number are an error in one batch, and in two batches of a stream that was restarted."""

    def page(name, seconds):
        path = tmp_path / "pages" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps({"changes": [json.loads(t) for t in wires(3)]}))
        os.utime(path, (time.time() - 1000 + seconds,) * 2)

    def run(name):
        stream = read_page_files(spark, str(tmp_path / "pages"), stream=True)
        streams.finish(streams.sync_changelog(stream, str(tmp_path / name), str(tmp_path / f"c{name}")))

    page("p-7.json", 0)
    page("p-8.json", 1)
    run("a")
    page("p-007.json", 2)
    for name in ("a", "b"):
        with pytest.raises(Exception, match="page number 7 comes twice"):
            run(name)
    assert changelog.read_changelog(spark, str(tmp_path / "a")).count() == 6


def test_streams_leave_no_folders_behind(spark, landed, tmp_path):
    folder, _ = landed
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    streams.finish(streams.sync_requests(source(spark, folder), str(tmp_path / "requests"), str(tmp_path / "c"), batch_size=7))
    assert set(os.listdir(shared)) == before
    assert spark.read.parquet(str(tmp_path / "requests")).count() > 10


def test_run_log_keeps_every_batch(spark, landed, tmp_path):
    folder, _ = landed
    path = str(tmp_path / "runs")
    listener = streams.RunLog(spark, path)
    spark.streams.addListener(listener)
    try:
        streams.finish(streams.sync_changelog(source(spark, folder), str(tmp_path / "log"), str(tmp_path / "c")))
        for _ in range(100):
            if os.path.exists(path) and len([n for n in os.listdir(path) if not n.startswith(".")]) >= 3:
                break
            time.sleep(0.2)
        time.sleep(1)
    finally:
        spark.streams.removeListener(listener)
    assert [r.input_rows for r in streams.read_run_log(spark, path).orderBy("batch_id").collect()][:3] == [40, 20, 60]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), 16, merge_every=1)
    table.apply(events_of(spark, [event(i, "WRITE", f"k{i}") for i in range(100)]), 0)
    table.apply(events_of(spark, [event(100, "WRITE", "k0")]), 1)
    written = [d for d in os.listdir(tmp_path / "state/data/version=1") if d.startswith("bucket=")]
    assert len(written) == 1
    assert table.read().count() == 100


def test_requests(spark, landed, tmp_path):
    folder, texts = landed
    path = str(tmp_path / "requests")
    streams.finish(
        streams.sync_requests(source(spark, folder), path, str(tmp_path / "checkpoint"), batch_size=7)
    )
    got = spark.read.parquet(path).select("batch_id", "chunk", "body").collect()
    expected = []
    for batch, (low, high) in enumerate([(0, 40), (40, 60), (60, 120)]):
        events = parse_feed(feed_of(spark, texts[low:high], low))
        made = replicate.bodies(replicate.requests(events, 7)).collect()
        expected += [(batch, r.chunk, r.body) for r in made]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_polling(spark, landed, tmp_path):
    folder, _ = landed
    query = streams.sync_changelog(
        source(spark, folder), str(tmp_path / "log"), str(tmp_path / "checkpoint"), poll_interval="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert changelog.read_changelog(spark, str(tmp_path / "log")).count() == 119


def test_repeats_in_a_stream(spark, tmp_path):
    folder = str(tmp_path / "feed")
    land(spark, folder, wires(20), 0, 0)
    land(spark, folder, wires(20), 10, 1)
    events = dedupe.drop_repeats_within(parse_feed(source(spark, folder)), "10 minutes")
    out = str(tmp_path / "out")
    writer = events.select("seq").writeStream.format("parquet").option("path", out)
    streams.finish(
        writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(30))


def test_page_files(spark, tmp_path):
    texts = wires(50)
    folder = tmp_path / "pages"
    folder.mkdir()
    for page in range(0, len(texts), 10):
        body = {"changes": [json.loads(t) for t in texts[page : page + 10]], "continuation_token": str(page)}
        path = folder / f"page-{page // 10:04}.json"
        path.write_text(json.dumps(body, indent=1))
        os.utime(path, (time.time() - 1000 + page,) * 2)
    pages = read_page_files(spark, str(folder))
    assert pages.count() == -(-len(texts) // 10)
    batch = state_dict(state.fold(parse_pages(pages, page_rows=10)))
    assert batch == state_dict(state.fold(batch_events(spark, texts)))
    stream = read_page_files(spark, str(folder), stream=True, max_files=2)
    path = str(tmp_path / "state")
    streams.finish(streams.sync_state(stream, path, str(tmp_path / "c1"), buckets=2))
    streamed = state_dict(StateTable(spark, path, 2).read())
    assert {k: v[:3] for k, v in streamed.items()} == {k: v[:3] for k, v in batch.items()}
    log = str(tmp_path / "log")
    streams.finish(streams.sync_changelog(stream, log, str(tmp_path / "c2")))
    assert changelog.read_changelog(spark, log).count() == len(texts)
    (folder / "page.json").write_text("{}")
    with pytest.raises(Exception, match="no page number"):
        read_page_files(spark, str(folder)).collect()


def test_counts_follow_the_state(spark, tmp_path):
    """After each batch, also one that runs twice, the numbers are those of the state there is."""
    table, counts = StateTable(spark, str(tmp_path / "state"), 3, merge_every=2), TupleCounts(spark, str(tmp_path / "counts"))
    assert counts.latest() == -1
    rows = [(r[0], f"t{i % 3}", *r[2:]) for i, r in enumerate(random_events(7, 120, keys=9))]
    done, effects = {}, 0
    for batch in range(6):
        part = rows[20 * batch : 20 * batch + 20]
        for _ in range(1 + batch % 2):
            table.apply(events_of(spark, part), batch)
            counts.add(table, batch)
        before, done = done, replay(part, done)
        got = {r.object_type: r for r in counts.read(batch).collect()}
        for name in ("t0", "t1", "t2"):
            assert got[name].tuples == sum(key[0] == name for key in done) == got[name].inserted - got[name].removed
        effects += len({k: v for k, v in done.items() if before.get(k) != v}) + len(before.keys() - done.keys())
        assert sum(r.inserted + r.updated + r.replaced + r.removed for r in got.values()) == effects
    assert counts.latest() == 5


def test_a_lookup_opens_only_the_folders_of_its_keys(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), 16, merge_every=2)
    for batch, low in enumerate((0, 100, 200)):
        table.apply(events_of(spark, [event(low + i, "WRITE", f"k{low + i}") for i in range(100)]), batch)
    keys = events_of(spark, [event(0, "WRITE", "k5"), event(0, "WRITE", "k250"), event(0, "WRITE", "none")])
    found = table.with_keys(keys)
    assert sorted(r.object_id for r in found.collect()) == ["k250", "k5"]
    assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "/data/" in f} < {str(b) for b in range(16)}
    assert len({f.rsplit("/", 1)[0] for f in found.inputFiles() if "/data/" in f}) <= 3
    assert [r.object_id for r in table.with_keys(keys, 0).collect()] == ["k5"]


@pytest.mark.parametrize("kept", [False, True])
def test_events_are_kept_only_for_more_passes(spark, tmp_path, monkeypatch, kept):
    """The changelog reads a batch once; with a side folder it is read again."""
    folder, cached = str(tmp_path / "feed"), []
    land(spark, folder, wires(10), 0, 0)

    def rows(events, created_at=None):
        cached.append(events.is_cached)
        return changelog.changelog_rows(events, created_at)

    monkeypatch.setattr(streams, "changelog_rows", rows)
    side = str(tmp_path / "side") if kept else None
    streams.finish(streams.sync_changelog(source(spark, folder), str(tmp_path / "log"), str(tmp_path / "c"), side=side))
    assert cached == [kept]
    assert changelog.read_changelog(spark, str(tmp_path / "log")).count() == 10
