import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, event, events_of, feed_of, with_page
from tuplefeed.operators.ordering import block_of, dense_position, prefix_sums
from tuplefeed.operators.parse import parse_changes
from tuplefeed.sources import feed as source


def test_block_of_is_exact_for_large_positions(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big,)], "n BIGINT")
    assert df.select(block_of(F.col("n"), 3)).first()[0] == big // 3


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_prefix_sums(spark, block):
    rng = random.Random(block)
    keys = rng.sample(range(200), 60)
    rows = [(k, rng.randrange(10)) for k in keys]
    df = spark.createDataFrame(rows, "k BIGINT, v BIGINT")
    for row in prefix_sums(df, "k", "v", block).collect():
        assert row.before == sum(v for k, v in rows if k < row.k)


@pytest.mark.parametrize("gap", [1, 1 << 31, 1 << 50])
def test_dense_position(spark, gap):
    seqs = [s * gap for s in random.Random(gap).sample(range(5_000), 300)]
    df = spark.createDataFrame([(s, str(s)) for s in seqs], "seq BIGINT, name STRING").repartition(5)
    got = {r.seq: (r.position, r.name) for r in dense_position(df, "seq", "position").collect()}
    assert got == {s: (i, str(s)) for i, s in enumerate(sorted(seqs))}


def test_sparse_positions_are_dealt_by_rows(spark, tmp_path):
    seqs = [i if i < 1000 else i << 40 for i in range(2000)]  # half dense, half with gaps
    df = spark.createDataFrame([(s,) for s in seqs], "seq BIGINT").repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = dense_position(df)
        assert sorted(r.position for r in placed.collect()) == list(range(2000))
        shares = placed.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in shares) < 1200


def test_following_tokens_gives_the_pages(spark):
    wires = [json.dumps({"n": i}) if i % 7 else "broken" for i in range(53)]
    feed = feed_of(spark, wires).withColumn("seq", F.col("seq") * 3 + 5).cache()
    pages = {}
    for row in source.paginate(feed, 10).collect():
        pages.setdefault(row.page_no, {})[row.pos] = row.seq
    summary = {r.page_no: r for r in source.page_summary(feed, 10).collect()}
    token, page_no = source.START, 0
    while True:
        page = [r.seq for r in source.read_page(feed, token, 10).collect()]
        assert pages[page_no] == dict(enumerate(page))
        good = sum(1 for s in page if ((s - 5) // 3) % 7)
        assert (summary[page_no].processed, summary[page_no].total_fetched) == (good, len(page))
        if not summary[page_no].has_more:
            break
        token, page_no = summary[page_no].next_token, page_no + 1
        assert token == str(page[-1])
    assert summary[page_no].next_token == ""
    assert page_no == max(pages) == 5
    feed.unpersist()


def test_page_summary_of_a_last_full_page(spark):
    rows = source.page_summary(feed_of(spark, ["{}"] * 20), 10).orderBy("page_no").collect()
    assert [(r.total_fetched, r.has_more) for r in rows] == [(10, True), (10, False)]


def test_resume(spark):
    feed = feed_of(spark, ["{}"] * 10)
    assert source.resume(feed).count() == 10
    assert sorted(r.seq for r in source.resume(feed, "6").collect()) == [7, 8, 9]
    assert source.resume(feed, F.lit("")).count() == 10
    assert source.resume(feed, F.lit("8")).count() == 1
    with pytest.raises(Exception, match="no feed token: x"):
        source.resume(feed, F.lit("x")).collect()
    with pytest.raises(ValueError):
        source.resume(feed, "x")


def test_pages_of_changes(spark):
    def body(changes, **more):
        return json.dumps({"changes": changes, **more})

    change = {"operation": "WRITE", "tuple_key": {"user": "u:1", "relation": "r", "object": "o:1"}}
    pages = spark.createDataFrame(
        [
            (0, body([change, "junk", {**change, "operation": "DELETE"}], continuation_token="t1")),
            (1, body([])),
            (2, body([change], continuation_token="")),
            (3, "no json"),
            (4, '{"changes":{"a":1}}'),
            (5, '{"changes":[null,[1]]}'),
        ],
        "page_no BIGINT, body STRING",
    )
    events = parse_changes(source.decode_pages(pages, 10)).orderBy("seq").collect()
    assert [(r.seq, r.page_no, r.pos, r.operation) for r in events] == [
        (0, 0, 0, "WRITE"), (2, 0, 2, "DELETE"), (20, 2, 0, "WRITE"),
    ]
    tokens = {r.page_no: (r.next_token, r.has_more) for r in source.page_tokens(pages).collect()}
    assert tokens == {0: ("t1", True), **{p: ("", False) for p in (1, 2, 4, 5)}}
    assert [r.page_no for r in source.rejects(pages, "body").collect()] == [3]
    assert sorted((tuple(r) for r in source.page_item_rejects(pages).collect()), key=str) == [
        (0, 1, '"junk"'), (4, None, '{"a":1}'), (5, 0, "null"), (5, 1, "[1]"),
    ]
    with pytest.raises(Exception, match="page_rows=2"):
        source.decode_pages(pages, 2).collect()


@pytest.mark.parametrize("cap", [0, 1, 3, 4, 11, 12, 13, 1000])
def test_fetch_all_and_since(spark, cap):
    rng = random.Random(5)
    rows = [
        event(s, "WRITE", ts=START + timedelta(seconds=rng.randrange(60)))
        for s in range(40) if rng.random() < 0.6 and not 10 <= s < 15
    ]
    events = with_page(events_of(spark, rows), 5)
    fetched, total = [], 0
    for page in range(8):
        if cap and total >= cap:
            break
        mine = [r for r in rows if r[0] // 5 == page]
        fetched += mine
        total += len(mine)
    assert sorted(r.seq for r in source.fetch_all(events, cap).collect()) == [r[0] for r in fetched]
    assert source.fetch_all(events, F.lit(cap)).count() == len(fetched)
    since = START + timedelta(seconds=30)
    got = source.changes_since(events, since, cap).collect()
    assert sorted(r.seq for r in got) == [r[0] for r in fetched if r[6] >= since]


def test_since_includes_the_bound(spark):
    events = with_page(events_of(spark, [event(0, "WRITE", ts=datetime(2024, 1, 1))]), 5)
    assert source.changes_since(events, datetime(2024, 1, 1)).count() == 1


def test_token_filter_reaches_the_scan(spark, tmp_path):
    feed_of(spark, ["{}"] * 10).write.parquet(str(tmp_path / "feed"))
    feed = source.read_feed(spark, str(tmp_path / "feed"))
    plan = source.resume(feed, "3")._jdf.queryExecution().toString()
    assert "GreaterThan(seq,3)" in plan
