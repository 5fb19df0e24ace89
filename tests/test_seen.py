import random

import pytest


from test_streaming import land, source, wires
from tuplefeed.operators import changelog
from tuplefeed.streaming import streams
from tuplefeed.streaming.seen import SeenPositions, merge_ranges, not_in, ranges_of


def rows(spark, positions):
    return spark.createDataFrame([(p, f"w{p}") for p in positions], "seq BIGINT, wire STRING")


def test_ranges(spark):
    found = ranges_of(rows(spark, [0, 1, 2, 2, 4, 7, 8, 9, 10, 25, -1, -3]), 8)
    assert {p for r in found.collect() for p in range(r.low, r.high + 1)} == {0, 1, 2, 4, 7, 8, 9, 10, 25, -1, -3}
    parts = spark.createDataFrame([(0, 1, 2), (0, 3, 3), (0, 2, 6), (0, 8, 9), (1, 12, 13), (1, 12, 12)], "block BIGINT, low BIGINT, high BIGINT")
    assert sorted(map(tuple, merge_ranges(parts).collect())) == [(0, 1, 6), (0, 8, 9), (1, 12, 13)]


def test_not_in_equals_a_set(spark):
    rng = random.Random(2)
    for _ in range(3):
        known, asked = rng.sample(range(200), 90), rng.sample(range(220), 60)
        fresh = not_in(rows(spark, asked), ranges_of(rows(spark, known), 16), 16)
        assert fresh.columns == ["seq", "wire"]
        assert sorted(map(tuple, fresh.collect())) == sorted((p, f"w{p}") for p in set(asked) - set(known))


@pytest.mark.parametrize("merge_every", [1, 2, 50])
def test_batches(spark, tmp_path, merge_every):
    """Gaps, repeats within a batch and of any age, and a batch that runs twice."""
    rng = random.Random(merge_every)
    table, known = SeenPositions(spark, str(tmp_path / "seen"), 16, merge_every), set()
    for batch in range(5):
        positions = rng.choices(range(batch * 10, 120), k=40)
        for _ in range(2):
            got = sorted(r.seq for r in table.fresh(rows(spark, positions), batch).collect())
            assert got == sorted(set(positions) - known)
        known |= set(positions)
    assert {p for r in table.before(5).collect() for p in range(r.low, r.high + 1)} == known


def test_a_repeat_three_batches_later_is_dropped(spark, tmp_path):
    folder, texts = str(tmp_path / "feed"), wires(40)
    for part, (low, high) in enumerate([(0, 10), (10, 20), (20, 30), (0, 15), (25, 40)]):
        land(spark, folder, texts[low:high], low, part)
    path, side = str(tmp_path / "log"), str(tmp_path / "side")
    streams.finish(streams.sync_changelog(source(spark, folder), path, str(tmp_path / "c"), side=side, seen=str(tmp_path / "seen")))
    assert sorted(r.id for r in changelog.read_changelog(spark, path).collect()) == list(range(40))
    assert [r.processed for r in streams.read_reports(spark, side).orderBy("batch_id").collect()] == [10, 10, 10, 15, 15]


def test_not_in_leaves_one_row_per_position(spark):
    """Null positions are one position; rows come in one pass and are kept for the next ones."""
    asked = spark.createDataFrame([(p, f"w{p}") for p in [3, 3, 4, 17, 17, 17, 40, None, None]], "seq BIGINT, wire STRING")
    known = ranges_of(rows(spark, [4, 5, 40]), 16)
    assert sorted(r.seq for r in not_in(asked, known, 16).collect() if r.seq) == [3, 3, 17, 17, 17]
    once = not_in(asked, known, 16, distinct=True)
    assert sorted(map(str, once.collect())) == sorted(map(str, asked.distinct().where("seq IS NULL OR seq IN (3, 17)").collect()))
    assert "Aggregate" not in once.select("seq", "wire")._jdf.queryExecution().optimizedPlan().toString().split("LeftSemi")[0]


def test_what_is_left_is_kept(spark, tmp_path):
    fresh = SeenPositions(spark, str(tmp_path / "seen")).fresh(rows(spark, [1, 2, 2]), 0)
    assert fresh.is_cached and fresh.count() == 2
    fresh.unpersist()
