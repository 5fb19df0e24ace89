from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import feed_of, plan, wire
from tuplefeed.operators import changelog, clustering
from tuplefeed.operators.parse import parse_feed

SIDE = 4  # values per column
START = datetime(2024, 3, 1)


def rows_of(spark, copies=80):
    wires = [
        wire("WRITE", f"u{c}:id{i}", f"r{b}", f"t{a}:id{i}", ts=(START + timedelta(days=d)).isoformat() + "Z")
        for i in range(copies) for d in range(SIDE) for c in range(SIDE) for b in range(SIDE) for a in range(SIDE)
    ]
    return changelog.changelog_rows(parse_feed(feed_of(spark, wires)))


def read_rows(found):
    """Rows that the scan returned, after row groups and pages were skipped."""
    kept = len(found.collect())
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return kept, scan.metrics().apply("numOutputRows").value()


def test_each_filter_skips_most_rows(spark, tmp_path):
    path, rows = str(tmp_path / "log"), rows_of(spark)
    clustering.write_clustered(rows, path, **{"parquet.block.size": "20000"})
    table, total = clustering.read_clustered(spark, path), rows.count()
    assert total == table.count() == 80 * SIDE**4
    day = START + timedelta(days=2)
    filters = [
        {"object_type": "t3"}, {"relation": "r1"}, {"user_type": "u2"},
        {"since": day, "until": day + timedelta(hours=23)},
    ]
    for given in filters:
        kept, read = read_rows(changelog.audit(table, **given))
        assert kept == total // SIDE and read < 0.6 * total, given
    kept, read = read_rows(changelog.audit(table, object_type="t3", relation="r1", user_type="u2"))
    assert kept == total // SIDE**3 and read < 0.15 * total
    assert "_curve" not in table.columns and "_place" not in plan(table)


def test_a_hot_place_is_cut_into_several_files(spark, tmp_path):
    rows = rows_of(spark, 3).withColumns({c: F.lit("same") for c in ("object_type", "relation", "user_type")})
    path = tmp_path / "log"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustering.write_clustered(rows.withColumn("ts", F.lit(START)), str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list(path.glob("part-*.parquet"))) == 4
    assert clustering.read_clustered(spark, str(path)).count() == 3 * SIDE**4


def test_nulls_and_no_rows(spark, tmp_path):
    path, rows = str(tmp_path / "log"), rows_of(spark, 3)
    some = rows.withColumn("relation", F.when(F.col("id") % 3 > 0, F.col("relation")))
    clustering.write_clustered(some, path)
    table = clustering.read_clustered(spark, path)
    assert sorted(r.id for r in table.collect()) == list(range(3 * SIDE**4))
    assert table.where("relation IS NULL").count() == SIDE**4
    clustering.write_clustered(rows.where("false"), path)
    assert clustering.read_clustered(spark, path).count() == 0


@pytest.mark.parametrize("places, want", [([0, 0], 0), ([1, 0], 2), ([0, 1], 1), ([2, 3], 13), ([255, 255], 65535)])
def test_curve(spark, places, want):
    columns = [F.lit(p).cast("bigint") for p in places]
    assert spark.range(1).select(clustering.curve(columns)).first()[0] == want
