"""The feed in parts as it lands for streams."""

from pathlib import Path

from tuplefeed.sources import derived


def test_landed_parts_are_in_files_that_many_tasks_can_read(spark, tmp_path, monkeypatch):
    """The events are one row group, but a part has a file for so many rows."""
    monkeypatch.setattr(derived, "LANDED_ROWS", 100, raising=False)
    rows = [(i, None, i % 7, "view" if i % 2 else None, 1.0, '{"k": 1}') for i in [*range(899), 898, 898]] + [(None, None, 1, "click", 1.0, None)]
    events = spark.createDataFrame(rows, derived.EVENTS_SCHEMA)
    events.coalesce(1).write.parquet(f"{tmp_path}/sf/events.parquet")
    for batch in range(derived.BATCHES):
        derived.land(spark, f"{tmp_path}/sf", f"{tmp_path}/landed", batch)
        files = list(Path(f"{tmp_path}/landed/part={batch}").glob("*.parquet"))
        assert len(files) >= 3
        assert max(spark.read.parquet(str(f)).count() for f in files) <= 150
    landed = spark.read.parquet(f"{tmp_path}/landed").select("seq", "wire")
    expected = derived.to_feed(events).where("seq IS NOT NULL")
    assert landed.exceptAll(expected).count() == expected.exceptAll(landed).count() == 0


def test_an_empty_part_is_still_one_batch(spark, tmp_path):
    spark.createDataFrame([(5, None, 1, "click", 1.0, None)], derived.EVENTS_SCHEMA).write.parquet(f"{tmp_path}/sf/events.parquet")
    for batch in range(derived.BATCHES):
        derived.land(spark, f"{tmp_path}/sf", f"{tmp_path}/landed", batch)
        assert len(list(Path(f"{tmp_path}/landed/part={batch}").glob("*.parquet"))) == 1
    assert spark.read.parquet(f"{tmp_path}/landed").count() == 1
