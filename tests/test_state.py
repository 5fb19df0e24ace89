from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, event, events_of, plan, random_events, replay, state_dict
from tuplefeed.operators import state


def fold(spark, rows, **options):
    return state_dict(state.fold(events_of(spark, rows), **options))


def test_write_then_delete(spark):
    rows = [event(0, "WRITE", "a"), event(1, "WRITE", "b"), event(2, "DELETE", "a")]
    assert fold(spark, rows) == replay(rows)
    assert [k[1] for k in fold(spark, rows)] == ["b"]


def test_rewrite_replaces_the_condition_even_by_none(spark):
    rows = [event(0, "WRITE", "a", '{"name":"x"}'), event(1, "WRITE", "a", None)]
    [(key, value)] = fold(spark, rows).items()
    assert value == (None, START, START + timedelta(seconds=1), 1)


def test_delete_of_a_missing_key_and_new_creation(spark):
    rows = [event(0, "DELETE", "a"), event(1, "WRITE", "a"), event(2, "DELETE", "a"), event(3, "WRITE", "a")]
    [(_, value)] = fold(spark, rows).items()
    assert value[1] == START + timedelta(seconds=3)


def test_order_is_feed_order_not_time(spark):
    rows = [
        event(0, "WRITE", "a", '{"name":"x"}', START + timedelta(days=9)),
        event(1, "WRITE", "a", '{"name":"y"}', START),
    ]
    [(_, value)] = fold(spark, rows).items()
    assert value == ('{"name":"y"}', START + timedelta(days=9), START, 1)


def test_sink_vocabulary(spark):
    rows = [event(0, "WRITE", "a"), event(1, "TUPLE_OPERATION_WRITE", "b"), event(2, "DELETE", "b")]
    assert [k[1] for k in fold(spark, rows, vocab="sink")] == ["b"]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("segment_rows", [1, 4, 50, 1 << 18])
def test_fold_equals_replay(spark, seed, segment_rows):
    rows = random_events(seed, 250, gap=3)
    assert fold(spark, rows, segment_rows=segment_rows) == replay(rows)


@pytest.mark.parametrize("seed", range(3))
def test_batches_equal_one_fold(spark, seed):
    rows = random_events(seed, 120)
    cuts = [0, 1, 30, 31, 77, 120]
    current = spark.createDataFrame([], state.STATE_SCHEMA)
    for low, high in zip(cuts, cuts[1:]):
        current = state.apply_changes(current, events_of(spark, rows[low:high]))
        current = spark.createDataFrame(current.collect(), state.STATE_SCHEMA)
        assert state_dict(current) == replay(rows[:high])


def test_state_as_of(spark):
    rows = random_events(7, 100)
    events = events_of(spark, rows)
    for seq in (rows[0][0], rows[40][0], rows[-1][0]):
        assert state_dict(state.state_as_of(events, seq)) == replay([r for r in rows if r[0] <= seq])


def test_apply_counts(spark):
    rows = [event(0, "WRITE"), event(1, "WRITE"), event(2, "DELETE"), event(3, "DELETE"), event(4, "X")]
    [row] = state.apply_counts(events_of(spark, rows), []).collect()
    assert (row.inserts, row.deletes, row.skipped) == (2, 2, 1)


def test_row_effects(spark):
    before = state.fold(events_of(spark, [event(0, "WRITE", "a"), event(1, "WRITE", "b"), event(2, "WRITE", "c")]))
    batch = [
        event(3, "WRITE", "a"), event(4, "DELETE", "b"), event(5, "WRITE", "d"), event(6, "DELETE", "none"),
        event(7, "DELETE", "c"), event(8, "WRITE", "c"), event(9, "WRITE", "e"), event(10, "DELETE", "e"),
    ]
    [row] = state.row_effects(before, events_of(spark, batch)).collect()
    assert (row.inserted, row.updated, row.replaced, row.removed) == (1, 1, 1, 1)


def test_lookups(spark):
    current = state.fold(events_of(spark, [event(0, "WRITE", "a", '{"name":"x"}'), event(1, "WRITE", "b")]))
    assert state.lookup(current, object_type="doc", object_id="a").count() == 1
    with pytest.raises(ValueError):
        state.lookup(current, condition="x")
    keys = events_of(spark, [event(0, "WRITE", "b"), event(1, "WRITE", "z"), event(2, "WRITE", "b")])
    found = {r.object_id: r.found for r in state.lookup_many(current, keys).collect()}
    assert found == {"b": True, "z": False}
    assert [r.object_id for r in state.conditional_tuples(current).collect()] == ["a"]


def test_hot_key_is_combined_before_both_shuffles(spark):
    events = spark.range(0, 30_000, 1, 4).select(
        F.col("id").alias("seq"),
        F.lit("doc").alias("object_type"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("object_id"),
        F.lit("viewer").alias("relation"),
        F.lit("user").alias("user_type"),
        F.lit("u").alias("user_id"),
        F.timestamp_seconds("id").alias("ts"),
        F.lit(None).cast("string").alias("condition"),
        F.when(F.col("id") % 30_000 == 15_000, "DELETE").otherwise("WRITE").alias("operation"),
    )
    folded = state.fold(events, segment_rows=1 << 12)
    hot = folded.where("object_id = 'hot'").collect()
    assert [(h.last_seq, h.created_at.timestamp()) for h in hot] == [(29_997, 15_003.0)]
    assert folded.count() == 20_001
    physical = plan(folded).split("== Physical Plan ==")[1]
    assert physical.count("Exchange") == 2
    assert physical.count("partial_collect_list") == 1 and physical.count("partial_max_by") == 2


def test_conditional_tuples_come_in_the_order_of_objects(spark):
    rows = [event(i, "WRITE", key, '{"name":"a"}') for i, key in enumerate("dbcaeb")]
    rows = [(*r[:4], r[4], f"u{i}", *r[6:]) for i, r in enumerate(rows)]  # two users of b
    rows.append(event(10, "WRITE", "aa"))
    found = state.conditional_tuples(state.fold(events_of(spark, rows).repartition(4))).collect()
    assert [r.object_id for r in found] == ["a", "b", "b", "c", "d", "e"]
