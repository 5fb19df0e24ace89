import json
import random

import pytest

from helpers import event, events_of, random_events, replay, wire, feed_of
from tuplefeed.operators import replicate
from tuplefeed.operators.parse import parse_feed


def made(spark, wires, **options):
    events = parse_feed(feed_of(spark, wires))
    rows = replicate.bodies(replicate.requests(events, **options)).orderBy("chunk").collect()
    return [(r.chunk, r.n_writes, r.n_deletes, json.loads(r.body)) for r in rows]


def test_chunks_are_cut_before_unknown_operations_go(spark):
    wires = [wire(op, f"user:{i}", "viewer", "doc:1") for i, op in enumerate(["WRITE", "DELETE", "UNKNOWN"])]
    assert made(spark, wires, batch_size=2) == [
        (0, 1, 1, {
            "writes": [{"user": "user:0", "relation": "viewer", "object": "doc:1"}],
            "deletes": [{"user": "user:1", "relation": "viewer", "object": "doc:1"}],
        })
    ]


def test_conditions_of_requests(spark):
    conditions = [
        {"name": "ip", "context": {"a": [1, "x"]}}, {"name": "t"}, {"name": "e", "context": {}}, {"context": {"a": 1}}, "oops",
    ]
    wires = [wire("WRITE", "bob", "r", "readme", condition=c) for c in conditions]
    wires.append(wire("DELETE", "bob", "r", "readme", condition=conditions[0]))
    [(_, _, _, body)] = made(spark, wires)
    key = {"user": "user:bob", "relation": "r", "object": "object:readme"}
    assert body["writes"] == [
        {**key, "condition": {"name": "ip", "context": {"a": [1, "x"]}}},
        {**key, "condition": {"name": "t"}},
        {**key, "condition": {"name": "e"}},
        key,
        key,
    ]
    assert body["deletes"] == [key]


@pytest.mark.parametrize("net", [False, True])
def test_requests_against_plain_chunking(spark, net):
    rows = random_events(3, 157, gap=4)
    random.Random(1).shuffle(rows)
    events = events_of(spark, rows).repartition(3)
    expected, ordered = {}, sorted(rows)
    for start in range(0, len(ordered), 10):
        known = [r for r in ordered[start : start + 10] if r[8] != "NOOP"]
        if net:
            known = [r for r in known if r[0] == max(o[0] for o in known if o[1:6] == r[1:6])]
        writes = [r[0] for r in known if "WRITE" in r[8].upper()]
        deletes = [r[0] for r in known if "DELETE" in r[8].upper()]
        if known:
            expected[start // 10] = (writes, deletes)
    got = replicate.requests(events, 10, net=net).collect()
    assert {r.chunk: ([w.seq for w in r.writes], [d.seq for d in r.deletes]) for r in got} == expected


def test_selection(spark):
    events = events_of(spark, [event(0, "WRITE", "a"), event(1, "WRITE", "b")])
    assert replicate.select_changes(events, object_types=["doc"], relations=["viewer"]).count() == 2
    assert replicate.select_changes(events, object_types=["folder"]).count() == 0
    assert replicate.select_changes(events, relations=["editor"]).count() == 0
    assert replicate.select_changes(events).count() == 2


def test_net_changes_reach_the_same_state(spark):
    rows = random_events(11, 200)
    net = replicate.net_changes(events_of(spark, rows)).collect()
    assert len({tuple(r[:5]) for r in net}) == len(net)
    current = {tuple(r[:5]): r.condition for r in net if "WRITE" in r.operation.upper()}
    assert current == {key: value[0] for key, value in replay(rows).items()}


def test_delivery_skips_what_was_delivered(spark, tmp_path):
    target, broken = str(tmp_path / "target"), str(tmp_path / "broken")

    def send(body):
        import os

        if '"user:3"' in body and os.path.exists(broken):
            raise OSError("refused")
        with open(target, "a") as out:
            out.write(body + "\n")

    events = parse_feed(feed_of(spark, [wire("WRITE", f"user:{i}", "r", "doc:1") for i in range(6)]))
    requests = replicate.bodies(replicate.requests(replicate.net_changes(events), batch_size=1))
    open(broken, "w").close()
    log = str(tmp_path / "log")
    replicate.deliver(requests, send).write.parquet(log + "/try=1")
    first = spark.read.parquet(log + "/try=1")
    assert [r.error for r in first.where("NOT delivered").collect()] == ["refused"]
    (tmp_path / "broken").rename(tmp_path / "mended")
    second = replicate.deliver(requests, send, first).collect()
    assert [(r.chunk, r.delivered) for r in second] == [(3, True)]
    sent = [json.loads(line)["writes"][0]["user"] for line in open(target)]
    assert sorted(sent) == [f"user:{i}" for i in range(6)]
