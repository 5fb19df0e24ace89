import pytest
from pyspark.sql import functions as F

from tuplefeed.functions import changes as C
from tuplefeed.functions import refs

# By rule: a type ends at the first colon, but not one that leads; a user with a leading colon and a
# set behind it has an empty type. What has no type gets the default.
IDS = ["b7", "x.y/z", "p:q", "p:q:r", "é-漢"]
TYPED = [(f"{t}:{i}", t, i) for t in ("robot", "crew_2") for i in [*IDS, ""]]
USERS = [
    *TYPED, *[(f"robot:{i}#lead", "robot", f"{i}#lead") for i in IDS],
    *[(i, "user", i) for i in ("b7", "x.y/z", "b7#lead", "")],
    (":b7", "user", ":b7"), (":b7#lead", "", "b7#lead"),
]
OBJECTS = [
    *TYPED, *[(i, "object", i) for i in ("b7", "x.y/z", "b7#lead", "", ":b7", ":b7#lead")],
]


@pytest.mark.parametrize(
    "split, cases", [(refs.split_user_ref, USERS), (refs.split_object_ref, OBJECTS)]
)
def test_split(spark, split, cases):
    df = spark.createDataFrame(cases, "ref STRING, t STRING, i STRING")
    ref_type, ref_id = split(F.col("ref"))
    for row in df.select("*", ref_type.alias("got_t"), ref_id.alias("got_i")).collect():
        assert (row.got_t, row.got_i) == (row.t, row.i), row.ref


def test_join_ref(spark):
    cases = [("robot", "b7", "robot:b7"), ("", "b7", "b7"), ("crew", "p:q", "crew:p:q")]
    df = spark.createDataFrame(cases, "t STRING, i STRING, ref STRING")
    for row in df.select("ref", refs.join_ref(F.col("t"), F.col("i")).alias("got")).collect():
        assert row.got == row.ref


def test_tuple_key_and_display(spark):
    df = spark.createDataFrame([("crew:night#lead", "viewer", "doc:1")], "u STRING, r STRING, o STRING")
    key = refs.tuple_key(F.col("u"), F.col("r"), F.col("o"))
    row = df.select(key.alias("k")).first().k
    assert row.asDict() == {
        "user": "crew:night#lead", "user_type": "crew", "user_id": "night#lead", "relation": "viewer",
        "object": "doc:1", "object_type": "doc", "object_id": "1",
    }
    parts = df.select(key.alias("k")).select(
        refs.display(*[F.col(f"k.{c}") for c in ("object_type", "object_id", "relation", "user_type", "user_id")])
    )
    assert parts.first()[0] == "doc:1#viewer@crew:night#lead"


def test_operations(spark):
    cases = [
        ("WRITE", "tuple_write", "W", "U"),
        ("write", "tuple_write", "W", "U"),
        ("TUPLE_TO_USERSET_WRITE", "tuple_write", "W", "U"),
        ("DELETE", "tuple_delete", "D", "U"),
        ("Tuple_To_Userset_Delete", "tuple_delete", "D", "U"),
        ("TUPLE_OPERATION_WRITE", "tuple_change", "W", "W"),
        ("tuple_operation_delete", "tuple_change", "D", "D"),
        ("", "tuple_change", "U", "U"),
        ("WRITE ", "tuple_change", "U", "U"),
        ("rewrite", "tuple_change", "U", "U"),
    ]
    df = spark.createDataFrame(cases, "o STRING, kind STRING, op STRING, sink STRING")
    o = F.col("o")
    got = df.select("*", C.change_type(o).alias("a"), C.op_code(o).alias("b"), C.op_code(o, "sink").alias("c"))
    for row in got.collect():
        assert (row.a, row.b, row.c) == (row.kind, row.op, row.sink), row.o
    with pytest.raises(ValueError):
        C.op_code(o, "other")
