from llm import brute
from oracle import compare, connect
from tuplefeed.llm import reply_trees
from tuplefeed.llm.queries import ORACLES, QUERIES

MESSAGES = "tree long, node long, parent long, role string, text string, score double"


def test_query_equals_its_oracle(spark, sf_dir):
    got = QUERIES["op7_reply_trees"](spark, sf_dir)
    assert compare(got, connect(sf_dir), ORACLES["op7_reply_trees"]) is None
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_branches_by_score_cycles_and_missing_parents(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "low", 1.0), (1, 3, 1, "assistant", "high", 2.0),
        (1, 4, 3, "user", "end", 0.0), (1, 5, 2, "user", "tied", 1.0),
        (2, 7, 99, "user", "lost parent", 0.0), (3, 1, 2, "user", "a", 0.0), (3, 2, 1, "user", "b", 0.0),
    ]
    out = reply_trees.conversations(spark.createDataFrame(rows, MESSAGES), branches=2)
    got = {(r.conv_id, r["rank"]): [tuple(t) for t in r.turns] for r in reply_trees.read_back(out).collect()}
    assert got == {
        (1, 1): [("user", "root"), ("assistant", "high"), ("user", "end")],
        (1, 2): [("user", "root"), ("assistant", "low"), ("user", "tied")],
        (2, 1): [("user", "lost parent")],
    }


def test_odd_rows_are_read_back(spark):
    long = "\\s\\\\l<s></s>[user]\U0001f600" * 3000
    rows = [
        (None, 0, "user", "no id"), (5, 1, "assistant", None), (5, 0, None, ""), (5, 1, "assistant", None),
        (6, None, "we[ir]d\\", long), (6, 1, "assistant", long), (6, 2, "assistant", "\\"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS tree", "'x' AS node")
    got = {r.conv_id: r for r in reply_trees.digests(reply_trees.conversations(reply_trees.from_turns(df))).collect()}
    assert got[None].n_turns == 1 and got[5].n_turns == 3
    assert got[5].turns_sha256 == brute.hexed("\n\n" + "assistant\n\n" * 2)
    assert got[6].turns_sha256 == brute.hexed(f"we[ir]d\\\n{long}\nassistant\n{long}\nassistant\n\\\n")
    assert got[6].loss_sha256 == brute.hexed(long + "\\") and got[6].loss_chars == len(long) + 1


def test_long_thread_and_empty_table(spark):
    thread = spark.range(300).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "cast(id AS string) AS text")
    (row,) = reply_trees.digests(reply_trees.conversations(reply_trees.from_turns(thread))).collect()
    assert row.n_turns == 300
    assert row.turns_sha256 == brute.hexed("".join(f"user\n{i}\n" for i in range(300)))
    assert reply_trees.conversations(reply_trees.from_turns(thread.limit(0))).count() == 0
