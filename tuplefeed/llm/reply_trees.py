"""Conversations from reply trees, in DataFrame operations alone.

Each message names its parent. Root-to-leaf paths are found by self-joins that double: after k
rounds a message points 2**k replies up and holds the score and length of what lies between, so a
thread of n messages takes log2(n) rounds. Leaves are ranked by the score of their branch; the
rounds are gone back through to collect the messages of chosen branches; and each branch becomes
one text with a mask over what is to be learnt.

The text is ``<s>`` and, for each turn, ``[role]text</s>``. Inside roles and texts the first
characters of control strings are escaped, and so is the escape: ``read_back`` is exact.

Every round's pointers, without texts, are written to the shared folder, so a lost executor costs
one round. Defined results: a null text or role is empty; a null tree is a tree of its own; a
parent that is not there makes its reply a root; messages on a cycle of parents have no root and
are left out; of equal scores the longer branch leads, then the smaller leaf; repeated messages of
``from_turns`` are turns each; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuplefeed.llm.common import NO_ID, settled

START, END = "<s>", "</s>"
#: Escaped forms of the characters that start or end control strings; the escape itself is first.
ESCAPES = [("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("]", "\\e")]


def escaped(text: Column) -> Column:
    for plain, form in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(form))
    return text


def unescaped(text: Column) -> Column:
    for plain, form in reversed(ESCAPES):
        text = F.replace(text, F.lit(form), F.lit(plain))
    return text


def from_turns(rows: DataFrame) -> DataFrame:
    """Threads without branches: each row replies to the one before it, by turn, role and text."""
    plain = rows.select(
        F.coalesce(rows["conv_id"].cast("long"), F.lit(NO_ID)).alias("tree"),
        rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"], F.lit("")).alias("role"),
        F.coalesce(rows["text"], F.lit("")).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return plain.select(
        "tree", place.alias("node"), F.when(place > 1, place - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"),
    )


def best_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth) for the messages of each tree's best ``branches``."""
    here = messages.select("tree", "node", F.col("parent").alias("up"), F.coalesce("score", F.lit(0.0)).alias("score"))
    there = here.select("tree", F.col("node").alias("up"), F.lit(True).alias("known"))
    step = settled(
        here.join(there, ["tree", "up"], "left").select(
            "tree", "node", F.when(F.col("known"), F.col("up")).alias("up"), "score", F.lit(1).cast("long").alias("depth")
        ),
        "reply-jumps",
    )
    jumps, open_ends, rounds = [step], step.where("up IS NOT NULL").count(), 0
    most = step.count().bit_length()  # pointers still open after this are on a cycle
    while open_ends and rounds <= most:
        onward = step.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"),
            F.col("score").alias("more"), F.col("depth").alias("longer"),
        )
        longer = step.where("up IS NOT NULL").join(onward, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"),
            (F.col("score") + F.col("more")).alias("score"), (F.col("depth") + F.col("longer")).alias("depth"),
        )
        step = settled(step.where("up IS NULL").unionByName(longer), "reply-jumps")
        jumps.append(step)
        open_ends, rounds = step.where("up IS NOT NULL").count(), rounds + 1
    rooted = step.where("up IS NULL").select("tree", "node", "score", "depth")
    replied = here.select("tree", F.col("up").alias("node")).where("node IS NOT NULL").distinct()
    by_score = Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("depth").desc(), "node")
    leaves = rooted.join(replied, ["tree", "node"], "left_anti").withColumn("rank", F.row_number().over(by_score))
    path = leaves.where(F.col("rank") <= branches).select("tree", "rank", F.col("node").alias("leaf"), "node")
    for jump in reversed(jumps[:-1] if len(jumps) > 1 else []):
        up = path.join(jump.select("tree", "node", "up"), ["tree", "node"]).where("up IS NOT NULL")
        path = settled(path.unionByName(up.select("tree", "rank", "leaf", F.col("up").alias("node"))), "reply-paths")
    return path.join(rooted.select("tree", "node", "depth"), ["tree", "node"])


def conversations(messages: DataFrame, branches: int = 1, learnt: str = "assistant") -> DataFrame:
    """One row per chosen branch: conv_id, leaf, rank, the text, and the spans of its loss mask."""
    of_branch = best_branches(messages, branches).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    pieces = of_branch.select(
        "tree", "leaf", "rank", "depth", F.concat(F.lit("["), role, F.lit("]"), text, F.lit(END)).alias("piece"),
        (F.length(role) + 2).alias("before"), F.length(text).alias("length"), (F.col("role") == learnt).alias("learnt"),
    )
    earlier = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0)) + len(START)
    placed = pieces.withColumn("start", (at + F.col("before")).cast("int"))
    turns = F.sort_array(F.collect_list(F.struct("depth", "piece", "learnt", "start", "length")))
    whole = placed.groupBy("tree", "leaf").agg(F.first("rank").alias("rank"), turns.alias("turns"))
    return whole.select(
        F.nullif(F.col("tree"), F.lit(NO_ID)).alias("conv_id"),
        "leaf",
        "rank",
        F.concat(F.lit(START), F.array_join(F.transform("turns", lambda t: t["piece"]), "")).alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: F.struct(t["start"], t["length"])).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns (role, text) and learnt texts, from the text and its mask alone."""
    split = F.split(F.substr("formatted", F.lit(len(START) + 1)), END, -1)
    pieces = F.slice(split, F.lit(1), F.size(split) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(2)), "]", 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(piece, F.length(role) + 3)).alias("text"))

    learnt = F.transform(
        "loss_mask", lambda m: unescaped(F.substr("formatted", m["start"] + 1, m["length"]))
    )
    return formatted.withColumns({"turns": F.transform(pieces, turn), "learnt": learnt})


def digests(formatted: DataFrame) -> DataFrame:
    """What each text says, read back from it."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("learnt", "")
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The digests of threads by turn, in DuckDB.
ORACLE = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\\\<\\[\\]]', '', 'g')) + 6 AS size FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(size))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
