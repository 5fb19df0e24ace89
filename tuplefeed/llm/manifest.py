"""A Merkle manifest of a dataset and octopus multiproofs of its rows.

Each row is a leaf. Leaves of one part (here a language) are numbered by id, and every run of ``FAN``
consecutive nodes becomes one node, until one is left: the part's subroot. Subroots, ordered by part,
are numbered and joined in the same way up to the root. Both steps use one routine: nodes are grouped
by blocks of ``FAN ** levels`` neighbours, a task works out the levels inside its block, and the tops of
the blocks are the next input, so no task sees more than a block.

To prove rows, a task takes a partition of leaves. Level by level it has the nodes that its leaves
lead to, and of the runs they lie in, the other nodes are missing: their union is an octopus multiproof.
These coordinates are asked for once per partition, shared interior nodes are derived from the
partition's own leaves, and single proofs are expanded from both.

A null id sorts before all others, of rows with one id the smaller leaf comes first; null texts,
languages and sources enter as ``-``. An empty table has no rows, no nodes and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuplefeed.llm.common import settled
from tuplefeed.llm.skew import join_counted

FAN = 8
#: Levels that one task works out in a block, and leaves that it proves together.
LEVELS = 4
LEAVES = 4096
#: Name of the tree of subroots; parts have theirs as text behind "=", the null part is "-".
TOP = "top"

NODE = "tree string, level int, place long, node string"


def digest(texts: list[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(*columns: Column) -> Column:
    """SHA-256 of the values, each as byte count, ``:`` and value, or ``-`` for null."""

    def entry(column: Column) -> Column:
        value = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(entry, columns)), 256)


def numbered(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """Add ``place``, from 0 in each tree by ``order``, and ``size``, the tree's rows.

    Rows are dealt into ranges, sorted and written; there the place in a range is known, and only
    the counts per tree and range, which a range has few of, are summed over ranges.
    """
    spot = F.monotonically_increasing_id()  # the range in the upper bits, the place below
    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    written = settled(ranged.withColumns({"_range": F.shiftright(spot, 33), "_spot": spot}), name)
    counts = written.groupBy(tree, "_range").agg(F.count("*").alias("_rows"), F.min("_spot").alias("_first"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        tree, "_range", "_first", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("size"),
    )
    placed = join_counted(written, settled(starts, f"{name}-starts"), [tree, "_range"], "_rows")
    place = F.col("_before") + F.col("_spot") - F.col("_first")
    return placed.select(*rows.columns, place.alias("place"), "size")


def _joined_up(tree: str, level: int, place: int, nodes: list[str], levels: int) -> Iterator[tuple]:
    """The levels above one block of neighbours, the first of which has ``place``; the block's top is last."""
    for _ in range(levels):
        nodes = [digest(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
        level, place = level + 1, place // FAN
        yield from ((tree, level, place + k, node) for k, node in enumerate(nodes))


def _block_levels(key: tuple, frame: pd.DataFrame, levels: int) -> pd.DataFrame:
    frame = frame.sort_values("place")
    rows = _joined_up(key[0], int(frame["level"].iloc[0]), int(frame["place"].iloc[0]), frame["node"].tolist(), levels)
    return pd.DataFrame(rows, columns=["tree", "level", "place", "node"])


def height(size: int) -> int:
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def nodes_above(leaves: DataFrame, name: str, levels: int = LEVELS) -> DataFrame:
    """All nodes (tree, level, place, node) over ``leaves`` (tree, place, size, node), which are level 0.

    Trees with one leaf have it as root. Rounds end when no tree has a second block; their number is
    the logarithm of the largest tree. Levels above a tree's root, which blocks make too, are cut off.
    """
    bottom = settled(leaves.select("tree", F.lit(0).alias("level"), "place", "node"), f"{name}-nodes")
    sizes = settled(leaves.groupBy("tree").agg(F.max("size").alias("size")), f"{name}-sizes")
    largest = sizes.agg(F.max("size")).first()[0] or 0
    parts, tops, level = [bottom], bottom, 0
    while largest > FAN**level:
        block = F.call_function("div", F.col("place"), F.lit(FAN**levels)).alias("block")
        made = tops.groupBy("tree", block).applyInPandas(lambda k, f: _block_levels(k, f, levels), NODE)
        made = settled(made, f"{name}-nodes")
        level += levels
        parts.append(made)
        tops = made.where(F.col("level") == level)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    counted, heights = F.lit(0), F.col("size")
    for _ in range(height(largest)):
        counted = counted + (heights > 1).cast("int")
        heights = F.call_function("div", heights + (FAN - 1), F.lit(FAN))
    tall = sizes.select("tree", counted.alias("height"))
    return found.join(tall, "tree").where("level <= height")


def siblings(places: list[int], size: int) -> Iterator[tuple[int, set[int], set[int]]]:
    """Level by level: the nodes that ``places`` lead to, and those missing in their runs."""
    known, level = set(places), 0
    while size > 1:
        runs = {p // FAN for p in known}
        whole = {p for r in runs for p in range(r * FAN, min((r + 1) * FAN, size))}
        yield level, known, whole - known
        known, size, level = runs, -(-size // FAN), level + 1


def _missing(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Coordinates that a partition of leaves lacks in its tree, and its place in the tree of subroots."""
    tree, size, part, top_place, top_size = (frame[c].iloc[0] for c in ("tree", "size", "part", "top_place", "top_size"))
    own = ((tree, level, p) for level, _, lacks in siblings(frame["place"].tolist(), int(size)) for p in lacks)
    top = ((TOP, level, p) for level, _, lacks in siblings([int(top_place)], int(top_size)) for p in lacks)
    rows = [(part, *c) for c in (*own, *top)]
    return pd.DataFrame(rows, columns=["part", "tree", "level", "place"])


class Octopus:
    """One tree's nodes as a partition sees them: fetched ones, and those derived from its leaves."""

    def __init__(self, leaves: dict[int, str], size: int, fetched: dict[tuple[int, int], str]):
        self.nodes = {**fetched, **{(0, p): n for p, n in leaves.items()}}
        self.steps = list(siblings(list(leaves), size))
        self.sizes = [size]
        for level, known, _ in self.steps:
            size = self.sizes[-1]
            for run in sorted({p // FAN for p in known}):
                self.nodes[level + 1, run] = digest(self.run(level, run, size))
            self.sizes.append(-(-size // FAN))

    def run(self, level: int, run: int, size: int) -> list[str]:
        return [self.nodes[level, p] for p in range(run * FAN, min((run + 1) * FAN, size))]

    @property
    def root(self) -> str:
        return self.nodes[len(self.steps), 0]

    def path(self, place: int) -> list[tuple[list[str], list[str]]]:
        """Per level, the siblings before and behind the node on the way from ``place`` to the root."""
        out = []
        for level in range(len(self.steps)):
            run = self.run(level, place // FAN, self.sizes[level])
            at = place % FAN
            out.append((run[:at], run[at + 1 :]))
            place //= FAN
        return out


def folded(node: str, path: list[tuple[list[str], list[str]]]) -> str:
    for left, right in path:
        node = digest([*left, node, *right])
    return node


def _proofs(keys: list[str], leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
    size, top_place, top_size = (int(leaves[c].iloc[0]) for c in ("size", "top_place", "top_size"))
    own, top = {}, {}
    for tree, level, place, node in fetched[["tree", "level", "place", "node"]].itertuples(index=False):
        (top if tree == TOP else own)[int(level), int(place)] = node
    part = Octopus(dict(zip(leaves["place"].tolist(), leaves["leaf"], strict=True)), size, own)
    whole = Octopus({top_place: part.root}, top_size, top)
    above = whole.path(top_place)
    proofs, ends = [], []
    for place, shown in zip(leaves["place"].tolist(), leaves["shown"], strict=True):
        path = part.path(place) + above
        proofs.append(digest([n for left, right in path for n in (*left, *right)]))
        ends.append(folded(shown, path))
    out = leaves[[*keys, "leaf"]].assign(subroot=part.root, root=whole.root, proof_sha256=proofs, folded_root=ends)
    return out.assign(verified=out["folded_root"] == out["root"])


def manifest(rows: DataFrame, key: str, part: str, leaf: str, *, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(leaves, nodes) of a dataset of (key, part, leaf, ...) rows.

    ``leaves`` has the rows with ``tree``, ``place``, ``size``, ``top_place`` and ``top_size``.
    """
    named = rows.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit("-")))
    ordered = numbered(settled(named, "merkle-rows"), "tree", [key, leaf], "merkle-ranges")
    leaves = settled(ordered, "merkle-leaves")
    inner = settled(nodes_above(leaves.withColumn("node", F.col(leaf)), "merkle", levels), "merkle-inner")
    counts = leaves.groupBy("tree").agg(F.count("*").alias("size"))
    last = inner.groupBy("tree").agg(F.max_by("node", "level").alias("node")).withColumn("top", F.lit(TOP))
    subroots = settled(numbered(last, "top", ["tree"], "merkle-subroots"), "merkle-subroots")
    above = nodes_above(subroots.select(F.col("top").alias("tree"), "place", "size", "node"), "merkle-top", levels)
    tops = subroots.join(counts.drop("size"), "tree").select("tree", F.col("place").alias("top_place"), F.col("size").alias("top_size"))
    sized = settled(tops.join(counts.withColumnRenamed("size", "_rows"), "tree"), "merkle-parts")
    return join_counted(leaves, sized, ["tree"], "_rows").drop("_rows"), inner.unionByName(above)


def prove(leaves: DataFrame, nodes: DataFrame, keys: list[str], *, leaves_at_once: int = LEAVES) -> DataFrame:
    """Proofs of ``leaves``: rows of a manifest, all or some, with ``leaf`` and ``shown``.

    ``shown`` is the leaf to be verified. Returns ``keys``, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root`` and ``verified``. Partitions are ranges of places, so the rows of
    one share most of their paths.
    """
    block = F.call_function("div", F.col("place"), F.lit(leaves_at_once)).cast("string")
    parts = settled(leaves.withColumn("part", F.concat(block, F.lit(" "), F.col("tree"))), "merkle-partitions")
    asked = parts.select("part", "tree", "place", "size", "top_place", "top_size").groupBy("part")
    asked = settled(asked.applyInPandas(_missing, "part string, tree string, level int, place long"), "merkle-asked")
    spots = ["tree", "level", "place"]
    wanted = settled(asked.groupBy(*spots).agg(F.count("*").alias("_rows")).join(nodes, spots), "merkle-wanted")
    fetched = join_counted(asked, wanted, spots, "_rows").select("part", *spots, "node")
    made = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = ", ".join([*(f"{n} string" for n in [*keys, *made]), "verified boolean"])
    texts = [F.col(k).cast("string").alias(k) for k in keys]  # pandas has no whole numbers with nulls
    grouped = parts.select("part", "place", "size", "top_place", "top_size", *texts, "leaf", "shown").groupBy("part")
    found = grouped.cogroup(fetched.groupBy("part")).applyInPandas(lambda a, b: _proofs(keys, a, b), schema)
    return found.select(*[F.col(k).cast(leaves.schema[k].dataType).alias(k) for k in keys], *made, "verified")


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, shown) of documents: ``shown`` is the leaf of the row as it would be with its
    text's A-Z lower-cased where 3 divides the CRC-32 of the id, and else the leaf. Null ids stay as they are."""
    doc_id, source, lang, n_chars = (docs[c] for c in ("doc_id", "source", "lang", "n_chars"))
    text = docs["text"].cast("string")
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return docs.select(
        doc_id.cast("long").alias("doc_id"), lang.cast("string").alias("lang"),
        leaf_of(doc_id, source, lang, n_chars, text).alias("leaf"),
        leaf_of(doc_id, source, lang, n_chars, F.when(tampered, lower).otherwise(text)).alias("shown"),
    )


def audit(docs: DataFrame, *, leaves_at_once: int = LEAVES, levels: int = LEVELS) -> DataFrame:
    """Build the manifest of all documents and verify each of them with its proof."""
    leaves, nodes = manifest(documents(docs), "doc_id", "lang", "leaf", levels=levels)
    return prove(leaves, nodes, ["doc_id"], leaves_at_once=leaves_at_once)


#: The same result as SQL. The CRC-32 goes through the digits' bits; trees and proofs are recursions.
ORACLE = """
WITH RECURSIVE given AS (
    SELECT row_number() OVER () AS row, doc_id, lang, text, lower_text, list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda d:
            [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head
    FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM documents)),
hashed AS (
    SELECT row, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(lower_text) || ':' || lower_text, '-')) END AS changed
    FROM given),
leaves AS (
    SELECT *, coalesce('=' || lang, '-') AS tree,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size
    FROM hashed),
nodes AS (
    SELECT tree, 0 AS level, place, size, leaf AS node FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 8, (size + 7) // 8, sha256(string_agg(node, '' ORDER BY place))
    FROM nodes WHERE size > 1 GROUP BY tree, level, size, place // 8),
subroots AS (
    SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size FROM nodes WHERE size = 1),
above AS (
    SELECT 'top' AS tree, 0 AS level, place, size, subroot AS node FROM subroots
    UNION ALL
    SELECT tree, level + 1, place // 8, (size + 7) // 8, sha256(string_agg(node, '' ORDER BY place))
    FROM above WHERE size > 1 GROUP BY tree, level, size, place // 8),
beside AS (
    SELECT tree, level, place,
        coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
    FROM (SELECT * FROM nodes UNION ALL SELECT * FROM above) WHERE size > 1
    WINDOW run AS (PARTITION BY tree, level, place // 8 ORDER BY place)),
inside AS (
    SELECT row, tree, 0 AS level, place, size, '' AS proof, coalesce(changed, leaf) AS node FROM leaves
    UNION ALL
    SELECT w.row, w.tree, w.level + 1, w.place // 8, (w.size + 7) // 8, w.proof || b.before || b.behind, sha256(b.before || w.node || b.behind)
    FROM inside w JOIN beside b ON w.tree = b.tree AND w.level = b.level AND w.place = b.place),
whole AS (
    SELECT i.row, 0 AS level, s.place, s.size, i.proof, i.node FROM inside i JOIN subroots s USING (tree) WHERE i.size = 1
    UNION ALL
    SELECT w.row, w.level + 1, w.place // 8, (w.size + 7) // 8, w.proof || b.before || b.behind, sha256(b.before || w.node || b.behind)
    FROM whole w JOIN beside b ON b.tree = 'top' AND w.level = b.level AND w.place = b.place)
SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root, w.node = r.node AS verified
FROM whole w JOIN leaves l USING (row) JOIN subroots s USING (tree) JOIN above r ON r.size = 1
WHERE w.size = 1
"""
