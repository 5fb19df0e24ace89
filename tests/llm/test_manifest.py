import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from tuplefeed.llm import manifest
from tuplefeed.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [doc_id, source, lang, n_chars, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, place):
    """(siblings in order, siblings before, behind per level, root) of the node at ``place``."""
    path = []
    while len(nodes) > 1:
        start = place // 8 * 8
        path.append((nodes[start:place], nodes[place + 1 : start + 8]))
        nodes = [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        place //= 8
    return path, nodes[0]


def brute(docs):
    parts = {}
    for d in docs:
        parts.setdefault(d[2], []).append(d)
    langs = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    for rows in parts.values():
        rows.sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
    subroots = [climb([leaf(*d) for d in parts[x]], 0)[1] for x in langs]
    out = Counter()
    for at, lang in enumerate(langs):
        leaves = [leaf(*d) for d in parts[lang]]
        for place, (doc_id, text, *rest) in enumerate(parts[lang]):
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            path, subroot = climb(leaves, place)
            above, root = climb(subroots, at)
            node = leaf(doc_id, text, *rest)
            for before, behind in path + above:
                node = h(*before, node, *behind)
            proof = h(*(n for pair in path + above for side in pair for n in side))
            out[doc_id, leaves[place], subroot, root, proof, node, node == root] += 1
    return out


def check(df, **sizes):
    docs = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = manifest.audit(df, **sizes)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    expected = brute(docs)
    assert Counter(map(tuple, got.collect())) == expected
    return expected


def test_query_equals_sql(spark, sf_dir):
    assert compare(QUERIES["op12_merkle_manifest"](spark, sf_dir), connect(sf_dir), ORACLES["op12_merkle_manifest"]) is None


@pytest.mark.parametrize("sizes", [{"leaves_at_once": 5, "levels": 1}, {"leaves_at_once": 64, "levels": 2}, {}])
def test_trees_of_all_heights(spark, sizes):
    """Parts of 1 to 700 rows, more than eight of them, blocks of one level, partitions that cut runs apart."""
    rng = random.Random(2)
    docs = []
    for lang, count in [(None, 7), ("", 1), ("-", 8), ("a", 9), ("é", 64), ("z", 65), ("b", 2), ("c", 3), ("d", 1), ("hot", 700)]:
        docs += [(i * 7 - 40, rng.choice([None, "", "Text", "text", "漢 X"]), lang, rng.choice([None, "s"]), rng.choice([None, 4])) for i in range(count)]
    rng.shuffle(docs)
    found = check(spark.createDataFrame(docs, SCHEMA).repartition(5), **sizes)
    assert {row[-1] for row in found} == {True, False}


def test_some_rows_only(spark):
    """Proofs of a subset need nodes from all levels."""
    docs = [(i, "Some text", "en" if i % 3 else "fr", None, i) for i in range(300)]
    df = spark.createDataFrame(docs, SCHEMA)
    leaves, nodes = manifest.manifest(manifest.documents(df), "doc_id", "lang", "leaf")
    some = leaves.where(F.col("doc_id").isin(0, 1, 2, 77, 150, 299))
    expected = {row for row in brute(docs) if row[0] in (0, 1, 2, 77, 150, 299)}
    assert set(map(tuple, manifest.prove(some, nodes, ["doc_id"], leaves_at_once=100).collect())) == expected


def test_missing_nodes_are_few():
    """256 neighbours of a tree of 4096 leaves lack only the rest of the runs above them."""
    lacks = [len(missing) for _, _, missing in manifest.siblings(list(range(256, 512)), 4096)]
    assert lacks == [0, 0, 4, 7]


def test_odd_rows_and_empty_table(spark, odd, empty):
    check(odd)
    assert manifest.audit(empty).count() == 0
