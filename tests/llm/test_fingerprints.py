import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from oracle import compare, connect
from tuplefeed.llm import fingerprints
from tuplefeed.llm.queries import ORACLES, QUERIES


def brute(docs):
    """Multiset of result rows by plain grouping of whole texts."""
    groups = {}
    for doc_id, text in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = Counter()
    for norm, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        ordered = known + [None] * (len(ids) - len(known))
        for place, doc_id in enumerate(ordered):
            out[doc_id, ordered[0], len(ids), place == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def check(df, **sizes):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = fingerprints.dedup(df, **sizes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(docs)


def test_query_equals_sql(spark, sf_dir):
    assert compare(QUERIES["op11_fingerprints"](spark, sf_dir), connect(sf_dir), ORACLES["op11_fingerprints"]) is None


def test_chunks_compose():
    rng = random.Random(3)
    data = np.frombuffer(rng.randbytes(1000), np.uint8)
    modulus = fingerprints.MODULI[1]
    table = fingerprints.powers(1000, modulus)
    whole = int(fingerprints.hashes(data, np.array([1000]), modulus, table)[0])
    plain = 0
    for digit in data.tolist():
        plain = (plain * fingerprints.BASE + digit + 1) % modulus
    assert whole == plain
    for _ in range(20):
        ends = np.array(sorted([*rng.choices(range(1001), k=5), 1000]))
        parts = fingerprints.hashes(data, ends, modulus, table)
        summed = sum(int(h) * pow(fingerprints.BASE, 1000 - int(e), modulus) for h, e in zip(parts, ends, strict=True))
        assert summed % modulus == whole


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 7}, {"moduli": (2, 2, 2)}, {"moduli": (3,), "chunk_bytes": 5}])
def test_copies_and_weak_fingerprints(spark, sizes):
    """With small primes many different texts share a fingerprint, and only the comparison tells them apart."""
    rng = random.Random(1)
    kinds = ["", " ", "a", "b", "ab", "ba", "a b", "a \t\nb", "a  b ", "é漢\U0001f600", "é漢\U0001f601", None, *("x" * 30 + c for c in "abcdefgh")]
    docs = [(rng.choice([None, *range(40)]), rng.choice(kinds)) for _ in range(150)]
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), **sizes)


def test_a_large_group_meets_copies_of_its_first_text(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "PER_COPY", 4)
    docs = [(i, "the same  words" if i % 3 else f"words {i}") for i in range(120)]
    check(spark.createDataFrame(docs, "doc_id long, text string"), moduli=(5, 3, 2))


def test_odd_rows_and_empty_table(spark, odd, empty):
    check(odd)
    check(odd, chunk_bytes=1000)
    assert fingerprints.dedup(empty).count() == 0
