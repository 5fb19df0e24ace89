import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import brute
from tuplefeed.llm import exact_dedup
from tuplefeed.llm.queries import QUERIES

FIVE = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@settings(deadline=None)
@given(st.lists(st.text("ab", min_size=4, max_size=30), min_size=1, max_size=12), st.sampled_from([20, 60, 10_000]))
def test_shards_find_what_starts_earlier(given_texts, shard_bytes):
    texts = [t.encode() for t in given_texts]
    docs = np.arange(len(texts))[::-1].copy()
    flags, ends = exact_dedup.repeats(texts, np.zeros(len(texts), np.uint64), [docs, np.zeros(len(texts), np.int64)], 4, shard_bytes)
    seen = set()
    for _, p, i, s in sorted((docs[i], p, i, t[p : p + 4]) for i, t in enumerate(texts) for p in range(len(t) - 3)):
        assert flags[ends[i] - len(texts[i]) + 3 + p] == (s in seen)
        seen.add(s)


def check(docs, rows):
    expected = brute.deduplicated(docs)
    assert sorted((tuple(r) for r in rows), key=str) == sorted(expected, key=str)
    return expected


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = check(docs, QUERIES["op3_suffix_arrays"](spark, sf_dir).collect())
    assert sum(r[2] for r in expected) > 10_000


@pytest.mark.parametrize("sizes", [{}, {"block_chars": 900, "shard_bytes": 700}])
def test_passages_edits_and_periods(spark, sizes):
    rng = random.Random(1)

    def text(n):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(n))

    passages = [text(180) for _ in range(3)] + ["For " * 60, "z" * 500]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else text(rng.randrange(150)) for _ in range(4)]
        whole = list("".join(parts))
        if whole and rng.random() < 0.5:
            whole[rng.randrange(len(whole))] = "#"
        docs.append((rng.randrange(10**6), "".join(whole)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check(docs, exact_dedup.remove(df, **sizes).select(FIVE).collect())


def test_odd_rows_and_empty_table(spark, odd, empty):
    rows = exact_dedup.remove(odd).select(FIVE).collect()
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    check(docs, rows)
    assert exact_dedup.remove(empty).count() == 0
