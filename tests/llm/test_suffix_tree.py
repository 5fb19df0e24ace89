import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import brute
from tuplefeed.llm import suffix_tree
from tuplefeed.llm.common import texts_of
from tuplefeed.llm.queries import QUERIES


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def test_query_has_the_base_of_plain_counts_and_beats_bytes_alone(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute.word_base(docs, held)
    rows = QUERIES["op1_suffix_tree"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(expected)
    for r in rows:
        *exact, base = expected[r.doc_id]
        assert [r.held_out, r.n_tokens, r.n_known, r.train_tokens] == exact
        assert r.base_score == pytest.approx(base, rel=1e-9)
    learns = lambda k: F.coalesce(F.crc32(k.cast("string").cast("binary")) % 7, F.lit(-1)) != 2
    plain = suffix_tree.score(spark.read.parquet(f"{sf_dir}/documents.parquet"), learns, depth=1).collect()
    assert sum(r.score for r in rows if r.held_out) > 0.8 * sum(r.score for r in plain if r.held_out)


def test_tree_equals_the_definitions(spark):
    import random

    rng = random.Random(2)
    words = ["the", "then", "thin", "a", "an", "été", "X"]
    docs = [(i, " ".join(rng.choices(words, [9, 5, 3, 4, 2, 1, 1], k=rng.randrange(30)))) for i in range(120)] + [(500, "unseen ζ bytes")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    expected, kept = brute.tree_scores(docs, held, 4, 1e-3, 5)
    learns = lambda k: F.coalesce(F.crc32(k.cast("string").cast("binary")) % 7, F.lit(-1)) != 2
    tree = suffix_tree.train(suffix_tree._written(texts_of(df), learns(F.col("doc_id"))), 4, 1e-3, 5)
    assert len(tree.log10) == len(kept)
    spelled = [suffix_tree.spelled([suffix_tree.words_of(t)], 0)[0].tobytes() for _, t in docs]
    assert [tree.score(s).sum() for s in spelled] == pytest.approx([expected[d] for d, _ in docs], rel=1e-9)
    alone = tree.score(b"".join(spelled))
    assert alone.sum() == pytest.approx(sum(expected.values()), rel=1e-9)
    unseen = 256 - (len(tree.log10[0]) - 1)
    sums = (10.0 ** tree.log10[:, 1:]).sum(1) + unseen * 10.0 ** tree.log10[:, 0]
    assert np.allclose(sums, 1)


def test_odd_rows_and_empty_tables(spark, odd, empty):
    all_learn = lambda k: F.lit(True)
    rows = suffix_tree.score(odd, all_learn).collect()
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    expected = brute.word_base(docs, lambda d: False)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][1:4]
        assert r.base_score == pytest.approx(expected[r.doc_id][4], rel=1e-9)
    assert suffix_tree.score(empty, all_learn).count() == 0
    none = suffix_tree.score(odd, lambda k: F.lit(False)).collect()
    assert all(r.train_tokens == r.n_known == 0 and r.held_out for r in none)
    assert [r.score for r in none if r.doc_id == 1] == [pytest.approx(-np.log10(256))]
