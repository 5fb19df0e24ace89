import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import brute
from tuplefeed.llm import fm_index
from tuplefeed.llm.queries import QUERIES
from tuplefeed.llm.suffixes import common_prefixes, suffix_array

SIX = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@settings(deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9))
def test_suffix_arrays_and_common_prefixes(symbols, most):
    s = np.array(symbols, np.int64)
    order, rank = suffix_array(s)
    assert order.tolist() == sorted(range(len(s)), key=lambda i: symbols[i:])
    assert rank[order].tolist() == list(range(len(s)))

    def shared(a, b):
        m = 0
        while m < most and max(a, b) + m < len(s) and symbols[a + m] == symbols[b + m]:
            m += 1
        return m

    assert common_prefixes(s, order, rank, most).tolist()[1:] == [shared(a, b) for a, b in zip(order, order[1:])]


@settings(deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_index_finds_every_occurrence(symbols, phrase):
    index = fm_index.FMIndex(np.array(symbols, np.int64), 3)
    low, high = index.search(np.array([[-1] * (5 - len(phrase)) + phrase], np.int64))
    found = index.locate(np.arange(low[0], high[0]))
    n = len(phrase)
    assert sorted(found.tolist()) == [i for i in range(len(symbols) - n + 1) if symbols[i : i + n] == phrase]


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op8_fm_index"](spark, sf_dir).collect())
    assert got == sorted(brute.decontaminated(docs, bench))
    assert any(r[2] for r in got)


@pytest.mark.parametrize("parameters", [{}, {"block_words": 3, "shard_chars": 100}])
def test_odd_rows_and_short_items(spark, odd, parameters):
    items = [(1, "TWO three"), (2, "four five six seven eight nine ten eleven twelve one two"), (3, ""), (4, None), (5, "漢字"), (None, "naïve"), (6, "two THREE")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in fm_index.find(odd, bench, **parameters).select(SIX).collect()), key=str)
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got == sorted(brute.decontaminated(docs, items), key=str)


def test_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert fm_index.find(empty, none).count() == 0
    assert not any(r.contaminated for r in fm_index.find(odd, none).collect())


def test_clean_cuts_spans_and_keeps_columns(spark, odd):
    bench = spark.createDataFrame([(1, "two three"), (2, "three FOUR five")], "item_id long, text string")
    cleaned = fm_index.clean(odd, bench)
    assert cleaned.columns == odd.columns
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts[6] == ("one  six seven eight nine ten eleven twelve " * 40)
    assert texts[1] is None and texts[4] == "Word"


def test_clean_keeps_columns_named_like_its_marks(spark, odd):
    bench = spark.createDataFrame([("a-1", "two three"), (None, "three FOUR five")], "item_id string, text string")
    clash = odd.withColumnsRenamed({"spans": "__spans", "block": "__WORDS", "score": "__items", "source": "c0"})
    cleaned = fm_index.clean(clash, bench)
    assert cleaned.schema == clash.schema
    plain = fm_index.clean(odd, bench)
    assert sorted(map(str, map(tuple, cleaned.collect()))) == sorted(map(str, map(tuple, plain.collect())))
    items = {r.doc_id: r["items"] for r in fm_index.find(clash, bench).collect()}
    assert items[6] == ["None", "a-1"] and items[4] == []
