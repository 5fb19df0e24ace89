from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tuplefeed.llm import packing
from tuplefeed.llm.queries import QUERIES


@settings(deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40))
def test_pieces_fill_sequences_in_a_row(lengths):
    pieces = packing.pack_lengths(lengths, 16, 1.0, 0.1)
    at = defaultdict(int)
    for doc, start, n, _, _ in sorted(pieces, key=lambda p: p[:2]):
        assert start == at[doc] and 0 < n <= 16
        at[doc] += n
    assert [at[d] for d in range(len(lengths))] == lengths
    filled = defaultdict(int)
    for _, _, n, k, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert offset == filled[k]
        filled[k] += n
    assert max(filled.values(), default=0) <= 16
    assert len(filled) == -(-sum(lengths) // 16)


def test_longest_first_to_the_cheapest():
    pieces = packing.pack_lengths([5, 9, 6, 4], 12, 1.0, 1.0)
    assert pieces == [(1, 0, 9, 0, 0), (2, 0, 6, 1, 0), (0, 0, 5, 1, 6), (3, 0, 1, 1, 11), (3, 1, 3, 0, 9)]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="ab é漢\U0001f600\n\t\x1c .,'s12<|endoftext|>", max_size=40), min_size=1, max_size=6))
def test_segments_have_the_ids_of_whole_texts(texts):
    encoder = test_segments_have_the_ids_of_whole_texts.encoder
    assert [e.tolist() for e in encoder.encode(texts)] == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


test_segments_have_the_ids_of_whole_texts.encoder = packing.SegmentEncoder(packing.bpe_50k(), keep=50)


def test_query_pads_little(spark, sf_dir):
    rows = QUERIES["op10_packing"](spark, sf_dir).collect()
    filled = defaultdict(int)
    for r in rows:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048
    assert len(filled) * 2048 - sum(filled.values()) < 2048


@pytest.mark.parametrize("chars", [10, 6_000_000])
def test_odd_rows(spark, odd, empty, chars):
    rows = packing.pack(odd, packing.bpe_50k, block_chars=chars).collect()
    assert sum(r.doc_id is None for r in rows) >= 1
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert sum(r.length for r in rows if r.doc_id == 3) == 2 * (len(packing.bpe_50k().encode(" \n\t ").ids) + 1)
    assert packing.pack(empty, packing.bpe_50k).count() == 0
