import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tuplefeed.llm import suffix_tree, word_contexts


def plain(texts, learns, spelling, longest, weight, least_gain):
    """Every context of words by definition; the log10 score of each text."""
    rows = [["", *t.lower().split(), ""] for t in texts]
    runs, words = Counter(), Counter()
    for row, learn in zip(rows, learns, strict=True):
        for i in range(1, len(row)):
            words[row[i]] += learn
            for k in range(1, min(i, longest) + 1):
                runs[tuple(row[i - k : i + 1])] += learn
    context = Counter()
    for run, n in runs.items():
        context[run[:-1]] += n
    total, kinds = sum(words.values()), sum(n > 0 for n in words.values())

    def p(run):
        if len(run) == 1:
            return (words[run[0]] + kinds * spelling[run[0]]) / (total + kinds)
        shorter, c = p(run[1:]), context[run[:-1]]
        return (runs[run] + weight * shorter) / (c + weight) if c >= 2 else shorter

    gain = Counter()
    for run, n in runs.items():
        if n and context[run[:-1]] >= 2:
            shorter = p(run[1:])
            gain[run[:-1]] += n * math.log((n - 1 + weight * shorter) / (context[run[:-1]] - 1 + weight) / shorter)
    kept = {c for c, g in gain.items() if g > least_gain}
    out = []
    for row in rows:
        s = 0.0
        for i in range(1, len(row)):
            k = max([k for k in range(1, min(i, longest) + 1) if tuple(row[i - k : i]) in kept], default=0)
            s += math.log10(p(tuple(row[i - k : i + 1])))
        out.append(s)
    return out, kept


def made(seed, n):
    rng = random.Random(seed)
    words = ["the", "then", "thin", "a", "an", "été", "X", "on", "of", "to"]
    some = []
    for _ in range(n):
        row = [rng.choice(words)]
        while len(row) < 2 + rng.randrange(25):  # most words follow from the one before
            row.append(words[(3 * words.index(row[-1]) + 1) % 10] if rng.random() < 0.7 else rng.choice(words))
        some.append(" ".join(row))
    return [*some, some[3], some[3], some[5], "the unseen ζ bytes", ""]


@pytest.mark.parametrize("longest", [1, 3])
def test_scores_equal_the_definitions(spark, longest, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK_CHARS", 400)
    texts = made(4, 80)
    learns = [i % 7 != 2 for i in range(len(texts))]
    trained = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r.score for r in suffix_tree.score(trained, lambda k: k % 7 != 2, longest=longest).collect()}
    vocabulary = sorted({w for t, learn in zip(texts, learns, strict=True) if learn for w in t.lower().split()})
    one = spark.createDataFrame([([0] * len(vocabulary), bytearray(suffix_tree.zstandard.compress("".join(w + " \n" for w in vocabulary).encode())))], "held array<int>, data binary")
    tree = suffix_tree.train(one)
    every = sorted({w for t in texts for w in t.lower().split()})
    spelling = dict(zip(["", *every], 10.0 ** suffix_tree.spellings(tree, [w.encode() for w in every]), strict=True))
    expected, kept = plain(texts, learns, spelling, longest, 4.0, 1.0)
    assert len(kept) > 5 and max(map(len, kept)) == longest
    assert [rows[i] for i in range(len(texts))] == pytest.approx(expected, rel=1e-9)


def test_probabilities_of_the_next_token_sum_to_at_most_one(spark):
    texts = made(5, 60)
    every = sorted({w for t in texts for w in t.lower().split()})
    asked = [*(f"{a} {b}" for a in every[:4] for b in every), *every[:4]]
    docs = [(i, t) for i, t in enumerate([*texts, *asked])]
    held = len(texts)
    rows = {r.doc_id: r.score for r in suffix_tree.score(spark.createDataFrame(docs, "doc_id long, text string"), lambda k: k < held, longest=1).collect()}
    # P(a b end) summed over b, and P(a end), stay below P(a).
    for a in range(4):
        both = sum(10.0 ** rows[held + a * len(every) + b] for b in range(len(every)))
        assert 0 < both + 10.0 ** rows[held + 4 * len(every) + a] < 1


def test_contexts_grow_with_the_input_and_repeated_texts_stand_apart(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    apart = []
    for n in (60, 240):
        texts = [" ".join(rng.choices(words, k=60)) for _ in range(n)]
        docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts[: n // 3])]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        rows = {r.doc_id: r.score for r in suffix_tree.score(df, lambda k: F.lit(True), longest=2).collect()}
        once = [rows[i] for i in range(n // 3, n)]
        assert all(rows[1000 + i] == rows[i] for i in range(n // 3))
        apart.append(sum(rows[i] > max(once) for i in range(n // 3)))
    assert apart == [20, 80]


def test_numbers_survive_their_planes():
    numbers = np.array([0, 1, 255, 256, 2**40 + 7, 2**64 - 1], np.uint64)
    assert (word_contexts.numbers_of(word_contexts.planes(numbers)) == numbers).all()
    assert len(word_contexts.numbers_of(word_contexts.planes(numbers[:0]))) == 0


def test_buckets_and_bits_grow_with_the_tokens():
    assert word_contexts.buckets_of(10, 8) == 8 and word_contexts.buckets_of(10**10, 8) == 2500
    assert word_contexts.bits_of(10**6) == 40 and word_contexts.bits_of(10**15) == 64


def test_odd_rows_and_empty_tables(spark, odd, empty):
    rows = suffix_tree.score(odd, lambda k: F.lit(True), longest=3).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    by_id = {}
    for r in rows:
        assert by_id.setdefault(r.doc_id, r.score) == r.score
    assert suffix_tree.score(empty, lambda k: F.lit(True), longest=3).count() == 0
    none = suffix_tree.score(odd, lambda k: F.lit(False), longest=3).collect()
    assert [r.score for r in none if r.doc_id == 1] == [pytest.approx(-math.log10(256))]
    assert all(math.isfinite(r.score) for r in none)


def test_contexts_of_a_level_are_those_of_sorted_keys_without_a_sort(monkeypatch):
    rng = np.random.default_rng(6)
    token = np.append(np.where(rng.random(600) < 0.1, 0, rng.integers(1, 9, 600)), 0)
    hashes = rng.integers(0, 2**63, 8).astype(np.uint64)
    learns = rng.random(int((token == 0).sum())) < 0.8
    sorts, of = [], word_contexts.Keys.of.__func__
    monkeypatch.setattr(word_contexts.Keys, "of", classmethod(lambda cls, keys: sorts.append(len(keys)) or of(cls, keys)))
    state = word_contexts.Block(hashes, token, learns, 40)
    state.begin(np.full(9, -2.0), np.append(learns.sum(), np.bincount(token, minlength=9)[1:]))
    for level in (1, 2, 3):
        places, keys = state.run_keys(level)
        seen = np.bincount(keys.at, minlength=len(keys.distinct)).astype(np.uint64)
        state.counted(level, {0: word_contexts.planes(seen)}, 4.0)
        expected = np.unique(state.runs[level - 1][state.candidate - 1] >> state.shift, return_inverse=True)
        assert len(state.candidate) and (state.contexts().distinct == expected[0]).all() and (state.contexts().at == expected[1]).all()
    assert sorts[0] == 9 and len(sorts) == 1 + 2 * 3  # the distinct words once, then a level's runs in each of the two calls


def test_long_logarithms_keep_what_is_below_the_smallest_number():
    got = word_contexts.log_sum(np.array([0, 0, 3, 3]), 4.0, np.array([-2000.0, -1.0, -2000.0, -1.0]))
    assert got == pytest.approx([math.log(4) - 2000, math.log(4) - 1, math.log(3), math.log(3 + 4 / math.e)], rel=1e-14)


def test_spelling_in_pieces_is_that_of_one_piece(spark, monkeypatch):
    words = sorted({w.encode() for t in made(7, 60) for w in t.split()})
    one = spark.createDataFrame([([0] * len(words), bytearray(suffix_tree.zstandard.compress(b"".join(w + b" \n" for w in words))))], "held array<int>, data binary")
    tree = suffix_tree.train(one, 4, 1e-6, 1)
    whole = suffix_tree.spellings(tree, words)
    monkeypatch.setattr(suffix_tree, "PIECE", 5)
    assert tree.depth == 4 and (suffix_tree.spellings(tree, words) == whole).all() and len(whole) == len(words) + 1
    assert len(suffix_tree.spellings(tree, [])) == 1
