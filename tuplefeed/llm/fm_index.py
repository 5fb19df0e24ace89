"""Benchmark decontamination by an FM-index of each shard of documents.

A shard is some documents of one task. Its words become numbers of the benchmark's vocabulary;
words outside it end a run, and runs shorter than the shortest phrase cannot hold one, so only
the other runs are indexed. Phrases are searched backward through the ranks of a wavelet tree,
all at once; occurrences are located by walking to sampled suffix positions; the spans found are
merged per document.

The phrases of a benchmark are sent to tasks in blocks of at most ``block_words`` words, one pass
over the documents for each block, so what a task holds has a bound however large the benchmark.

Defined results: a null or empty text has no words and is not contaminated; repeated rows are
each marked; null ids stay null; items without words match nothing, as does an empty benchmark,
equal items are all named, one with a null id as ``None``; a text of any length is
searched whole; other columns are kept, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuplefeed.llm.common import LOWERED, prepared, texts_of
from tuplefeed.llm.suffixes import suffix_array

# Fixed value: the bytes of words, by the definition of the task.
_BREAKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_WORDS = bytes(32 if b in _BREAKS else b for b in LOWERED)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPANS, ITEMS, WORDS = "__spans", "__items", "__words"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split()


class WaveletTree:
    """Ranks of symbols, kept level by level from the highest bit (all nodes of a level in one row)."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros_like(end)
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            bit = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[k][start], self.ones[k][end]
            start = np.where(bit, self.zeros[k] + a, start - a)
            end = np.where(bit, self.zeros[k] + b, end - b)
        return end - start

    def at(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(place)
        for k in range(self.bits):
            before = self.ones[k][place]
            bit = self.ones[k][place + 1] - before
            place = np.where(bit == 1, self.zeros[k] + before, place - before)
            symbol = (symbol << 1) | bit
        return symbol


class FMIndex:
    """Symbols 0..top of a text; inside, each counts one more and 0 is the end of the text."""

    def __init__(self, symbols: np.ndarray, top: int, every: int = 8) -> None:
        text, top = np.append(symbols + 1, 0), top + 1
        order, _ = suffix_array(text)
        last = text[order - 1]
        self.n = len(text)
        self.tree = WaveletTree(last, max(1, int(top).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.sampled = order % every == 0
        self.sample_of = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase; phrases are right-aligned and filled up with -1."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            on = np.flatnonzero((phrases[:, j] >= 0) & (low < high))
            symbol = phrases[on, j] + 1
            low[on] = self.before[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.before[symbol] + self.tree.rank(symbol, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row: back to a sampled suffix, then on by as many steps."""
        found, steps = np.zeros(len(rows), np.int64), 0
        lanes, rows = np.arange(len(rows)), rows.copy()
        while len(lanes):
            here = self.sampled[rows]
            found[lanes[here]] = self.samples[self.sample_of[rows[here]]] + steps
            lanes, rows = lanes[~here], rows[~here]
            symbol = self.tree.at(rows)
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return found


class Phrases:
    """The windows of some benchmark items, as numbers of their own vocabulary."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = 10) -> None:
        self.number: dict[bytes, int] = {}
        of: dict[tuple[int, ...], list[str]] = {}
        for item, words in items:
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words)
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                of.setdefault(ids[i : i + window], []).append(item)
        self.rows = np.full((len(of), window), -1, np.int64)
        for k, ids in enumerate(of):
            self.rows[k, window - len(ids) :] = ids
        self.sizes = np.array([len(x) for x in of], np.int64)
        self.items = [sorted(set(x)) for x in of.values()]

    def hits(self, docs: list[list[bytes]]) -> tuple[list[list[int]], list[list[str]]]:
        """For each document, merged spans of hit words (start, end, start, ...) and the items."""
        spans, items = [[] for _ in docs], [set() for _ in docs]
        if not len(self.rows):
            return spans, [[] for _ in docs]
        get = self.number.get
        parts = [np.zeros(1, np.int64)]
        for words in docs:
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
            parts.append(np.zeros(1, np.int64))
        symbols = np.concatenate(parts)
        doc_start = np.cumsum([0, *(len(w) + 1 for w in docs)])[:-1] + 1
        ends = np.flatnonzero(symbols == 0)
        lengths = np.diff(ends) - 1
        runs = np.flatnonzero(lengths >= self.sizes.min())
        if not len(runs):
            return spans, [[] for _ in docs]
        size = lengths[runs] + 1  # with the 0 that ends the run
        offset = np.cumsum(size) - size
        place = np.repeat(ends[runs] + 1 - offset, size) + np.arange(int(size.sum()))
        index = FMIndex(symbols[place], len(self.number))
        low, high = index.search(self.rows)
        which = np.repeat(np.arange(len(low)), high - low)
        count = high - low
        rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        start = place[index.locate(rows)]
        doc = np.searchsorted(doc_start, start, side="right") - 1
        by = np.lexsort((start, doc))
        for d, s, w in zip(doc[by].tolist(), start[by].tolist(), which[by].tolist(), strict=True):
            s -= int(doc_start[d])
            e = s + int(self.sizes[w])
            mine = spans[d]
            if mine and s <= mine[-1]:
                mine[-1] = max(mine[-1], e)
            else:
                mine += [s, e]
            items[d].update(self.items[w])
        return spans, [sorted(x) for x in items]


def _phrase_blocks(benchmark: DataFrame, block_words: int, window: int) -> Iterator[Phrases]:
    held, size = [], 0
    named = benchmark.select(*(F.coalesce(benchmark[c].cast("string"), F.lit(null)) for c, null in (("item_id", "None"), ("text", ""))))
    for item, text in named.toLocalIterator():
        words = words_of(text)
        if words:
            held.append((item, words))
            size += len(words)
        if size >= block_words:
            yield Phrases(held, window)
            held, size = [], 0
    if held:
        yield Phrases(held, window)


def _united(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2], b[1::2], strict=True)]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _mark(docs: DataFrame, phrases: Phrases, shard_chars: int) -> DataFrame:
    """Add a block's hits to the columns of spans and items."""
    at, schema = docs.columns.index("text"), docs.schema
    spans_at, items_at, words_at = (docs.columns.index(c) for c in (SPANS, ITEMS, WORDS))
    sent = docs.sparkSession.sparkContext.broadcast(phrases)  # at most block_words words

    def shard(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [[words_of(t or "") for t in b.column(at).to_pylist()] for b in batches]
        spans, items = sent.value.hits([w for part in texts for w in part])
        done = 0
        for b, words in zip(batches, texts, strict=True):
            columns, n = b.columns, len(words)
            old_spans, old_items = b.column(spans_at).to_pylist(), b.column(items_at).to_pylist()
            new = {
                spans_at: [_united(o, s) for o, s in zip(old_spans, spans[done : done + n], strict=True)],
                items_at: [sorted({*o, *s}) for o, s in zip(old_items, items[done : done + n], strict=True)],
                words_at: [len(w) for w in words],
            }
            for k, values in new.items():
                columns[k] = pa.array(values, b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)
            done += n

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.column(at).nbytes
            if size >= shard_chars:
                yield from shard(held)
                held, size = [], 0
        if held:
            yield from shard(held)

    return docs.mapInArrow(task, schema)


def marked(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_chars: int = 4_000_000, block_words: int = 200_000) -> DataFrame:
    """``docs`` with merged word spans, items and the number of words."""
    prepared(docs.sparkSession)
    out = docs.withColumns({
        SPANS: F.array().cast("array<bigint>"), ITEMS: F.array().cast("array<string>"), WORDS: F.lit(0).cast("long"),
    })
    blocks = 0
    for phrases in _phrase_blocks(benchmark, block_words, window):
        out, blocks = _mark(out, phrases, shard_chars), blocks + 1
    return out if blocks else _mark(out, Phrases([]), shard_chars)


def find(docs: DataFrame, benchmark: DataFrame, **parameters: int) -> DataFrame:
    """Per document: words, hit words, items met (as a digest) and whether there are any."""
    hits = marked(texts_of(docs), benchmark, **parameters)
    signed = F.transform(SPANS, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)
    return hits.select(
        "doc_id",
        F.col(WORDS).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(ITEMS, ","), 256).alias("items_sha256"),
        (F.size(SPANS) > 0).alias("contaminated"),
        F.col(ITEMS).alias("items"),
        F.col(SPANS).alias("word_spans"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **parameters: int) -> DataFrame:
    """``docs`` without the hit words and what stands between words of one span."""
    apart = docs.toDF(*("text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)))  # no clash with the marks
    hits = marked(apart, benchmark, **parameters)
    at, spans_at, names = hits.columns.index("text"), hits.columns.index(SPANS), docs.columns

    def cut(text: str | None, spans: list[int]) -> str | None:
        if not spans:
            return text
        words = [m.span() for m in WORD.finditer(text)]
        kept, done = [], 0
        for s, e in zip(spans[::2], spans[1::2], strict=True):
            kept.append(text[done : words[s][0]])
            done = words[e - 1][1]
        return "".join([*kept, text[done:]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = b.columns[: len(names)]
            texts = map(cut, b.column(at).to_pylist(), b.column(spans_at).to_pylist())
            columns[at] = pa.array(list(texts), b.schema.field(at).type)
            fields = [b.schema.field(k).with_name(name) for k, name in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return hits.mapInArrow(task, T.StructType(docs.schema.fields))
