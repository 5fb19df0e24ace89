"""Removal of repeated byte strings, by suffix arrays of shards.

A string of ``size`` bytes is repeated if it also starts earlier: in a document with a smaller id,
or further left in the same one. Every byte that a repeated string covers is removed.

Strings are brought together by content: of the grams of ``GRAM`` bytes inside a string, the one with
the smallest hash (the leftmost of several) is its anchor, so all copies of a string have the same
anchor at the same place. Neighbouring strings with one anchor form a context, a run of bytes.

1. Blocks of documents send the hashes of their anchors and contexts to buckets by anchor. Where an
   anchor has one context, its first occurrence stays and all others are repeats.
2. Where contexts differ (ends of shared passages, edits) one copy of each is sent to the bucket.
   There they form shards of at most ``shard_bytes``; each gets a suffix array by Larsson-Sadakane
   refinement and Kasai's common prefixes, which show its equal strings. Strings whose anchor lies in several
   shards are merged across them by binary search in the sorted first strings of each.
3. Blocks learn which strings start earlier elsewhere, and remove what they cover.

Hashes have 64 bits for the anchor and 64 more for the context. A block sends equal contexts once,
so copies, however many, add one entry per block. Nothing but bits comes back to a block.

Defined results: a null or empty text has no bytes and an empty rest; a text shorter than ``size``
stays; of equal ids the row read first is earlier; a null id is before all others and comes
back as null; an empty table gives no rows; texts are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuplefeed.llm.common import NO_ID, grouped_by_size, settled, texts_of
from tuplefeed.llm.suffixes import common_prefixes, suffix_array

GRAM = 32
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
FIRST, REPEAT, COMPARE = 0, 1, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = (1 << bits) + 1
    up, back = np.full(n, STEP, np.uint64), np.full(n, BACK, np.uint64)
    up[0] = back[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` keys in a row."""
    n = len(key)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


class Block:
    """The contexts of a block of documents, sorted by anchor and context."""

    def __init__(self, data: bytes, ids: list[int], sizes: list[int], size: int) -> None:
        self.size, self.data = size, data
        self.ends = np.cumsum(np.asarray(sizes, np.int64))
        self.starts = self.ends - np.asarray(sizes, np.int64)
        self.ids = np.asarray(ids, np.int64)
        none = np.zeros(0, np.int64)
        self.low, self.high, self.doc = none, none, none  # first and last string of each context
        self.anchor, self.context, self.new = none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
        x = np.frombuffer(data, np.uint8)
        start = np.flatnonzero(np.arange(len(x)) + size <= np.repeat(self.ends, sizes)) if len(x) else none
        if not len(start):
            return
        gram = min(GRAM, size)
        bits = max(16, len(x).bit_length())
        up, back = _powers(bits)
        prefix = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[x] * up[: len(x)], out=prefix[1:])
        hashed = _mixed((prefix[gram:] - prefix[:-gram]) * back[: len(x) - gram + 1])
        mask = np.uint64((1 << bits) - 1)
        key = (hashed & ~mask) | np.arange(len(hashed), dtype=np.uint64)
        at = (_least(key, size - gram + 1)[start] & mask).astype(np.int64)
        cut = np.flatnonzero(np.append(True, (np.diff(at) != 0) | (np.diff(start) != 1)))
        low, high, at = start[cut], start[np.append(cut[1:], len(start)) - 1], at[cut]
        content = (prefix[high + size] - prefix[low]) * back[low]
        anchor = _mixed(hashed[at] + STEP)  # as smallest hashes they would crowd the low buckets
        context = _mixed(content + _mixed(((at - low) * 4096 + (high - low)).astype(np.uint64) + STEP))
        doc = np.searchsorted(self.starts, low, side="right") - 1
        place = np.empty(len(self.ids), np.int64)
        place[np.lexsort((np.arange(len(self.ids)), self.ids))] = np.arange(len(self.ids))
        by = np.lexsort((low, place[doc], context, anchor))
        self.low, self.high, self.doc, self.anchor, self.context = low[by], high[by], doc[by], anchor[by], context[by]
        self.new = np.append(True, (np.diff(self.anchor) != 0) | (np.diff(self.context) != 0))

    def slices(self, buckets: int) -> np.ndarray:
        """Where the distinct contexts of each bucket start; buckets are ranges of anchors."""
        bucket = ((self.anchor[self.new] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(bucket.astype(np.int64), np.arange(buckets + 1))

    def removed(self, states: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Which bytes go: ``states`` of the distinct contexts, and for those compared, in a row,
        which of their strings are repeats."""
        edge = np.zeros(len(self.data) + 1, np.int32)

        def cover(low: np.ndarray, high: np.ndarray) -> None:
            np.add.at(edge, low, 1)
            np.add.at(edge, high + self.size, -1)

        distinct = np.flatnonzero(self.new)
        whole = ~self.new
        whole[distinct[states == REPEAT]] = True
        cover(self.low[whole], self.high[whole])
        some = distinct[states == COMPARE]
        count = self.high[some] - self.low[some] + 1
        strings = np.repeat(self.low[some] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        strings = strings[repeats.astype(bool)]
        cover(strings, strings)
        return np.cumsum(edge[:-1]) > 0


def equal_strings(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one shard: every string's place among the sorted distinct ones, its text, its start."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    used = np.unique(joined)
    symbols = np.zeros(len(joined) + len(texts), np.int64)
    ends = np.cumsum(sizes + 1)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = np.searchsorted(used, joined) + 1
    order, rank = suffix_array(symbols)
    shared = common_prefixes(symbols, order, rank, size)
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    starts = ends - sizes - 1
    place = order - starts[text[order]]
    string = place + size <= sizes[text[order]]
    # Between two strings that follow each other, suffixes that are too short may stand.
    at = np.flatnonzero(string)
    least = np.minimum.reduceat(shared[: at[-1] + 1], np.append(0, at[:-1] + 1)) if len(at) else shared[:0]
    return np.cumsum(least < size), text[order][at], place[at]


def repeats(texts: list[bytes], anchors: np.ndarray, order: list[np.ndarray], size: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Which strings start earlier in another place, text by text in a row, and where each text's
    strings end.

    ``order`` ranks the texts' first bytes (keys from the first to the last, then the start)."""
    ends = np.cumsum(np.array([len(t) - size + 1 for t in texts], np.int64))
    first_of = ends - np.array([len(t) - size + 1 for t in texts], np.int64)
    flags = np.zeros(int(ends[-1]) if len(texts) else 0, bool)
    by = np.argsort(anchors, kind="stable")
    filled = np.cumsum(np.array([len(texts[i]) + 1 for i in by], np.int64))
    shard = filled // shard_bytes
    split = {int(a) for s in np.flatnonzero(np.diff(shard)) if (a := anchors[by[s]]) == anchors[by[s + 1]]}
    merged: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # sorted strings of split anchors, text, start

    def keys(text: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
        return [order[-1][text] + start, *(k[text] for k in order[-2::-1])]

    for s in np.unique(shard):
        mine = by[shard == s]
        kind, text, start = equal_strings([texts[i] for i in mine], size)
        text = mine[text]
        first = np.lexsort([*keys(text, start), kind])
        later = np.append(False, np.diff(kind[first]) == 0) if len(first) else np.zeros(0, bool)
        flags[first_of[text[first[later]]] + start[first[later]]] = True
        if split:
            stay = first[~later]
            stay = stay[np.isin(anchors[text[stay]], np.array(sorted(split), np.uint64))]
            strings = np.array([texts[t][p : p + size] for t, p in zip(text[stay], start[stay], strict=True)], f"S{size}")
            merged.append((strings, text[stay], start[stay]))
    for k, (strings, text, start) in enumerate(merged):
        for other, other_text, other_start in merged[:k]:
            if not len(other) or not len(strings):
                continue
            at = np.minimum(np.searchsorted(other, strings), len(other) - 1)
            for here in np.flatnonzero(other[at] == strings):
                there = at[here]
                a, b = (text[here], start[here]), (other_text[there], other_start[there])
                before = [tuple(int(c[0]) for c in keys(np.array([t]), np.array([p])))[::-1] for t, p in (a, b)]
                t, p = a if before[0] > before[1] else b
                flags[first_of[t] + p] = True
    return flags, ends


def _written(docs: DataFrame, block_chars: int) -> DataFrame:
    texts = texts_of(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, block = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32
        pairs = ((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)
        for ids, some in grouped_by_size(pairs, block_chars):
            data = [t.encode() for t in some]
            columns = [
                pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(d) for d in data]], pa.list_(pa.int64())), pa.array([pack.compress(b"".join(data))], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "sizes", "data"])
            block += 1

    return settled(texts.mapInArrow(task, "block long, ids array<long>, sizes array<long>, data binary"), "dedup-blocks")


def _planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers byte by byte: the highest bytes of all, then the next; they compress better."""
    return numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _opened(row: object, size: int) -> Block:
    return Block(zstandard.ZstdDecompressor().decompress(row.data), list(row.ids), list(row.sizes), size)


_BLOCK_SCHEMA = ["block", "ids", "sizes", "data"]


def _hashes(blocks: DataFrame, size: int, buckets: int) -> DataFrame:
    """(bucket, block, anchors, contexts, ids, starts) of the distinct contexts."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples():
                b = _opened(row, size)
                at, cuts = np.flatnonzero(b.new), b.slices(buckets)
                out = []
                for k in np.flatnonzero(np.diff(cuts)):
                    mine = at[cuts[k] : cuts[k + 1]]
                    out.append((int(k), row.block, b.anchor[mine].tobytes(), b.context[mine].tobytes(),
                                _planes(b.ids[b.doc[mine]]), _planes(b.low[mine] - b.starts[b.doc[mine]])))
                yield pd.DataFrame(out, columns=["bucket", "block", "anchors", "contexts", "ids", "starts"])

    return blocks.mapInPandas(task, "bucket int, block long, anchors binary, contexts binary, ids binary, starts binary")


def _states(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: which context occurrences are first, which are repeats, which must be compared."""
    parts = [[np.frombuffer(r.anchors, np.uint64), np.frombuffer(r.contexts, np.uint64), _from_planes(r.ids), _from_planes(r.starts)] for r in rows.itertuples()]
    sizes = [len(p[0]) for p in parts]
    anchor, context, ids, starts = (np.concatenate(c) for c in zip(*parts, strict=True))
    block = np.repeat(rows["block"].to_numpy(), sizes)
    by = np.lexsort((starts, block, ids, context, anchor))
    new_anchor = np.append(True, np.diff(anchor[by]) != 0)
    first = new_anchor | np.append(True, np.diff(context[by]) != 0)
    group = np.cumsum(new_anchor) - 1
    several = np.bincount(group, first) > 1
    states = np.empty(len(by), np.uint8)
    states[by] = np.where(first, np.where(several[group], COMPARE, FIRST), REPEAT)
    ends = np.cumsum(sizes)
    return pd.DataFrame({
        "block": rows["block"], "bucket": rows["bucket"],
        "data": [states[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)],
    })


def _joined(answers: pd.DataFrame) -> np.ndarray:
    """A block's answers, put together in the order of buckets."""
    data = answers.sort_values("bucket")["data"]
    return np.frombuffer(b"".join(data), np.uint8)


def _contexts(blocks: DataFrame, states: DataFrame, size: int, buckets: int) -> DataFrame:
    """(bucket, block, texts, lengths, anchors, ids, docs, starts) of contexts to compare."""
    schema = "bucket int, block long, texts binary, lengths binary, anchors binary, ids binary, docs binary, starts binary"
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def send(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in block.itertuples():
            b = _opened(row, size)
            distinct, cuts, found = np.flatnonzero(b.new), b.slices(buckets), _joined(answers)
            for k in np.flatnonzero(np.diff(cuts)):
                mine = distinct[cuts[k] : cuts[k + 1]][found[cuts[k] : cuts[k + 1]] == COMPARE]
                if len(mine):
                    ends, doc = b.high[mine] + size, b.doc[mine]
                    texts = b"".join([b.data[s:e] for s, e in zip(b.low[mine], ends, strict=True)])
                    out.append((int(k), row.block, zstandard.ZstdCompressor(level=1).compress(texts), _planes(ends - b.low[mine]),
                                b.anchor[mine].tobytes(), _planes(b.ids[doc]), _planes(doc), _planes(b.low[mine] - b.starts[doc])))
        return pd.DataFrame(out, columns=names)

    return blocks.groupBy("block").cogroup(states.groupBy("block")).applyInPandas(send, schema)


def _compared(size: int, shard_bytes: int):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        texts, parts, counts = [], [], []
        for r in rows.itertuples():
            data, lengths = zstandard.ZstdDecompressor().decompress(r.texts), _from_planes(r.lengths)
            ends = np.cumsum(lengths)
            texts += [data[e - n : e] for e, n in zip(ends, lengths, strict=True)]
            counts.append(len(lengths))
            parts.append([np.frombuffer(r.anchors, np.uint64), _from_planes(r.ids), _from_planes(r.docs), _from_planes(r.starts)])
        anchors, ids, docs, starts = (np.concatenate(c) for c in zip(*parts, strict=True))
        block = np.repeat(rows["block"].to_numpy(), counts)
        flags, ends = repeats(texts, anchors, [ids, block, docs, starts], size, shard_bytes)
        ends = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        return pd.DataFrame({
            "block": rows["block"], "bucket": rows["bucket"],
            "data": [flags[a:e].astype(np.uint8).tobytes() for a, e in zip(ends[:-1], ends[1:], strict=True)],
        })

    return compare


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def remove(docs: DataFrame, size: int = 100, block_chars: int = 1_000_000, shard_bytes: int = 400_000) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs, and the digest of what is left."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answer = "block long, bucket int, data binary"
    blocks = _written(docs, block_chars)
    states = settled(_hashes(blocks, size, buckets).groupBy("bucket").applyInPandas(_states, answer), "dedup-states")
    flags = settled(
        _contexts(blocks, states, size, buckets).groupBy("bucket").applyInPandas(_compared(size, shard_bytes), answer), "dedup-repeats"
    )
    answers = states.withColumn("compared", F.lit(False)).unionByName(flags.withColumn("compared", F.lit(True)))

    def finish(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in block.itertuples():
            b = _opened(row, size)
            gone = b.removed(_joined(answers[~answers["compared"]]), _joined(answers[answers["compared"]]))
            for doc, (s, e) in enumerate(zip(b.starts.tolist(), b.ends.tolist(), strict=True)):
                edges = np.flatnonzero(np.diff(gone[s:e].astype(np.int8), prepend=0, append=0)).tolist()
                kept, done = [], s
                for a, z in zip(edges[::2], edges[1::2], strict=True):
                    kept.append(b.data[done : s + a])
                    done = s + z
                kept.append(b.data[done:e])
                key = int(b.ids[doc])
                n = sum(edges[1::2]) - sum(edges[::2])
                out.append((None if key == NO_ID else key, e - s, n, len(edges) // 2, hashlib.sha256(b"".join(kept)).hexdigest(), edges))
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
        return frame.astype({"doc_id": "Int64"})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, RESULT)
