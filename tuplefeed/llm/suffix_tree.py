"""Language-model scoring by a probabilistic suffix tree, with a word-count base beside it.

The tree's contexts are runs of up to ``longest`` words, counted and tested in tables that grow with
the input (``word_contexts``). Their level 0 mixes the words' counts with their spelling, so unknown
words have a probability too: a tree over bytes, of ``depth``, learns from the distinct training words
and predicts a word's bytes and the space that ends it, or a line end for the end of a text.

The tree over bytes grows level by level: a context is a candidate from ``least_count`` occurrences
on, and only while it makes up ``least_share`` of the bytes, which bounds each level by
1 / ``least_share`` contexts; it is about spelling, and what grows are the words. Next-byte distributions are smoothed
towards the next shorter context (Witten-Bell); a context is retained if its distribution diverges
from the shorter one's by more than its parameters cost, or if a longer retained one needs it.
Without ``longest`` this tree learns from whole texts and scores them alone.

Texts are written once, in blocks, to the shared folder; each level of words reads them again, with
the answers so far. The byte tree's sums, bounded as above, meet on the driver. Counts of words
and contexts have no bound, so they stay distributed: each block sends its distinct words and runs
once, to buckets by hash, and gets their counts back. A frequent one is one entry of a block, so it
is no hot key.

Defined results: a null or empty text is the end token alone; repeated rows are scored each; a null
id trains (it has no remainder) and comes back as null; without training texts every byte has the
same probability; an empty table gives no rows; texts are taken whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuplefeed.llm import word_contexts
from tuplefeed.llm.common import LOWERED, grouped_by_size, packed, settled, texts_of, unpacked

END = 10  # a line end, which no word holds
SLICE = 1 << 16
BLOCK_CHARS = 3_000_000
PIECE = 1 << 15  # bytes scored at once


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWERED).split()


def spelled(texts: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts behind ``depth`` line ends, and where each text's bytes end."""
    parts = [b" ".join([*words, b"\n"]) for words in texts]
    ends = depth + np.cumsum([len(p) for p in parts])
    return np.frombuffer(b"\n" * depth + b"".join(parts), np.uint8), ends


class Tree:
    """Contexts by level; 0 is no context. Symbols are classes of bytes, 0 for those unseen.

    ``down[level]`` leads from a shorter context and one more symbol to a context. With ``follows``
    (what followed each context) and ``shorter`` (each one's shorter context), it can score.
    """

    def __init__(self, symbol: np.ndarray, down: list[np.ndarray], follows: list[np.ndarray] | None = None, shorter: list[np.ndarray] | None = None) -> None:
        self.symbol, self.width, self.depth = symbol, int(symbol.max(initial=0)) + 1, len(down)
        self.down, self.follows, self.shorter = down, follows, shorter
        w = self.width
        # The contexts of three symbols, the newest first, are looked up at once.
        here, self._levels = np.zeros((), np.int32), []
        for table in down[:3]:
            here = table.reshape(-1, w)[here]
            self._levels.append(here.reshape(here.shape + (1,) * (3 - here.ndim)))
        self._third = np.ascontiguousarray(here).ravel() if len(down) > 2 else None
        if follows is not None:
            self._prepare()

    def __reduce__(self) -> tuple:
        """Sent to tasks as the counts, which compress well."""
        sparse = lambda arrays: None if arrays is None else [(a.shape, packed(a.ravel())) for a in arrays]
        return _restored, (self.symbol, sparse(self.down), sparse(self.follows), sparse(self.shorter))

    def _prepare(self) -> None:
        total = int(self.follows[0].sum())
        smoothed = [(self.follows[0] + 1.0) / (total + 256.0)]
        for level in range(1, len(self.follows)):
            smoothed.append(smooth(self.follows[level], smoothed[-1][self.shorter[level]]))
        self.base = np.cumsum([1, *(len(f) - 1 for f in self.follows[1:])]) - 1  # node = base + context
        self.log10 = np.log10(np.concatenate([smoothed[0], *(p[1:] for p in smoothed[1:])]))
        w, node = self.width, np.zeros((1, 1, 1), np.int32)
        for level, here in enumerate(self._levels):
            node = np.where(here > 0, here + np.int32(self.base[level]), node)
        self._node = np.ascontiguousarray(np.broadcast_to(node, (w, w, w))).ravel()

    def _codes(self, x: np.ndarray, start: int) -> np.ndarray:
        w, n = np.int32(self.width), len(x)
        return (x[start - 1 : n - 1] * w + x[start - 2 : n - 2]) * w + x[start - 3 : n - 3]

    def deepest(self, x: np.ndarray, start: int) -> np.ndarray:
        """The context of the last level (the third at least) before every byte from ``start`` on."""
        w, here = np.int32(self.width), self._third[self._codes(x, start)]
        for k in range(3, self.depth):
            here = self.down[k][here * w + x[start - k - 1 : len(x) - k - 1]]
        return here

    def score(self, data: bytes) -> np.ndarray:
        """The log10 probability of every byte, in its longest context."""
        start, raw = max(3, self.depth), np.frombuffer(data, np.uint8)
        raw = np.append(np.full(start, END, np.uint8), raw)
        pieces = [self._scored(raw[max(0, at - start) : at + PIECE], start) for at in range(start, len(raw), PIECE)]
        return np.concatenate([*pieces, np.empty(0)])

    def _scored(self, raw: np.ndarray, start: int) -> np.ndarray:
        """A piece of bytes behind ``start`` others; what it takes in between fits a core's cache."""
        w, x = np.intp(self.width), self.symbol.astype(np.intp).take(raw)
        codes = (x[start - 1 : -1] * w + x[start - 2 : -2]) * w + x[start - 3 : -3]
        node = self._node.take(codes)
        if self.depth > 3:
            here = self._third.take(codes)
            for k in range(3, self.depth):
                here = self.down[k].take(here * w + x[start - k - 1 : len(x) - k - 1])
                node = np.where(here > 0, here + np.int32(self.base[k]), node)
        return self.log10.ravel().take(node * w + x[start:])


def _restored(symbol: np.ndarray, *sparse: list | None) -> Tree:
    dense = [None if arrays is None else [unpacked(d).reshape(shape) for shape, d in arrays] for arrays in sparse]
    return Tree(symbol, [d.astype(np.int32) for d in dense[0]], *dense[1:])


def smooth(follows: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Distributions of contexts, towards those of their shorter contexts."""
    kinds, total = (follows > 0).sum(1, keepdims=True), follows.sum(1, keepdims=True)
    return (follows + kinds * shorter) / np.maximum(total + kinds, 1)


def numbered(texts: list[list[bytes]]) -> tuple[bytes, np.ndarray]:
    """The distinct words of some texts, and the number of each token's word; 0 ends a text."""
    flat = list(chain.from_iterable((*words, b"") for words in texts))
    number: dict[bytes, int] = defaultdict(count(1).__next__)
    number[b""] = 0
    tokens = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    return b"\n".join(list(number)[1:]), tokens


def _written(texts: DataFrame, learns: Column, raw: bool = True) -> DataFrame:
    """Blocks of texts with their ids and which of them are held out: numbered words, and with
    ``raw`` the bytes as well."""
    keyed = texts.withColumn("held", (~learns).cast("int"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, block = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32
        rows = ((list(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)), b.column(1).to_pylist()) for b in batches)
        for keys, some in grouped_by_size(rows, BLOCK_CHARS):
            split = [words_of(t) for t in some]
            words, tokens = numbered(split)
            data = pack.compress(spelled(split, 0)[0].tobytes()) if raw else None
            columns = [
                pa.array([block], pa.int64()), pa.array([[k for k, _ in keys]], pa.list_(pa.int64())),
                pa.array([[h for _, h in keys]], pa.list_(pa.int32())), pa.array([data], pa.binary()),
                pa.array([pack.compress(words)], pa.binary()), pa.array([word_contexts.planes(tokens)], pa.binary()), pa.array([len(tokens)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "held", "data", "words", "tokens", "size"])
            block += 1

    return settled(keyed.mapInArrow(task, "block long, ids array<long>, held array<int>, data binary, words binary, tokens binary, size long"), "tree-blocks")


def learnt_of(data: bytes, held: list[int]) -> bytes:
    """The bytes of the texts that train."""
    texts = data.split(b"\n")[:-1]
    return b"".join(t + b"\n" for t, h in zip(texts, held, strict=True) if not h)


def _over_bytes(blocks: DataFrame, count: Callable[[Iterator[bytes]], Iterator[dict]], schema: str) -> DataFrame:
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        data = (learnt_of(unpack.decompress(d), held) for held, d in rows)
        for columns in count(data):
            yield pa.RecordBatch.from_arrays([pa.array(columns[n]) for n in names], names=names)

    return blocks.select("held", "data").mapInArrow(task, schema)


def _summed(blocks: DataFrame, count: Callable[[Iterator[bytes]], np.ndarray]) -> np.ndarray:
    """The sum over all tasks of the array that ``count`` makes of a task's bytes."""
    schema = "slice long, part long, data binary"

    def make(data: Iterator[bytes]) -> Iterator[dict]:
        part, total = TaskContext.get().partitionId(), count(data)
        for at in range(0, len(total), SLICE):
            piece = total[at : at + SLICE]
            if piece.any():
                yield {"slice": [at // SLICE], "part": [part], "data": [packed(piece)]}

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        data = sum(unpacked(d) for d in rows["data"])
        return pd.DataFrame({"slice": rows["slice"][:1], "part": rows["part"][:1] // 64, "data": [packed(data)]})

    some = _over_bytes(blocks, make, schema).groupBy("slice", F.floor(F.col("part") / 64).alias("some")).applyInPandas(add, schema)
    rows = some.groupBy("slice").applyInPandas(add, schema).select("slice", "data").collect()
    pieces = {r["slice"] * SLICE: unpacked(r["data"]) for r in rows}
    out = np.zeros(max((at + len(p) for at, p in pieces.items()), default=0), np.int64)
    for at, piece in pieces.items():
        out[at : at + len(piece)] = piece
    return out


def _counted(blocks: DataFrame, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """For the deepest contexts: how often each symbol follows, and stands before them."""
    sent = blocks.sparkSession.sparkContext.broadcast(tree)  # bounded by the share of contexts
    size = (int(tree.down[-1].max(initial=0)) + 1) * tree.width

    def count(data: Iterator[bytes]) -> np.ndarray:
        known, total = sent.value, np.zeros(2 * size, np.int64)
        for raw in data:
            start = known.depth + 1
            x = known.symbol[np.frombuffer(b"\n" * start + raw, np.uint8)]
            here = known.deepest(x, start) * np.int32(known.width)
            total[:size] += np.bincount(here + x[start:], minlength=size)
            total[size:] += np.bincount(here + x[: len(x) - start], minlength=size)
        total[: known.width] = total[size : size + known.width] = 0  # no context
        return total

    found = _summed(blocks, count)
    sent.destroy()
    found = np.pad(found, (0, 2 * size - len(found)))
    return found[:size].reshape(-1, tree.width), found[size:].reshape(-1, tree.width)


def train(blocks: DataFrame, depth: int = 6, least_share: float = 5e-6, least_count: int = 30) -> Tree:
    """A tree from the texts of ``blocks`` that are not held out."""


    def triples(data: Iterator[bytes]) -> Iterator[dict]:
        total = np.zeros(1 << 24, np.int32)
        for block in data:
            raw = np.frombuffer(b"\n\n" + block, np.uint8).astype(np.int32)
            np.add.at(total, (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:], 1)
        key = np.flatnonzero(total)
        yield {"key": key, "n": total[key].astype(np.int64)}

    rows = _over_bytes(blocks, triples, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = rows["key"].to_numpy(), rows["n"].to_numpy()  # at most 2**24 of them
    symbol = np.zeros(256, np.int32)
    known = np.unique(key & 255)
    symbol[known] = np.arange(1, len(known) + 1)
    width, total = len(known) + 1, int(n.sum())
    if total == 0:
        return Tree(symbol, [], [np.zeros((1, 1), np.int64)], [np.zeros(1, np.int64)])
    count = np.zeros((width, width, width), np.int64)
    np.add.at(count, (symbol[key >> 16], symbol[(key >> 8) & 255], symbol[key & 255]), n)
    least = max(least_count, least_share * total)

    # Level by level: the contexts, the shorter context of each, and what follows them.
    follows, shorter, down = [count.sum((0, 1))[None, :]], [np.zeros(1, np.int64)], []
    before, longer = count.sum((0, 2))[None, :], np.ones((1, 1), bool)
    while len(down) < depth:
        parent, more = np.nonzero((before >= least) & longer)
        if not len(parent):
            break
        table = np.zeros(before.shape, np.int32)
        table[parent, more] = np.arange(1, len(parent) + 1)
        down.append(table.ravel())
        shorter.append(np.append(0, parent))
        none = np.zeros((1, width), np.int64)
        if len(down) == 1:
            one = more
            following, before = np.concatenate([none, count.sum(0)[one]]), np.concatenate([none, count.sum(2).T[one]])
        elif len(down) == 2:
            newest = one[parent - 1]
            following, before = np.concatenate([none, count[more, newest]]), np.concatenate([none, count[:, more, newest].T])
        else:
            following, before = _counted(blocks, Tree(symbol, down))
        follows.append(following)
        longer = np.append(False, more != symbol[END])[:, None]  # a text's start ends its contexts
    return _retained(symbol, down, shorter, follows)


def _retained(symbol: np.ndarray, down: list, shorter: list, follows: list) -> Tree:
    """The tree of the contexts whose distribution diverges, and of those that these need."""
    width, keep, nearest = follows[0].shape[1], [np.ones(1, bool)], (follows[0] + 1.0) / (follows[0].sum() + 256.0)
    for level in range(1, len(follows)):
        c, before = follows[level], nearest[shorter[level]]
        p = smooth(c, before)
        gain = (c * np.log(np.where(c > 0, p / before, 1.0))).sum(1)
        kinds, total = (c > 0).sum(1), np.maximum(c.sum(1), 2)
        keep.append(gain > 0.5 * kinds * np.log(total))
        keep[-1][0] = False
        nearest = p
    for level in range(len(keep) - 1, 1, -1):
        keep[level - 1][shorter[level][keep[level]]] = True
    numbers = [np.where(k, np.cumsum(k), 0).astype(np.int32) for k in keep]
    numbers[0] = np.zeros(1, np.int32)
    stay = [np.append(0, np.flatnonzero(k)) for k in keep]
    stay[0] = np.zeros(1, np.int64)
    levels = range(1, len(keep))
    return Tree(
        symbol,
        [numbers[k][down[k - 1].reshape(-1, width)][stay[k - 1]].ravel() for k in levels],
        [follows[0], *(follows[k][stay[k]] for k in levels)],
        [shorter[0], *(numbers[k - 1][shorter[k][stay[k]]].astype(np.int64) for k in levels)],
    )


class Words:
    """A block's distinct words with their hashes, and the order in which buckets have them."""

    def __init__(self, words: bytes, buckets: int) -> None:
        joined = zstandard.ZstdDecompressor().decompress(words)
        self.list = joined.split(b"\n") if joined else []
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.list), np.uint64, len(self.list))
        bucket = (self.hashes >> np.uint64(32)).astype(np.int64) % buckets
        self.order = np.argsort(bucket, kind="stable")
        self.starts = np.searchsorted(bucket[self.order], np.arange(buckets + 1))

    def counts(self, answers: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(len(self.list), np.int64)
        for k, found in answers.items():
            out[self.order[self.starts[k] : self.starts[k + 1]]] = unpacked(found)
        return out


def _asked(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, words, n): a block's words of each bucket, and their counts in training."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for block, held, words, tokens in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                own, token = Words(words, buckets), word_contexts.numbers_of(tokens).astype(np.int64)
                text = np.cumsum(token == 0) - (token == 0)
                learns = (np.asarray(held)[text] == 0) & (token > 0)
                n = np.bincount(token[learns] - 1, minlength=len(own.list))[own.order]
                listed, starts = [own.list[i] for i in own.order], own.starts
                some = np.flatnonzero(np.diff(starts))
                columns = [
                    pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()),
                    pa.array([pack.compress(b"\n".join(listed[starts[k] : starts[k + 1]])) for k in some], pa.binary()),
                    pa.array([packed(n[starts[k] : starts[k + 1]]) for k in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "words", "n"])

    return blocks.select("block", "held", "words", "tokens").mapInArrow(task, "bucket int, block long, words binary, n binary")


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: its words are counted over all blocks, and each block gets its words' counts.

    The first row also has the bucket's training words, each as a text."""
    number: dict[bytes, int] = {}
    unpack = zstandard.ZstdDecompressor()
    ids = [np.array([number.setdefault(w, len(number)) for w in unpack.decompress(words).split(b"\n")], np.int64) for words in rows["words"]]
    count = np.zeros(len(number), np.int64)
    for words, n in zip(ids, rows["n"], strict=True):
        count[words] += unpacked(n)
    out = pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "counts": [packed(count[words]) for words in ids]})
    total = [0] * len(out)
    total[0], kinds = int(count.sum()), [int((count > 0).sum())] + [0] * (len(out) - 1)
    learnt = b"".join(w + b" \n" for w, n in zip(number, count, strict=True) if n)
    spelt = [zstandard.ZstdCompressor(level=1).compress(learnt)] + [None] * (len(out) - 1)
    return out.assign(total=total, kinds=kinds, spelt=spelt)


def score(
    docs: DataFrame, learns: Callable[[Column], Column], depth: int = 6, least_share: float = 5e-6,
    longest: int = 0, weight: float = 4.0, least_gain: float = 1.0,
) -> DataFrame:
    """Per document: its tokens, the base score by word counts, and the model's score, log10 both.

    With ``longest`` contexts of up to so many words predict whole words (``word_contexts``), and the
    tree over bytes, of ``depth``, spells the word in their level 0. Without it the bytes' tree
    scores alone, and ``least_share`` bounds its contexts.
    """
    spark, texts = docs.sparkSession, texts_of(docs)
    blocks = _written(texts, learns(F.col("doc_id")), raw=not longest)
    size = blocks.agg(F.sum("size").alias("n"), F.sum(F.size(F.filter("held", lambda h: h == 0))).alias("learnt")).first()
    learnt, bits = size.learnt or 0, word_contexts.bits_of(size.n or 0)
    buckets = word_contexts.buckets_of(size.n or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    answers = settled(
        _asked(blocks, buckets).groupBy("bucket").applyInPandas(_answer, "block long, bucket int, counts binary, total long, kinds long, spelt binary"),
        "word-counts",
    )
    spelt = answers.where("kinds > 0").select(F.expr("array_repeat(0, cast(kinds as int))").alias("held"), F.col("spelt").alias("data"))
    tree = train(spelt if longest else blocks, depth, least_share)
    sent = spark.sparkContext.broadcast(tree)  # bounded by the share of contexts
    whole = answers.agg(F.sum("total").alias("n"), F.sum("kinds").alias("v")).first()
    total, kinds = (whole.n or 0) + learnt, (whole.v or 0) + int(learnt > 0)
    known = answers.select("block", F.lit(0).alias("kind"), "bucket", F.col("counts").alias("data"))
    test = word_contexts.answer(round(least_gain * word_contexts.UNIT))

    def opened(row: NamedTuple, found: dict[int, dict[int, bytes]], counted: int = 0, tested: int = 0) -> word_contexts.Block:
        """What a block's contexts got as answers, up to a level; a block that asked nothing got none."""
        words = Words(row.words, buckets)
        state = word_contexts.Block(words.hashes, word_contexts.numbers_of(row.tokens).astype(np.int64), np.asarray(row.held) == 0, bits)
        if counted:
            counts, spelling = np.append(learnt, words.counts(found.get(0, {}))), spellings(sent.value, words.list) * np.log(10)
            state.begin(word_contexts.log_sum(counts, kinds, spelling) - np.log(total + kinds) if total else spelling, counts)
        for level in range(1, counted + 1):
            state.counted(level, found.get(2 * level - 1, {}), weight)
            if level <= tested:
                state.tested(found.get(2 * level, {}))
        return state

    def asked(block: int, asks: list[tuple]) -> pd.DataFrame:
        rows = pd.DataFrame(asks, columns=["kind", "bucket", "keys", "amounts"])
        rows.insert(0, "block", block)
        return rows

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            for row in rows.itertuples():
                yield asked(row.block, opened(row, {}).count_asks(1, bits, buckets))

    def next_after(level: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
        def ask(block: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
            out = [asked(-1, [])]
            for row in block.itertuples():
                state = opened(row, _by_kind(given), level)
                asks = state.test_asks(level, weight, bits, buckets)
                if level < longest:
                    asks += state.count_asks(level + 1, bits, buckets)
                out.append(asked(row.block, asks))
            return pd.concat(out)

        return ask

    for level in range(longest + 1 if longest else 0):
        if level == 0:
            asks = blocks.select("block", "held", "words", "tokens").mapInPandas(first, word_contexts.ASKS)
        else:
            counted = known.where("kind = 0 or kind % 2 = 1")
            asks = blocks.drop("ids", "data").groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(next_after(level), word_contexts.ASKS)
        new = settled(asks.groupBy("kind", "bucket").applyInPandas(test, word_contexts.ANSWERS), f"contexts-{level}")
        known = known.unionByName(new)

    def finish(block: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out, found = [], _by_kind(given)
        for row in block.itertuples():
            token = word_contexts.numbers_of(row.tokens).astype(np.int64)
            last = np.flatnonzero(token == 0)
            begin = np.append(0, last[:-1] + 1)
            tokens = np.diff(np.append(begin, last[-1] + 1))
            if longest:
                state = opened(row, found, longest, longest)
                c, scores = state.of_token, np.add.reduceat(state.longest_p[1:], begin) / np.log(10)
            else:
                data = zstandard.ZstdDecompressor().decompress(row.data)
                c = np.append(learnt, Words(row.words, buckets).counts(found.get(0, {})))[token]
                is_end = np.flatnonzero(np.frombuffer(data, np.uint8) == END)
                scores = np.add.reduceat(sent.value.score(data), np.append(0, is_end[:-1] + 1))
            out.append(pd.DataFrame({
                "doc_id": pd.array([None if i is None or i != i else int(i) for i in row.ids], "Int64"),
                "held_out": np.asarray(row.held) == 1, "n_tokens": tokens, "n_known": np.add.reduceat((c > 0).astype(np.int64), begin),
                "train_tokens": total, "base_score": np.add.reduceat(np.log10(c + 1.0), begin) - tokens * np.log10(total + kinds + 1.0),
                "score": scores,
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=_COLUMNS)

    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(finish, _SCORES)


def _by_kind(given: pd.DataFrame) -> dict[int, dict[int, bytes]]:
    found: dict[int, dict[int, bytes]] = {}
    for kind, bucket, data in zip(given["kind"], given["bucket"], given["data"], strict=True):
        found.setdefault(int(kind), {})[int(bucket)] = data
    return found


def spellings(tree: Tree, words: list[bytes]) -> np.ndarray:
    """The log10 probability of the end's byte, and of each word's with the space after it."""
    data = b"\n" + b" \n".join([*words, b""])  # words hold no line ends
    scores, ends = tree.score(data), np.flatnonzero(np.frombuffer(data, np.uint8) == END)
    scores[ends[1:]] = 0
    return np.add.reduceat(scores, np.append(0, ends[:-1] + 1))


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_COLUMNS = [part.strip().split(" ")[0] for part in _SCORES.split(",")]
