"""Cost-balanced packing of token sequences.

A document of n tokens costs ``linear * n + quadratic * n**2`` to train on. Pieces go, in
descending order, each to the sequence with the lowest cost so far that has tokens left; what
does not fit is cut off and goes on with the rest. As many sequences are opened as the tokens
fill, so that a block of documents pads less than one sequence.

Each task packs its own documents in blocks of bounded size, so nothing is shuffled; a block
that a lost executor held is packed again in the same way.

Defined results: a null or empty text is a document of the end id alone; repeated rows and ids
are packed as often as they occur; a null id stays null; an empty table gives no rows; a text
longer than a block is a block of its own; ties keep the order of rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tuplefeed.llm.common import grouped_by_size, map_texts, texts_of

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
SPACE_RUN = re.compile(r" \s")
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class _Known(dict):
    """Numbers strings in the order in which they are first met."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class SegmentEncoder:
    """Token ids of texts, made by a byte-level BPE tokenizer from each distinct segment once.

    The tokenizer's own splitting puts a boundary before every single space that has no white
    space beside it, so a text may be cut there, and new segments may be encoded as one text.
    ``keep`` bounds the segments remembered.
    """

    def __init__(self, tokenizer, keep: int = 1_000_000) -> None:
        self.tokenizer, self.keep = tokenizer, keep
        vocabulary = tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)  # each byte is one character there
        self._clear()

    def _clear(self) -> None:
        self.known = {"": _Known(), " ": _Known()}
        self.flat = {p: np.zeros(0, np.uint32) for p in self.known}
        self.ends = {p: np.zeros(1, np.int64) for p in self.known}

    def _learn(self) -> None:
        for prefix, known in self.known.items():
            if known.new:
                at_once = 500 if prefix else 1
                joined = [prefix + prefix.join(known.new[i : i + at_once]) for i in range(0, len(known.new), at_once)]
                encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
                ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
                size = np.fromiter((len(s.encode()) for s in known.new), np.int64, len(known.new)) + len(prefix)
                last = np.cumsum(self.bytes_of[ids])  # a segment ends where its last token does
                ends = np.searchsorted(last, np.cumsum(size), side="right")
                self.flat[prefix] = np.concatenate([self.flat[prefix], ids])
                self.ends[prefix] = np.concatenate([self.ends[prefix], self.ends[prefix][-1] + ends])
                known.new = []

    def _ids(self, prefix: str, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered segments in a row, and how many each has."""
        ends = self.ends[prefix]
        starts, lengths = ends[numbers], ends[numbers + 1] - ends[numbers]
        before = np.cumsum(lengths) - lengths
        return self.flat[prefix][np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))], lengths

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if sum(map(len, self.known.values())) > self.keep:
            self._clear()
        heads, rests = self.known[""], self.known[" "]
        first, rest, counts = [], [], []
        for text in texts:
            parts = SINGLE_SPACE.split(text) if SPACE_RUN.search(text) else text.split(" ")
            first.append(heads[parts[0]])
            rest.append(np.fromiter(map(rests.__getitem__, parts[1:]), np.int64, len(parts) - 1))
            counts.append(len(parts) - 1)
        self._learn()
        head_ids, head_lengths = self._ids("", np.array(first, np.int64))
        rest_ids, rest_lengths = self._ids(" ", np.concatenate([np.zeros(0, np.int64), *rest]))
        head_ends = np.cumsum(head_lengths)
        rest_ends = np.concatenate([[0], np.cumsum(rest_lengths)])[np.cumsum(np.array(counts, np.int64))]
        return [
            np.concatenate([head_ids[a - n : a], rest_ids[c:d]])
            for a, n, c, d in zip(head_ends, head_lengths, np.concatenate([[0], rest_ends[:-1]]), rest_ends, strict=True)
        ]


def pack_lengths(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of documents of these lengths."""
    pieces, rests, sequence = [], [], 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - capacity + 1, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rests.append((-(n % capacity), doc, n - n % capacity))
    heapq.heapify(rests)
    opened = -(-sum(-r[0] for r in rests) // capacity)
    cheapest = [(0.0, sequence + k, 0) for k in range(opened)]  # cost, sequence, tokens so far
    while rests:
        size, doc, start = heapq.heappop(rests)
        cost, k, filled = heapq.heappop(cheapest)
        n = min(-size, capacity - filled)
        pieces.append((doc, start, n, k, filled))
        if n < -size:
            heapq.heappush(rests, (size + n, doc, start + n))
        if filled + n < capacity:
            heapq.heappush(cheapest, (cost + linear * n + quadratic * n * n, k, filled + n))
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: Callable[[], object],
    end_id: int = 1,
    capacity: int = 2048,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    block_chars: int = 6_000_000,
) -> DataFrame:
    """One row per piece. ``tokenizer`` is called once in each task and gives an object of the
    tokenizers library; ``block_chars`` bounds what a task packs at once."""

    def make(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        encoder, base = SegmentEncoder(tokenizer()), TaskContext.get().partitionId() << 40
        for ids, texts in grouped_by_size(pairs, block_chars):
            tokens: list[np.ndarray] = []
            for at in range(0, len(texts), 200):
                tokens += [np.append(t, np.uint32(end_id)).astype("<u4") for t in encoder.encode(texts[at : at + 200])]
            pieces = pack_lengths([len(t) for t in tokens], capacity, linear, quadratic)
            yield {
                "doc_id": [ids[p[0]] for p in pieces],
                "start": [p[1] for p in pieces],
                "length": [p[2] for p in pieces],
                "ids_crc32": [zlib.crc32(tokens[p[0]][p[1] : p[1] + p[2]].tobytes()) for p in pieces],
                "doc_tokens": [len(tokens[p[0]]) for p in pieces],
                "sequence_id": [base + p[3] for p in pieces],
                "offset": [p[4] for p in pieces],
            }
            base += 1 + max(p[3] for p in pieces)

    return map_texts(texts_of(docs), make, SCHEMA)


def bpe_50k(path: str | None = None):
    """The tokenizer of this file; by default the public 50k byte-level BPE."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Tokenizer.from_file(path)
