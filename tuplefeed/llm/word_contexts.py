"""Contexts of words for the suffix tree: counted, tested and looked up in tables that Spark holds.

A context is the last 1 to ``longest`` tokens before the next one; the start of a text counts as a
token and ends its contexts. A context is a candidate from two occurrences in training on, an
absolute number, so candidates grow with the input. Probabilities are smoothed level by level,

    p_k = (n_k + weight * p_(k-1)) / (c_k + weight),

with the context's count c_k and the count n_k of the token after it; p_0 mixes word counts with the
spelling of the word. A context is retained if, on its own occurrences and each of them left out in
turn, its distribution diverges from the shorter one's: the sum of
log(((n_k - 1) + weight * p_(k-1)) / (c_k - 1 + weight)) - log p_(k-1) is above ``least_gain``.
A token is scored in the longest retained context before it.

Nothing of this is gathered in one place. A block of texts asks: it sends its distinct keys with
what it adds to each (a count, or a part of the test's sum in whole 1/1024), ordered ranges of keys
go to buckets, a bucket sums over the blocks and answers each of them. A frequent context is one
key of a block, so there are no hot keys. The number of buckets grows with the tokens, so a bucket
is of bounded size. Keys are hashes with 20 bits more than the tokens need, at every size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import zstandard

PER_BUCKET = 4_000_000  # tokens
SPARE_BITS = 20
UNIT = 1024

ANSWERS = "block long, kind int, bucket int, data binary"
ASKS = "block long, kind int, bucket int, keys binary, amounts binary"


def buckets_of(tokens: int, least: int) -> int:
    return max(least, -(-tokens // PER_BUCKET))


def bits_of(tokens: int) -> int:
    return min(64, int(tokens).bit_length() + SPARE_BITS)


def planes(numbers: np.ndarray) -> bytes:
    """Whole numbers as the first bytes of all, the second bytes of all, and so on, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def numbers_of(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view("<u8").ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def log_sum(n: np.ndarray, weight: float, p: np.ndarray) -> np.ndarray:
    """log(n + weight * e**p); very long words have a p below the smallest number."""
    return np.where(n > 0, np.log(np.maximum(n, 1) + weight * np.exp(p)), np.log(weight) + p)


class Keys:
    """A block's distinct keys in order, and where each of its places finds its key."""

    def __init__(self, distinct: np.ndarray, at: np.ndarray) -> None:
        self.distinct, self.at = distinct, at

    @classmethod
    def of(cls, keys: np.ndarray) -> Keys:
        return cls(*np.unique(keys, return_inverse=True))

    def some(self, places: np.ndarray) -> Keys:
        """The keys of some places, in order too, without sorting again."""
        at = self.at[places]
        stays = np.zeros(len(self.distinct), bool)
        stays[at] = True
        return Keys(self.distinct[stays], (np.cumsum(stays) - 1)[at])

    def asks(self, kind: int, amounts: np.ndarray, bits: int, buckets: int) -> list[tuple]:
        """(kind, bucket, keys, amounts) of every bucket; keys are sent as differences."""
        edges = [np.uint64((k << bits) // buckets) for k in range(buckets)]
        starts = np.append(np.searchsorted(self.distinct, edges), len(self.distinct))
        signed = amounts.astype(np.int64)
        folded = ((signed << 1) ^ (signed >> 63)).astype(np.uint64)
        return [
            (kind, k, planes(np.diff(self.distinct[a:b], prepend=np.uint64(0))), planes(folded[a:b]))
            for k, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)) if b > a
        ]

    def answered(self, answers: dict[int, bytes]) -> np.ndarray:
        """The answers of all buckets, at the places that asked."""
        found = [numbers_of(answers[k]) for k in sorted(answers)]
        return np.concatenate([*found, np.empty(0, np.uint64)])[self.at].astype(np.int64)


def answer(least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Sums of one bucket: counts (odd kinds) as they are, sums of the test (even kinds) as 1 if above ``least``."""

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(numbers_of(d), dtype=np.uint64) for d in rows["keys"]]
        folded = [numbers_of(d) for d in rows["amounts"]]
        given = np.concatenate(folded)
        amounts = (given >> np.uint64(1)).astype(np.int64) ^ -(given & np.uint64(1)).astype(np.int64)
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(at.max(initial=-1) + 1, np.int64)
        np.add.at(total, at, amounts)
        if rows["kind"].iloc[0] % 2 == 0:
            total = (total > least).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        data = [planes(part) for part in np.split(total[at], ends[:-1])]
        return pd.DataFrame({"block": rows["block"], "kind": rows["kind"], "bucket": rows["bucket"], "data": data})

    return summed


class Block:
    """The tokens of a block of texts, each text behind a start, and what is known of their contexts.

    ``hashes`` are those of the distinct words, ``token`` the words' numbers from 1 on, with 0 at the
    end of every text, ``learns`` whether a text trains.
    """

    def __init__(self, hashes: np.ndarray, token: np.ndarray, learns: np.ndarray, bits: int) -> None:
        self.token = np.append(0, token)  # 0 starts and ends texts
        lengths = np.diff(np.flatnonzero(self.token == 0))
        first = np.append(0, np.cumsum(lengths)[:-1])  # the start of each text; its tokens follow
        self.behind = np.append(0, np.arange(1, len(self.token)) - np.repeat(first, lengths))
        self.learns = np.append(False, np.repeat(learns, lengths))
        self.shift = np.uint64(64 - bits)
        of_word = np.append(np.uint64(0x5851F42D4C957F2D), hashes)
        self._hash = of_word[self.token]
        mixed = _mixed(of_word)
        self.runs = [mixed[self.token]]  # of each token and the k before it
        # The keys of the last level's runs, found at the place of their last token.
        self._keys = Keys.of(mixed >> self.shift)
        self._keys.at = self._keys.at[self.token]
        self.longest_p = self.p = self.count = self.candidate = None

    def begin(self, word_p: np.ndarray, word_count: np.ndarray) -> None:
        """Level 0: natural log of the probability, and training count, of the end and of each distinct word."""
        self.p = word_p[self.token]
        self.longest_p, self.count = self.p.copy(), word_count[self.token]
        self.of_token = self.count[1:]  # each token's count

    def run_keys(self, level: int) -> tuple[np.ndarray, Keys]:
        """The places with a context of ``level`` tokens that may be a candidate, and the keys of
        that context with the token after it. Level 1 needs no counts, so all places ask."""
        if len(self.runs) <= level:
            self.runs.append(_mixed(np.append(np.uint64(0), self.runs[-1][:-1]) * np.uint64(3) + self._hash))
        may = self.behind >= level
        if level > 1:
            may[1:] &= self.count[:-1] >= 2
        places = np.flatnonzero(may)
        return places, Keys.of(self.runs[level][places] >> self.shift)

    def count_asks(self, level: int, bits: int, buckets: int) -> list[tuple]:
        places, keys = self.run_keys(level)
        seen = np.bincount(keys.at[self.learns[places]], minlength=len(keys.distinct))
        return keys.asks(2 * level - 1, seen, bits, buckets)

    def counted(self, level: int, answers: dict[int, bytes], weight: float) -> None:
        """Take the counts of a level, which give its candidates and their probabilities."""
        places, keys = self.run_keys(level)
        n = np.zeros(len(self.token), np.int64)
        n[places] = keys.answered(answers)
        c = np.append(0, self.count[:-1])
        self.candidate = np.flatnonzero((self.behind >= level) & (c >= 2))
        of = self.candidate
        self.shorter, self.n, self.c = self.p[of], n[of], c[of]
        self.p[of] = log_sum(self.n, weight, self.shorter) - np.log(self.c + weight)
        self.count = n
        # A candidate's context is the run before it, one level shorter, whose keys are in order already.
        self._contexts = self._keys.some(of - 1)
        self._keys = Keys(keys.distinct, np.zeros(len(self.token), np.int64))
        self._keys.at[places] = keys.at

    def contexts(self) -> Keys:
        """The contexts of the level's candidates."""
        return self._contexts

    def test_asks(self, level: int, weight: float, bits: int, buckets: int) -> list[tuple]:
        """The sum over this block's training occurrences, each of them left out in its turn."""
        part = log_sum(np.maximum(self.n - 1, 0), weight, self.shorter) - np.log(self.c - 1 + weight) - self.shorter
        gain = np.where(self.learns[self.candidate], np.rint(part * UNIT), 0)
        contexts = self.contexts()
        sums = np.bincount(contexts.at, gain, minlength=len(contexts.distinct))
        return contexts.asks(2 * level, np.rint(sums), bits, buckets)

    def tested(self, answers: dict[int, bytes]) -> None:
        """Take the results of the test: places in a retained context are scored there."""
        kept = self.candidate[self.contexts().answered(answers) == 1]
        self.longest_p[kept] = self.p[kept]
