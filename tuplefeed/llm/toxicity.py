"""Toxicity by multiple-instance learning: documents are labelled, sentences offend.

A sentence's probability is a logistic function of its words' parts; a document's is the noisy-or
of its sentences, 1 - prod(1 - p). Weights are fitted to document labels only, and the sentences
that drive a document's score can be named afterwards.

The classifier is fitted on a bounded sample: at most ``sample`` labelled documents of each class
(those with the smallest hash of their id). Parts that are met more in toxic documents than chance
would have it are chosen by their counts over that sample, at most ``parts`` of them. Every
document is scored, in one pass and without a shuffle.

Defined results: a null or empty text has no sentences and scores 0; repeated rows are scored each;
several labels of one document count as the highest; null labels and labels without a document are
left out; a null id is scored, and counts as not held out; without toxic labels every score is
near 0; a text of any length is scored whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuplefeed.llm.common import map_texts, prepared, settled, texts_of

_ENDS = b".!?\n"
_TO_PARTS = bytes(
    46 if b in _ENDS else b if b >= 128 or chr(b).isalnum() or b == 39 else 32 for b in range(256)
)
GRAMS = (4, 5)


def sentences_of(text: str) -> list[list[bytes]]:
    """The lower-cased words of every sentence that has any."""
    split = (s.split() for s in text.lower().encode().translate(_TO_PARTS).split(b"."))
    return [words for words in split if words]


def parts_of(word: bytes) -> set[str]:
    """A word as a whole, and its runs of letters with the word's edges marked."""
    w = f"^{word.decode()}$"
    return {w, *(w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1))}


class Scorer(dict):
    """Weights of words, each worked out once; ``keep`` bounds how many are remembered."""

    def __init__(self, weights: dict[str, float], bias: float, keep: int = 1_000_000) -> None:
        self.weights, self.bias, self.keep = weights, bias, keep

    def __missing__(self, word: bytes) -> float:
        known = self.weights
        value = sum(known[p] for p in known.keys() & parts_of(word)) if known else 0.0
        if len(self) >= self.keep:
            self.clear()
        self[word] = value
        return value

    def sentences(self, text: str) -> list[float]:
        """The probability of each sentence."""
        get = self.__getitem__
        logits = np.array([sum(map(get, words)) for words in sentences_of(text)], np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(logits + self.bias, -40, 40)))

    def score(self, text: str) -> float:
        p = self.sentences(text)
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def remainder(key: Column, by: int) -> Column:
    """crc32 of the id's text, modulo ``by``; -1 for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % by, F.lit(-1))


def fit_noisy_or(
    docs: list[list[list[int]]], labels: list[int], n: int, rounds: int = 400, rate: float = 0.1, ridge: float = 1e-5
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the log loss of documents; a document lists its sentences' parts."""
    weights, bias = np.zeros(n), -8.0
    if not docs or n == 0:
        return weights, bias
    y = np.array(labels, np.float64)
    of_doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    flat = [s for d in docs for s in d]
    of_sentence = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    part = np.array([p for s in flat for p in s], np.int64)
    balance = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(of_sentence, weights[part], len(flat))
        total = np.bincount(of_doc, np.logaddexp(0, z), len(docs)) + 1e-9
        by_total = balance * ((1 - y) - y / np.expm1(np.minimum(total, 50)))
        by_z = by_total[of_doc] / (1 + np.exp(-z))
        slope = np.append(np.bincount(part, by_z[of_sentence], n) + ridge * weights, by_z.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, learns: Callable[[Column], Column], sample: int = 4000, parts: int = 3000, label: str = "toxic"
) -> Scorer:
    """A scorer from at most ``sample`` documents of each class for which ``learns(id)`` holds."""
    marks = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("mark"))
        .where(F.col("mark").isNotNull() & learns(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("mark").alias("mark"))
    )
    some = [
        marks.where(F.col("mark") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)
    ]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # two samples of bounded size
    texts = settled(texts_of(docs).join(chosen, "doc_id").select("mark", "text"), "toxicity-sample")

    def parts_met(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        for marks, texts in pairs:
            for mark, text in zip(marks, texts, strict=True):
                met = set().union(*(parts_of(w) for w in {w for s in sentences_of(text) for w in s}))
                yield {"part": list(met), "mark": [mark] * len(met)}

    counted = map_texts(texts, parts_met, "part string, mark long").groupBy("part").agg(
        F.sum("mark").alias("toxic"), F.sum(1 - F.col("mark")).alias("clean")
    )
    n = {r.mark: r.n for r in texts.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    rate_toxic = (F.col("toxic") + 0.5) / (n.get(1, 0) + 1.0)
    rate_clean = (F.col("clean") + 0.5) / (n.get(0, 0) + 1.0)
    gain = F.col("toxic") * F.log(rate_toxic / rate_clean)
    known = [
        r.part
        for r in counted.where((F.col("toxic") >= 3) & (rate_toxic > 3 * rate_clean)).orderBy(gain.desc(), "part").limit(parts).collect()
    ]
    number = {p: i for i, p in enumerate(known)}

    def chosen_parts(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        for marks, texts in pairs:
            for mark, text in zip(marks, texts, strict=True):
                rows = [[number[p] for w in words for p in number.keys() & parts_of(w)] for words in sentences_of(text)]
                bag = [r for r in rows if r]
                yield {
                    "mark": [mark], "n": [len(rows)],
                    "sizes": [[len(r) for r in bag]], "parts": [[p for r in bag for p in r]],
                }

    bags, marks_of = [], []
    for r in map_texts(texts, chosen_parts, "mark long, n long, sizes array<long>, parts array<long>").collect():
        at, bag = 0, []
        for size in r.sizes:
            bag.append(r.parts[at : at + size])
            at += size
        bags.append(bag + [[]] * (r.n - len(bag)))
        marks_of.append(int(r.mark > 0))
    weights, bias = fit_noisy_or(bags, marks_of, len(known))
    if not any(marks_of) or all(marks_of):
        return Scorer({}, -20.0)
    return Scorer({p: float(w) for p, w in zip(known, weights, strict=True) if w}, bias)


def score(docs: DataFrame, scorer: Scorer, offends: float = 0.5) -> DataFrame:
    """Per document: score, and the ordinals of sentences that offend by themselves."""

    def make(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        for ids, texts in pairs:
            by_sentence = [scorer.sentences(t) for t in texts]
            yield {
                "doc_id": ids,
                "score": [float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0 for p in by_sentence],
                "offending": [np.flatnonzero(p >= offends).tolist() for p in by_sentence],
            }

    return map_texts(texts_of(docs), make, "doc_id long, score double, offending array<long>")


def reject(docs: DataFrame, scorer: Scorer, threshold: float = 0.7) -> DataFrame:
    """``docs`` without those that score at least ``threshold``; all columns are kept."""
    prepared(docs.sparkSession)
    at = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stays = [scorer.score(t or "") < threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(task, T.StructType(docs.schema.fields))
