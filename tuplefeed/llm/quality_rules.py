"""Quality rules as a short-circuit cascade.

Each rule's cost and the share it rejects are estimated on a bounded sample of documents; rules
then run in the order of rejections per cost, and a document leaves at the first that rejects it.
What a rule needs is worked out when first asked for, and rules that need the same share it. The
order decides how long a document takes, never the verdict: it is kept if no rule rejects it.

One pass, no shuffle. Defined results: a null or empty text has no words and fails the base;
repeated rows are judged each; null ids stay null; an empty table gives the rules as listed and no
rows; a text of any length is judged whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuplefeed.llm.common import map_texts, texts_of

# Fixed values of the task's definitions.
SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"
)


class Facts:
    """What rules ask about a text, each worked out once."""

    def __init__(self, text: str) -> None:
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [s for s in self.text.split("\n") if s.strip(SPACES)]

    @property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def numbered(self) -> tuple[np.ndarray, int]:
        number: dict[bytes, int] = {}
        ids = [number.setdefault(w, len(number)) for w in self.words]
        return np.array(ids, np.int64), len(number)

    @cached_property
    def n_repeat_words(self) -> int:
        ids, top = self.numbered
        if len(ids) < 4:  # two windows at least
            return 0
        pairs = np.unique(ids[:-1] * top + ids[1:], return_inverse=True)[1]
        _, which, counts = np.unique(pairs[:-1] * top + ids[2:], return_inverse=True, return_counts=True)
        found = counts[which] > 1
        hit = np.zeros(len(ids), bool)
        for k in range(3):
            hit[k : k + len(found)] |= found
        return int(hit.sum())

    @cached_property
    def n_lettered(self) -> int:
        return sum(any(map(str.isalpha, w.decode())) for w in self.words)

    @cached_property
    def n_letters_upper(self) -> int:
        return sum(map(str.isupper, self.text))


Rule = tuple[str, Callable[[Facts], bool]]

#: Each says whether it rejects. Thresholds are those of published rule sets for web text.
RULES: list[Rule] = [
    ("few_words", lambda f: f.n_words < 50),
    ("repeated_words", lambda f: 100 * f.n_repeat_words > 50 * f.n_words),
    ("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 12 * f.n_words),
    ("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    ("repeated_lines", lambda f: 2 * f.n_dup_lines > len(f.lines)),
    ("letters", lambda f: 10 * f.n_lettered < 8 * f.n_words),
    ("shouting", lambda f: 2 * f.n_letters_upper > f.word_chars),
]


def base_failed(f: Facts) -> bool:
    return f.n_words < 50 or 100 * f.n_repeat_words > 50 * f.n_words


def ordered(docs: DataFrame, rules: list[Rule] = RULES, sample: int = 1000) -> list[Rule]:
    """The rules by rejections per second, over the ``sample`` documents with the smallest hash."""
    texts = texts_of(docs)
    some = texts.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = F.broadcast(some.distinct())  # bounded by the sample

    def make(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        for _, texts in pairs:
            seconds, rejected = [0.0] * len(rules), [0] * len(rules)
            for text in texts:
                for k, (_, rejects) in enumerate(rules):
                    facts = Facts(text)  # the cost of a rule by itself
                    start = time.perf_counter()
                    rejected[k] += rejects(facts)
                    seconds[k] += time.perf_counter() - start
            yield {"rule": list(range(len(rules))), "seconds": seconds, "rejected": rejected}

    measured = map_texts(texts.join(chosen, "doc_id", "left_semi"), make, "rule int, seconds double, rejected long")
    found = {r.rule: (r.rejected, r.seconds) for r in measured.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()}
    value = {k: (found[k][0] / max(found[k][1], 1e-9) if k in found else 0.0) for k in range(len(rules))}
    return [rules[k] for k in sorted(value, key=lambda k: (-value[k], k))]


def judge(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Facts and verdict of every document, with the rule that ended its cascade."""
    cascade = ordered(docs) if rules is None else rules

    def make(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        for ids, texts in pairs:
            facts = [Facts(t) for t in texts]
            by = [next((name for name, rejects in cascade if rejects(f)), None) for f in facts]
            failed = [base_failed(f) for f in facts]
            yield {
                "doc_id": ids,
                "n_words": [f.n_words for f in facts],
                "word_chars": [f.word_chars for f in facts],
                "n_symbols": [f.n_symbols for f in facts],
                "n_dup_lines": [f.n_dup_lines for f in facts],
                "n_repeat_words": [f.n_repeat_words for f in facts],
                "base_failed": failed,
                "kept": [b is None and not x for b, x in zip(by, failed, strict=True)],
                "rejected_by": by,
            }

    return map_texts(texts_of(docs), make, SCHEMA)
