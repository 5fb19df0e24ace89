"""Personal data by candidate boosting: generators propose, boosted trees decide.

Strict patterns give the base spans, which always stay. Generators of high recall propose more,
overlapping spans: addresses with a written-out @, windows of digit groups in any punctuation,
dotted quads inside longer runs. Gradient-boosted trees score each by format and context, a logistic fit
on held-back candidates calibrates the score, and for each kind the lowest threshold that keeps
the wanted precision there selects what is redacted; of overlapping spans the likeliest wins.

There are no labels for personal data, so the trees learn from the base: its spans are right, also
when rewritten in another format of the same kind, and so are not digit groups that fail checks,
parts of secrets, or windows that take too much or too little. They are fitted on a bounded sample:
the candidates of at most ``sample_docs`` documents (smallest hash of the id), at most
``sample_rows`` of them. Every document is searched whole, in one pass without a shuffle.

Defined results: a null or empty text has no spans; repeated rows are searched each; null ids stay
null; without candidates to learn from only base spans are given; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuplefeed.llm.common import map_texts, prepared, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Fixed values of the task's definitions.
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def octets(text: str) -> bool:
    parts = [x.lstrip("0") or "0" for x in text.split(".")]
    return all(len(x) <= 3 and int(x) <= 255 for x in parts)


def emails(text: str) -> Iterator[Span]:
    """Leftmost, from each @ back over what may stand before it, so long words cost no more."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        after = DOMAIN.match(text, at + 1) if start < at else None
        if after:
            done = after.end()
            yield ("email", start, done)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then by start."""
    found = list(emails(text))
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if octets(m[0])]
        found += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


# Generators.
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[{] ?(?:at|AT|@) ?[)\]}] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[(\[{] ?(?:dot|DOT|\.) ?[)\]}] ?)[A-Za-z0-9-]{1,63}){1,8}")
NUMBERS = re.compile(r"\+?\(?[0-9][0-9 ().\-/]*[0-9]")
GROUP = re.compile(r"[0-9]+")
QUAD = re.compile(r"(?=(?<![0-9])([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]))")
MOST_DIGITS = 19


def candidates(text: str) -> list[Span]:
    """Overlapping spans that may be personal data."""
    found: list[Span] = []
    if "@" in text or "at" in text or "AT" in text:
        if any(b in text for b in ")]}"):
            done = 0
            for m in SPELLED.finditer(text):
                start = m.start()
                while start > done and text[start - 1] in LOCAL:
                    start -= 1
                done = m.end()
                found.append(("email", start, done))
    if not DIGIT.search(text):
        return found
    found += [("ip", *m.span(1)) for m in QUAD.finditer(text)]
    for run in NUMBERS.finditer(text):
        groups = [(m.start() + run.start(), m.end() + run.start()) for m in GROUP.finditer(run[0])]
        for i, (start, _) in enumerate(groups):
            before = text[run.start() : start]
            opens = start - 2 if before.endswith("+(") else start - 1 if before[-1:] in ("+", "(") else start
            size = 0
            for a, b in groups[i : i + MOST_DIGITS]:  # of a digit at least
                size += b - a
                if size > MOST_DIGITS:
                    break
                if size >= 13:
                    found.append(("card", start, b))
                if 9 <= size <= 15 and (opens < start or a > start):
                    found.append(("phone", opens, b))
    return found


# Features: of the format, and of the context.
WORDS = {
    "email": re.compile(r"(?i)mail|contact|write|schreib|correo|courriel"),
    "ip": re.compile(r"(?i)\bip|address|server|host"),
    "card": re.compile(r"(?i)card|visa|karte|tarjeta|carte|credit|pay"),
    "phone": re.compile(r"(?i)phone|tel|call|mobil|fax|ruf"),
}
VERSION = re.compile(r"(?i)(version|release|build|v)\W{0,2}$")
SECRET = re.compile(r"(?i)(token|password|secret|key|id|hash)\W{0,4}$")
N_FEATURES = 26


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    inside, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 20]
    digits = digits_of(inside)
    groups = [len(g) for g in GROUP.findall(inside)]
    dots, prev, following = inside.count("."), before[-1:], after[:1]
    return [
        *(kind == k for k in KINDS),
        len(inside), len(digits), len(groups), max(groups, default=0), groups[-1] if groups else 0,
        inside.count(" "), inside.count("-"), dots, inside.count("(") == inside.count(")"),
        inside.startswith("+"), "(" in inside, "@" in inside,
        bool(digits) and luhn(digits), dots == 3 and not set(inside) - set("0123456789.") and octets(inside),
        digits[:1] in ("3", "4", "5", "6") and bool(digits),
        prev.isalnum() or prev in "_/=\"'#" and prev != "", following.isalnum() or following in "_/=\"'%" and following != "",
        prev.isdigit() or (prev in "+-.(" and prev != ""), bool(re.match(r"[ .\-]?[0-9]", after)),
        bool(WORDS[kind].search(before)), bool(VERSION.search(before)), bool(SECRET.search(before)),
    ]


class Boosted:
    """Gradient-boosted trees of fixed depth on binned features, with a logistic calibration."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 24) -> None:
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start, self.slope, self.shift = 0.0, 1.0, 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)

    def _leaves(self, b: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        node = np.zeros(len(b), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        return node - (2**self.depth - 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        levels = [np.unique(x[:, j]) for j in range(x.shape[1])]
        self.edges = [v if len(v) <= self.bins else np.unique(np.quantile(v, np.linspace(0, 1, self.bins))) for v in levels]
        b = self._binned(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        z = np.full(len(y), self.start)
        wide = self.bins + 2
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            inner = 2**self.depth - 1
            feature, cut = np.zeros(inner, np.int64), np.full(inner, wide)
            node = np.zeros(len(y), np.int64)
            for at in range(inner):
                mine = np.flatnonzero(node == at)
                best = 1e-9
                if len(mine) >= 10:
                    gs, hs = g[mine], h[mine]
                    whole = gs.sum() ** 2 / (hs.sum() + 1)
                    for j in range(b.shape[1]):
                        left_g = np.cumsum(np.bincount(b[mine, j], gs, wide))[:-1]
                        left_h = np.cumsum(np.bincount(b[mine, j], hs, wide))[:-1]
                        gain = left_g**2 / (left_h + 1) + (gs.sum() - left_g) ** 2 / (hs.sum() - left_h + 1) - whole
                        k = int(gain.argmax())
                        if gain[k] > best:
                            best, feature[at], cut[at] = gain[k], j, k
                node[mine] = 2 * at + 1 + (b[mine, feature[at]] > cut[at])
            leaf = node - inner
            value = self.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
            z += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        return self.start + sum((v[self._leaves(b, f, c)] for f, c, v in self.trees), np.zeros(len(x)))

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        z = self.raw(x)
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -40, 40)))
            self.slope -= 0.05 * float(((p - y) * z).mean() + 0.01 * (self.slope - 1))
            self.shift -= 0.2 * float((p - y).mean())
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -40, 40)))


class Detector:
    """Base spans, and those candidates that the trees select."""

    def __init__(self, trees: Boosted | None = None, thresholds: dict[str, float] | None = None) -> None:
        self.trees, self.thresholds = trees, thresholds or {}

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans), each by kind as listed, then start."""
        base = base_spans(text)
        taken = list(base)
        if self.trees is not None:
            covered = bytearray(len(text))
            for _, s, e in base:
                covered[s:e] = b"\1" * (e - s)
            free = [c for c in candidates(text) if not any(covered[c[1] : c[2]])]
            if free:
                p = self.trees.probability(np.array([features(text, c) for c in free], np.float64))
                for k in sorted(range(len(free)), key=lambda k: (-round(p[k], 6), free[k][1] - free[k][2], free[k][1])):
                    kind, s, e = free[k]
                    if p[k] >= self.thresholds.get(kind, 2.0) and not any(covered[s:e]):
                        covered[s:e] = b"\1" * (e - s)
                        taken.append(free[k])
        return base, sorted(taken, key=lambda c: (KINDS.index(c[0]), c[1], c[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _rewritten(kind: str, inside: str) -> list[str]:
    """The same datum in other formats."""
    digits = digits_of(inside)
    if kind == "email":
        local, _, domain = inside.partition("@")
        return [f"{local} [at] {domain}", f"{local}(at){domain.replace('.', ' (dot) ')}"]
    if kind == "phone":
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({a}) {b}-{c}", f"+{digits}", f"+{digits[:-10]}.{a}.{b}.{c}"]
    if kind == "card":
        return ["/".join(digits[i : i + 4] for i in range(0, len(digits), 4)), ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    return []


def lessons(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and label of what one document teaches."""
    base = base_spans(text)
    right = set(base)
    for span in base:
        kind, s, e = span
        yield features(text, span), 1
        for other in _rewritten(kind, text[s:e]):
            yield features(text[:s] + other + text[e:], (kind, s, s + len(other))), 1
    for c in candidates(text):
        if c not in right:
            yield features(text, c), 0


def train(docs: DataFrame, sample_docs: int = 3000, sample_rows: int = 20_000, precision: float = 0.995) -> Detector:
    texts = texts_of(docs)
    some = texts.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
    ids = F.broadcast(some.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).distinct())

    def make(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        for keys, found in pairs:
            rows = [(k, i, f, y) for k, t in zip(keys, found, strict=True) for i, (f, y) in enumerate(lessons(t))]
            yield {
                "doc_id": [r[0] for r in rows], "place": [r[1] for r in rows],
                "given": [",".join(f"{float(v):g}" for v in r[2]) for r in rows], "label": [r[3] for r in rows],
            }

    taught = map_texts(texts.join(ids, "doc_id", "left_semi"), make, "doc_id long, place long, given string, label int")
    rows = taught.orderBy(F.xxhash64("doc_id", "place"), "doc_id", "place").limit(sample_rows).collect()
    if len({r.label for r in rows}) < 2:
        return Detector()
    x = np.array([[float(v) for v in r.given.split(",")] for r in rows])
    y = np.array([r.label for r in rows], np.float64)
    held = np.array([r.doc_id % 3 == 0 for r in rows])
    if min(y[held].sum(), (1 - y[held]).sum(), y[~held].sum(), (1 - y[~held]).sum()) < 1:
        held = np.zeros(len(y), bool)
    trees = Boosted().fit(x[~held], y[~held])
    check = held if held.any() else ~held
    trees.calibrate(x[check], y[check])
    p, thresholds = trees.probability(x[check]), {}
    for k, kind in enumerate(KINDS):
        mine = x[check][:, k] == 1
        order = np.argsort(-p[mine])
        right = np.cumsum(y[check][mine][order]) / np.arange(1, mine.sum() + 1)
        good = np.flatnonzero(right >= precision)
        if len(good):
            thresholds[kind] = max(0.9, float(p[mine][order][good[-1]]))
    return Detector(trees, thresholds)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, detector: Detector) -> DataFrame:
    """Per document: base spans counted by kind, their digest, and all spans."""

    def make(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        for ids, texts in pairs:
            found = [detector.spans(t) for t in texts]
            columns = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS}
            yield columns | {
                "doc_id": ids,
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                "spans": [joined(every) for _, every in found],
                "n_added": [len(every) - len(base) for base, every in found],
            }

    return map_texts(texts_of(docs), make, SCHEMA)


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` with every span replaced by its kind, such as ``[EMAIL]``; other columns stay."""
    prepared(docs.sparkSession)
    at = docs.columns.index("text")

    def redacted(text: str | None) -> str | None:
        kept, done = [], 0
        every = detector.spans(text)[1] if text else []
        for kind, s, e in sorted(every, key=lambda c: (c[1], -c[2])):
            if s >= done:
                kept += [text[done:s], f"[{kind.upper()}]"]
            done = max(done, e)
        return "".join([*kept, text[done:]]) if every else text

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array(map(redacted, b.column(at).to_pylist()), b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), texts)

    return docs.mapInArrow(task, T.StructType(docs.schema.fields))
