"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminated(docs, bench, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [(i, pattern.findall(lowered(t))) for i, t in bench]
    windows = [(i, w[k : k + window]) for i, w in items if w for k in range(max(1, len(w) - window + 1))]
    out = []
    for d, t in docs:
        words = pattern.findall(lowered(t))
        hit, met = set(), set()
        for i, w in windows:
            for k in range(len(words) - len(w) + 1):
                if words[k : k + len(w)] == w:
                    hit.update(range(k, k + len(w)))
                    met.add(str(i))
        out.append((d, len(words), len(hit), len(met), hexed(",".join(sorted(met))), bool(hit)))
    return out


def personal(text):
    """Base spans by the patterns as they stand."""
    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    def digits(s):
        return re.sub(r"[^0-9]", "", s)

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [(k, *m.span()) for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m[0])]


def near_components(docs, n=3, percent=90):
    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        if not words:
            return set()
        size = min(n, len(words))
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}

    sets = [(d, grams(t)) for d, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d, key=lambda x: (x is None, x or 0))  # a null is no smallest id
    return [(d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets)]


def token_texts(docs):
    return [(d, re.findall(r"[^\x20\x09-\x0D]+", lowered(t))) for d, t in docs]


def word_base(docs, held):
    import math
    from collections import Counter

    texts = token_texts(docs)
    count = Counter(w for d, ws in texts if not held(d) for w in [*ws, None])
    total, kinds = sum(count.values()), len(count)
    out = {}
    for d, ws in texts:
        ws = [*ws, None]
        base = sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in ws)
        out[d] = (held(d), len(ws), sum(count[w] > 0 for w in ws), total, base)
    return out


def tree_scores(docs, held, depth, least_share, least_count):
    """A suffix tree in dictionaries, by the definitions alone."""
    import math
    from collections import Counter, defaultdict

    spelled = [(d, ("".join(w + " " for w in ws) + "\n").encode()) for d, ws in token_texts(docs)]
    follows = defaultdict(Counter)
    for d, text in spelled:
        if not held(d):
            text = b"\n" + text
            for i in range(1, len(text)):
                for k in range(min(depth, i) + 1):
                    follows[text[i - k : i]][text[i]] += 1
    total = sum(follows[b""].values())
    least = max(least_count, least_share * total)
    good = {c for c, f in follows.items() if sum(f.values()) >= least or not c}
    good = {c for c in good if all(c[k:] in good for k in range(len(c) + 1))}

    def p(context, symbol):
        if not context:
            return (follows[b""][symbol] + 1) / (total + 256)
        f = follows[context]
        return (f[symbol] + len(f) * p(context[1:], symbol)) / (sum(f.values()) + len(f))

    kept = {b""}
    for c in good - {b""}:
        f = follows[c]
        gain = sum(n * math.log(p(c, s) / p(c[1:], s)) for s, n in f.items())
        if gain > 0.5 * len(f) * math.log(max(2, sum(f.values()))):
            kept |= {c[k:] for k in range(len(c))}
    out = {}
    for d, text in spelled:
        text, score = b"\n" + text, 0.0
        for i in range(1, len(text)):
            k = next(k for k in range(min(depth, i), -1, -1) if text[i - k : i] in kept)
            score += math.log10(p(text[i - k : i], text[i]))
        out[d] = score
    return out, kept


def deduplicated(docs, size=100):
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        data = (docs[i][1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            s = data[p : p + size]
            if s in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(s)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((docs[i][0], len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
