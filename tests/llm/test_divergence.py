import random
import re
from collections import Counter

import pytest

from oracle import compare, connect
from tuplefeed.llm import divergence
from tuplefeed.llm.queries import ORACLES, QUERIES

SCHEMA = "lang string, source string, text string"


def brute(docs, least_docs, ranks=50):
    words, seen, groups = {}, {}, set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups.add((lang, source))
        words.setdefault((lang, source), Counter()).update(found)
        seen.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least_docs]
        sources = [s for x, s in groups if x == lang]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        q = shares(sum((words[lang, s] for s in sources), Counter()))
        p = {s: shares(words[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if words[lang, s][t] and p[s][t] > q[t]]
            for part, found, last in (("pair", pairs, None), ("term", terms, ranks)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:last]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ordered, 1)]
    return Counter(out)


def check(df, **sizes):
    docs = [tuple(r) for r in df.select("lang", "source", "text").collect()]
    got = divergence.audit(df, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    expected = brute(docs, sizes.get("least_docs", 30), sizes.get("ranks", 50))
    assert Counter(map(tuple, got.collect())) == expected
    return expected


def test_query_equals_sql(spark, sf_dir):
    assert compare(QUERIES["op13_source_divergence"](spark, sf_dir), connect(sf_dir), ORACLES["op13_source_divergence"]) is None


@pytest.mark.parametrize("sizes", [{"held": 7, "ranks": 3}, {"held": 1}, {}])
def test_runs_and_odd_names(spark, sizes):
    """Small memories make many runs; a source with a third of the rows, empty names, ties."""
    rng = random.Random(4)
    words = ["Alpha", "alpha", "béta", "漢字", "x", "y2k", "it's", "ZÉ", "_", "tail", "\x00nul", "rare" * 9]
    docs = []
    for i in range(400):
        source = rng.choice(["hot", "hot", "", None, "s\n1", "ü", f"few{i % 7}"])
        docs.append((rng.choice([None, "", "en", "fr"]), source, rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(1, 12)))])))
    docs.append(("empty", "a", None))
    docs.append(("empty", "b", "12 34"))
    found = check(spark.createDataFrame(docs, SCHEMA).repartition(4), least_docs=5, **sizes)
    assert {row[2] for row in found} == {"pair", "term"}


def test_more_sources_than_a_block(spark):
    docs = [("en", f"s{i:03}", f"common word{'abcdefg'[i % 7]} w{'abc'[j]}" + " more" * (i % 5)) for i in range(300) for j in range(i % 3 + 1)]
    check(spark.createDataFrame(docs, SCHEMA), least_docs=10, ranks=2)


def test_long_texts_are_cut_between_terms():
    text = b"Abc d\xc3\xa9f " * 400_000 + b"z" * 3_000_000 + b" end"
    assert [w for words in divergence.terms(text) for w in words] == re.findall(rb"[a-z\x80-\xff]+", text.lower())


def test_odd_rows_and_empty_table(spark, odd, empty):
    check(odd, least_docs=2)
    assert divergence.audit(empty).count() == 0
