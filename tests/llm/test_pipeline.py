import re
import zlib

import corpus_pipeline
from llm import brute
from tuplefeed.llm import packing, personal_data, toxicity
from tuplefeed.llm.queries import learns_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut_words(text, bench):
    """The text without runs of words that benchmark windows cover."""
    spans = [m.span() for m in WORD.finditer(text)]
    words = [brute.lowered(text[s:e]) for s, e in spans]
    hit = set()
    for _, item in bench:
        item = [brute.lowered(w) for w in WORD.findall(item or "")]
        windows = [item[k : k + 10] for k in range(max(1, len(item) - 9))] if item else []
        for w in windows:
            for k in range(len(words) - len(w) + 1):
                if words[k : k + len(w)] == w:
                    hit.add((k, k + len(w)))
    covered = sorted(hit)
    merged = []
    for s, e in covered:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in reversed(merged):
        text = text[: spans[s][0]] + text[spans[e - 1][1] :]
    return text


def redacted(text, detector):
    done, out = 0, ""
    for kind, s, e in sorted(detector.spans(text)[1], key=lambda c: (c[1], -c[2])):
        if s >= done:
            out += text[done:s] + f"[{kind.upper()}]"
        done = max(done, e)
    return out + text[done:]


def test_stages_equal_plain_steps_and_run_equals_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = docs
    tables = []
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf_dir).cache()
        tables.append(kept)
    for df in tables[:-1]:
        assert df.columns == COLUMNS and df.dtypes == docs.dtypes
    texts = [{r.doc_id: r.text for r in df.collect()} for df in (docs, *tables[:-1])]

    scorer = toxicity.train(docs, labels, learns_toxicity)
    assert texts[1] == {d: t for d, t in texts[0].items() if scorer.score(t) < 0.7} != texts[0]
    near = brute.near_components(list(texts[1].items()), 5, 80)
    assert texts[2] == {d: texts[1][d] for d, _, c in near if d == c} != texts[1]
    assert texts[3] == {d: cut_words(t, bench) for d, t in texts[2].items()} != texts[2]
    detector = personal_data.train(tables[2])
    assert texts[4] == {d: redacted(t, detector) for d, t in texts[3].items()} != texts[3]
    assert all(r.n_chars == len(r.text) for r in tables[3].collect())

    tokenizer = packing.bpe_50k()
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).drop("sequence_id").collect())
    assert {(r[0], r[4]) for r in got} == {(r.doc_id, r.doc_tokens) for r in tables[4].collect()}
    of = {}
    for doc, start, length, crc, n, _ in got:
        of.setdefault(doc, []).append((start, length, crc, n))
    assert of.keys() == texts[4].keys()
    for d, pieces in of.items():
        ids = tokenizer.encode(texts[4][d], add_special_tokens=False).ids + [1]
        at = 0
        for start, length, crc, n in pieces:
            assert (start, n) == (at, len(ids))
            assert crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[start : start + length]))
            at += length
        assert at == len(ids)


def test_odd_rows_pass_every_stage(spark, odd, empty, sf_dir):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, sf_dir)
            docs.collect()
        assert before.columns[:5] == COLUMNS
