import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tuplefeed.llm import quality_rules as q
from tuplefeed.llm.queries import QUERIES


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(s in lines[:i] for i, s in enumerate(lines)), len(hit),
    )


@settings(deadline=None)
@given(st.text(alphabet="ab \n\t\x0b#é |", max_size=80))
def test_facts_are_those_of_the_definitions(text):
    f = q.Facts(text)
    assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words) == plain(text)


def test_letters_of_scripts_without_case():
    rejects = dict(q.RULES)["letters"]
    for words in ("هذا نص عادي", "זה טקסט רגיל", "यह सामान्य पाठ", "นี่คือ ข้อความ", "이것은 평범한 글"):
        assert not rejects(q.Facts(" ".join([words] * 20)))
    assert rejects(q.Facts("12 -- 2024 ... " * 20))


def test_query_equals_plain_rules_whatever_the_order(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op6_quality_rules"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        facts = plain(docs[r.doc_id])
        failed = facts[0] < 50 or 100 * facts[4] > 50 * facts[0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (*facts, failed)
        assert r.kept == (not failed and not any(rejects(q.Facts(docs[r.doc_id])) for _, rejects in q.RULES))
    assert 0 < sum(r.kept for r in rows) < len(rows)


def test_order_is_by_rejections_per_cost(spark):
    docs = spark.createDataFrame([(i, "w") for i in range(50)], "doc_id long, text string")

    def slow(f):
        return sum(range(20_000)) > 0

    rules = [("never", lambda f: False), ("slow", slow), ("quick", lambda f: True)]
    assert [name for name, _ in q.ordered(docs, rules)] == ["quick", "slow", "never"]
    assert {r.rejected_by for r in q.judge(docs, q.ordered(docs, rules)).collect()} == {"quick"}


def test_odd_rows(spark, odd, empty):
    rows = q.judge(odd).collect()
    assert len(rows) == odd.count()
    assert all(not r.kept and r.base_failed for r in rows if r.doc_id in (1, 2, 3))
    assert q.judge(empty).count() == 0 and [n for n, _ in q.ordered(empty)] == [n for n, _ in q.RULES]
