from hypothesis import example, given, settings
from hypothesis import strategies as st

from llm import brute
from tuplefeed.llm import personal_data as pd
from tuplefeed.llm.queries import QUERIES


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="0123459.+-@ (ab%é", max_size=60))
@example("a@b.c@d.e a@@b.c x@y z@q.r.@s.t")
@example("1.2.3.4.5.6.7.8 01.002.0003.255 256.1.1.1")
@example("4111 1111 1111 1111 0 4111-1111-1111-1111")
def test_base_spans_are_those_of_the_patterns(text):
    assert pd.base_spans(text) == brute.personal(text)


def test_query_keeps_the_base_and_stays_with_it_on_clean_texts(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op2_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute.personal(docs[r.doc_id])
        assert r.base_sha256 == brute.hexed(pd.joined(base))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pd.KINDS]
        assert {pd.joined([s]) for s in base} <= set(r.spans.split(","))


def test_trees_add_other_formats_and_leave_plain_numbers(spark):
    import random

    rng = random.Random(5)

    def text(i):
        digits = "".join(rng.choice("0123456789") for _ in range(10))
        words = " ".join(rng.choice(["some", "plain", "words", "here"]) for _ in range(12))
        return f"{words} write u{i}.{digits[:2]}@mail.example.com or +1 ({digits[:3]}) 555-{digits[:4]} {words} id {digits}{digits[:6]} in 1999, 12 of 300"

    docs = spark.createDataFrame([(i, text(i)) for i in range(300)], "doc_id long, text string")
    detector = pd.train(docs)
    assert [s[0] for s in detector.spans("call +1.208.555.0142 now")[1]] == ["phone"]
    assert [s[0] for s in detector.spans("write me.too [at] mail.example.com now")[1]] == ["email"]
    assert detector.spans("in 1999 there were 12 of 300 for 25.50 each, version 1.2.3.4000")[1] == []


def test_odd_rows(spark, odd, empty):
    detector = pd.Detector()
    assert pd.find(empty, pd.train(empty)).count() == 0
    rows = {r.doc_id: r for r in pd.find(odd, detector).collect()}
    assert rows[1].spans == rows[2].spans == "" and rows[None].n_email == 0
    assert pd.find(odd, detector).count() == odd.count()
    redacted = pd.redact(odd, detector)
    assert redacted.columns == odd.columns and sorted(map(str, redacted.collect())) == sorted(map(str, odd.collect()))
    one = spark.createDataFrame([(1, "to a@b.c, +1 208 555 0142.", 7)], "doc_id long, text string, spans int")
    assert pd.redact(one, detector).collect()[0].text == "to [EMAIL], [PHONE]."


def test_candidates_of_many_groups_and_long_names():
    for text, kind in (
        ("2 0 8 5 5 5 0 1 4 2", "phone"), ("41.11.11.11.11.11.11.1.1", "card"), ("4/1/1/1/1/1/1/1/1/1/1/1/1/1/1/1/0/0/0", "card"),
        ("x" * 80 + " [at] mail.example.com", "email"),
    ):
        assert (kind, 0, len(text)) in pd.candidates(text)
    first, second = (s for s in pd.candidates("a[at]b.c" + "d" * 70 + "(at)e.f") if s[0] == "email")
    assert second[1] >= first[2]


def test_very_long_words_take_no_longer():
    assert pd.base_spans("9" * 200_000 + "x" * 200_000 + "@") == []
