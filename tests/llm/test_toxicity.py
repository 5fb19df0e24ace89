import pytest
from pyspark.sql import functions as F

from tuplefeed.llm import toxicity
from tuplefeed.llm.queries import QUERIES, learns_toxicity

LABELS = "doc_id long, toxic int, quality int"


def planted(spark, n=400):
    import random

    rng = random.Random(4)
    words = [a + b for a in "bcdfgh" for b in ("ing", "an", "ore", "ut", "isl")]

    def text(toxic):
        sentences = [[rng.choice(words) for _ in range(6)] for _ in range(rng.randrange(1, 9))]
        if toxic:
            rng.choice(sentences)[rng.randrange(6)] = rng.choice(["vilenoun", "grimslur", "foulcurse"])
        return ". ".join(" ".join(s) for s in sentences) + "."

    rows = [(i, text(i % 4 == 0), "en", int(i % 4 == 0)) for i in range(n)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3], 1) for r in rows], LABELS), {r[0]: r for r in rows}


def test_held_out_documents_and_their_sentences_are_found(spark):
    docs, labels, rows = planted(spark)
    scorer = toxicity.train(docs, labels, learns_toxicity)
    for r in toxicity.score(docs, scorer).collect():
        _, text, _, toxic = rows[r.doc_id]
        assert (r.score >= 0.7) == bool(toxic)
        sentences = [s for s in text.split(".") if s.strip()]
        assert r.offending == [i for i, s in enumerate(sentences) if any(w in s for w in ("vilenoun", "grimslur", "foulcurse"))]
    kept = toxicity.reject(docs, scorer)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in rows.items() if not r[3]}


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels, _ = planted(spark, 200)
    turned = labels.withColumn("toxic", F.when(learns_toxicity(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.train(docs, x, learns_toxicity) for x in (labels, turned))
    assert a.weights == b.weights and a.bias == b.bias


def test_query_columns(spark, sf_dir):
    rows = QUERIES["op4_toxicity"](spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


@pytest.mark.parametrize("labels", [[], [(1, None, 0), (77, 1, 0)], [(6, 1, 0), (6, 0, 0), (6, 0, 1), (None, 1, 1), (4, 0, 0)]])
def test_odd_rows(spark, odd, empty, labels):
    scorer = toxicity.train(odd, spark.createDataFrame(labels, LABELS), lambda k: F.lit(True))
    rows = toxicity.score(odd, scorer).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {0.0}
    assert toxicity.score(empty, scorer).count() == toxicity.reject(empty, scorer).count() == 0
