from itertools import product

import numpy as np
import pytest

from cohortflow.llm import language as L
from cohortflow.llm.queries import QUERIES


def test_viterbi_is_exact():
    for seed in range(40):
        rng = np.random.default_rng(seed)
        count = rng.integers(0, 6, 5)
        first = np.cumsum(count) - count
        scores = rng.normal(size=(int(count.sum()), 3)) * 2
        path = L.viterbi(scores, first, count, 1.0)

        def value(q, f):
            return sum(scores[f + i][x] for i, x in enumerate(q)) - sum(1.0 for a, b in zip(q, q[1:], strict=False) if a != b)

        for f, c in zip(first.tolist(), count.tolist(), strict=True):
            if c:
                best = max(value(q, f) for q in product(range(3), repeat=c))
                assert value(path[f : f + c].tolist(), f) == pytest.approx(best)


def tiny_model():
    texts = {"en": "the cat sat on the mat and the dog", "de": "der hund und die katze sind hier", "ru": "кошка и собака"}
    table = np.full((1 << L.BUCKET_BITS, 3), 0.5)
    foreign = np.full((L.N_SCRIPTS, 3), L.FOREIGN_SCRIPT, np.float32)
    for i, n in enumerate(sorted(texts)):
        found = L.letters_of([texts[n]])
        np.add.at(table[:, i], found.bucket, 1)
        foreign[np.unique(found.script), i] = 0
    return L.Model(sorted(texts), np.log(table / table.sum(axis=0)).astype(np.float32), foreign)


def test_spans_of_mixed_text():
    (lang, score, spans), empty, mark = L.label_texts(["the cat and the dog sat, der hund und die katze sind", "", "... 12 !"], tiny_model())
    assert [(s[2], s[1]) for s in spans] == [("en", 6), ("de", 6)]
    assert lang in ("de", "en") and 0.4 < score < 0.7
    assert empty == (L.UNKNOWN, 0.0, []) and mark == (L.UNKNOWN, 0.0, [])


def test_scripts_narrow_the_candidates():
    assert L.label_texts(["ждлорп"], tiny_model())[0][0] == "ru"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op3_language_id"](spark, folder).collect() if r["held_out"] and docs[r["doc_id"]]]
    assert len(rows) > 100
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in rows) / len(rows) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_predictions_use_the_text_alone(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.train(docs, F.lit(True))
    same = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit("xx"))
    a = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs, model).collect()}
    b = {r["doc_id"] - 1000: r["lang_pred"] for r in L.identify(same, model).collect()}
    assert a == b
