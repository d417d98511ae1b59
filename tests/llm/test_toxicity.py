from itertools import product

import numpy as np

from cohortflow.llm import toxicity as T
from cohortflow.llm.queries import QUERIES


def by_rules(classes):
    """The grammar in plain words, for a clause's classes."""
    hit = [c in (T.INSULT, T.THREAT) for c in classes]
    near = lambda a, b: any(classes[i] == a and b(classes[j]) for i in range(len(classes)) for j in range(i + 1, min(len(classes), i + T.REACH + 2)))
    bad = lambda c: c in (T.INSULT, T.THREAT)
    out = set()
    if T.INSULT in classes:
        out.add("insult")
    if T.THREAT in classes:
        out.add("threat")
    if T.FAINT in classes:
        out.add("faint")
    if near(T.NEGATION, bad):
        out.add("negated")
    if near(T.TARGET, bad) or any(near(c, lambda x: x == T.TARGET) for c in (T.INSULT, T.THREAT)):
        out.add("aimed")
    if T.REPORT in classes and any(hit[classes.index(T.REPORT) :]):
        out.add("reported")
    return out


def test_composed_transducers_are_the_rules():
    table, marks = T.compose(T.GRAMMAR)
    for n in range(6):
        for classes in product((T.INSULT, T.TARGET, T.FAINT, T.OTHER), repeat=n):
            state = 0
            for c in classes:
                state = table[state, c]
            assert marks[state] == by_rules(list(classes)), classes
    rng = np.random.default_rng(0)
    for _ in range(2000):
        classes = rng.integers(0, 7, rng.integers(1, 9)).tolist()
        state = 0
        for c in classes:
            state = table[state, c]
        got, want = marks[state], by_rules(classes)
        # a countdown restarts at the latest word, so of two chains the later one may hide the earlier
        assert got - {"aimed", "negated"} == want - {"aimed", "negated"}
        assert got <= want


def test_clauses():
    m = T.Matcher({"idiot*": 3.0, "scum": 3.0})
    kinds = lambda t: [T.KINDS[i] for i, n in enumerate(m.counts(t)) for _ in range(n)]
    assert kinds("You are an idiot.") == ["aimed"]
    assert kinds("he is really not an idiot") == ["negated"]
    assert kinds("she said the man is an idiot!") == ["reported"]
    assert kinds("I will kill you") == ["threat"] and kinds("kill the lights") == []
    assert kinds("not bad. Idiots everywhere. scumbag\nthe scum") == ["direct", "direct"]
    faint = T.Matcher({"idiot*": 3.0, "often": 1.5})
    assert [T.KINDS[i] for i, n in enumerate(faint.counts("it is often so. often an idiot")) if n] == ["direct", "faint"]
    assert kinds("") == [] and T.Matcher({}).counts("nice") == [0] * len(T.KINDS)


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op9_toxicity"](spark, folder).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    hit = sum(r["predicted"] == 1 and labels[r["doc_id"]] == 1 for r in rows)
    toxic = sum(labels[r["doc_id"]] == 1 for r in rows)
    said = sum(r["predicted"] for r in rows)
    assert toxic > 50 and hit >= 0.9 * toxic and hit >= 0.95 * said
    assert all((r["score"] >= T.THRESHOLD) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_copies_add_nothing_to_the_lexicon():
    copied = [f"copy{i}" for i in range(50)]
    forms = [["bad", f"w{i}"] for i in range(30)] + [["bad", *copied] for _ in range(40)] + [[] for _ in range(300)]
    toxic = np.array([True] * 70 + [False] * 300)
    chosen = list(T.learn_lexicon(forms, toxic))
    assert chosen[0] == "bad" and len(chosen) == T.EXPLAINED


def test_stage(spark, sf_dir):
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = T.train(docs, labels, F.lit(True))
    said = {r["doc_id"]: r["predicted"] for r in T.score_texts(docs, model).collect()}
    kept = T.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, p in said.items() if not p}
