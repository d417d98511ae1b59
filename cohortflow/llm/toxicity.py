"""Toxicity by a weighted finite-state grammar over clauses.

A clause (text between stops) is read as a sequence of word classes: insult, threat, target,
negation, report and other. Five small transducers each mark one thing, an insult, a
threat, a target near it, a negation shortly before it, reported speech before it; each
adds its mark to the state it is composed with. Composition is the product of their states, built once
as one table (state x class -> state, weight). What a clause is worth depends on the marks it
ends with (direct, aimed, negated, reported), never on a word alone, and the score of a text
comes from its counted clauses by a logistic regression.

Insults are learned: words and word beginnings that are over-represented in texts labelled
toxic, on a bounded sample of labelled rows. Those that clean texts use as well are faint:
they make a clause of a kind of its own, which counts by how densely a text holds them. They are chosen one after the other, each for
the toxic texts that few earlier ones explain, so that the words of a much-copied text add
little. The short lists of targets, threats, negations and reports are general words of
the four languages. Weights of the clause kinds are learned with the prior order direct >
reported > negated.

Defined results: a null or empty text scores like any text without a matched clause. Repeated rows
are scored each. Without labelled rows of both kinds only threats count. Texts are read whole;
clauses of any length are read, matched ones word by word. Other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.tables import stored

THRESHOLD = 0.3  # fixed value of the contract
SAMPLE_PER_CLASS = 4000
STEMS = (4, 5, 6)
MIN_SUPPORT = 4
MIN_G2 = 20.0
EXPLAINED = 4  # chosen forms after which a toxic text counts for no other form
MIN_RATIO = 3.0
STRONG = math.log(20.0)  # log odds from which a form is an insult by itself
CANDIDATES = 3000
MAX_LEXICON = 2000
RIDGE = 0.05

# General words by class.
TARGETS = "you your yours u they them he she du dich dir ihr euch sie vous vos tu te toi ils tú ti usted ustedes vosotros ellos".split()
THREATS = "kill hurt destroy murder stab shoot burn beat töten umbringen vernichten tuer détruire matar destruir".split()
NEGATIONS = "not no never nobody isn aren don nicht kein keine niemals ne pas jamais nunca jamás ningún".split()
REPORTS = "said says saying quoted quote wrote called reported claimed sagte sagt schrieb dit disait écrit dijo dice escribió".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, FAINT, OTHER = range(7)
REACH = 2  # words over which a negation or a target is near
KINDS = ("direct", "aimed", "threat", "negated", "reported", "faint")
#: Prior weight of the clauses of each kind and of their density, towards which the regression is drawn.
PRIOR = np.array([3.0, 4.0, 3.0, 1.0, 1.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0])

WORD = re.compile(r"[^\W\d_]+")
STOPS = ".!?;:\n"
STOP = re.compile(f"[{STOPS}]")


class Transducer(NamedTuple):
    """step[(state, class)] -> state; absent: stays in `rest`. output[state]: mark."""

    states: int
    step: dict[tuple[int, int], int]
    rest: dict[int, int]
    output: dict[int, str]


def marks_when_seen(wanted: int, mark: str) -> Transducer:
    return Transducer(2, {(0, wanted): 1}, {0: 0, 1: 1}, {1: mark})


def marks_when_near(first: int, second: tuple[int, ...], mark: str, reach: int = REACH, either: bool = False) -> Transducer:
    """Marks `first` followed by one of `second` within reach words; with `either` also the other order."""
    done = 1
    step, rest = {}, {0: 0, done: done}
    countdown = [2 + i for i in range(reach + 1)]
    mirrored = [2 + reach + 1 + i for i in range(reach + 1)] if either else []
    for chain, follow in ((countdown, second), (mirrored, (first,))):
        for i, s in enumerate(chain):
            rest[s] = chain[i + 1] if i + 1 < len(chain) else 0
            step |= {(s, c): done for c in follow}
    for s in [0, *countdown, *mirrored]:
        if (s, first) not in step:
            step[(s, first)] = countdown[0]
        for c in second if either else ():
            if (s, c) not in step:
                step[(s, c)] = mirrored[0]
    return Transducer(2 + len(countdown) + len(mirrored), step, rest, {done: mark})


def marks_when_after(first: int, second: tuple[int, ...], mark: str) -> Transducer:
    """Marks any of `second` that comes anywhere after `first`."""
    return Transducer(3, {(0, first): 1, **{(1, c): 2 for c in second}}, {0: 0, 1: 1, 2: 2}, {2: mark})


def compose(parts: list[Transducer]) -> tuple[np.ndarray, list[frozenset[str]]]:
    """The product: a table state x class -> state, and the marks of each state. State 0 is the start."""
    number = {s: i for i, s in enumerate(product(*[range(p.states) for p in parts]))}
    table = np.zeros((len(number), OTHER + 1), np.int64)
    marks: list[frozenset[str]] = [frozenset()] * len(number)
    for states, i in number.items():
        marks[i] = frozenset(p.output[s] for p, s in zip(parts, states, strict=True) if s in p.output)
        for c in range(OTHER + 1):
            table[i, c] = number[tuple(p.step.get((s, c), p.rest[s]) for p, s in zip(parts, states, strict=True))]
    return table, marks


GRAMMAR = [
    marks_when_seen(INSULT, "insult"),
    marks_when_seen(THREAT, "threat"),
    marks_when_seen(FAINT, "faint"),
    marks_when_near(TARGET, (INSULT, THREAT), "aimed", either=True),
    marks_when_near(NEGATION, (INSULT, THREAT), "negated"),
    marks_when_after(REPORT, (INSULT, THREAT), "reported"),
]


def kind_of(marks: frozenset[str]) -> int | None:
    """What a clause with these marks is; a threat needs a target."""
    if "insult" not in marks and not {"threat", "aimed"} <= marks:
        return KINDS.index("faint") if "faint" in marks else None
    if "negated" in marks:
        return KINDS.index("negated")
    if "reported" in marks:
        return KINDS.index("reported")
    if "insult" not in marks:
        return KINDS.index("threat")
    return KINDS.index("aimed" if "aimed" in marks else "direct")


class Model(NamedTuple):
    lexicon: dict[str, float]  # words and, with a trailing *, word beginnings
    weights: np.ndarray  # per kind, then per kind's density
    bias: float


class Matcher:
    """Counts the matched clauses of a text by kind."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        strength = {w: INSULT if x >= STRONG else FAINT for w, x in lexicon.items()}
        self.words = {w: c for w, c in strength.items() if not w.endswith("*")}
        self.stems = {w[:-1]: c for w, c in strength.items() if w.endswith("*")}
        self.sizes = sorted({len(s) for s in self.stems})
        self.classes = {w: c for c, ws in ((TARGET, TARGETS), (THREAT, THREATS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.table, marks = compose(GRAMMAR)
        self.kinds = [kind_of(m) for m in marks]
        self.rows = self.table.tolist()
        self.finder = ahocorasick.Automaton()
        for w in [*self.words, *self.stems, *THREATS]:
            self.finder.add_word(w, len(w))
        if len(self.finder):
            self.finder.make_automaton()

    def class_of(self, word: str) -> int:
        found = [self.stems[word[:n]] for n in self.sizes if word[:n] in self.stems]
        if word in self.words:
            found.append(self.words[word])
        return min(found) if found else self.classes.get(word, OTHER)

    def counts(self, text: str) -> list[int]:
        out = [0] * len(KINDS)
        if not len(self.finder):
            return out
        low = text.lower()
        done = 0  # end of the last clause that was read
        for end, size in self.finder.iter(low):
            start = end + 1 - size
            if start < done or (start and low[start - 1].isalpha()):
                continue
            first = max(done, max(low.rfind(s, done, start) for s in STOPS) + 1)
            stop = STOP.search(low, end)
            done = stop.start() if stop else len(low)
            state = 0
            for m in WORD.finditer(low, first, done):
                state = self.rows[state][self.class_of(m.group())]
            kind = self.kinds[state]
            if kind is not None:
                out[kind] += 1
        return out


def features(counts: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Clauses of each kind, and their number per thousand characters."""
    return np.log1p(np.hstack([counts, 1000 * counts / np.maximum(chars, 1)[:, None]]))


def judged(texts: list[str], matcher: Matcher, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Clause counts and score of each text."""
    counts = np.array([matcher.counts(t) for t in texts], np.int64).reshape(-1, len(KINDS))
    chars = np.array([len(t) for t in texts], np.int64)
    return counts, 1 / (1 + np.exp(-np.clip(features(counts, chars) @ model.weights + model.bias, -30, 30)))


def _forms(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def learn_lexicon(forms: list[list[str]], toxic: np.ndarray) -> dict[str, float]:
    """forms: of each distinct labelled text, the candidate forms in it. Chosen one by one on the toxic texts left."""
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    holders: dict[str, list[int]] = {}
    clean = Counter()
    for i, fs in enumerate(forms):
        if toxic[i]:
            for f in fs:
                holders.setdefault(f, []).append(i)
        else:
            clean.update(fs)
    left = {f: set(h) for f, h in holders.items()}
    chosen: dict[str, float] = {}
    times = Counter()
    while left and len(chosen) < MAX_LEXICON:
        # a form and its longer spellings hold the same texts: the most telling one stands for them
        best = max(left, key=lambda f: (g2(len(left[f]), n1, clean[f], n0), len(f), f))
        own = left.pop(best)
        a = len(holders[best])
        if g2(len(own), n1, clean[best], n0) < MIN_G2:
            break
        if len(own) < MIN_SUPPORT or len(own) / n1 < MIN_RATIO * clean[best] / n0 or _spelled(best, chosen, holders):
            continue
        chosen[best] = math.log((a + 0.5) / (n1 + 1) / ((clean[best] + 0.5) / (n0 + 1)))
        times.update(own)
        explained = {i for i in own if times[i] >= EXPLAINED}
        for f in list(left):
            left[f] -= explained
            if len(left[f]) < MIN_SUPPORT:
                del left[f]
    return chosen


def _spelled(form: str, chosen: dict[str, float], holders: dict[str, list[int]]) -> bool:
    """Whether a chosen form already stands for this one: its beginning, or a longer spelling of the same texts."""
    if any(form[:n] + "*" in chosen for n in STEMS):
        return True
    return any(c.startswith(form.rstrip("*")) and 10 * len(holders[form]) <= 11 * len(holders[c]) for c in chosen)


def g2(a: int, n1: int, b: int, n0: int) -> float:
    """Likelihood-ratio statistic of a form in a of n1 toxic and b of n0 other texts; 0 if it is rarer among the toxic."""
    if not n1 or not n0 or a * n0 <= b * n1:
        return 0.0
    total = 0.0
    for k, n in ((a, n1), (b, n0)):
        for observed, share in ((k, (a + b) / (n1 + n0)), (n - k, 1 - (a + b) / (n1 + n0))):
            if observed and share:
                total += observed * math.log(observed / (n * share))
    return 2 * total


def fit_weights(x: np.ndarray, y: np.ndarray, case_weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, drawn towards the prior weights."""
    z = np.column_stack([x, np.ones(len(x))])
    prior = np.append(PRIOR, -3.0)
    ridge = np.append(np.full(len(PRIOR), RIDGE * max(1.0, case_weight.sum() ** 0.5)), 1e-3)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (case_weight * (y - p)) - ridge * (w - prior)
        hessian = (z * (case_weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """`learn` is a condition on the id column. Reads about `per_class` distinct labelled texts of each class."""
    known = labels.where(learn & F.col("toxic").isNotNull()).groupBy(id_column).agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model({}, PRIOR.copy(), -3.0)
    draw = F.pmod(F.xxhash64(F.col(id_column), F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, per_class / sizes[1]).otherwise(per_class / sizes[0])
    # at most about 2 x per_class rows
    drawn = known.where(draw < share).select(F.col(id_column).alias("__id"), (F.col("toxic") == 1).alias("toxic"))
    texts = docs.join(F.broadcast(drawn), F.col(id_column) == F.col("__id")).select(F.coalesce(F.col(text_column), F.lit("")).alias("text"), "toxic")
    texts = texts.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    texts = stored(texts, "labelled-texts")

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"h": batch["h"], "toxic": batch["toxic"], "forms": [sorted(_forms(t)) for t in batch["text"]]})

    spelled = texts.mapInPandas(spell, "h long, toxic boolean, forms array<string>")
    spelled = stored(spelled, "labelled-forms")
    n1, n0 = (int(x or 0) for x in spelled.agg(F.sum(F.col("toxic").cast("int")), F.sum((~F.col("toxic")).cast("int"))).first())
    if not n1 or not n0:
        return Model({}, PRIOR.copy(), -3.0)
    one = F.col("toxic").cast("int")
    counted = spelled.select("toxic", F.explode("forms").alias("form")).groupBy("form").agg(F.sum(one).alias("a"), F.sum(1 - one).alias("b"))
    promising = counted.where((F.col("a") >= MIN_SUPPORT) & (F.col("a") * n0 >= MIN_RATIO * F.col("b") * n1))
    # the most frequent promising forms; each is then judged with its statistic
    top = promising.orderBy(F.desc("a"), "b", "form").limit(CANDIDATES).select("form")
    hits = spelled.select("h", "toxic", F.explode("forms").alias("form")).join(F.broadcast(top), "form").groupBy("h", "toxic").agg(F.collect_list("form").alias("forms")).collect()
    toxic = np.zeros(n1 + n0, bool)
    toxic[:n1] = True
    forms: list[list[str]] = [[] for _ in toxic]
    at = {True: 0, False: n1}
    for r in hits:  # bounded by the sample
        forms[at[r["toxic"]]] = r["forms"]
        at[r["toxic"]] += 1
    lexicon = learn_lexicon(forms, toxic)
    matcher = Matcher(lexicon)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [matcher.counts(t) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "counts": counts, "chars": [len(t) for t in batch["text"]]})

    seen = texts.mapInPandas(count, "toxic boolean, counts array<long>, chars long").collect()  # a row per sampled text
    x = features(np.array([r["counts"] for r in seen], float), np.array([r["chars"] for r in seen], float))
    y = np.array([r["toxic"] for r in seen], float)
    # the sample holds a larger share of one class: weigh it back
    back = {True: sizes[1] / n1, False: sizes[0] / n0}
    weight = np.array([back[r["toxic"]] for r in seen])
    weights, bias = fit_weights(x, y, weight * (n1 + n0) / weight.sum())
    return Model(lexicon, weights, bias)


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, score, predicted, and clauses: how many of each kind matched."""
    matcher: list[Matcher] = []

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not matcher:
            matcher.append(Matcher(model.lexicon))
        for batch in batches:
            counts, score = judged(batch["text"].tolist(), matcher[0], model)
            yield pd.DataFrame({
                "id": batch["id"].astype("Int64"), "score": score, "predicted": (score >= THRESHOLD).astype(np.int32), "clauses": list(counts),
            })

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return narrow.mapInPandas(each, "id long, score double, predicted int, clauses array<long>").withColumnRenamed("id", id_column)


def without_toxic(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of docs that the model does not reject, with all their columns; no row moves."""
    place = docs.columns.index(text_column)
    matcher: list[Matcher] = []

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not matcher:
            matcher.append(Matcher(model.lexicon))
        for batch in batches:
            _, score = judged([t or "" for t in batch.column(place).to_pylist()], matcher[0], model)
            yield batch.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(each, docs.schema)
