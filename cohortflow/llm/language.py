"""Language identification of mixed text: scripts narrow the candidates, Viterbi labels the spans.

Every letter is seen with its two neighbours inside the word (a boundary mark at the ends). A
word's score in a language is the sum of the log probabilities of these trigrams; languages
whose training texts hardly use the script of a word are no candidates for it. Over the
words of a text, Viterbi with a fixed penalty for changing the language gives spans. The
language of the text is the one whose spans hold most letters, its score their share.

Training counts trigrams of a bounded sample (about `docs_per_language` texts of each
language, chosen by a hash) in Spark and keeps one table of (hash buckets x languages) log
probabilities, 256 KB per language, which goes to the tasks.

Defined results: a null text or one without a letter is `und` with score 0, as is every text
if nothing could be learned. Of equally good languages the first in alphabetical order wins. Very
long texts are read whole. Repeated rows are labelled each. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
BUCKET_BITS = 16
SMOOTHING = 0.5
SWITCH_PENALTY = 12.0
FOREIGN_SCRIPT = -60.0  # log score of a word in a language that does not use its script
SCRIPT_SHARE = 0.01
DOCS_PER_LANGUAGE = 2000
CHARS_AT_ONCE = 1 << 22

# First and last code point of blocks, by script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}
N_SCRIPTS = len(SCRIPTS) + 1  # the last one: any other


class Model(NamedTuple):
    languages: list[str]
    log_prob: np.ndarray  # bucket x language
    foreign: np.ndarray  # script x language: 0 or FOREIGN_SCRIPT


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: the lower-case letter (0 for others), and the script."""
    size = 0x110000
    lower = np.zeros(size, np.uint32)
    script = np.full(size, N_SCRIPTS - 1, np.uint8)
    for i in range(0x31350):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            lower[i] = ord(small) if len(small) == 1 else i
    lower[0x31350:0x32400] = np.arange(0x31350, 0x32400)
    for n, blocks in enumerate(SCRIPTS.values()):
        for first, last in blocks:
            script[first : last + 1] = n
    return lower, script


class Letters(NamedTuple):
    """All letters of some texts: trigram bucket and script of each, where words begin, and words per text."""

    bucket: np.ndarray
    script: np.ndarray
    word_start: np.ndarray
    word_text: np.ndarray


def letters_of(texts: list[str]) -> Letters:
    lower, script = _tables()
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    low = lower[codes]
    at = np.flatnonzero(low)
    padded = np.concatenate(([0], low, [0])).astype(np.uint64)
    mixed = padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + padded[at + 2] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    bucket = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    begins = np.flatnonzero(padded[at] == 0)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return Letters(bucket, script[codes[at]], begins, np.searchsorted(ends, at[begins], side="right"))


def word_scores(found: Letters, model: Model) -> np.ndarray:
    """Words x languages."""
    if not len(found.word_start):
        return np.zeros((0, len(model.languages)), np.float32)
    sums = np.add.reduceat(model.log_prob[found.bucket], found.word_start, axis=0)
    return sums + model.foreign[found.script[found.word_start]]


def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best language per word for many texts at once; text i has words first[i] to first[i] + count[i]."""
    path = np.zeros(len(scores), np.int64)
    back = np.zeros(scores.shape, np.int16)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    live = np.searchsorted(-count, -np.arange(int(count.max(initial=0)) + 1), side="left")  # texts with more than t words
    n = int(live[0]) if len(live) else 0
    delta = scores[first[:n]].astype(np.float64)
    same = np.arange(scores.shape[1], dtype=np.int16)
    for t in range(1, int(count.max(initial=0))):
        n = int(live[t])
        at, d = first[:n] + t, delta[:n]
        best = d.argmax(axis=1)
        moved = d[np.arange(n), best] - penalty
        move = moved[:, None] > d
        back[at] = np.where(move, best[:, None], same)
        d[:] = np.where(move, moved[:, None], d) + scores[at]
    n = int(live[0]) if len(live) else 0
    last = first[:n] + count[:n] - 1
    path[last] = delta[:n].argmax(axis=1)
    for t in range(int(count.max(initial=0)) - 1, 0, -1):
        at = first[: int(live[t])] + t
        path[at - 1] = back[at, path[at]]
    return path


def label_texts(texts: list[str | None], model: Model) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Language, score and spans (first word, words, language) of each text."""
    found = letters_of([t or "" for t in texts])
    out = [(UNKNOWN, 0.0, [])] * len(texts)
    if not len(found.word_start) or not model.languages:
        return out
    count = np.bincount(found.word_text, minlength=len(texts))
    first = np.cumsum(count) - count
    path = viterbi(word_scores(found, model), first, count)
    size = np.diff(np.append(found.word_start, len(found.bucket)))
    n = len(model.languages)
    held = np.bincount(found.word_text * n + path, weights=size, minlength=len(texts) * n).reshape(-1, n)
    cut = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (found.word_text[1:] != found.word_text[:-1]))))
    spans: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(path)], strict=True):
        i = int(found.word_text[a])
        spans[i].append((a - int(first[i]), b - a, model.languages[path[a]]))
    for i in np.flatnonzero(count).tolist():
        best = int(held[i].argmax())
        out[i] = (model.languages[best], float(held[i, best] / held[i].sum()), spans[i])
    return out


def train(docs: DataFrame, learn: Column, text_column: str = "text", lang_column: str = "lang", key: str = "doc_id", docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from a sample of the rows where `learn` holds."""
    rows = docs.where(learn & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_column).count().collect()}  # one row per language
    names = sorted(counts)
    if not names:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros((N_SCRIPTS, 0), np.float32))
    number = {n: i for i, n in enumerate(names)}
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[F.lit(x) for n in names for x in (n, docs_per_language / counts[n])]), F.col(lang_column))
    sample = rows.where(draw < share).select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, part in batch.groupby("lang")["text"]:
                for texts in _portions(part.tolist()):
                    found = letters_of(texts)
                    seen = total.setdefault(number[lang], np.zeros((1 << BUCKET_BITS) + N_SCRIPTS, np.int64))
                    seen[: 1 << BUCKET_BITS] += np.bincount(found.bucket, minlength=1 << BUCKET_BITS)
                    seen[1 << BUCKET_BITS :] += np.bincount(found.script, minlength=N_SCRIPTS)
        for lang, seen in total.items():
            at = np.flatnonzero(seen)
            yield pd.DataFrame({"lang": lang, "feature": at, "n": seen[at]})

    counted = sample.mapInPandas(count, "lang int, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    seen = np.zeros(((1 << BUCKET_BITS) + N_SCRIPTS, len(names)))
    tables = counted.groupBy("lang").agg(F.collect_list("feature").alias("features"), F.collect_list("n").alias("counts"))
    for lang, features, counts in tables.collect():  # one row of bounded length per language
        seen[features, lang] = counts
    grams, scripts = seen[: 1 << BUCKET_BITS], seen[1 << BUCKET_BITS :]
    smoothed = grams + SMOOTHING
    share_of = scripts / np.maximum(scripts.sum(axis=0), 1)
    used = share_of >= SCRIPT_SHARE
    # a script that no language uses leaves all as candidates
    foreign = np.where(used | ~used.any(axis=1, keepdims=True), 0.0, FOREIGN_SCRIPT)
    return Model(names, np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32), foreign.astype(np.float32))


def _portions(texts: list, chars: int = CHARS_AT_ONCE) -> Iterator[list]:
    """Texts in order, in lists of about so many characters."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size < chars):
            size += len(texts[stop] or "")
            stop += 1
        yield texts[at:stop]
        at = stop


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, lang_pred, score and spans, an array of (first_word, words, lang)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            for texts in _portions(batch["text"].tolist()):
                found = label_texts(texts, model)
                ids = batch["id"].iloc[at : at + len(texts)].astype("Int64")
                yield pd.DataFrame({"id": ids.array, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "spans": [f[2] for f in found]})
                at += len(texts)

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    spans = "array<struct<first_word:long,words:long,lang:string>>"
    return narrow.mapInPandas(each, f"id long, lang_pred string, score double, spans {spans}").withColumnRenamed("id", id_column)
