"""Runs of words against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cohortflow.llm import squares
from cohortflow.llm.queries import op11_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, exponent, least):
    """(start, length, period) by trying every period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, exponent * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def tangled(draw):
    words = [draw.randrange(draw.choice([1, 2, 3, 30])) for _ in range(draw.randrange(200))]
    for _ in range(draw.randrange(3)):
        if len(words) > 4:
            start, period = draw.randrange(len(words)), draw.randint(1, 40)
            for i in range(start + period, len(words)):
                words[i] = words[i - period]
            words[draw.randrange(len(words))] = 99
    return words


@pytest.mark.parametrize("at_once", [1, 3, 50, 1000])
def test_catcher_equals_plain_search_however_it_is_fed(at_once):
    draw = random.Random(7)
    for _ in range(300):
        words, exponent, least = tangled(draw), draw.choice([2, 2.5, 3, 4]), draw.choice([2, 6])
        catcher = squares.SquareCatcher(exponent, least)
        for i in range(0, len(words), at_once):
            catcher.append(np.array(words[i : i + at_once]))
        assert [tuple(r) for r in catcher.runs().T.tolist()] == plain_runs(words, exponent, least)


def test_texts_of_one_batch_do_not_touch(monkeypatch):
    monkeypatch.setattr(squares, "APPEND_WORDS", 37)
    draw = random.Random(3)
    texts = [tangled(draw) for _ in range(200)] + [[], [5], [5] * 400]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, runs = squares.runs_of_texts(np.array(sum(texts, [])), first, 4, 6)
    got = [[tuple(r) for r in runs[:, text == i].T.tolist()] for i in range(len(texts))]
    assert got == [plain_runs(t, 4, 6) for t in texts]


def test_state_of_a_level_stays_small():
    catcher = squares.SquareCatcher(4, 6)
    words = np.random.default_rng(1).integers(0, 50, 50_000)
    for i in range(0, len(words), 500):
        catcher.append(words[i : i + 500])
    for level in catcher.levels:
        assert len(level.blocks) <= 4 + 500 // level.size and len(level.recent) <= level.size + 500


def test_words_are_split_at_ascii_space_only():
    texts = ["", " a\tb\x0bc\x0cd\r\ne ", "x\xa0y z", "é\x1cü", "last", "\n"]
    words, first = squares.split_words(pa.array(texts))
    got = [words.to_pylist()[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [WORD.findall(t) for t in texts]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 4, 6)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("folder", ["sf_dir", "odd_dir"])
def test_query_equals_plain_search(spark, request, folder):
    folder = request.getfixturevalue(folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    docs = [d for d in docs if len(d.text or "") < 4_000] if folder.startswith("/root") else docs
    cut = {d.doc_id for d in docs}
    got = [tuple(r) for r in op11_periodic_runs(spark, folder).collect() if r.doc_id in cut]
    short = [d for d in docs if len(d.text or "") < 4_000]
    want = [(d.doc_id, *expected(d.doc_id, d.text)) for d in short]
    long_ids = {d.doc_id for d in docs} - {d.doc_id for d in short}
    order = lambda r: (r[0] is not None, str(r))
    assert sorted((g for g in got if g[0] not in long_ids), key=order) == sorted(want, key=order)


def test_long_periodic_text(spark, odd_dir):
    """A text of 45,000 words with period 9: one run over all of it, nine words left."""
    rows = {r.doc_id: r for r in op11_periodic_runs(spark, odd_dir).collect()}
    assert (rows[3].n_runs, rows[3].start, rows[3].length, rows[3].period) == (1, 0, 45_000, 9)
    assert rows[3].collapsed_sha256 == hashlib.sha256(b"the quick brown fox jumps over the lazy dog").hexdigest()
