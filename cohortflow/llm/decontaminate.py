"""Benchmark decontamination by latent semantic retrieval.

Passages of the benchmark and all passages of the corpus give a TF-IDF matrix
over the benchmark's words (idf counted over all documents; any other word has their median weight,
which counts in the length of a vector). Its dominant subspace comes from
a distributed randomised SVD: tasks multiply their rows with a block of vectors, sums meet by
blocks of words. Every document is then read in windows of words; a window whose latent cosine
with a benchmark passage reaches `min_cosine` is a candidate. Candidates are checked on the
words themselves: the longest common subsequence with the passage, around the window, must
hold `copied` of the passage's words, or `paraphrased` of them if most of the passage's answer
words (the rarest of its last third) are there as well.

Beside the latent search there is an exact one, so that no hit depends on how much of a passage the
basis keeps: whoever shares k of a passage's n words in order holds t of its n - k + t rarest ones close
together. Windows where that is so are candidates too; those that only fit a paraphrase must hold its answer.

The benchmark goes to the tasks in blocks of `block_passages` passages, so what a task holds is
bounded; documents are read once per block, and never shuffled. Nothing is kept of documents
but their hits.

Defined results: a null or empty text, and an item without words, matches nothing. Repeated items are
reported each, repeated rows of documents too. Texts are read whole. Items of fewer than MIN_WORDS words
match only as a whole run of words, so an item of one word matches every text that has it. Characters of
scripts without spaces count as words. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.tables import stored
from cohortflow.llm.words import Words, hashed_words, utf8, words_of

STEP = 16
WINDOW = 2  # steps
MIN_WORDS = 8
PASSAGE = 40
MIN_COSINE = 0.2
COPIED, PARAPHRASED, ANSWERED = 0.7, 0.5, 0.6
ANSWER_WORDS = 5
MIN_IDF = 1.5
RANK, EXTRA, POWER_STEPS = 128, 16, 2
BENCHMARK_WEIGHT = 20.0  # squared length of all benchmark rows over that of the corpus
BLOCK_PASSAGES = 2048
BYTES_AT_ONCE = 1 << 21
SUM_BLOCKS = 16
CELLS_AT_ONCE, RUN, RUNS_AT_ONCE = 1 << 16, 16, 2048  # of the rows that are multiplied


PROBE_SHARE = 0.1  # of a passage's words must meet before the exact search looks closer
FLOOR_IDF = 0.1


KNOWN_NAMES = ["rows", "held", "docs", "first", "at", "n"]
KNOWN = "rows long, held binary, docs binary, first binary, at binary, n binary"


class Passage(NamedTuple):
    item: int
    words: np.ndarray


class Probes(NamedTuple):
    """Rare words of the passages: for each place in the vocabulary the passages that have it among theirs."""

    first: np.ndarray  # probes before each place, and the total
    passage: np.ndarray
    least: np.ndarray  # per passage: occurrences close together


class Bits(NamedTuple):
    """The places of each passage's words in it, as bits of a machine word."""

    first: np.ndarray  # entries before each passage, and the total
    place: np.ndarray  # words of a passage, by their place in the vocabulary
    bits: np.ndarray  # where each stands in the passage
    answer: np.ndarray  # per passage: the first occurrences of its answer words
    answers: np.ndarray  # per passage: how many there are


class Space(NamedTuple):
    """What a task needs of a block: sorted word hashes, their latent vectors times idf, and the passages."""

    vocabulary: np.ndarray
    weighted: np.ndarray  # whether a word has weight; very common ones have none
    vectors: np.ndarray
    outside: float  # weight of a word that no passage has
    unit: np.ndarray  # passage x rank, length 1
    passages: list[Passage]
    answers: list[frozenset[int]]
    sizes: np.ndarray  # words of each passage
    copies: Probes
    paraphrases: Probes
    runs: Probes  # the rarest word of each short passage; `least` is its place there
    asked: np.ndarray  # passage x ANSWER_WORDS: places of the answer words, -1 if there are fewer
    bits: Bits


def split_items(items: list[tuple[int, str]], size: int = PASSAGE) -> list[Passage]:
    """Items as passages of at most `size` words; a longer item gives overlapping ones up to its end."""
    out = []
    for item, text in items:
        words = words_of(text or "", characters=True)
        if not len(words):
            continue
        starts = [0] if len(words) <= size else [*range(0, len(words) - size, size // 2), len(words) - size]
        out += [Passage(item, words[a : a + size]) for a in starts]
    return out


def _find(vocabulary: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted vocabulary, -1 if absent."""
    if not len(vocabulary):
        return np.full(len(words), -1)
    # most words are not in it: a table of hash prefixes settles that without a search
    at = np.searchsorted(vocabulary, words)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == words, at, -1)


class Lookup:
    """The same through an open table of 2**22 slots: one gather for most words."""

    BITS = 22

    def __init__(self, vocabulary: np.ndarray) -> None:
        self.vocabulary = vocabulary
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self._slot(vocabulary)] = True

    def _slot(self, words: np.ndarray) -> np.ndarray:
        return (words >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are in the vocabulary (their places in `words`), and where."""
        maybe = np.flatnonzero(self.seen[self._slot(words)])
        at = _find(self.vocabulary, words[maybe])
        return maybe[at >= 0], at[at >= 0]


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Words]]:
    """Ids and words of a batch, some megabytes of text at a time."""
    raw, offsets = utf8(batch.column(1))
    at, n = 0, batch.num_rows
    while at < n:
        stop = int(np.searchsorted(offsets, offsets[at] + BYTES_AT_ONCE, side="right")) - 1
        stop = min(n, max(stop, at + 1))
        yield batch.column(0).slice(at, stop - at), hashed_words(raw, offsets[at : stop + 1], characters=True)
        at = stop


def _narrow(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def text_of(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def known_words(docs: DataFrame, vocabulary: np.ndarray, id_column: str, text_column: str) -> DataFrame:
    """The words of the vocabulary in all documents, packed: of each passage the words (at) and how often (n), `first` counting those of the
    passages before; and in how many of the record's `rows` documents each word `held` stands (docs). Passages are PASSAGE words that
    follow one another, so that each word is in one; those without a word of the vocabulary are left out."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, n_words = Lookup(vocabulary), np.int64(len(vocabulary))
        kind = np.min_scalar_type(len(vocabulary) - 1)
        for batch in batches:
            for ids, words in _portions(batch):
                at, place = lookup(words.hash)
                counts = np.diff(words.first)
                pieces = -(-counts // PASSAGE)
                text = text_of(words.first)[at]
                passage = (np.cumsum(pieces) - pieces)[text] + (at - words.first[text]) // PASSAGE
                pairs, n = np.unique(passage * n_words + place, return_counts=True)
                passage, place = np.divmod(pairs, n_words)
                begins = np.flatnonzero(np.diff(passage, prepend=-1))
                seen = np.bincount(np.unique(text_of(np.append(0, np.cumsum(pieces)))[passage] * n_words + place) % n_words)
                held = np.flatnonzero(seen)
                packed = held.astype(np.int32), seen[held].astype(np.int32), np.append(begins, len(place)).astype(np.int32), place.astype(kind), n.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), *[pa.array([v.tobytes()], pa.binary()) for v in packed]], names=KNOWN_NAMES)

    return _narrow(docs, id_column, text_column).mapInArrow(each, KNOWN)


def document_frequency(known: DataFrame, n_words: int) -> tuple[np.ndarray, int, int]:
    """Documents that hold each word, all documents, and passages with some word, counted over every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_words + 2, np.int64)
        for batch in batches:
            for rows, *packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held, docs, first = (np.frombuffer(b, np.int32) for b in packed)
                seen[held] += docs
                seen[-2:] += rows, len(first) - 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["place", "n"])

    out = np.zeros(n_words + 2, np.int64)
    counted = known.select("rows", "held", "docs", "first").mapInArrow(each, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    for place, n in counted.collect():  # as many rows as the block has words
        out[place] = n
    return out[:-2], int(out[-2]), int(out[-1])


Cells = tuple[np.ndarray, np.ndarray, np.ndarray]  # of some rows: cells before each, and the total; their places and values


def listed_cells(batch: pa.RecordBatch) -> Iterator[Cells]:
    """Rows (at, value)."""
    offsets = np.unique(batch.column(0).offsets.to_numpy()).astype(np.int64)  # empty rows add nothing
    at, value = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in (0, 1))
    yield offsets - offsets[0], at[offsets[0] : offsets[-1]], value[offsets[0] : offsets[-1]]


def weighted_rows(known: DataFrame, passages: list[Passage], vocabulary: np.ndarray, n_passages: int) -> DataFrame:
    """(first, at, n, weight): the passages of the corpus and of the benchmark."""
    # the space must hold the benchmark: its few rows weigh more than all others together
    weight = float(np.sqrt(BENCHMARK_WEIGHT * max(1.0, n_passages / len(passages))))
    at, n = zip(*[np.unique(_find(vocabulary, p.words), return_counts=True) for p in passages], strict=True)
    kinds = np.int32, np.min_scalar_type(len(vocabulary) - 1), np.uint8
    packed = np.cumsum([0, *map(len, at)]), np.concatenate(at), np.concatenate(n)
    own = [(*[bytearray(v.astype(k).tobytes()) for v, k in zip(packed, kinds, strict=True)], weight)]
    corpus = known.select("first", "at", "n", F.lit(1.0).alias("weight"))
    return corpus.unionByName(known.sparkSession.createDataFrame(own, "first binary, at binary, n binary, weight double").coalesce(1))


def packed_cells(idf: np.ndarray) -> Callable[[pa.RecordBatch], Iterator[Cells]]:
    """TF-IDF rows of length 1, times their weight, of packed passages; words without weight and rows without any other are left out."""
    kind = np.min_scalar_type(len(idf) - 1)

    def cells(batch: pa.RecordBatch) -> Iterator[Cells]:
        for first, at, n, weight in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            first, at, n = np.frombuffer(first, np.int32), np.frombuffer(at, kind), np.frombuffer(n, np.uint8)
            value = n * idf[at]
            some = np.flatnonzero(value)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))[some]
            begins = np.flatnonzero(np.diff(row, prepend=-1))
            if len(some):
                first, at, value = np.append(begins, len(some)), at[some], value[some]
                norm = np.sqrt(np.add.reduceat(value**2, begins)) / weight
                yield first, at, (value / np.repeat(norm, np.diff(first))).astype(np.float32)

    return cells


def _totals(rows: DataFrame, block: np.ndarray, shape: tuple[int, int], add: Callable, cells: Callable) -> np.ndarray:
    """What `add` sums over all rows. Tasks hold one sum each; its blocks of rows are summed apart."""
    cuts = np.linspace(0, shape[0], SUM_BLOCKS + 1).astype(int).tolist()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, vectors = np.zeros(shape), {}
        for batch in batches:
            for first, at, value in cells(batch):
                held = vectors.setdefault(value.dtype, block.astype(value.dtype))
                a, last = 0, len(first) - 1
                while a < last:  # some rows at a time, so that what is gathered stays small
                    z = min(last, max(a + 1, int(np.searchsorted(first, first[a] + CELLS_AT_ONCE, side="right")) - 1))
                    add(out, held, first[a : z + 1] - first[a], at[first[a] : first[z]], value[first[a] : first[z]])
                    a = z
        parts = [out[a:z].tobytes() for a, z in zip(cuts, cuts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SUM_BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names=["b", "m"])

    def summed(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for m in batch["m"]:
                part = np.frombuffer(m)
                total = part.copy() if total is None else total + part
        yield pd.DataFrame({"b": [key[0]], "m": [total.tobytes()]})

    partial = rows.mapInArrow(each, "b int, m binary")
    parts = {r["b"]: r["m"] for r in partial.groupBy("b").applyInPandas(summed, "b int, m binary").collect()}
    return np.concatenate([np.frombuffer(parts[b]).reshape(-1, shape[1]) for b in range(SUM_BLOCKS)]) if parts else np.zeros(shape)


def multiplied(rows: DataFrame, block: np.ndarray, cells: Callable = listed_cells) -> np.ndarray:
    """A'(A block) for the distributed rows A."""
    return _totals(rows, block, block.shape, _add_product, cells)


def inner_products(rows: DataFrame, block: np.ndarray, cells: Callable = listed_cells) -> np.ndarray:
    """(A block)'(A block)."""
    return _totals(rows, block, (block.shape[1],) * 2, _add_inner, cells)


def _add_product(out: np.ndarray, vectors: np.ndarray, first: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
    product = _gathered(vectors, at, value, first[:-1])
    row = np.repeat(np.arange(len(product)), np.diff(first))
    order = np.argsort(at, kind="stable")
    begins = np.flatnonzero(np.diff(at[order].astype(np.int64), prepend=-1))
    out[at[order[begins]]] += _gathered(product, row[order], value[order], begins)


def _add_inner(out: np.ndarray, vectors: np.ndarray, first: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
    product = _gathered(vectors, at, value, first[:-1])
    out += product.T @ product


def _gathered(vectors: np.ndarray, at: np.ndarray, value: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of value x vectors[at] over runs of cells, none empty: the k-th cell of many runs at a time, long runs in pieces."""
    held = np.diff(np.append(begins, len(at)))
    pieces = -(-held // RUN)
    if len(pieces) and pieces.max() > 1:
        owner, k = _spread(pieces)
        sums = _gathered(vectors, at, value, begins[owner] + k * RUN)
        return _gathered(sums, np.arange(len(sums)), np.ones(len(sums), sums.dtype), np.cumsum(pieces) - pieces)
    order = np.argsort(-held, kind="stable")
    out = np.empty((len(begins), vectors.shape[1]), vectors.dtype)
    part = np.empty((min(len(begins), RUNS_AT_ONCE), vectors.shape[1]), vectors.dtype)
    for a in range(0, len(begins), RUNS_AT_ONCE):
        own = order[a : a + RUNS_AT_ONCE]
        total = np.zeros((len(own), vectors.shape[1]), vectors.dtype)
        for k in range(int(held[own[0]])):
            n = int(np.searchsorted(-held[own], -k, side="left"))  # runs with more than k cells
            cell = begins[own[:n]] + k
            np.take(vectors, at[cell], axis=0, out=part[:n], mode="clip")
            part[:n] *= value[cell, None]
            total[:n] += part[:n]
        out[own] = total
    return out


def latent_basis(rows: DataFrame, n_words: int, rank: int = RANK, seed: int = 1, cells: Callable = listed_cells) -> np.ndarray:
    """Words x rank: an orthonormal basis of the dominant right singular vectors."""
    width = min(n_words, rank + EXTRA)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_words, width)))[0]
    for _ in range(POWER_STEPS):
        q = np.linalg.qr(multiplied(rows, q, cells))[0]
    # Rayleigh-Ritz: the best directions inside the range found
    inner = inner_products(rows, q, cells)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    return q @ vectors[:, np.argsort(-values)[: min(rank, width)]]


def build_space(docs: DataFrame, passages: list[Passage], id_column: str, text_column: str, rank: int = RANK) -> Space:
    vocabulary = np.unique(np.concatenate([p.words for p in passages]))
    known = stored(known_words(docs, vocabulary, id_column, text_column), "known_words")
    df, total, n_passages = document_frequency(known, len(vocabulary))
    idf = np.log((1 + total) / (1 + df))
    rarity = idf
    # in a corpus too small to tell common words, all count
    weighs = idf >= min(MIN_IDF, np.median(idf))
    # a passage whose words are common for the most part keeps the weight of all of them
    for p in passages:
        place = _find(vocabulary, p.words)
        if weighs[place].mean() < 0.5:
            weighs[place] = True
    idf = np.where(weighs, np.maximum(idf, FLOOR_IDF), 0.0)
    basis = latent_basis(weighted_rows(known, passages, vocabulary, n_passages), len(vocabulary), rank, cells=packed_cells(idf))
    vectors = (basis * idf[:, None]).astype(np.float32)
    latent = np.array([vectors[_find(vocabulary, p.words)].sum(axis=0) for p in passages])
    unit = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    answers = []
    for p in passages:
        last = p.words[len(p.words) * 2 // 3 :]
        rare = np.argsort(-rarity[_find(vocabulary, last)], kind="stable")[:ANSWER_WORDS]
        answers.append(frozenset(last[rare].tolist()))
    asked = np.full((len(passages), ANSWER_WORDS), -1)
    for i, a in enumerate(answers):
        asked[i, : len(a)] = _find(vocabulary, np.array(sorted(a), np.uint64))
    outside = float(np.median(idf[idf > 0])) if (idf > 0).any() else 0.0
    sizes = np.array([len(p.words) for p in passages])
    copies, paraphrases = (rare_words(passages, vocabulary, rarity, share) for share in (COPIED, PARAPHRASED))
    runs = rarest_of_short(passages, vocabulary, rarity)
    bits = passage_bits(passages, answers, vocabulary)
    return Space(vocabulary, idf > 0, vectors, outside, unit.astype(np.float32), passages, answers, sizes, copies, paraphrases, runs, asked, bits)


def passage_bits(passages: list[Passage], answers: list[frozenset[int]], vocabulary: np.ndarray) -> Bits:
    place, bits, answer = [], [], np.zeros(len(passages), np.uint64)
    for i, p in enumerate(passages):  # of PASSAGE words at most, so that a machine word holds them
        words, begins, which = np.unique(p.words, return_index=True, return_inverse=True)
        held = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(held, which, np.uint64(1) << np.arange(len(p.words), dtype=np.uint64))
        place.append(_find(vocabulary, words))
        bits.append(held)
        for at in begins[np.isin(words, np.array(sorted(answers[i]), np.uint64))].tolist():
            answer[i] |= np.uint64(1) << np.uint64(at)
    first = np.concatenate([[0], np.cumsum([len(x) for x in place])]).astype(np.int64)
    return Bits(first, np.concatenate(place), np.concatenate(bits), answer, np.array([len(a) for a in answers]))


def _least(total: int, share: float) -> int:
    """The smallest count that is `share` of the total."""
    return next(k for k in range(total + 1) if k >= share * total or k / max(1, total) >= share)


def rare_words(passages: list[Passage], vocabulary: np.ndarray, rarity: np.ndarray, share: float) -> Probes:
    """Per passage the n - k + t rarest of its n words; a text with k of the n in order has at least t of these."""
    place, owner, least = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for i, p in enumerate(passages):
        n = len(p.words)
        if n < MIN_WORDS:  # see rarest_of_short
            least.append(1)
            continue
        need = _least(n, share)
        t = min(need, max(2, round(PROBE_SHARE * n)))
        at = _find(vocabulary, p.words)
        rare = np.unique(at[np.argsort(-rarity[at], kind="stable")[: n - need + t]])
        place.append(rare)
        owner.append(np.full(len(rare), i))
        least.append(t)
    return _probes(np.concatenate(place), np.concatenate(owner), np.array(least), len(vocabulary))


def rarest_of_short(passages: list[Passage], vocabulary: np.ndarray, rarity: np.ndarray) -> Probes:
    short = np.array([i for i, p in enumerate(passages) if len(p.words) < MIN_WORDS], np.int64)
    least, place = np.zeros(len(passages), np.int64), np.zeros(len(short), np.int64)
    for k, i in enumerate(short.tolist()):
        at = _find(vocabulary, passages[i].words)
        least[i] = int(np.argmax(rarity[at]))
        place[k] = at[least[i]]
    return _probes(place, short, least, len(vocabulary))


def _probes(place: np.ndarray, passage: np.ndarray, least: np.ndarray, n_words: int) -> Probes:
    order = np.argsort(place, kind="stable")
    return Probes(np.searchsorted(place[order], np.arange(n_words + 1)), passage[order], least)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence of two lists of any length; common_subsequences takes many pairs at once."""
    places: dict[int, int] = defaultdict(int)
    for i, x in enumerate(a):
        places[x] |= 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def common_subsequences(size: np.ndarray, owner: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of a passage and a text, for many pairs at once, a machine word of bits per row.

    size: the passages' words; masks: for each word of the texts that the passage has, in order, where it stands there; owner: its pair."""
    held = np.bincount(owner, minlength=len(size))
    order = np.argsort(-held, kind="stable")
    begins, longest = (np.cumsum(held) - held)[order], held[order]
    full = (np.uint64(1) << size[order].astype(np.uint64)) - np.uint64(1)
    row = full.copy()
    for k in range(int(longest[0]) if len(longest) else 0):
        n = int(np.searchsorted(-longest, -k, side="left"))  # pairs with more than k such words
        hit = row[:n] & masks[begins[:n] + k]
        row[:n] = ((row[:n] + hit) | (row[:n] - hit)) & full[:n]
    out = np.empty(len(size), np.int64)
    out[order] = size[order] - np.bitwise_count(row)
    return out


def _spread(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts n: whose each of the n.sum() places is, and its number there."""
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def rare_word_windows(at: np.ndarray, place: np.ndarray, first: np.ndarray, sizes: np.ndarray, probes: Probes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, step and passage of the windows around which enough of a passage's rare words occur; none is missed."""
    owner, k = _spread((probes.first[1:] - probes.first[:-1])[place])
    span, texts = np.int64(first[-1] + 1), text_of(first)
    passage, at = np.divmod(np.sort(probes.passage[probes.first[place[owner]] + k] * span + at[owner]), span)
    text = texts[at]
    last = np.arange(len(at)) + probes.least[passage] - 1
    inside = np.flatnonzero(last < len(at))
    last = last[inside]
    n = sizes[passage[inside]]
    near = (passage[last] == passage[inside]) & (text[last] == text[inside]) & (at[last] - at[inside] < 2 * n + STEP * WINDOW)
    begin, last, n = inside[near], last[near], n[near]
    # every window with all of them between n words before it and n words after it
    low = np.maximum(0, -(-(at[last] - first[text[begin]] + 1 - n - STEP * WINDOW) // STEP))
    high = np.minimum(at[begin] - first[text[begin]] + n, first[text[begin] + 1] - first[text[begin]] - 1) // STEP
    owner, k = _spread(np.maximum(0, high - low + 1))
    passage, begin = np.divmod(np.unique(passage[begin][owner] * span + first[text[begin]][owner] + (low[owner] + k) * STEP), span)
    text = texts[begin]
    return text, (begin - first[text]) // STEP, passage


def _answered(text: np.ndarray, step: np.ndarray, passage: np.ndarray, at: np.ndarray, place: np.ndarray, first: np.ndarray, space: Space) -> np.ndarray:
    """Whether enough answer words of the passage occur around the window."""
    # known words by (place, position)
    span = np.int64(first[-1] + 1)
    known = np.sort(place * span + at)
    n = space.sizes[passage]
    low = first[text] + np.maximum(0, step * STEP - n)
    high = np.minimum(first[text] + step * STEP + STEP * WINDOW + n, first[text + 1])
    asked = space.asked[passage]
    held = np.zeros(len(text), int)
    for j in range(asked.shape[1]):
        key = asked[:, j] * span
        held += (asked[:, j] >= 0) & (np.searchsorted(known, key + low) < np.searchsorted(known, key + high))
    return held / np.maximum(1, (asked >= 0).sum(axis=1)) >= ANSWERED


def short_runs(words: Words, at: np.ndarray, place: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, step and passage where a short passage stands as a whole run of words."""
    owner, k = _spread((space.runs.first[1:] - space.runs.first[:-1])[place])
    passage = space.runs.passage[space.runs.first[place[owner]] + k]
    text = np.searchsorted(words.first, at[owner], side="right") - 1
    begin = at[owner] - space.runs.least[passage]
    n = space.sizes[passage]
    same = (begin >= words.first[text]) & (begin + n <= words.first[text + 1])
    table = np.zeros((len(space.passages), MIN_WORDS), np.uint64)
    for p in np.unique(passage).tolist():
        table[p, : space.sizes[p]] = space.passages[p].words
    for j in range(MIN_WORDS - 1):
        some = np.flatnonzero(same & (j < n))
        same[some] = words.hash[begin[some] + j] == table[passage[some], j]
    text, passage = text[same], passage[same]
    return text, (begin[same] - words.first[text]) // STEP, passage


def exact_candidates(at: np.ndarray, place: np.ndarray, first: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, step and passage of all windows that can pass the check."""
    copies = rare_word_windows(at, place, first, space.sizes, space.copies)
    text, step, passage = rare_word_windows(at, place, first, space.sizes, space.paraphrases)
    some = _answered(text, step, passage, at, place, first, space) if len(text) else np.zeros(0, bool)
    both = np.concatenate([np.stack(copies), np.stack([text[some], step[some], passage[some]])], axis=1)
    span = np.int64(first[-1] + 1)
    one = np.unique(both[2] * span + first[both[0]] + both[1] * STEP, return_index=True)[1]
    return tuple(both[:, one])


def window_candidates(
    words: Words, space: Space, at: np.ndarray, place: np.ndarray, min_cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in the text, passage and cosine of the windows that come near a passage. at, place: the known words."""
    counts = np.diff(words.first)
    steps = -(-counts // STEP)  # steps of each text
    first_step = np.cumsum(steps) - steps
    text = text_of(words.first)[at]
    step = first_step[text] + (at - words.first[text]) // STEP
    total = int(steps.sum())
    owner = np.repeat(np.arange(len(counts)), steps)
    size = np.minimum(STEP, counts[owner] - (np.arange(total) - first_step[owner]) * STEP)
    # the last column gathers the weight of words that no passage has
    sums = np.zeros((total + WINDOW, space.vectors.shape[1] + 1), np.float32)
    sums[:total, -1] = (size - np.bincount(step, minlength=total)) * space.outside**2
    exact = [np.concatenate(x) for x in zip(exact_candidates(at, place, words.first, space), short_runs(words, at, place, space), strict=True)]
    known = space.weighted[place]
    step, place = step[known], place[known]
    if len(step):
        begins = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1])))
        held = np.diff(np.append(begins, len(step)))
        for k in range(int(held.max())):  # the k-th known word of every step; a step has STEP words at most
            some = begins[held > k] + k
            sums[step[some], :-1] += space.vectors[place[some]]
    window = sums[:total].copy()
    for w in range(1, WINDOW):
        same = np.append(owner, np.full(w, -1))[w:] == owner
        window[same] += sums[w : total + w][same]
    window, other = window[:, :-1], window[:, -1]
    own = (window * window).sum(axis=1)
    norm = np.sqrt(own + other)
    live = np.flatnonzero((own > 0) & (own >= (min_cosine * norm) ** 2))  # no cosine exceeds the length of the latent part
    cosine = (window[live] @ space.unit.T) / norm[live][:, None]
    near, passage = np.nonzero((cosine >= min_cosine) & (space.sizes >= MIN_WORDS))
    hit, cosine = live[near], cosine[near, passage]
    # windows that only the exact search found
    more = first_step[exact[0]] + exact[1]
    new = ~np.isin(more * len(space.passages) + exact[2], hit * len(space.passages) + passage)
    more, exact_passage = more[new], exact[2][new]
    exact_cosine = np.einsum("ij,ij->i", window[more], space.unit[exact_passage]) / np.maximum(norm[more], 1e-12)
    hit, passage, cosine = np.append(hit, more), np.append(passage, exact_passage), np.append(cosine, exact_cosine)
    return owner[hit], (hit - first_step[owner[hit]]) * STEP, passage, cosine


def _region_bits(passage: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """For regions of known words (low to high), in order of their passages: the words that the passage has, as the region's
    number and the places in the passage."""
    table = np.zeros(len(space.vocabulary), np.uint64)
    owners, masks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    cuts = np.flatnonzero(np.diff(passage, prepend=-1, append=-1))
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = slice(*space.bits.first[passage[a] : passage[a] + 2].tolist())
        table[space.bits.place[own]] = space.bits.bits[own]
        owner, k = _spread(high[a:z] - low[a:z])
        bits = table[place[low[a:z][owner] + k]]
        some = np.flatnonzero(bits)
        owners.append(a + owner[some])
        masks.append(bits[some])
        table[space.bits.place[own]] = 0
    return np.concatenate(owners), np.concatenate(masks)


def matches(words: Words, space: Space, lookup: Lookup, min_cosine: float = MIN_COSINE) -> list[tuple[int, int, float, float, float, int]]:
    """(text, item, cosine, share of the passage in order, share of its answer, first word) of checked hits, the best per text and item."""
    best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
    at, place = lookup(words.hash)
    found = window_candidates(words, space, at, place, min_cosine)

    def keep(text: np.ndarray, passage: np.ndarray, *values: np.ndarray) -> None:
        for t, p, *value in zip(text.tolist(), passage.tolist(), *(v.tolist() for v in values), strict=True):
            key = (t, space.passages[p].item)
            best[key] = max(best.get(key, (0.0, 0.0, 0.0, 0)), tuple(value))

    short = space.sizes[found[2]] < MIN_WORDS  # found as a whole run
    text, start, p, cosine = (x[short] for x in found)
    keep(text, p, np.ones(len(text)), np.ones(len(text)), cosine, start)
    # the others passage by passage
    order = np.flatnonzero(~short)[np.argsort(found[2][~short], kind="stable")]
    text, start, p, cosine = (x[order] for x in found)
    n = space.sizes[p]
    # the passage may begin before the window and end after it
    low = np.searchsorted(at, words.first[text] + np.maximum(0, start - n))
    high = np.searchsorted(at, np.minimum(words.first[text] + start + STEP * WINDOW + n, words.first[text + 1]))
    owner, masks = _region_bits(p, low, high, place, space)
    there = np.zeros(len(p), np.uint64)
    begins = np.flatnonzero(np.diff(owner, prepend=-1))
    if len(begins):
        there[owner[begins]] = np.bitwise_or.reduceat(masks, begins)
    answered = np.bitwise_count(there & space.bits.answer[p]) / np.maximum(1, space.bits.answers[p])
    # no common subsequence is longer than the passage's words that are there at all
    some = np.bitwise_count(there) / n >= np.where(answered >= ANSWERED, PARAPHRASED, COPIED)
    number = np.cumsum(some) - 1
    mine = some[owner]
    common = common_subsequences(n[some], number[owner[mine]], masks[mine]) / n[some]
    hit = (common >= COPIED) | ((common >= PARAPHRASED) & (answered[some] >= ANSWERED))
    keep(text[some][hit], p[some][hit], common[hit], answered[some][hit], cosine[some][hit], start[some][hit])
    return [(t, i, cosine, common, answered, start) for (t, i), (common, answered, cosine, start) in sorted(best.items())]


def leaked(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    rank: int = RANK, block_passages: int = BLOCK_PASSAGES, min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """One row per (document row, item) that matches: id, item, cosine, common, answered, first_word."""
    spark = docs.sparkSession
    schema = f"id long, {item_column} long, cosine double, common double, answered double, first_word long"
    out = spark.createDataFrame([], schema)
    for passages in _blocks(benchmark, item_column, text_column, block_passages):
        out = out.unionByName(_search(docs, build_space(docs, passages, id_column, text_column, rank), schema, id_column, text_column, min_cosine))
    return out.withColumnRenamed("id", id_column)


def _blocks(benchmark: DataFrame, item_column: str, text_column: str, size: int) -> Iterator[list[Passage]]:
    """The stated query set, read in order by the driver one block after the other."""
    block: list[Passage] = []
    rows = benchmark.select(F.col(item_column).cast("long"), text_column).where(F.col(text_column).isNotNull()).orderBy(item_column, text_column)
    for item, text in rows.toLocalIterator():
        block += split_items([(item, text)])
        if len(block) >= size:
            yield block
            block = []
    if block:
        yield block


def _search(docs: DataFrame, space: Space, schema: str, id_column: str, text_column: str, min_cosine: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(space)  # bounded by the passages of a block

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value.vocabulary)
        for batch in batches:
            for ids, words in _portions(batch):
                found = matches(words, shared.value, lookup, min_cosine)
                if found:
                    text, item, cosine, common, answered, start = zip(*found, strict=True)
                    columns = [ids.take(pa.array(text)), pa.array(item, pa.int64()), *[pa.array(c, pa.float64()) for c in (cosine, common, answered)], pa.array(start, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    return _narrow(docs, id_column, text_column).mapInArrow(each, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", rank: int = RANK) -> DataFrame:
    """The rows of docs in which no item was found, with all their columns; no row moves."""
    place, kept = docs.columns.index(text_column), docs
    for passages in _blocks(benchmark, item_column, text_column, BLOCK_PASSAGES):
        shared = docs.sparkSession.sparkContext.broadcast(build_space(docs, passages, id_column, text_column, rank))
        kept = kept.mapInArrow(_keep_clean(shared, place), docs.schema)
    return kept


def _keep_clean(shared, place: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value.vocabulary)
        for batch in batches:
            texts = batch.column(place).fill_null("")
            narrow = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), texts], names=["at", "text"])
            clean = np.ones(batch.num_rows, bool)
            for at, words in _portions(narrow):
                clean[[at[m[0]].as_py() for m in matches(words, shared.value, lookup)]] = False
            yield batch.filter(pa.array(clean))

    return each
