"""Periodic stretches of words, caught online by dyadic blocks.

Words are appended to a catcher. On level k every completed block of 2^k words is watched while the next words
come: a square whose half-length p lies in [2^(k+1), 2^(k+2)) has such a block in its first half, and the same
words p later. So each appended word, once it completes a window of 2^k words, is compared with the two blocks
that can be its partner, and nothing else. Consecutive blocks that match at one distance are one stretch of
overlapping squares; its two ends are then compared word by word, at most a block each way, and it is a run.

State per level: the window hashes that the next level still needs, the hashes of four blocks and the stretches
that may go on, in all a small multiple of the text held. The catcher gives the same runs whether it is fed
single words or thousands at once; feeding many at once lets numpy do the comparisons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.llm.words import utf8

SLICE_BYTES = 4 << 20  # text handled at once, more only for a single longer text
APPEND_WORDS = 1 << 16
ENDS_AT_ONCE = 1 << 20  # word pairs compared at once at the ends of stretches

# Fixed values of the contract: characters that part words.
_PARTING = np.zeros(256, bool)
_PARTING[[0x20, *range(0x09, 0x0E)]] = True
_STEP, _MIX, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _MIX
    x ^= x >> np.uint64(29)
    return x


class _Level:
    """What blocks of `size` words still have to see."""

    def __init__(self, k: int, at: int):
        self.k, self.size = k, 1 << k
        self.partners = (1, 2, 3) if k == 0 else (2, 3)  # blocks back from the one a window starts in
        self.recent, self.recent_at = np.zeros(0, np.uint64), at  # window hashes the next level needs
        self.blocks, self.first_block = np.zeros(0, np.uint64), 0
        self.stretches = np.zeros((3, 0), np.int64)  # distance, first block, last block; may still go on

    def catch(self, fresh: np.ndarray, at: int) -> np.ndarray:
        """Compare the new windows, which start at `at`, with their blocks; the stretches that ended."""
        first = -(-at // self.size)
        self.blocks = np.concatenate([self.blocks, fresh[first * self.size - at :: self.size]])
        block = np.arange(at, at + len(fresh)) >> self.k
        hits = [self.stretches]
        for back in self.partners:
            known = np.searchsorted(block, self.first_block + back)
            equal = self.blocks[block[known:] - back - self.first_block] == fresh[known:]
            i = np.flatnonzero(equal) + known
            start = (block[i] - back) << self.k
            hits.append(np.stack([i + at - start, start, start]))
        oldest = max(self.first_block, ((at + len(fresh)) >> self.k) - 3)
        self.blocks, self.first_block = self.blocks[oldest - self.first_block :], oldest
        joined = self._joined(np.concatenate(hits, axis=1))
        going_on = joined[2] + self.size + joined[0] >= at + len(fresh)
        self.stretches = joined[:, going_on]
        return joined[:, ~going_on]

    def _joined(self, parts: np.ndarray) -> np.ndarray:
        """Neighbouring blocks at one distance as one stretch."""
        if not parts.shape[1]:
            return parts
        distance, first, last = parts[:, np.lexsort((parts[1], parts[0]))]
        new = np.ones(len(distance), bool)
        new[1:] = (distance[1:] != distance[:-1]) | (first[1:] != last[:-1] + self.size)
        begins = np.flatnonzero(new)
        return np.stack([distance[begins], first[begins], last[np.append(begins[1:], len(new)) - 1]])

    def rest(self) -> np.ndarray:
        ended, self.stretches = self.stretches, np.zeros((3, 0), np.int64)
        return ended


class SquareCatcher:
    """Runs of at least `min_exponent` periods and `min_length` words in a growing sequence of numbers."""

    def __init__(self, min_exponent: float = 2, min_length: int = 2):
        if min_exponent < 2:
            raise ValueError("a run holds a square: min_exponent is 2 at least")
        self.min_exponent, self.min_length = min_exponent, min_length
        self.words, self.n = np.zeros(1024, np.int64), 0
        self.levels: list[_Level] = []
        self.longest = None
        self.found: list[np.ndarray] = []

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """Take the next words. `longest` promises that no run from these words on has a longer period."""
        at, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            self.words = np.concatenate([self.words[:at], np.zeros(max(self.n, 2 * at) - at, np.int64)])
        self.words[at : self.n] = words
        if longest is not None:
            self.longest = longest if self.longest is None else min(self.longest, longest)
        fresh = _mixed(words.astype(np.uint64) * _STEP + _ADD)
        k = 0
        while len(fresh) and (self.longest is None or (2 << k if k else 1) <= self.longest):
            if k == len(self.levels):
                self.levels.append(_Level(k, at))
            level = self.levels[k]
            self._settle(level, level.catch(fresh, at))
            have = np.concatenate([level.recent, fresh])
            complete = max(0, len(have) - level.size)
            fresh = _mixed(have[:complete] * _STEP + have[level.size :][:complete])
            at = level.recent_at
            level.recent, level.recent_at = have[complete:], at + complete
            k += 1
        if self.longest is not None and (2 << k if k else 1) > self.longest:
            self._close(k)

    def _close(self, first_level: int) -> None:
        for level in self.levels[first_level:]:
            self._settle(level, level.rest())
        del self.levels[first_level:]

    def _settle(self, level: _Level, stretches: np.ndarray) -> None:
        """Compare the ends of ended stretches; those long enough are runs."""
        distance, first, last = stretches
        least = np.maximum(np.ceil(self.min_exponent * distance).astype(np.int64), self.min_length) - distance
        enough = last - first + 3 * level.size - 2 >= least
        distance, first, end, least = distance[enough], first[enough], last[enough] + level.size, least[enough]
        if not len(distance):
            return
        start = first - self._agreeing(first - 1, distance, -1, level.size)
        end = end + self._agreeing(end, distance, 1, level.size)
        kept = end - start >= least
        self.found.append(np.stack([start, end + distance, distance])[:, kept])

    def _agreeing(self, at: np.ndarray, distance: np.ndarray, step: int, most: int) -> np.ndarray:
        """How many words from `at` on, going by `step`, equal those `distance` later; below `most`."""
        out = np.zeros(len(at), np.int64)
        if most < 2:
            return out
        rows = max(1, ENDS_AT_ONCE // most)
        for i in range(0, len(at), rows):
            place = at[i : i + rows, None] + step * np.arange(most)
            other = place + distance[i : i + rows, None]
            inside = (place >= 0) & (other < self.n)
            same = inside & (self.words[np.where(inside, place, 0)] == self.words[np.where(inside, other, 0)])
            out[i : i + rows] = np.where(same.all(1), most, same.argmin(1))
        return out

    def runs(self) -> np.ndarray:
        """Rows start, length, smallest period of the runs so far, by start and period. Call it at the end."""
        self._close(0)
        if not self.found:
            return np.zeros((3, 0), np.int64)
        start, end, period = np.concatenate(self.found, axis=1)
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        # a run is also caught at multiples of its period, over the very same words
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        start, end, period = start[new], end[new], period[new]
        order = np.lexsort((period, start))
        return np.stack([start, end - start, period])[:, order]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (no nulls) in one array, and how many come before each text."""
    raw, offsets = utf8(texts)
    own, edges = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    inside = ~_PARTING[own]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = edges[(edges > 0) & (edges < len(own))]  # a word never goes on in the next text
    begins[cut], ends[cut - 1] = inside[cut], inside[cut - 1]
    begins = np.flatnonzero(begins)
    size = np.flatnonzero(ends) + 1 - begins
    places = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(places), pa.py_buffer(own[inside])])
    return words, np.searchsorted(begins, edges)


def runs_of_texts(words: np.ndarray, first: np.ndarray, min_exponent: float, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, (start, length, period)) of all runs inside texts; words are numbers from 0, text t has first[t]:first[t+1]."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")  # long texts first: high levels end with them
    begin = np.concatenate([[0], np.cumsum(count[order] + 1)])
    line = np.empty(begin[-1], np.int64)
    line[begin[1:] - 1] = (int(words.max()) + 1 if len(words) else 0) + np.arange(len(order))  # each border is a word of its own
    inside = np.ones(len(line), bool)
    inside[begin[1:] - 1] = False
    line[inside] = words[np.repeat(first[:-1][order] - begin[:-1] + np.arange(len(order)), count[order]) + np.arange(len(words))]
    catcher = SquareCatcher(min_exponent, min_length)
    for at in range(0, len(line), APPEND_WORDS):
        longest = count[order[np.searchsorted(begin, at, side="right") - 1]]
        catcher.append(line[at : at + APPEND_WORDS], int(longest / min_exponent))
    runs = catcher.runs()
    place = np.searchsorted(begin, runs[0], side="right") - 1
    runs[0] -= begin[place]
    text = order[place]
    by_text = np.argsort(text, kind="stable")
    return text[by_text], runs[:, by_text]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        before = total[at] - sizes[at]
        stop = max(at + 1, int(np.searchsorted(total, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def _collapsed(batch: pa.RecordBatch, min_exponent: float, min_length: int, keep_periods: int) -> list[pa.Array]:
    words, first = split_words(pc.fill_null(batch.column(1), ""))
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text, (start, length, period) = runs_of_texts(numbers, first, min_exponent, min_length)
    change = np.zeros(len(numbers) + 1, np.int64)
    from_word, to_word = first[text] + start + keep_periods * period, first[text] + start + length
    some = from_word < to_word
    np.add.at(change, from_word[some], 1)
    np.add.at(change, to_word[some], -1)
    kept = np.cumsum(change[:-1]) == 0
    kept_before = np.concatenate([[0], np.cumsum(kept)])[first].astype(np.int32)
    left = pa.ListArray.from_arrays(pa.array(kept_before), words.filter(pa.array(kept)))
    fields = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], names=["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)), fields)
    return [batch.column(0), pa.array(np.diff(first).astype(np.int64)), runs, pc.binary_join(left, " ")]


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", min_exponent: float = 4, min_length: int = 6, keep_periods: int = 1
) -> DataFrame:
    """One row per row of df: id, n_words, runs (array of start, length, period by start and period) and collapsed,
    the words joined by one space without those that a run holds after its first `keep_periods` periods.

    A run is a stretch of words with smallest period p, at least max(min_length, min_exponent * p) words long, that no
    neighbouring word extends. A null text has no words, an empty list and an empty collapsed text, as an empty one has.
    Ids may be null or repeated: every row is worked on by itself, and no other column of df is read. A long text is held
    whole by one task, with a few numbers per word."""
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = df.select(id_col).schema.add("n_words", "long").add("runs", T.ArrayType(run)).add("collapsed", "string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield pa.RecordBatch.from_arrays(_collapsed(part, min_exponent, min_length, keep_periods), names=schema.fieldNames())

    return df.select(F.col(id_col), F.col(text).cast("string")).mapInArrow(work, schema)
