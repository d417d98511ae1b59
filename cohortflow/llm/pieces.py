"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one Viterbi pass.

The automaton reads a segment once; at every position its output links name all pieces that
end there, longest first, and each relaxes the best score of that position. If no piece
reaches over a word mark that follows another character, a text may be cut before every such
mark without changing the result, so words repeated in a task are looked up. Characters that no
piece covers become the byte pieces (or the unknown piece of a vocabulary without them).

Vocabulary files are read on the driver only; tasks get the pieces with the closure (a
vocabulary has a fixed size of some hundred kilobytes, whatever the input).

Defined results: a null or empty text has no pieces and decodes to the empty string. Among equally
good segmentations the one whose last piece is longest wins, at every position. A word mark
(U+2581) in the text itself decodes to a space, and an unknown piece to U+2047 between spaces:
`round_trip` says whether the text came back. Repeated rows are encoded each; other columns
than the id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # fixed value: the mark that stands for a space
UNKNOWN_PENALTY = 10.0  # fixed value of the format: below the lowest score
UNKNOWN_SURFACE = " ⁇ "  # fixed value of the format
MEMO = 1 << 18  # words a task remembers
CHARS_AT_ONCE = 1 << 21
WORDS_AT_ONCE = 1 << 14  # new words that are segmented together
SHORT = 256  # characters of a word that is segmented together with others
GAP = "\0"


class Vocabulary(NamedTuple):
    pieces: dict[str, tuple[int, float]]  # ordinary pieces: id, score
    surface: list[str]  # text of each id, empty for control pieces
    byte_ids: tuple[int, ...]  # of bytes 0 to 255, or empty
    byte_of: dict[int, int]
    unknown: int


def read_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, surface, byte_of = {}, [], {}
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_of[i] = int(text[3:5], 16)
            surface.append("")
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            surface.append("")
        else:
            pieces[text] = (i, model.get_score(i))
            surface.append(text)
    by_byte = {b: i for i, b in byte_of.items()}
    byte_ids = tuple(by_byte[b] for b in range(256)) if len(by_byte) == 256 else ()
    return Vocabulary(pieces, surface, byte_ids, byte_of, model.unk_id())


class Segmenter:
    """Best segmentation by a vocabulary's scores."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        scores = [s for _, s in vocabulary.pieces.values()]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        # no piece reaches over a mark that follows another character: texts may be cut there
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p in vocabulary.pieces)
        self.automaton = ahocorasick.Automaton()
        for p, (i, s) in vocabulary.pieces.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.size = np.zeros(len(vocabulary.surface), np.int64)
        self.score = np.zeros(len(vocabulary.surface))
        for p, (i, s) in vocabulary.pieces.items():
            self.size[i], self.score[i] = len(p), s
        self.sizes, self.scores = self.size.tolist(), self.score.tolist()
        # what decoding writes for an id, as bytes
        written = [s.replace(MARK, " ").encode("utf-8") for s in vocabulary.surface]
        for i, b in vocabulary.byte_of.items():
            written[i] = bytes([b])
        if vocabulary.unknown >= 0:
            written[vocabulary.unknown] = UNKNOWN_SURFACE.encode("utf-8")
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.written_size = np.array([len(w) for w in written], np.int64)
        self.written_at = np.cumsum(self.written_size) - self.written_size
        self.memo: dict[str, bytes] = {}

    def segment(self, text: str) -> list[int]:
        """Viterbi over a marked text: the automaton's outputs at a position relax its best score."""
        n = len(text)
        best = [-np.inf] * (n + 1)
        best[0] = 0.0
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0  # positions up to here have their best score
        lowest = self.unknown_score
        for end, piece in self.automaton.iter(text):
            stop, size = end + 1, self.sizes[piece]
            while done < stop - 1:  # earlier positions are final: let unknown characters reach the next one
                done += 1
                if best[done] == -np.inf:
                    best[done], back[done] = best[done - 1] + lowest, (done - 1, -1)
            value = best[stop - size] + self.scores[piece]
            if value > best[stop]:
                best[stop], back[stop] = value, (stop - size, piece)
        while done < n:
            done += 1
            if best[done] == -np.inf:
                best[done], back[done] = best[done - 1] + lowest, (done - 1, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            elif self.v.byte_ids:
                ids += [self.v.byte_ids[b] for b in reversed(text[start:at].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(self.v.unknown)
            at = start
        return ids[::-1]

    def segment_many(self, words: list[str]) -> list[bytes]:
        """The same for many short words at once: the automaton reads them in one go, and each step
        relaxes one position of all words."""
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1  # a character that no piece has stands between words
        flat = np.fromiter(chain.from_iterable(self.automaton.iter(GAP.join(words))), np.int64)
        stops, pieces = flat[::2] + 1, flat[1::2]
        total = int(starts[-1] + lengths[-1]) + 1
        word_start = np.repeat(starts, lengths + 1)
        level = stops - word_start[stops - 1]
        order = np.argsort(level, kind="stable")  # by end inside a level, longest piece first inside an end
        stops, pieces = stops[order], pieces[order]
        cuts = np.searchsorted(level[order], np.arange(int(lengths.max()) + 2))
        best = np.full(total, -np.inf)
        best[starts] = 0.0
        back = np.full(total, -1, np.int64)
        by_length = np.argsort(-lengths, kind="stable")
        at_least = np.searchsorted(-lengths[by_length], -np.arange(int(lengths.max()) + 1), side="right")
        for j in range(1, int(lengths.max()) + 1):
            at = starts[by_length[: at_least[j]]] + j
            best[at] = best[at - 1] + self.unknown_score
            stop, piece = stops[cuts[j] : cuts[j + 1]], pieces[cuts[j] : cuts[j + 1]]
            if not len(stop):
                continue
            value = best[stop - self.size[piece]] + self.score[piece]
            first = np.flatnonzero(np.concatenate(([True], stop[1:] != stop[:-1])))
            top = np.maximum.reduceat(value, first)
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(stop))))
            wins = np.flatnonzero(value == top[group])[::-1]  # the first of equal values is written last
            best[stop[wins]], back[stop[wins]] = value[wins], piece[wins]
        chosen = np.zeros(total, bool)
        missing = np.zeros(len(words), bool)
        at, word = starts + lengths, np.arange(len(words))
        while len(at):
            piece = back[at]
            missing[word[piece < 0]] = True
            chosen[at] = True
            at = at - np.where(piece < 0, 1, self.size[piece])
            more = at > starts[word]
            at, word = at[more], word[more]
        ends = np.flatnonzero(chosen)
        ids = back[ends].astype("<i4")
        edge = np.searchsorted(ends, starts, side="right").tolist() + [len(ends)]
        raw = ids.tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip(edge, edge[1:], strict=False)]
        for i in np.flatnonzero(missing).tolist():
            out[i] = np.array(self.segment(words[i]), "<i4").tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts."""
        if not self.cuts:
            return [np.array(self.segment(MARK + t.replace(" ", MARK) if t else ""), "<i4") for t in texts]
        cut = [_words(t or "") for t in texts]
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        new = list(set().union(*cut) - memo.keys())
        short = [w for w in new if len(w) < SHORT]
        for at in range(0, len(short), WORDS_AT_ONCE):
            some = short[at : at + WORDS_AT_ONCE]
            memo.update(zip(some, self.segment_many([_marked(w) for w in some]), strict=True))
        memo.update((w, np.array(self.segment(_marked(w)), "<i4").tobytes()) for w in new if len(w) >= SHORT)
        return [np.frombuffer(b"".join(map(memo.__getitem__, words)), "<i4") for words in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of a text: the surfaces in order, without the leading mark. Byte pieces may form any bytes."""
        size = self.written_size[ids]
        done = np.cumsum(size)
        at = np.repeat(self.written_at[ids] - done + size, size) + np.arange(int(done[-1]) if len(done) else 0)
        text = self.written[at].tobytes()
        return text[1:] if text[:1] == b" " else text


def _words(text: str) -> list[str]:
    """A text cut before every mark that follows another character. A word after a single space is
    given bare; a word after several is given with its marks."""
    if not text:
        return []
    if text[0] == " " or "  " in text or MARK in text:
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", MARK + text.replace(" ", MARK))
    return text.split(" ")


def _marked(word: str) -> str:
    return word if word[:1] == MARK else MARK + word


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ids (array), n_pieces and round_trip: whether decoding the ids gives the text again."""
    segmenters: list[Segmenter] = []

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not segmenters:
            segmenters.append(Segmenter(vocabulary))
        coder = segmenters[0]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):  # a batch of long texts goes out in pieces
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars < CHARS_AT_ONCE):
                    chars += len(texts[stop] or "")
                    stop += 1
                coded = coder.encode(texts[at:stop])
                counts = np.array([len(c) for c in coded], np.int64)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                same = [coder.decode(c) == (t or "").encode() for c, t in zip(coded, texts[at:stop], strict=True)]
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*coded, np.zeros(0, "<i4")])))
                columns = [batch.column(0).slice(at, stop - at), ids, pa.array(counts), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "n_pieces", "round_trip"])
                at = stop

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    coded = narrow.mapInArrow(each, "id long, ids array<int>, n_pieces long, round_trip boolean")
    return coded.withColumnRenamed("id", id_column)
