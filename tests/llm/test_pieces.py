import random

import numpy as np
import pytest

from cohortflow.llm import pieces as P
from cohortflow.llm.queries import QUERIES, TOKENIZERS
from tests.llm.conftest import odd_documents


@pytest.fixture(scope="module")
def vocabulary():
    return P.read_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")


def best_score(v, text):
    """Every segmentation, by dynamic programming over all substrings."""
    low = min(s for _, s in v.pieces.values()) - P.UNKNOWN_PENALTY
    best = [0.0] + [-np.inf] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            got = v.pieces.get(text[i:j])
            s = got[1] if got else (low if j - i == 1 else -np.inf)
            best[j] = max(best[j], best[i] + s)
    return best[-1]


def score(v, ids):
    by_id = {i: s for i, s in v.pieces.values()}
    return sum(by_id[i] for i in ids)


def test_best_segmentation(vocabulary, spark, sf_dir):
    coder = P.Segmenter(vocabulary)
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    words = sorted({w for t in texts for w in t.split()})
    random.Random(1).shuffle(words)
    words = [w for w in words if all(c in vocabulary.pieces for c in w)][:300] + ["a  b", "  x", "y   "]
    for w, ids in zip(words, coder.encode(words), strict=True):
        marked = P.MARK + w.replace(" ", P.MARK)
        assert score(vocabulary, ids.tolist()) == best_score(vocabulary, marked)
    # cutting a text at its words, many words at once, and one automaton pass over all of it agree
    whole = P.Segmenter(vocabulary)
    whole.cuts = False
    assert [a.tolist() for a in coder.encode(texts)] == [a.tolist() for a in whole.encode(texts)]


def test_ties_take_the_longest_last_piece():
    v = P.Vocabulary({"▁": (1, -1.0), "a": (2, -1.0), "b": (3, -1.0), "ab": (4, -2.0), "▁a": (5, -2.0)}, ["", "▁", "a", "b", "ab", "▁a"], (), {}, 0)
    coder = P.Segmenter(v)
    assert coder.encode(["ab"])[0].tolist() == [1, 4]
    assert coder.encode(["az"])[0].tolist() == [5, 0]
    assert coder.decode(np.array([5, 0])) == ("a" + P.UNKNOWN_SURFACE).encode()


def test_round_trip(vocabulary):
    coder = P.Segmenter(vocabulary)
    texts = [t or "" for _, t, _ in odd_documents()] + ["\0", " ", "   ", "\n\n a\tb", "🙂🙂", "x" * 1000, "e\u0301"]
    for t, ids in zip(texts, coder.encode(texts), strict=True):
        assert coder.decode(ids) == t.encode()


def test_query(spark, sf_dir):
    rows = QUERIES["op2_sentencepiece"](spark, sf_dir).collect()
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in rows)


def test_same_ids_as_the_library(vocabulary):
    """Short words, where its single-precision sums are exact and no user rule applies."""
    sentencepiece = pytest.importorskip("sentencepiece")
    bpe = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    coder = P.Segmenter(vocabulary)
    for w in ["hello", "größer", "naïve"]:
        assert bpe.decode(coder.encode([w])[0].tolist()) == w
