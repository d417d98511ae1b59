import base64

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from cohortflow.llm import token_scan as S
from cohortflow.llm.queries import BYTE_BPE_PATTERN, QUERIES, TOKENIZERS

FORM = S.TokenFormat(separator=50256)


@pytest.fixture(scope="module")
def coder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb"))}
    return ranks, tiktoken.Encoding("t", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_are_the_tokenizers(spark, sf_dir, coder):
    want = {r[0]: len(coder[1].encode_ordinary(r[1])) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op1_token_counts"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("whole", [1 << 30, 16])
def test_small_blocks_and_large_files(spark, odd_dir, coder, whole):
    """Documents over many blocks, runs of few blocks, and files read as records."""
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    got = S.token_counts(docs, coder[0], BYTE_BPE_PATTERN, FORM, block_tokens=8, blocks_per_run=3, whole_file_bytes=whole).collect()
    want = sorted((r[0] is None, r[0], len(coder[1].encode_ordinary(r[1] or ""))) for r in docs.select("doc_id", "text").collect())
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"]) for r in got) == want
    by_shard = {}
    for r in sorted(got, key=lambda r: (r["shard"], r["doc_no"])):
        assert r["first_token"] == by_shard.get(r["shard"], 0)
        by_shard[r["shard"]] = r["first_token"] + r["n_tokens"] + 1


def test_any_flat_file(spark, tmp_path):
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 5, 1009).astype("<u4")
    tokens[400:700] = 1  # a document over many blocks
    tokens.tofile(tmp_path / "a.bin")
    np.array([7, 0, 0, 9], "<u4").tofile(tmp_path / "b.bin")
    np.zeros(0, "<u4").tofile(tmp_path / "c.bin")
    form = S.TokenFormat(separator=0, width=4)
    for whole in (1 << 20, 4):
        got = S.stitch(S.scan_blocks(spark, str(tmp_path), form, 16, whole), 4).collect()
        a = sorted((r["doc_no"], r["first_token"], r["n_tokens"], r["closed"]) for r in got if r["file"].endswith("a.bin"))
        want, start = [], 0
        for at in np.flatnonzero(tokens == 0).tolist():
            want.append((len(want), start, at - start, True))
            start = at + 1
        if start < len(tokens):
            want.append((len(want), start, len(tokens) - start, False))
        assert a == want
        b = sorted((r["doc_no"], r["n_tokens"], r["closed"]) for r in got if r["file"].endswith("b.bin"))
        assert b == [(0, 1, True), (1, 0, True), (2, 1, False)]


def test_broken_file_is_refused(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple"):
        S.scan_blocks(spark, str(tmp_path), FORM).agg(F.count("*")).collect()
