import numpy as np
import pytest

from cohortflow.llm import decontaminate as D
from cohortflow.llm.queries import QUERIES
from cohortflow.llm.words import words_of

FOLDER = "/root/testdata/sf0.01"


def lcs(a, b):
    row = np.zeros(len(b) + 1, int)
    for x in a:
        new = row.copy()
        for j, y in enumerate(b):
            new[j + 1] = row[j] + 1 if x == y else max(row[j + 1], new[j])
        row = new
    return int(row[-1])


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = rng.integers(0, 5, rng.integers(0, 12)).tolist(), rng.integers(0, 5, rng.integers(0, 12)).tolist()
        assert D.common_subsequence(a, b) == lcs(a, b)


def test_recall_against_brute_force(spark):
    """Every window of every document against every passage, without the latent search."""
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    passages = D.split_items(items)
    want = set()
    for doc, text in docs:
        words = words_of(text).tolist()
        held = set(words)
        for p in passages:
            if sum(w in held for w in p.words.tolist()) < D.COPIED * len(p.words):
                continue
            n = len(p.words)
            for a in range(0, len(words), D.STEP):
                region = words[max(0, a - n) : a + D.STEP * D.WINDOW + n]
                if D.common_subsequence(p.words.tolist(), region) >= D.COPIED * n:
                    want.add((doc, p.item))
                    break
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_decontamination"](spark, FOLDER).collect()}
    assert len(want) > 20
    assert len(got & want) >= 0.9 * len(want)
    assert got >= want or len(want - got) <= 0.1 * len(want)


def test_paraphrase_and_answer(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    text = max((r["text"] for r in bench.collect()), key=lambda t: len(t.split()) if len(t.split()) <= 40 else 0)
    words = text.split()
    edited = [w if i % 3 else "zzz" for i, w in enumerate(words)]  # two words in three stay, in order
    lost = [w for i, w in enumerate(edited) if i < len(words) // 2]  # no answer
    extra = spark.createDataFrame([(-1, " ".join(edited)), (-2, " ".join(lost)), (-3, "qqq " * 50)], "doc_id long, text string")
    got = {r["doc_id"] for r in D.leaked(docs.unionByName(extra), bench).collect()}
    assert -2 not in got and -3 not in got
    assert -1 in got


def test_words_without_case():
    assert words_of("ÉTÉ Größe, THE ×").tolist() == words_of("été größe%%% the ×").tolist()
    assert len(words_of("a é. b")) == 3 and len(words_of("")) == 0


def test_low_rank_basis(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(3, 12))
    rows = rng.normal(size=(40, 3)) @ base
    df = spark.createDataFrame([(list(range(12)), r.tolist()) for r in rows], "at array<int>, value array<double>")
    basis = D.latent_basis(df, 12, rank=3)
    assert np.allclose(rows @ basis @ basis.T, rows, atol=1e-8)
    assert np.allclose(basis.T @ basis, np.eye(3), atol=1e-9)


def test_stage_keeps_the_rest(spark, sf_dir):
    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = {r["doc_id"] for r in D.leaked(docs, bench).collect()}
    kept = {r["doc_id"] for r in D.without_leaks(docs, bench).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - gone


@pytest.mark.parametrize("size", [1, 1000])
def test_blocks_of_the_benchmark(spark, odd_dir, size):
    docs, bench = spark.read.parquet(f"{odd_dir}/documents.parquet"), spark.read.parquet(f"{odd_dir}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaked(docs, bench, block_passages=size).collect()}
    assert {(4, 4), (9, 4)} <= got


def made_up(rng, n, size=6000):
    """Words with a skew like that of language."""
    return [f"w{k}" for k in np.minimum(rng.zipf(1.15, n), size).tolist()]


def test_passage_in_a_third_of_the_documents(spark):
    rng = np.random.default_rng(3)
    hot = " ".join(f"hot{k}" for k in range(24))
    docs = []
    for i in range(120):
        words = [f"x{k}" for k in rng.integers(0, 20000, 150)]
        docs.append((i, " ".join([*words[:70], *([hot] if i % 3 == 0 else []), *words[70:]])))
    items = [(0, hot)] + [(i, " ".join(f"x{k}" for k in rng.integers(0, 20000, 30))) for i in range(1, 60)]
    got = D.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, 0) for i in range(0, 120, 3)}
    assert all(r["common"] == 1 and r["cosine"] > 0 for r in got)


@pytest.mark.parametrize("size", [1000, 2048])
def test_recall_of_copies_in_large_blocks(spark, size):
    rng = np.random.default_rng(size)
    items = [(i, " ".join(made_up(rng, (8, 12, 25, 40)[i % 4]))) for i in range(size)]
    docs = []
    for i, text in items[: size // 2]:
        words = made_up(rng, 120)
        cut = int(rng.integers(0, 120))
        docs.append((i, " ".join([*words[:cut], text, *words[cut:]])))
    docs += [(i, " ".join(made_up(rng, 160))) for i in range(10_000, 10_500)]
    found = D.leaked(spark.createDataFrame(docs, "doc_id long, text string").repartition(8), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.where("common = 1").collect()}
    assert sum((i, i) in got for i in range(size // 2)) == size // 2


def test_exact_search_finds_all_of_brute_force(spark):
    """Without any latent candidate, on the given tables."""
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(150).collect()]
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    passages = D.split_items([tuple(r) for r in items.select("item_id", "text").collect()])
    want = set()
    for doc, text in docs:
        words = words_of(text).tolist()
        for p in passages:
            n, wanted = len(p.words), p.words.tolist()
            for a in range(0, len(words), D.STEP):
                region = words[max(0, a - n) : a + D.STEP * D.WINDOW + n]
                held = set(region)
                if sum(w in held for w in wanted) >= D.COPIED * n and D.common_subsequence(wanted, region) / n >= D.COPIED:
                    want.add((doc, p.item))
                    break
    found = D.leaked(spark.createDataFrame(docs, "doc_id long, text string"), items, min_cosine=2.0).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found if r["common"] >= D.COPIED}
    assert got == want and len(want) >= 5


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "北京是中华人民共和国的首都也是全国的政治文化中心"
    items = [(1, "Who wrote Hamlet?"), (2, chinese), (3, "東京タワーの高さは?"), (4, "zebra"), (5, " ?! "), (6, "กรุงเทพ")]
    docs = [
        (10, "they ask who wrote, Hamlet and more"), (11, "who wrote the play Hamlet"), (12, "前言。" + chinese + "。后记"), (13, "それでは「東京タワーの高さは」何メートル"),
        (14, "wrote Hamlet"), (15, "a zebra"), (16, "zebras"), (17, "who wrote"), (18, "Hamlet"), (19, "นครกรุงเทพมหา"), (20, "北京的天气很好今天是中秋"),
    ]
    got = D.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(10, 1), (12, 2), (13, 3), (15, 4), (19, 6)}
    kept = D.without_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {11, 14, 16, 17, 18, 20}


def test_characters_as_words():
    assert len(words_of("ab中文cd é", characters=True)) == 5 and len(words_of("ab中文cd é")) == 2
    assert words_of("中文,字", characters=True).tolist() == words_of("中 文 字", characters=True).tolist()
    assert words_of("naïve “quoted” größe", characters=True).tolist() == words_of("naïve “quoted” größe").tolist()


def test_many_subsequences_at_once():
    draw = np.random.default_rng(3)
    passages = [D.Passage(0, draw.integers(0, 9, n).astype(np.uint64)) for n in (8, 17, 40, 40, 9)]
    vocabulary = np.unique(np.concatenate([p.words for p in passages]))
    bits = D.passage_bits(passages, [frozenset(p.words[:3].tolist()) for p in passages], vocabulary)
    owner, masks, want = [], [], []
    for i, p in enumerate(passages):
        held = dict(zip(vocabulary[bits.place[bits.first[i] : bits.first[i + 1]]].tolist(), bits.bits[bits.first[i] : bits.first[i + 1]].tolist(), strict=True))
        region = draw.integers(0, 14, 60).tolist() if i != 4 else []
        some = [held[x] for x in region if x in held]
        owner += [i] * len(some)
        masks += some
        want.append(D.common_subsequence(p.words.tolist(), region))
        assert int(bits.answer[i]).bit_count() == bits.answers[i] == len(set(p.words[:3].tolist()))
    sizes = np.array([len(p.words) for p in passages])
    assert D.common_subsequences(sizes, np.array(owner), np.array(masks, np.uint64)).tolist() == want


def test_latent_rows_are_all_passages(spark):
    """Of every document, one without an id too, each word that weighs stands in one row, however many documents there are."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 60, n)) for n in (0, 1, 39, 40, 41, 400, 3000)] * 3
    docs = spark.createDataFrame([(None if i == 4 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    vocabulary = np.unique(words_of(" ".join(f"w{k}" for k in range(0, 60, 2))))
    idf = np.where(np.arange(len(vocabulary)) % 7, np.linspace(0.5, 2.0, len(vocabulary)), 0.0)
    want, seen, passages = np.zeros((len(vocabulary),) * 2), np.zeros(len(vocabulary)), 0
    for t in texts:
        words = words_of(t)
        seen[np.flatnonzero(np.isin(vocabulary, words))] += 1
        for a in range(0, len(words), D.PASSAGE):
            n = (words[a : a + D.PASSAGE, None] == vocabulary).sum(0)
            passages += bool(n.any())
            row = n * idf / max(1e-300, np.linalg.norm(n * idf))
            want += np.outer(row, row)
    known = D.known_words(docs, vocabulary, "doc_id", "text")
    df, total, held = D.document_frequency(known, len(vocabulary))
    assert df.tolist() == seen.tolist() and (total, held) == (len(texts), passages)
    own = D.Passage(0, words_of("w0 w2 w2 w4"))
    rows = D.weighted_rows(known, [own], vocabulary, held)
    row = (own.words[:, None] == vocabulary).sum(0) * idf
    want += D.BENCHMARK_WEIGHT * passages * np.outer(row, row) / (row @ row)
    cells = D.packed_cells(idf)
    assert np.allclose(D.multiplied(rows, np.eye(len(vocabulary)), cells), want, rtol=1e-5, atol=1e-4)
    assert np.allclose(D.inner_products(rows, np.eye(len(vocabulary)), cells), want, rtol=1e-5, atol=1e-4)


def test_product_of_packed_rows(spark, monkeypatch):
    """Rows of any length, empty ones among them, in portions smaller than a batch, give the dense product."""
    rng = np.random.default_rng(12)
    dense = rng.normal(size=(70, 30)) * (rng.random((70, 30)) < rng.random((70, 1)) ** 2)
    rows = [(np.flatnonzero(r).tolist(), r[r != 0].tolist()) for r in dense]
    block = rng.normal(size=(30, 7))
    monkeypatch.setattr(D, "CELLS_AT_ONCE", 64)
    df = spark.createDataFrame(rows, "at array<int>, value array<double>")
    assert np.allclose(D.multiplied(df, block), dense.T @ (dense @ block), atol=1e-9)
    assert np.allclose(D.inner_products(df, block), (dense @ block).T @ (dense @ block), atol=1e-9)


def test_stage_learns_from_every_passage(spark, sf_dir, monkeypatch):
    """The pipeline's stage counts each passage of the documents that it is given, not a sample of them."""
    import corpus_pipeline

    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    vocabulary = np.unique(np.concatenate([p.words for p in D.split_items([tuple(r) for r in bench.select("item_id", "text").collect()])]))
    texts = [words_of(r["text"] or "", characters=True) for r in docs.collect()]
    want = sum(bool(np.isin(w[a : a + D.PASSAGE], vocabulary).any()) for w in texts for a in range(0, len(w), D.PASSAGE))
    held, seen = D.weighted_rows, []
    monkeypatch.setattr(D, "weighted_rows", lambda *a: seen.append(a[-1]) or held(*a))
    corpus_pipeline.drop_leaks(spark, docs, sf_dir).count()
    assert seen == [want] and want > docs.count()
