from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import transcripts as T
from cohortflow.llm.queries import QUERIES


def random_model(seed):
    rng = np.random.default_rng(seed)
    return T.Model(np.log(rng.dirichlet(np.ones(T.K))), np.log(rng.dirichlet(np.ones(T.K), T.K)), np.log(rng.dirichlet(np.ones(T.K), T.N_SYMBOLS)))


def test_paths_and_matrices_are_exact():
    for seed in range(10):
        model, symbols = random_model(seed), np.random.default_rng(seed).integers(0, T.N_SYMBOLS, 6)

        def value(p, model=model, symbols=symbols):
            moves = sum(model.move[a, b] for a, b in zip(p, p[1:], strict=False))
            return model.start[p[0]] + moves + sum(model.emit[s, k] for s, k in zip(symbols, p, strict=True))

        best = max(value(p) for p in product(range(T.K), repeat=6))
        assert value(T.chain_path(symbols, model, -1, -1)) == pytest.approx(best)
        assert T.chain_matrix(symbols, model)[T.K].max() == pytest.approx(best)


def test_markers(spark):
    lines = ["User: hi", "### Human: hi", "<assistant> x", "[system] y", "A: b", "- dash", "plain text", "User name is", "Q: what?"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = [tuple(r)[1:] for r in df.select("i", T.marker_class(F.col("line")), T.content(F.col("line"))).orderBy("i").collect()]
    names = [*T.MARKERS, "none", "dash"]
    assert [names[m] for m, _ in got] == ["user", "user", "assistant", "system", "first", "dash", "none", "none", "user"]
    assert [c for _, c in got] == ["hi", "hi", "x", "y", "b", "dash", "plain text", "User name is", "what?"]


def one_task(rows, model):
    """Viterbi over a whole conversation at once."""
    return dict(zip([(r["turn"], r["line_no"], r["line"]) for r in rows], T.chain_path(np.array([r["symbol"] for r in rows]), model, -1, -1), strict=True))


@pytest.mark.parametrize("pieces", [2, 64])
def test_conversations_over_many_pieces(spark, pieces, monkeypatch):
    """One conversation holds most lines and lies in many pieces."""
    monkeypatch.setattr(T, "PIECES", pieces)
    rng = np.random.default_rng(3)
    words = ["User: hello there?", "ok then", "Answer: yes " * 9, "B: fine", "what?", "a" * 200]
    rows = [(1, i, 0, words[rng.integers(len(words))]) for i in range(500)] + [(c, i, 0, words[(c + i) % 6]) for c in range(2, 8) for i in range(5)]
    lines = spark.createDataFrame(rows, "conv_id long, turn long, line_no long, line string")
    model = random_model(1)
    got = T.recover(lines, model).collect()
    assert len(got) == len(rows)
    seen = lines.withColumn("marker", T.marker_class(F.col("line"))).withColumn("symbol", T.symbol(F.col("marker"), F.col("line")))
    for conv in range(1, 8):
        ordered = seen.where(F.col("conv_id") == conv).orderBy("turn", "line_no", "line").collect()
        want = T.chain_path(np.array([r["symbol"] for r in ordered]), model, -1, -1)
        mine = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: (r["turn"], r["line_no"]))
        assert [T.ROLES.index(r["role"]) for r in mine] == want
        begins = [m["marker"] != T.NONE or i == 0 or want[i] != want[i - 1] for i, m in enumerate(ordered)]
        assert [r["begins"] for r in mine] == begins
        text = "".join(r["rendered"] for r in mine)
        assert text.count("<|end|>") == sum(begins)
        for r, following in zip(mine, [*begins[1:], True], strict=True):
            assert r["rendered"].endswith("<|end|>\n") == following


def test_recovered_roles(spark):
    folder = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    true = {(r["conv_id"], r["turn"]): r["role"] for r in turns.collect()}
    held = {r[0] for r in turns.where(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 5 == 0).select("conv_id").collect()}
    rows = [r for r in QUERIES["op10_chat_format"](spark, folder).collect() if r["conv_id"] in held]
    right = sum(r["role"] == true[r["conv_id"], r["turn"]] for r in rows)
    assert len(rows) > 100 and right >= 0.8 * len(rows)  # a quarter of the turns has no marker
    marked = [r for r in rows if r["line_no"] == 0 and r["begins"]]
    assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") for r in marked)


HYPHENS = [
    "user-friendly design is key", "A - first option", "A-priori", "AI-based", "Q-learning", "system-wide", "model-based", "context-free", "a > b", "B] c",
    "- one", "-- two", "me", "A", "user", "Answer", "** bold **", "#hash", "<b>x</b>", "model : fit", "  indented", "", "é: x", "User name: x",
]


def test_words_with_hyphens_are_no_markers(spark):
    df = spark.createDataFrame([(x,) for x in HYPHENS], "line string")
    got = {r[0]: r[1] for r in df.select("line", T.marker_class(F.col("line"))).collect()}
    assert {x for x in HYPHENS if got[x] < T.NONE} == {"model : fit"}
    more = ["**User**: x", "**User:** x", "### Assistant", "[Bot] y", "<human>: z", "Question : q"]
    assert [T.marker_class(F.col("line")) is not None and r[0] for r in spark.createDataFrame([(x,) for x in more], "line string").select(T.marker_class(F.col("line"))).collect()] == [0, 0, 1, 1, 0, 0]


def test_prefix_and_content_are_the_line(spark):
    """Nothing of any text is lost, and only lines that begin a turn lose a prefix to `prefix`."""
    texts = [*HYPHENS, "User: hi", "### AI: yes", "[system] x", "  **A:** y", "- dash", "Q:", "<user>", None]
    rows = [(c, t, k, texts[(c * 7 + t * 3 + k) % len(texts)]) for c in range(6) for t in range(8) for k in range(4)]
    lines = spark.createDataFrame(rows, "conv_id long, turn long, line_no long, line string")
    lines = lines.withColumn("line", F.coalesce("line", F.lit("")))
    got = T.recover(lines, random_model(5)).collect()
    want = {(r.conv_id, r.turn, r.line_no): r.line for r in lines.collect()}
    assert {(r.conv_id, r.turn, r.line_no): r.prefix + r.content for r in got} == want
    assert all(r.begins or not r.prefix for r in got)
    assert all(r.content in r.rendered for r in got)


@pytest.mark.parametrize("unknown", [None, "tool"])
def test_training_does_not_depend_on_pieces(spark, monkeypatch, unknown):
    roles = ["system", "user", "assistant", "user", unknown, "assistant"]
    rows = [(c, t, 0, f"line {t} of {c}", roles[(c + t) % 6]) for c in range(9) for t in range(c + 3)]
    lines = spark.createDataFrame(rows, "conv_id long, turn long, line_no long, line string, role string")
    models = []
    for pieces in (1, 7, 64):
        monkeypatch.setattr(T, "PIECES", pieces)
        models.append(T.train(lines))
    for m in models[1:]:
        assert all(np.array_equal(a, b) for a, b in zip(models[0], m, strict=True))
    starts = np.full(3, T.SMOOTHING)
    moves = np.full((3, 3), T.SMOOTHING)
    for c in range(9):
        own = [roles[(c + t) % 6] for t in range(c + 3)]
        known = [T.ROLES.index(r) if r in T.ROLES else None for r in own]
        if known[0] is not None:
            starts[known[0]] += 1
        for a, b in zip(known, known[1:], strict=False):
            if a is not None and b is not None:
                moves[a, b] += 1
    assert models[0].start == pytest.approx(np.log(starts / starts.sum())) and models[0].move == pytest.approx(np.log(moves / moves.sum(1, keepdims=True)))
