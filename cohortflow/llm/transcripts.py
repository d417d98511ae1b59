"""Transcript parsing: a hidden Markov model over marker and line features recovers the roles.

A transcript is a sequence of lines of a conversation. A line shows a speaker marker or none
("User:", "### Assistant", "<system>", "B:", "-"), and features of the line (length, question,
first line). The hidden state of a line is its role; markers may be missing or say nothing of the
role, which the transition from the line before then decides. Transitions, starts and
emissions are counted from lines with known roles.

Lines are sorted over the cluster by conversation and place, so one conversation may lie in
several partitions and no task needs all of it. Every piece of such a conversation is reduced to
its max-plus matrix (best score from any state before it to any state at its end); the few
matrices of a conversation are composed in order, which gives the exact Viterbi states at
the borders, and each piece is then decoded between them. Turns are rendered line by line,
as `<|role|>` before a turn's first line and `<|end|>` after its last, so the rendered
conversation is the lines in order. A marker is taken off only where a turn begins; what is
taken off is kept as `prefix`, so prefix and content are the line, whatever it says.

Defined results: a null text is an empty line, null turns come first, a null conversation id is one
conversation. Rows of the same turn are ordered by their text; equal rows follow each other. Without
training lines all states are equally likely. Very long lines are one line. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.tables import stored

ROLES = ("system", "user", "assistant")
K = len(ROLES)
# Speaker names by marker class. The letters and numbers of the last two say only who speaks.
MARKERS = {
    "user": ["user", "human", "question", "q", "customer", "me"],
    "assistant": ["assistant", "ai", "bot", "model", "answer"],
    "system": ["system", "instructions", "context"],
    "first": ["a", "speaker 1", "person 1"],
    "second": ["b", "speaker 2", "person 2"],
}
NONE, DASH = len(MARKERS), len(MARKERS) + 1
N_MARKERS = len(MARKERS) + 2
LENGTHS = (40, 120, 300, 800)
SMOOTHING = 0.5
PIECES = 64  # least number of sorted partitions
LINES_PER_PIECE = 200_000

_NAMES = "|".join(n for names in MARKERS.values() for n in names)
# a name and a colon, a name in brackets or stars, or a heading of nothing but a name: "A - b", "user-friendly", "a > b" and "<b>" are text
_STYLES = [r"(?:#{1,4}\s*)?(NAMES)\s*:", r"<(?![abq]>)(NAMES)>\s*:?", r"\[(NAMES)\]\s*:?", r"\*\*(NAMES)(?:\s*:\s*\*\*|\*\*\s*:?)", r"#{1,4}\s*(NAMES)\s*$"]
MARKER = r"(?i)^\s*(?:" + "|".join(s.replace("NAMES", _NAMES) for s in _STYLES) + r")\s*"
DASHED = r"^\s*-\s+"


class Model(NamedTuple):
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbol x state


def marker_class(line: Column) -> Column:
    name = F.lower(F.concat(*[F.regexp_extract(line, MARKER, i + 1) for i in range(len(_STYLES))]))
    out = F.when(F.regexp_like(line, F.lit(DASHED)), DASH).otherwise(NONE)
    for i, names in enumerate(MARKERS.values()):
        out = F.when(name.isin(names), i).otherwise(out)
    return out


def prefix(line: Column) -> Column:
    """The marker at the start of a line, or the dash."""
    return F.when(F.regexp_like(line, F.lit(MARKER)), F.regexp_extract(line, MARKER, 0)).otherwise(F.regexp_extract(line, DASHED, 0))


def content(line: Column) -> Column:
    """The line without its prefix."""
    return F.substring(line, F.length(prefix(line)) + 1, F.length(line))


def symbol(marker: Column, line: Column) -> Column:
    """One number for the marker, whether the line asks, and its length class."""
    size = F.lit(0)
    for i, edge in enumerate(LENGTHS):
        size = F.when(F.length(line) >= edge, i + 1).otherwise(size)
    asks = F.regexp_like(line, F.lit(r"\?\s*$")).cast("int")
    return ((marker * 2 + asks) * (len(LENGTHS) + 1) + size).cast("int")


N_SYMBOLS = N_MARKERS * 2 * (len(LENGTHS) + 1)


def as_transcript(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Raw transcript lines of recorded conversations, in one of five styles by conversation; in
    each style one turn in four goes without a marker. Columns conv_id, turn, line_no, line, role."""
    style = F.pmod(F.xxhash64(F.coalesce(F.col(conv).cast("string"), F.lit(""))), F.lit(5))
    bare = F.pmod(F.xxhash64(F.coalesce(F.col(conv).cast("string"), F.lit("")), F.coalesce(F.col(turn), F.lit(-1))), F.lit(4)) == 0
    r = F.coalesce(F.col(role), F.lit("user"))
    named = F.when(style == 0, F.concat(F.initcap(r), F.lit(": ")))
    named = named.when(style == 1, F.concat(F.lit("### "), F.when(r == "user", "Human").when(r == "assistant", "AI").otherwise("Instructions"), F.lit(": ")))
    named = named.when(style == 2, F.concat(F.lit("<"), r, F.lit("> ")))
    named = named.when(style == 3, F.when(r == "user", "A: ").when(r == "assistant", "B: ").otherwise("Context: "))
    named = named.otherwise(F.when(r == "user", "Q: ").when(r == "assistant", "Answer: ").otherwise("[system] "))
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), r.alias("role"),
        F.when(bare, "").otherwise(named).alias("marker"), F.posexplode(lines).alias("line_no", "line"),
    )
    marked = F.when(F.col("line_no") == 0, F.concat("marker", "line")).otherwise(F.col("line"))
    return rows.select("conv_id", "turn", F.col("line_no").cast("long").alias("line_no"), marked.alias("line"), "role")


def _sorted(lines: DataFrame, with_text: bool = True) -> DataFrame:
    """Lines with a piece number and their place `at` in it; pieces in order. Stored, as several passes read it.
    Without text only the lines' hashes are moved, which order equal places otherwise."""
    parts = max(PIECES, lines.count() // LINES_PER_PIECE)
    marker = marker_class(F.col("line"))
    # equal rows differ only by chance, so that a turn repeated without end is dealt out too
    seen = lines.withColumn("marker", marker).withColumn("symbol", symbol(F.col("marker"), F.col("line"))).withColumn("tie", F.monotonically_increasing_id())
    if not with_text:
        seen = seen.withColumn("line", F.xxhash64("line"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "line_no", "line", "tie")]
    dealt = seen.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
    # text for grouping: a null id is a conversation too
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    return stored(dealt.select("*", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("at"), conv.alias("conv")), "lines")


def train(lines: DataFrame) -> Model:
    """Counts of all given lines: starts, moves between neighbouring lines, symbols by role. A line of unknown role counts for
    nothing, and neither do the moves to and from it. The counts do not depend on how the lines are cut into pieces."""
    number = F.when(F.col("role") == ROLES[0], 0).when(F.col("role") == ROLES[1], 1).when(F.col("role") == ROLES[2], 2)
    seen = _sorted(lines, with_text=False).select("piece", "conv", "at", "symbol", number.alias("state"))
    inside = Window.partitionBy("piece", "conv").orderBy("at")
    placed = seen.withColumns({"place": F.row_number().over(inside), "before": F.lag("state").over(inside), "is_last": F.lead("at").over(inside).isNull()})
    placed = stored(placed, "moves")
    # the first line of a piece follows the last one of the conversation's piece before: a row per piece and conversation
    ends = placed.where("is_last").select("piece", "conv", F.col("state").alias("end"))
    along = Window.partitionBy("conv").orderBy("piece")
    edges = placed.where("place = 1").select("piece", "conv", "state").join(ends, ["piece", "conv"])
    edges = edges.select("state", F.lag("end").over(along).alias("before"), (F.row_number().over(along) == 1).alias("is_start"))
    moves = placed.where("place > 1").select("state", "before", F.lit(False).alias("is_start")).unionByName(edges)
    emit, move, start = np.full((N_SYMBOLS, K), SMOOTHING), np.full((K, K), SMOOTHING), np.full(K, SMOOTHING)
    for s, k, n in placed.where("state IS NOT NULL").groupBy("symbol", "state").count().collect():
        emit[s, k] += n
    for a, b, starts, n in moves.where("state IS NOT NULL").groupBy("before", "state", "is_start").count().collect():
        if starts:
            start[b] += n
        elif a is not None:
            move[a, b] += n
    return Model(np.log(start / start.sum()), np.log(move / move.sum(axis=1, keepdims=True)), np.log(emit / emit.sum(axis=0)))


def chain_matrix(symbols: np.ndarray, model: Model) -> np.ndarray:
    """Best score from the state before the first of these lines (row; the last row: the start) to the state of the last one."""
    best = np.vstack([model.move, model.start]) + model.emit[symbols[0]]
    for s in symbols[1:]:
        best = (best[:, :, None] + model.move).max(axis=1) + model.emit[s]
    return best


def chain_path(symbols: np.ndarray, model: Model, before: int, last: int) -> list[int]:
    """Best states of the lines, given the state before them (-1: the start) and the last one (-1: free)."""
    best = (model.start if before < 0 else model.move[before]) + model.emit[symbols[0]]
    back = []
    for s in symbols[1:]:
        step = best[:, None] + model.move
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + model.emit[s]
    path = [int(best.argmax()) if last < 0 else last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _borders(group: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one conversation in order: the best state before each and at its end, and whether the line after it begins a turn by its marker."""
    group = group.sort_values("piece").reset_index(drop=True)
    mats = [np.array(m).reshape(K + 1, K) for m in group["matrix"]]
    best, back = mats[0][K], []
    for m in mats[1:]:
        step = best[:, None] + m[:K]
        back.append(step.argmax(axis=0))
        best = step.max(axis=0)
    ends = [int(best.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends = ends[::-1]
    return pd.DataFrame({"conv": group["conv"], "piece": group["piece"], "before": [-1, *ends[:-1]], "last": ends})


def recover(lines: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, line_no, role, begins (a turn starts here), prefix, content and rendered, for every line."""
    conv_type = lines.schema["conv_id"].dataType.simpleString()
    placed = _sorted(lines.select("conv_id", "turn", "line_no", "line"))

    # a border between pieces parts one conversation at most, so these are fewer than the pieces
    several = placed.groupBy("conv").agg(F.min("piece").alias("a"), F.max("piece").alias("b")).where("a < b").select("conv")
    several = F.broadcast(stored(several, "parted"))

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, edges in _whole_groups(batches, ["piece", "conv"]):
            symbols, first = rows["symbol"].to_numpy(), rows.iloc[edges[:-1]]
            found = [chain_matrix(symbols[a:b], model).ravel().tolist() for a, b in zip(edges, edges[1:], strict=False)]
            yield pd.DataFrame({"piece": first["piece"].array, "conv": first["conv"].array, "matrix": found})

    parted = placed.select("piece", "at", "conv", "symbol").join(several, "conv")
    keyed = parted.repartition("piece").sortWithinPartitions("piece", "at").select("piece", "conv", "symbol")
    pieces = stored(keyed.mapInPandas(matrices, "piece int, conv string, matrix array<double>"), "matrices")
    side = stored(pieces.groupBy("conv").applyInPandas(_borders, "conv string, piece int, before int, last int"), "borders")
    known = placed.join(F.broadcast(side) if side.count() <= 1_000_000 else side, ["conv", "piece"], "left")
    known = known.repartition("piece").sortWithinPartitions("piece", "at")
    out = f"conv_id {conv_type}, conv string, piece int, turn long, line_no long, role string, begins boolean, line string, first boolean, last boolean, open boolean"

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, edges in _whole_groups(batches, ["piece", "conv"]):
            symbols, marker = rows["symbol"].to_numpy(), rows["marker"].to_numpy()
            before, last = (rows[c].fillna(-1).to_numpy().astype(int) for c in ("before", "last"))
            path = np.concatenate([chain_path(symbols[a:b], model, before[a], last[a]) for a, b in zip(edges, edges[1:], strict=False)])
            first, ends = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
            first[edges[:-1]], ends[np.array(edges[1:]) - 1] = True, True
            earlier = np.where(first, before, np.concatenate(([-1], path[:-1])))
            begins = (marker < NONE) | (path != earlier)  # a dash may be a list's
            goes_on = np.append(~begins[1:], False) & ~ends
            yield pd.DataFrame({
                "conv_id": rows["conv_id"].array, "conv": rows["conv"].array, "piece": rows["piece"].array, "turn": rows["turn"].astype("Int64").array,
                "line_no": rows["line_no"].array, "role": np.array(ROLES, object)[path], "begins": begins, "line": rows["line"].array,
                "first": first, "last": ends, "open": goes_on,
            })

    columns = ["conv_id", "conv", "piece", "turn", "line_no", "symbol", "marker", "line", "before", "last"]
    found = known.select(*columns).mapInPandas(decode, out)
    # whether the turn of a piece's last line goes on is told by the first line of the next piece of the conversation
    if side.isEmpty():
        going = F.col("open")
    else:
        found = stored(found, "decoded")
        firsts = found.where("first").select("conv", "piece", "begins")
        after = Window.partitionBy("conv").orderBy("piece")
        firsts = firsts.join(several, "conv").select("conv", "piece", (~F.lead("begins").over(after)).alias("goes_on"))
        found = found.join(firsts, ["conv", "piece"], "left")
        going = F.when(F.col("last"), F.coalesce("goes_on", F.lit(False))).otherwise(F.col("open"))
    off = F.when(F.col("begins"), prefix(F.col("line"))).otherwise("")
    found = found.withColumns({"prefix": off, "content": F.substring("line", F.length(off) + 1, F.length("line"))})
    head = F.when(F.col("begins"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))).otherwise("")
    rendered = F.concat(head, F.col("content"), F.lit("\n"), F.when(going, "").otherwise("<|end|>\n"))
    return found.select("conv_id", "turn", "line_no", "role", "begins", "prefix", "content", rendered.alias("rendered"))


def _whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, list[int]]]:
    """Rows of whole groups of sorted batches, and where each group begins, with the end. A batch's last group is held back
    until it is known to be whole."""
    rest: list[pd.DataFrame] = []

    def ready(parts: list[pd.DataFrame]) -> tuple[pd.DataFrame, list[int]]:
        rows = parts[0].reset_index(drop=True) if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        return rows, [0, *_changes(rows, keys), len(rows)]

    for batch in batches:
        if not len(batch):
            continue
        cuts = _changes(batch, keys)
        new = bool(rest) and any(rest[-1][k].iloc[-1] != batch[k].iloc[0] for k in keys)
        if cuts or new:
            whole = [*rest, *([batch.iloc[: cuts[-1]]] if cuts else [])]
            yield ready(whole)
            rest = []
        rest.append(batch.iloc[cuts[-1] :] if cuts else batch)
    if rest:
        yield ready(rest)


def _changes(rows: pd.DataFrame, keys: list[str]) -> list[int]:
    """Positions at which a key differs from the row before."""
    differs = np.zeros(len(rows) - 1, bool)
    for k in keys:
        values = rows[k].to_numpy()
        differs |= values[1:] != values[:-1]
    return (np.flatnonzero(differs) + 1).tolist()
