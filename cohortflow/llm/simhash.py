"""SimHash near-duplicates: 64-bit fingerprints, searched with BK-trees.

A fingerprint takes the majority of every bit over the XXH64 hashes of the word shingles.
Distinct fingerprints are dealt to shards so that every pair within the radius meets in
some shard: 64 bits are cut into segments, and two fingerprints that differ in at most
`radius` bits agree on all but `radius` segments. In each shard a BK-tree holds the
fingerprints (children keyed by their Hamming distance to the parent) and a search follows
only edges within the radius. A search takes what it finds out of the tree, so a shard
yields a spanning forest of its links and a dense group of m near copies costs about m
steps, not m squared. Larger tables use more segments, hence smaller shards; the links are the same.

A shard with more than `shard_rows` fingerprints is cut into chunks, and every pair of
chunks is searched in a task of its own, so no task holds more than two chunks.

Components come from minimum labels on the forest edges: every round hooks each node to its
least neighbour, jumps pointers and keeps only edges between different components.

Defined results: a null text counts as empty; a text without words has fingerprint zero and
is linked like any other. Repeated rows share a fingerprint and a component. A row with a
null id gets the component of its fingerprint, which is null only if no member has an id. Other
columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.tables import small_side, stored

BITS = 64
SEED = 42  # fixed value of the contract
WORDS = 4  # fixed value of the contract
RADIUS = 4  # fixed value of the contract
#: Fingerprints that one search task holds at most (twice, for a pair of chunks).
SHARD_ROWS = 20_000
#: Wanted mean of fingerprints in a shard.
MEAN_SHARD = 200
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits over the hashes of the shingles of a whole text, as a signed 64-bit number."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z, only \x20 and \x09-\x0d
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = max(1, len(tokens) - words + 1)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        pairs = zip(starts[at : at + HASHES_AT_ONCE], stops[at : at + HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, id_column: str, text_column: str, words: int = WORDS) -> DataFrame:
    """Columns id, h (a hash of the text, to tell rows of one id apart) and fp (signed)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch["text"]], np.int64)
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "h": batch["h"], "fp": prints})

    text = F.coalesce(F.col(text_column), F.lit(""))
    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return narrow.mapInPandas(each, "id long, h long, fp long")


class BKTree:
    """Integers under Hamming distance. found() removes what it returns."""

    def __init__(self, values: list[int]) -> None:
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        self.parent = [-1] * len(values)
        self.alive = [True] * len(values)
        self.left = [1] * len(values)  # living nodes of the subtree
        for i in range(1, len(values)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        at, value = 0, self.values[i]
        while True:
            self.left[at] += 1
            d = (self.values[at] ^ value).bit_count()
            below = self.children[at].get(d)
            if below is None:
                self.children[at][d] = i
                self.parent[i] = at
                return
            at = below

    def take(self, i: int) -> None:
        self.alive[i] = False
        while i >= 0:
            self.left[i] -= 1
            i = self.parent[i]

    def found(self, value: int, radius: int) -> list[int]:
        """Living nodes within the radius of a value, which are then taken out."""
        hits, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            if not self.left[at]:
                continue
            d = (self.values[at] ^ value).bit_count()
            if d <= radius and self.alive[at]:
                hits.append(at)
            for edge, below in self.children[at].items():
                if d - radius <= edge <= d + radius:
                    todo.append(below)
        for i in hits:
            self.take(i)
        return hits


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Index pairs that span the components of "within the radius" among distinct values."""
    tree, links = BKTree(values), []
    for i in range(len(values)):
        if not tree.alive[i]:
            continue
        tree.take(i)
        todo = [i]
        while todo:
            at = todo.pop()
            hits = tree.found(values[at], radius)
            links += [(at, h) for h in hits]
            todo += hits
    return links


def segments(bits: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, width) of nearly equal cuts."""
    edges = [round(i * bits / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def parts_for(count: int, radius: int, mean: int = MEAN_SHARD) -> int:
    """The fewest segments whose shards would hold `mean` of `count` random fingerprints."""
    for parts in range(radius + 1, radius + 5):
        if count <= mean << (BITS * (parts - radius) // parts):
            break
    return parts


def shard_links(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """prints: distinct fp. Links (a, b) between fingerprints that span all pairs within the radius."""
    parts = parts_for(prints.count(), radius)
    tables = list(combinations(segments(BITS, parts), parts - radius))
    keys = []
    for t, chosen in enumerate(tables):
        key = F.lit(0).cast("long")
        for first, width in chosen:
            piece = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(piece)
        keys.append(F.struct(F.lit(t).alias("t"), key.alias("k")))
    keyed = prints.select("fp", F.inline(F.array(*keys)))
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # shards of one member have no pair; the others learn how many chunks they need
    chunks = F.ceil(F.col("n") / shard_rows).cast("int")
    met = keyed.join(sizes, ["t", "k"]).withColumn("chunks", chunks)
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    dealt = met.select("fp", "t", "k", F.inline(pairs))

    def search(batch: pd.DataFrame) -> pd.DataFrame:
        prints = batch["fp"].to_numpy()
        at = np.array(forest(prints.view(np.uint64).tolist(), radius), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": prints[at[:, 0]], "b": prints[at[:, 1]]})

    return _by_group(dealt, ["t", "k", "i", "j"], search, "a long, b long")


def _by_group(df: DataFrame, keys: list[str], f, schema: str) -> DataFrame:
    """f on each group. The groups are many and small, so tasks read sorted rows and cut them
    themselves instead of starting one call per group in Spark."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            k = rows[keys].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist()]
            out = [f(rows.iloc[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
            rest = rows.iloc[edges[-1] :]
            if out:
                yield pd.concat(out, ignore_index=True)
        if rest is not None and len(rest):
            yield f(rest)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(each, schema)


def components(links: DataFrame) -> DataFrame:
    """Columns node and component (the least node reachable) for every node that has a link.

    Each round hooks every root to its least neighbour, follows the pointers until all name a root, which takes the
    logarithm of the longest way, and renames the links; links inside a component vanish. A root that stays has a
    neighbour that went, so a round leaves half of the roots at most. Every table is written, so a round can be repeated."""
    labels = None
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("v"), F.least("a", "p").alias("p"))
        hooks = stored(hooks, "hooks")
        moving = True
        while moving:
            up = hooks.select(F.col("v").alias("p"), F.col("p").alias("q"))
            jumped = stored(hooks.join(up, "p").select("v", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), "hooks")
            hooks, moving = jumped.select("v", "p"), not jumped.where("moved").isEmpty()
        if labels is None:
            labels = hooks.select(F.col("v").alias("node"), F.col("p").alias("component"))
        else:
            up = hooks.select(F.col("v").alias("component"), F.col("p").alias("q"))
            labels = labels.join(up, "component", "left").select("node", F.coalesce("q", "component").alias("component"))
        labels = stored(labels, "labels")
        a = hooks.select(F.col("v").alias("a"), F.col("p").alias("x"))
        b = hooks.select(F.col("v").alias("b"), F.col("p").alias("y"))
        renamed = edges.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = stored(renamed.distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _classes(docs: DataFrame, id_column: str, text_column: str, words: int, radius: int, shard_rows: int) -> DataFrame:
    """Columns id, h, fp and component_id of every row."""
    marked = stored(with_fingerprint(docs, id_column, text_column, words), "fingerprints")
    prints = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    labels = components(shard_links(prints.select("fp"), radius, shard_rows))
    classes = prints.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("label"))
    names = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    return marked.join(classes.join(names, "label").select("fp", "component_id"), "fp").select("id", "h", "fp", "component_id")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, radius: int = RADIUS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row per row of docs: the id, fp (signed) and component_id (smallest id reachable)."""
    found = _classes(docs, id_column, text_column, words, radius, shard_rows)
    return found.select(F.col("id").alias(id_column), "fp", "component_id")


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, radius: int = RADIUS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The row of docs, with all its columns, whose id names its component; of several such rows the one whose
    text has the least hash, once. Rows of a component without any id all stay."""
    found = stored(_classes(docs, id_column, text_column, words, radius, shard_rows), "classes")
    heads = found.where("id = component_id").groupBy("component_id").agg(F.min("h").alias("least_h"))
    keys = found.groupBy("id", "h", "component_id").agg(F.count(F.lit(1)).alias("n")).join(heads, "component_id", "left")
    stays = F.col("component_id").isNull() | ((F.col("id") == F.col("component_id")) & (F.col("h") == F.col("least_h")))
    once = F.col("component_id").isNull() | (F.col("n") == 1)
    odd = keys.where(~(F.coalesce(stays, F.lit(False)) & once)).select(
        F.col("id").alias("__id"), F.col("h").alias("__h"), F.coalesce(stays, F.lit(False)).alias("__again")
    )
    odd = stored(odd, "not-once")
    key = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    met = docs.withColumn("__key", key).join(
        small_side(odd), F.col(id_column).cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__h")), "left"
    )
    kept = met.where(F.col("__again").isNull())
    if not odd.where("__again").isEmpty():
        kept = kept.unionByName(met.where("__again").dropDuplicates(["__id", "__h"]))
    return kept.select(*docs.columns)
