"""Mixing sources to target weights by hash thresholds.

A document's place in its source's order is a hash of what it is, so a threshold on the hash takes a share of a
source without sorting it. Word counts are summed by source and hash bucket; running totals over the buckets of
a source show in which bucket its budget ends, and only the documents of that bucket are summed again, by the
next digits of the hash, until one hash value is left. Larger budgets have larger thresholds, so what a budget
takes, every larger one takes too. The last pass is a filter: each document is compared with its source's
thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.tables import is_small, stored

DIGITS = 3  # hexadecimal digits per refinement: 4096 buckets a source
HASH_DIGITS = 32
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3  # times that a document may be taken
_WHOLE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(id_col: Column, text: Column) -> Column:
    """Hexadecimal hash of id and text; only rows equal in both have the same."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def _same(left: DataFrame, right: DataFrame, *others: str) -> Column:
    """Equal sources, null being one, and equal other columns."""
    out = left["source"].eqNullSafe(right["of"])
    for c in others:
        out &= left[c] == right[f"of_{c}"]
    return out


def _bucket(level: int) -> Column:
    return F.substring("hash", level * DIGITS + 1, DIGITS)


def _with_numbers(sources: DataFrame) -> DataFrame:
    """Adds the place of each source by code point from 0, null last: places inside value ranges plus the rows of the ranges before."""
    ranges = sources.sparkSession.sparkContext.defaultParallelism
    placed = stored(sources.repartitionByRange(ranges, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix_ranges")
    # one row per range: the window below is a fixed small job
    before = Window.partitionBy(F.lit(0)).orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(F.col("part").alias("of_part")).agg(F.count(F.lit(1)).alias("rows"))
    offsets = counts.select("of_part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = placed.withColumn("inside", inside).join(F.broadcast(offsets), F.col("part") == F.col("of_part"))
    return ranked.withColumn("number", F.col("offset") + F.col("inside")).drop("part", "of_part", "offset", "inside")


class Level(NamedTuple):
    """How full the sources are: those whose limit is below their share of `rest` by weight are full."""

    rest: int
    weight: int

    def full(self) -> Column:
        limit, weight = F.col("limit").cast(_WHOLE), F.col("weight").cast(_WHOLE)
        return limit * F.lit(self.weight).cast(_WHOLE) < weight * F.lit(self.rest).cast(_WHOLE)

    def target(self) -> Column:
        share = F.lit(float(self.rest)) * F.col("weight") / F.lit(self.weight)
        return F.when(self.full() | F.lit(not self.weight), F.col("limit").cast("double")).otherwise(share)


def _level(sources: DataFrame, budget: int) -> Level:
    """Share the budget by weight, cut at the limits, share the excess again until no source is above. One small
    aggregate over the sources per round; a source that is full stays full."""
    totals = sources.agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")).first()
    level, full = Level(budget, totals["weight"] or 0), 0
    while True:
        row = sources.agg(
            F.sum(F.when(level.full(), F.col("limit").cast(_WHOLE))).alias("spent"),
            F.sum(F.when(~level.full(), F.col("weight"))).alias("weight"),
            F.count(F.when(level.full(), 1)).alias("full"),
        ).first()
        if row["full"] == full:
            return level
        level, full = Level(budget - int(row["spent"] or 0), row["weight"] or 0), row["full"]


def source_targets(histogram: DataFrame, weights: Sequence[int], most: int, budgets: Sequence[float]) -> DataFrame:
    """source, budget (its number), source_size, target, whole (copies that every document gives), need (words of one more copy)."""
    sums = histogram.groupBy("source").agg(F.sum("words").alias("source_size"))
    numbered = _with_numbers(sums)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sources = stored(numbered.withColumns({"weight": weight.cast("long"), "limit": F.col("source_size") * most}), "mix_sources")
    every = int(sources.agg(F.sum(F.col("source_size").cast(_WHOLE)).alias("n")).first()["n"] or 0)
    levels = [_level(sources, round(every * b) if b != 1 else every) for b in budgets]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("budget"), lv.target().alias("target")) for i, lv in enumerate(levels)]))
    spread = sources.withColumn("each", each).select("source", "source_size", "each.budget", "each.target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return spread.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))


def _edges(sums: DataFrame, level: int) -> DataFrame:
    """Of every source and budget the bucket in which the words still needed run out."""
    before = Window.partitionBy("source", "budget").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)).cast("long"))
    crossing = running.where((F.col("below") < F.col("need")) & (F.col("below") + F.col("words") >= F.col("need")))
    prefix = F.col("bucket") if level == 0 else F.concat("prefix", "bucket")
    return crossing.select("source", "budget", prefix.alias("prefix"), (F.col("need") - F.col("below")).alias("need"), "words", "lowest", "highest")


def thresholds(sized: DataFrame, histogram: DataFrame, targets: DataFrame) -> DataFrame:
    """source, budget, threshold, with_it: hashes below the threshold are taken once more, and the threshold itself if with_it."""
    wanted = targets.where(F.col("need") > 0).select(F.col("source").alias("of"), "budget", "need")
    first = histogram.join(wanted, histogram["source"].eqNullSafe(wanted["of"])).drop("of")
    edges, settled = stored(_edges(first, 0), "mix_edges"), []
    for level in range(1, -(-HASH_DIGITS // DIGITS) + 1):
        one = F.col("lowest") == F.col("highest")
        # the documents of the last hash value are taken if that comes nearer to the target
        nearer = 2 * F.col("need") > F.col("words")
        settled.append(edges.where(one).select("source", "budget", F.col("lowest").alias("threshold"), nearer.alias("with_it")))
        open_ones = edges.where(~one)
        if open_ones.isEmpty():
            break
        marks = open_ones.select(
            F.col("source").alias("of"), F.substring("prefix", 1, DIGITS).alias("of_first"), "budget", "prefix", "need",
        )
        rows = sized.withColumn("first", _bucket(0))
        inside = rows.join(F.broadcast(marks) if is_small(marks) else marks, _same(rows, marks, "first"))
        inside = inside.where(F.col("hash").startswith(F.col("prefix"))).withColumn("bucket", _bucket(level))
        sums = inside.groupBy("source", "budget", "prefix", "need", "bucket").agg(*_sums())
        edges = stored(_edges(sums, level), "mix_edges")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def _sums() -> list[Column]:
    return [F.sum("size").alias("words"), F.min("hash").alias("lowest"), F.max("hash").alias("highest")]


def _once_more(plan: Column) -> Column:
    return ((F.col("hash") < plan["threshold"]) | ((F.col("hash") == plan["threshold"]) & plan["with_it"])).cast("long")


def mix(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
    most: int = MOST, budgets: Sequence[float] = (1.0,),
) -> DataFrame:
    """One row per row of df: id, size (words), source_size, targets and taken (arrays with an entry per budget).

    A budget is a share of all words. It is dealt to the sources by weight, in order of code point, null last; a source
    takes `most` times its words at most and the rest goes to the others. Every document of a source is taken
    floor(target / source_size) times, those up to a threshold of their hash once more, so that the words taken differ from
    the target by half the words of one hash value at most. Rows equal in id and text have one hash and are taken alike.
    Null and empty texts have no words; a source without words takes none. No rows: no rows. No other column of df is read."""
    sized = stored(
        df.select(
            F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
            document_hash(F.col(id_col), F.col(text)).alias("hash"),
        ),
        "mix_sizes",
    )
    histogram = stored(sized.groupBy("source", _bucket(0).alias("bucket")).agg(*_sums()), "mix_histogram")
    targets = stored(source_targets(histogram, weights, most, budgets), "mix_targets")
    found = thresholds(sized, histogram, targets).withColumnsRenamed({"source": "of", "budget": "of_budget"})
    plan = targets.join(found, _same(targets, found, "budget"), "left")
    entry = F.struct("budget", "target", "whole", F.coalesce("threshold", F.lit("")).alias("threshold"), F.coalesce("with_it", F.lit(False)).alias("with_it"))
    plan = plan.groupBy("source", "source_size").agg(F.sort_array(F.collect_list(entry)).alias("plan"))
    plan = stored(plan.withColumnRenamed("source", "of"), "mix_plan")
    if is_small(plan):
        planned = sized.join(F.broadcast(plan), _same(sized, plan))
    else:
        # too many sources to broadcast: one row per source and bucket, so that a large source is spread over 4096 keys
        spread = histogram.join(plan, _same(histogram, plan)).select(F.col("source").alias("of"), F.col("bucket").alias("of_bucket"), "source_size", "plan")
        rows = sized.withColumn("bucket", _bucket(0))
        planned = rows.join(spread, _same(rows, spread, "bucket"))
    return planned.select(
        F.col("id").alias(id_col), "size", "source_size", F.transform("plan", lambda p: p["target"]).alias("targets"),
        F.transform("plan", lambda p: F.col("size") * (p["whole"] + _once_more(p))).alias("taken"),
    )
