"""Exact ranks and running totals without a one-task sort.

A rank over a whole class is built from counts per small bucket: the counts table is
tiny, each bucket is ranked on its own, and the offset of the bucket is added."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.expressions import as_column, hash_key
from cohortflow.operators.binning import with_steps
from cohortflow.sources.scratch import materialize

ROWS_PER_BUCKET = 100_000  # of one class; hash buckets are equally likely
BROADCAST_OFFSETS = 1_000_000
COARSE_DIGITS = 3
MAX_RANGES = 20_000  # borders that reach the driver; beyond 2e9 distinct values ranges get wider
FEW_COPIES = 1000
COPIES_PER_CHUNK = 10_000


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class: label, count. A null label is a class like any other."""
    return df.groupBy(label).count()


def bucket_digits(rows: int) -> int:
    """Hexadecimal digits of the hash that give buckets of about ROWS_PER_BUCKET rows."""
    return max(1, math.ceil(math.log(max(1, rows / ROWS_PER_BUCKET), 16)))


def with_hash_order(
    df: DataFrame, seed: int, key: Sequence[str] | None, digits: int
) -> tuple[DataFrame, list[Column]]:
    """Add __h (hash), __b (bucket) and __m (copies), and give the order inside a bucket.

    With a unique key each row stands for itself. Without one, equal rows are first
    folded into one row with a copy count, so a row that occurs a billion times
    weighs as much as a single one."""
    columns = df.columns
    if key:
        keyed, order = df.withColumn("__m", F.lit(1).cast("long")), list(key)
    else:
        keyed, order = df.groupBy(*[as_column(c) for c in columns]).agg(F.count(F.lit(1)).alias("__m")), columns
    keyed = keyed.withColumn("__h", hash_key(seed, *[as_column(c) for c in order]))
    keyed = keyed.withColumn("__b", F.substring("__h", 1, digits))
    return keyed, [F.col("__h"), *[as_column(c) for c in order]]


def spread_copies(df: DataFrame, index: str = "__i") -> DataFrame:
    """Undo the folding: one row per copy, numbered from 0 in `index`.

    Rows with very many copies are cut into chunks that are spread over tasks first."""
    few = df.filter(F.col("__m") <= FEW_COPIES).withColumn(
        index, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__m") - 1))
    )
    size = F.lit(COPIES_PER_CHUNK)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__m") - 1) / size)))
    many = df.filter(F.col("__m") > FEW_COPIES).withColumn("__chunk", chunk)
    many = many.repartition(F.col("__h"), F.col("__chunk"))
    start = F.col("__chunk") * size
    end = F.least(start + size, F.col("__m")) - 1
    return few.unionByName(many.withColumn(index, F.explode(F.sequence(start, end))).drop("__chunk"))


def _same(column: str, other: str):
    """Equal, or both null."""
    return as_column(column).eqNullSafe(F.col(other))


def _offsets(keyed: DataFrame, label: str) -> DataFrame:
    """Per class and bucket: its rows (__n) and those of all earlier buckets of the class (__offset).

    Sums run over the buckets of one coarse bucket, then over the at most 4096 coarse ones."""
    counts = keyed.groupBy(as_column(label).alias("__label"), "__b").agg(F.sum("__m").alias("__n"))
    counts = counts.withColumn("__c", F.substring("__b", 1, COARSE_DIGITS))
    fine = Window.partitionBy("__label", "__c").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    coarse = Window.partitionBy("__label").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("__label", "__c").agg(F.sum("__n").alias("__t"))
    totals = totals.select(F.col("__label").alias("__l"), F.col("__c").alias("__cc"), F.coalesce(F.sum("__t").over(coarse), F.lit(0)).alias("__before"))
    inside = counts.withColumn("__in", F.coalesce(F.sum("__n").over(fine), F.lit(0)))
    joined = inside.join(totals, F.col("__label").eqNullSafe(F.col("__l")) & (F.col("__c") == F.col("__cc")))
    return joined.select("__label", F.col("__b").alias("__ob"), "__n", (F.col("__before") + F.col("__in")).alias("__offset"))


def hash_rank(
    df: DataFrame, label: str, seed: int, key: Sequence[str] | None = None, name: str = "class_rank"
) -> DataFrame:
    """1-based rank of every row inside its class, in seeded hash order."""
    digits = bucket_digits(df.count())
    keyed, order = with_hash_order(df, seed, key, digits)
    offsets = _offsets(keyed, label).drop("__n")
    if 16**digits <= BROADCAST_OFFSETS // 16:
        # a row per class and bucket; more than the bound are joined by a shuffle on the ranking's own keys
        offsets = F.broadcast(offsets) if offsets.count() <= BROADCAST_OFFSETS else offsets
    inside = Window.partitionBy(label, "__b").orderBy(*order)
    if key:
        local = F.row_number().over(inside).cast("long")
    else:
        local = F.sum("__m").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__m") + 1
    ranked = keyed.withColumn("__r", local).join(offsets, _same(label, "__label") & (F.col("__b") == F.col("__ob")))
    ranked = ranked.withColumn(name, F.col("__offset") + F.col("__r"))
    if not key:
        ranked = spread_copies(ranked).withColumn(name, F.col(name) + F.col("__i"))
    return ranked.select(*[as_column(c) for c in df.columns], name)


def take_per_class(
    df: DataFrame, label: str, quotas: DataFrame, seed: int, key: Sequence[str] | None = None, name: str = "is_test"
) -> DataFrame:
    """Flag exactly `quota` rows per class of the table quotas (label, quota): the first ones in seeded hash order.

    Only the rows of one bucket per class are ranked; every other bucket is wholly
    inside or outside the quota, so the bulk of the data is not moved at all."""
    keyed, order = with_hash_order(df, seed, key, bucket_digits(df.count()))
    wanted = quotas.select(as_column(label).alias("__q"), F.col("quota").alias("__quota"))
    end = F.col("__offset") + F.col("__n")
    cut = (
        _offsets(keyed, label)
        .join(wanted, F.col("__label").eqNullSafe(F.col("__q")))
        .filter(end >= F.col("__quota"))
        .groupBy("__label")
        .agg(F.min(F.struct(F.col("__ob").alias("__b"), (F.col("__quota") - F.col("__offset")).alias("left"))).alias("__cut"))
    )
    classes = cut.count()  # one row per class
    joined = keyed.join(F.broadcast(cut) if classes <= BROADCAST_OFFSETS else cut, _same(label, "__label"))
    inside = Window.partitionBy(label).orderBy(*order)
    cut_bucket = F.col("__cut.__b")
    settled = joined.filter(F.col("__b") != cut_bucket).withColumn(
        "__take", F.when(F.col("__b") < cut_bucket, F.col("__m")).otherwise(F.lit(0).cast("long"))
    )
    edge = joined.filter(F.col("__b") == cut_bucket)
    if key:
        start = F.row_number().over(inside).cast("long") - 1
    else:
        start = F.sum("__m").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__m")
    room = F.greatest(F.col("__cut.left") - start, F.lit(0).cast("long"))
    edge = edge.withColumn("__take", F.least(room, F.col("__m")))
    flagged = settled.unionByName(edge)
    if key:
        flagged = flagged.withColumn(name, F.col("__take") > 0)
    else:
        flagged = spread_copies(flagged).withColumn(name, F.col("__i") < F.col("__take"))
    return flagged.select(*[as_column(c) for c in df.columns], name)


def running_totals(
    df: DataFrame, value: str, sums: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """For one row per distinct value: totals of `sums` over all larger values.

    Adds <name>_above per column. Value ranges of about equal size come from a quantile
    sketch (at most `buckets` numbers reach the driver); their borders affect only the
    balance of the work, not the result."""
    df = materialize(df, "totals")  # counted, sketched, summed and ranked: what it took to make is done once
    if buckets is None:
        buckets = min(MAX_RANGES, max(16, math.ceil(df.count() / ROWS_PER_BUCKET)))
    probs = [i / buckets for i in range(1, buckets)]
    edges = sorted(set(df.approxQuantile(value, probs, 0.5 / buckets)))
    placed = with_steps(df, {value: edges}).withColumnRenamed(f"{value}__step", "__b")
    totals = placed.groupBy("__b").agg(*[F.sum(s).alias(s) for s in sums])
    # at most `buckets` rows, so the one-group window below is a fixed small job
    higher = Window.partitionBy(F.lit(0)).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__b", *[F.coalesce(F.sum(s).over(higher), F.lit(0)).alias(f"__{s}") for s in sums])
    inside = Window.partitionBy("__b").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    for s in sums:
        placed = placed.withColumn(f"{s}_above", F.coalesce(F.sum(s).over(inside), F.lit(0)))
    joined = placed.join(F.broadcast(offsets), "__b")
    above = [(F.col(f"{s}_above") + F.col(f"__{s}")).alias(f"{s}_above") for s in sums]
    return joined.select(*[as_column(c) for c in df.columns], *above)


def best_border(df: DataFrame, value: str, label: str) -> float | None:
    """The value from which on rows go right in the best single split of a 0/1 label; of equal splits the lowest, None if all values are equal.

    Every border between distinct values is considered; only the best one reaches the driver."""
    y = as_column(label).cast("double")
    known = df.filter(as_column(value).isNotNull())
    cells = materialize(known.groupBy(as_column(value).cast("double").alias("value")).agg(F.count(y).alias("n"), F.sum(y).alias("p")), "borders")
    every = cells.agg(F.sum("n").cast("double").alias("n"), F.sum("p").alias("p"), F.min("value").alias("least")).first()
    if not every["n"]:
        return None
    n, p = F.lit(every["n"]), F.lit(every["p"])
    rn, rp = F.col("n_above") + F.col("n"), F.col("p_above") + F.col("p")
    ln, lp = n - rn, p - rp

    def impurity(ones, rows):
        return F.lit(2.0) * (ones / rows) * (1 - ones / rows)

    gain = impurity(p, n) - ln / n * impurity(lp, ln) - rn / n * impurity(rp, rn)
    right = running_totals(cells, "value", ["n", "p"]).filter(F.col("value") > every["least"])
    best = right.agg(F.max(F.struct(gain.alias("gain"), (-F.col("value")).alias("value"))).alias("best")).first()["best"]
    return None if best is None else -best["value"]


def largest_remainder(counts: DataFrame, label: str, share: float) -> DataFrame:
    """Whole-number quotas per class (label, quota) that add up to ceil(share * total)."""
    raw = F.lit(float(share)) * F.col("count")
    base = F.floor(F.round(raw, 9))
    parts = counts.select(as_column(label), base.alias("quota"), F.round(raw - base, 9).alias("__left"))
    sums = counts.agg(F.sum("count").alias("n"), F.sum(base).alias("q")).first()
    spare = math.ceil(round(share * (sums["n"] or 0), 9)) - (sums["q"] or 0)
    # fewer spare rows than classes: they go to the largest remainders
    text = F.coalesce(as_column(label).cast("string"), F.lit("None"))
    first = parts.orderBy(F.desc("__left"), text).limit(max(0, spare)).select(as_column(label).alias("__l"), F.lit(1).alias("__one"))
    more = parts.join(first, _same(label, "__l"), "left")
    return more.select(as_column(label), (F.col("quota") + F.coalesce("__one", F.lit(0))).alias("quota"))
