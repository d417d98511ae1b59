"""Exact k-means on whole-number vectors, with centroids ruled out by n-simplex projection.

The distances of a vector to m pivots fix its place relative to them but for a rotation: the pivots are the base
of a simplex, the vector its apex, with m - 1 coordinates inside the base's space and an altitude above it. Two
apexes at altitudes on the same side are never farther apart than their vectors, on opposite sides never nearer
(Connor et al. 2017). Distances to pivots are taken once per vector and kept with it; each round compares the
short apexes of vectors and centroids, and only centroids whose lower bound does not exceed the least upper
bound are compared exactly, in whole numbers. The pivots decide the amount of work, never a result."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.llm.tables import stored

PIVOTS = 8
PIVOT_CANDIDATES = 64  # vectors that reach the driver to choose the pivots from
LEAST_ALTITUDE = 0.05  # of the first two pivots' distance: flatter simplexes would magnify rounding
MARGIN = 1e-6  # rounding of the bounds, as a share of the squared distances they come from
PAIRS_AT_ONCE = 1 << 15
_CENTROID = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("components", T.ArrayType(T.LongType()))])


class Simplex(NamedTuple):
    pivots: np.ndarray  # (m, dimensions)
    base: np.ndarray  # coordinates of pivots 1..m-1 seen from pivot 0
    solve: np.ndarray  # inverse of base


class Apexes(NamedTuple):
    place: np.ndarray  # (n, m): coordinates and altitude
    size: np.ndarray  # squared distance to pivot 0


def choose_pivots(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
    """Greedily the candidate farthest from the space of the pivots so far."""
    rest = candidates.astype(float) - candidates[0]
    chosen, axes, height = [0], [], None
    while len(chosen) < min(most, len(candidates)):
        altitude = np.sqrt((rest * rest).sum(1))
        top = int(altitude.argmax())
        height = height or altitude[top]
        if altitude[top] <= LEAST_ALTITUDE * height:
            break
        axis = rest[top] / altitude[top]
        axes.append(axis)
        chosen.append(top)
        rest = rest - np.outer(rest @ axis, axis)
    seen = candidates[chosen[1:]].astype(float) - candidates[0]
    base = np.tril(seen @ np.array(axes).T) if axes else np.zeros((0, 0))
    return Simplex(candidates[chosen], base, np.linalg.inv(base))


def apexes(vectors: np.ndarray, simplex: Simplex) -> Apexes:
    """Apex coordinates from nothing but the distances to the pivots."""
    squared = np.stack([((vectors - p).astype(float) ** 2).sum(1) for p in simplex.pivots], axis=1)
    side = (squared[:, :1] - squared[:, 1:] + (simplex.base**2).sum(1)) / 2
    inside = side @ simplex.solve.T
    altitude = np.sqrt(np.maximum(squared[:, 0] - (inside * inside).sum(1), 0.0))
    return Apexes(np.concatenate([inside, altitude[:, None]], axis=1), squared[:, 0])


def possible(vectors: Apexes, centroids: Apexes) -> np.ndarray:
    """(n, k) flags: centroids whose lower bound does not exceed the vector's least upper bound."""
    a, c = vectors.place, centroids.place
    lower = (a * a).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * (a @ c.T)
    upper = lower + 4.0 * np.outer(a[:, -1], c[:, -1])
    margin = MARGIN * (vectors.size[:, None] + centroids.size[None, :] + 1.0)
    return lower - margin <= (upper + margin).min(1)[:, None]


def nearest(vectors: np.ndarray, places: Apexes, centroids: np.ndarray, centroid_places: Apexes) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller of equals) and the exact squared distance."""
    cluster, distance = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
    step = max(1, PAIRS_AT_ONCE // len(centroids))
    for at in range(0, len(vectors), step):
        some = Apexes(places.place[at : at + step], places.size[at : at + step])
        rows, numbers = np.nonzero(possible(some, centroid_places))
        gap = vectors[at + rows] - centroids[numbers]
        exact = np.einsum("ij,ij->i", gap, gap)
        begins = np.searchsorted(rows, np.arange(len(some.size)))
        least = np.minimum.reduceat(exact, begins)
        first = np.flatnonzero(exact == least[rows])
        own, place = np.unique(rows[first], return_index=True)
        cluster[at + own], distance[at + own] = numbers[first[place]], least
    return cluster, distance


def largest_component(dimensions: int) -> int:
    """Components beyond this are set to it, so that squared distances fit a long."""
    return math.isqrt((1 << 62) // max(dimensions, 1)) // 2


def _complete(vector: Column, dimensions: int) -> Column:
    """Exactly so many components, none null, infinite or not a number."""
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    return F.coalesce((F.size(vector) == dimensions) & fit, F.lit(False))


def _whole(values: np.ndarray, scale: float) -> np.ndarray:
    limit = largest_component(values.shape[1])
    return np.clip(np.floor(scale * values.astype(float)), -limit, limit).astype(np.int64)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _first(df: DataFrame, id_col: str, vector: str, n: int, dimensions: int, scale: float) -> np.ndarray:
    """The n vectors of smallest sha256 of "1:<id>"; a row without id comes last, equal ids go by components."""
    order = F.sha2(F.concat(F.lit("1:"), F.col(id_col).cast("string")).cast("binary"), 256)
    rows = df.select(vector).orderBy(order.asc_nulls_last(), vector).limit(n).collect()
    return _whole(np.array([r[0] for r in rows]).reshape(-1, dimensions), scale)


def _with_apexes(df: DataFrame, id_col: str, vector: str, simplex: Simplex, dimensions: int, scale: float) -> DataFrame:
    fields = [("components", T.ArrayType(T.IntegerType())), ("place", T.ArrayType(T.DoubleType())), ("size", T.DoubleType())]
    schema = T.StructType([df.schema[id_col], *[T.StructField(n, t) for n, t in fields]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _whole(_matrix(batch.column(1), dimensions), scale)
            seen = apexes(whole, simplex)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(whole.astype(np.int32)), _lists(seen.place), pa.array(seen.size)], names=schema.fieldNames()
            )

    return df.select(id_col, vector).mapInArrow(work, schema)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _assignments(batch: pa.RecordBatch, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    whole = _matrix(batch.column("components"), centroids.shape[1]).astype(np.int64)
    places = Apexes(_matrix(batch.column("place"), len(simplex.pivots)), batch.column("size").to_numpy())
    return (whole, *nearest(whole, places, centroids, apexes(centroids, simplex)))


def _sums(ready: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """cluster, place, n, total: sums per task first, so a hot cluster sends one row per task and component."""
    schema = "cluster int, n long, totals array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            whole, cluster, _ = _assignments(batch, centroids, simplex)
            np.add.at(count, cluster, 1)
            np.add.at(total, cluster, whole)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), _lists(total[used])], names=["cluster", "n", "totals"]
        )

    per_task = ready.select("components", "place", "size").mapInArrow(work, schema)
    each = per_task.select("cluster", "n", F.posexplode("totals").alias("at", "total"))
    return each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))


def _moved(ready: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Each centroid at the floor of its vectors' means; those without vectors stay. k x dimensions numbers reach the driver."""
    out = centroids.copy()
    for r in _sums(ready, centroids, simplex).collect():
        out[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return out


def cluster(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, dimensions: int = 64,
    scale: float = 64.0, pivots: int = PIVOTS,
) -> DataFrame:
    """One row per vector of exactly `dimensions` finite components: id, cluster, distance (squared), cluster_inertia,
    inertia, components (of its final centroid). Other rows have no result.

    Components are floor(scale * x), beyond largest_component() that limit. Centroids start as the k vectors of smallest
    sha256 of "1:<id>", rows without id last, equal ids by components; fewer vectors than k give as many centroids. Equal
    vectors may start several centroids; the smaller number then takes all and the others stay. Repeated rows and ids count
    each. An inertia beyond a long is null. No vectors: no rows."""
    spark = df.sparkSession
    kept = df.select(F.col(id_col), F.col(vector).cast("array<double>").alias("vector")).where(_complete(F.col("vector"), dimensions))
    first = _first(kept, id_col, "vector", max(k, PIVOT_CANDIDATES), dimensions, scale)
    if not len(first):
        none = spark.createDataFrame([], _CENTROID)
        return _answer(kept.select(id_col, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), none, id_col)
    simplex, centroids = choose_pivots(first[:PIVOT_CANDIDATES], pivots), first[:k]
    ready = stored(_with_apexes(kept, id_col, "vector", simplex, dimensions, scale), "apexes")
    for _ in range(rounds):
        centroids = _moved(ready, centroids, simplex)
    assigned = stored(_assigned(ready, centroids, simplex, id_col), "clusters")
    return _answer(assigned, _table(spark, centroids), id_col)


def _assigned(ready: DataFrame, centroids: np.ndarray, simplex: Simplex, id_col: str) -> DataFrame:
    schema = T.StructType([ready.schema[id_col], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, number, distance = _assignments(batch, centroids, simplex)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], names=schema.fieldNames())

    return ready.mapInArrow(work, schema)


def _table(spark: SparkSession, centroids: Sequence[np.ndarray]) -> DataFrame:
    return spark.createDataFrame([(i, [int(x) for x in c]) for i, c in enumerate(centroids)], _CENTROID)


def _answer(assigned: DataFrame, centroids: DataFrame, id_col: str) -> DataFrame:
    """The vectors with the figures of their cluster: k rows are broadcast."""
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    whole = sums.agg(F.sum("own").alias("every"))
    figures = sums.join(F.broadcast(whole)).join(F.broadcast(centroids), "cluster")
    fit = [F.expr(f"try_cast({c} AS bigint)").alias(name) for c, name in (("own", "cluster_inertia"), ("every", "inertia"))]
    return assigned.join(F.broadcast(figures), "cluster").select(id_col, "cluster", "distance", *fit, "components")
