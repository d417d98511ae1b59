"""Placing values among many sorted borders, by binary search inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.expressions import as_column


def with_steps(
    df: DataFrame, borders: dict[str, Sequence[float]], suffix: str = "__step", strict: bool = False
) -> DataFrame:
    """Add <column><suffix>: how many of its (strictly increasing) borders are <= the value,
    or < the value when strict. Null stays null."""
    searched = [c for c, b in borders.items() if len(b)]
    raw = {c: f"{c}{suffix}__raw" for c in searched}
    inputs = {c: f"{c}{suffix}__in" for c in searched}
    out = df.withColumns({inputs[c]: as_column(c).cast("double") for c in searched}) if searched else df
    if searched:
        out = Bucketizer(
            inputCols=list(inputs.values()),
            outputCols=list(raw.values()),
            splitsArray=[[-math.inf, *map(float, borders[c]), math.inf] for c in searched],
            handleInvalid="keep",
        ).transform(out)
    steps = {}
    for c, b in borders.items():
        present = as_column(c).isNotNull()
        if not len(b):
            steps[f"{c}{suffix}"] = F.when(present, F.lit(0))
            continue
        step = F.col(raw[c]).cast("int")
        if strict:
            step = step - F.when(value_at(b, step) == F.col(inputs[c]), 1).otherwise(0)
        steps[f"{c}{suffix}"] = F.when(present, step)
    return out.withColumns(steps).drop(*raw.values(), *inputs.values())


def value_at(values: Sequence[float], position: Column) -> Column:
    """values[position - 1]; null for position 0."""
    table = F.array(*[F.lit(float(v)) for v in values])
    return F.when(position >= 1, F.element_at(table, F.greatest(position, F.lit(1))))


def with_interpolation(df: DataFrame, tables: dict[str, tuple[Sequence[float], Sequence[float]]], suffix: str) -> DataFrame:
    """Add <column><suffix>: the piecewise linear map through (knot, value) pairs, flat outside."""
    placed = with_steps(df, {c: knots for c, (knots, _) in tables.items()}, "__knot")
    out = {}
    for c, (knots, values) in tables.items():
        step, last = F.col(f"{c}__knot"), len(knots)
        slopes = [(values[i + 1] - values[i]) / (knots[i + 1] - knots[i]) for i in range(last - 1)] + [0.0]
        inside = value_at(values, step) + (as_column(c) - value_at(knots, step)) * value_at(slopes, step)
        out[f"{c}{suffix}"] = (
            F.when(step.isNull(), None).when(step == 0, F.lit(float(values[0])))
            .when(step == last, F.lit(float(values[-1]))).otherwise(inside)
        )
    return placed.withColumns(out).drop(*[f"{c}__knot" for c in tables])
