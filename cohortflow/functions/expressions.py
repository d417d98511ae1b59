"""Column expressions. Everything here stays inside JVM codegen."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin edges and labels of the two reported distributions.
AGE_EDGES = (0, 20, 30, 40, 50, 60, 70, 80, 90, 100, 150)
AGE_LABELS = ("0-20", "20-30", "30-40", "40-50", "50-60", "60-70", "70-80", "80-90", "90-100", "100+")
LOS_EDGES = (0, 2, 4, 6, 8, 10, 15, 20, 25, 30, 100)
LOS_LABELS = ("0-2", "2-4", "4-6", "6-8", "8-10", "10-15", "15-20", "20-25", "25-30", "30+")

DAYS_PER_YEAR = 365.25
MAX_AGE = 120
_DECIMAL_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_TWO_POW_52 = float(2**52)


def as_column(c: Column | str) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Name usable in F.col even when it holds dots or spaces (dummy columns do)."""
    return "`" + name.replace("`", "``") + "`"


def age_years(admitted: Column | str, born: Column | str, cap: int = MAX_AGE) -> Column:
    """Whole years between two dates, truncated toward zero and capped; null stays null."""
    days = F.datediff(as_column(admitted), as_column(born))
    years = (days / F.lit(DAYS_PER_YEAR)).cast("int")
    return cap_at(years, cap)


def cap_at(c: Column | str, upper) -> Column:
    c = as_column(c)
    return F.when(c > upper, F.lit(upper)).otherwise(c)


def clip(c: Column | str, lower, upper) -> Column:
    """Limit to [lower, upper]. A null value stays null, a null bound does not limit
    (least/greatest would instead return the bound for a null value)."""
    c = as_column(c)
    bounded = F.least(F.greatest(c, as_bound(lower)), as_bound(upper))
    return F.when(c.isNotNull(), bounded)


def as_bound(b) -> Column:
    return b if isinstance(b, Column) else F.lit(b).cast("double")


def finite_or_null(c: Column | str) -> Column:
    """NaN and both infinities become null."""
    c = as_column(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(math.inf)), c)


def parse_number(c: Column | str) -> Column:
    """Text to double, null when the text is no plain decimal number.

    The pattern keeps out forms that the JVM parser takes but a decimal
    reader does not ('1d', '0x1p3', 'NaN', 'Infinity')."""
    c = as_column(c).cast("string")
    return F.when(c.rlike(_DECIMAL_NUMBER), F.trim(c).try_cast("double"))


def number_or_zero(c: Column | str) -> Column:
    return F.coalesce(parse_number(c), F.lit(0.0))


def target_flag(c: Column | str, kind: str = "string") -> Column:
    """Outcome as an integer: unparsable or null counts as 0. kind: the column's type; whole numbers need no parsing."""
    if kind in ("tinyint", "smallint", "int"):
        return F.coalesce(as_column(c).cast("int"), F.lit(0))
    return number_or_zero(c).cast("int")


def bin_index(c: Column | str, edges: Sequence[float]) -> Column:
    """0-based half-open bin [edge, next edge); null outside all bins."""
    c = as_column(c)
    out = F.when(c.isNull() | (c < edges[0]), None)
    for i, upper in enumerate(edges[1:]):
        out = out.when(c < upper, F.lit(i))
    return out.cast("int")


def bin_label(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    c = as_column(c)
    out = F.when(c.isNull() | (c < edges[0]), None)
    for upper, label in zip(edges[1:], labels, strict=True):
        out = out.when(c < upper, F.lit(label))
    return out


def yeo_johnson(c: Column | str, lam: float) -> Column:
    """Yeo-Johnson power transform for a fixed lambda (Yeo & Johnson 2000)."""
    c = as_column(c)
    log_size = F.log1p(F.abs(c))
    up = log_size if lam == 0 else F.expm1(log_size * F.lit(float(lam))) / F.lit(float(lam))
    mirror = 2.0 - lam
    down = log_size if abs(mirror) < 1e-12 else F.expm1(log_size * F.lit(mirror)) / F.lit(mirror)
    return F.when(c >= 0, up).otherwise(-down)


def row_sum(columns: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for name in columns:
        total = total + F.coalesce(as_column(name).cast("double"), F.lit(0.0))
    return total


def null_count(columns: Sequence[str]) -> Column:
    """How many of the columns are missing in this row."""
    total = F.lit(0)
    for name in columns:
        total = total + as_column(name).isNull().cast("int")
    return total


def hash_key(seed: int | str, *parts: Column | str) -> Column:
    """Seeded md5 of a row key: the deterministic order behind splits, folds and draws."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[as_column(p).cast("string") for p in parts]))


def uniform(seed: int | str, *parts: Column | str) -> Column:
    """Uniform draw in [0, 1) that depends only on seed and key, so a lost task redraws the same."""
    digits = F.substring(hash_key(seed, *parts), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(_TWO_POW_52)


def standard_normal(seed: int | str, *parts: Column | str) -> Column:
    """Box-Muller normal from two keyed uniforms."""
    first = F.greatest(uniform(f"{seed}a", *parts), F.lit(1.0 / _TWO_POW_52))
    second = uniform(f"{seed}b", *parts)
    return F.sqrt(F.lit(-2.0) * F.log(first)) * F.cos(F.lit(2.0 * math.pi) * second)


def positive_probability(columns: Sequence[str]) -> Column:
    """Probability of class 1, or the decision value when the model has no probability."""
    from pyspark.ml.functions import vector_to_array

    source = "probability" if "probability" in columns else "rawPrediction"
    return vector_to_array(F.col(source))[1]
