"""Left joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.expressions import as_column
from cohortflow.sources.scratch import estimated_bytes

HOT_SHARE = 0.001  # a key above this share of the rows is handled on its own
HOT_ROWS = 200_000  # ... but only if it also has this many rows
TRACKED_KEYS = 4_096
SAMPLE_BYTES = 1 << 30
LEAST_SAMPLE = 0.001
UNKNOWN_BYTES = 1 << 60  # estimates above this stand for an unknown size
FEW_ROWS = 10_000  # size up to which a side is broadcast


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[as_column(k) for k in keys])


def _keys_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [as_column(k).isNotNull() for k in keys])


def hot_key_hashes(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS
) -> list[int]:
    """Hashes of the keys that hold more than `share` of the rows.

    A frequent-items sketch over the key columns, without a shuffle of rows. A share is
    seen as well in a sample, so large inputs are sampled to keep the sketches small.
    By definition there are at most 1/share such keys; which ones are found decides
    only how the join is carried out."""
    k = int(1 / share)
    present = df.filter(_keys_present(keys)).select(key_hash(keys).alias("h"))
    size = estimated_bytes(present)
    if size < min_rows * 8:  # not even room for one hot key
        return []
    fraction = 1.0 if size > UNKNOWN_BYTES else min(1.0, max(LEAST_SAMPLE, SAMPLE_BYTES / size))
    seen = present if fraction == 1.0 else present.sample(fraction, seed=1)
    found = seen.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {k}, {TRACKED_KEYS})").alias("top")).first()
    floor = max(min_rows * fraction, share * found["n"])
    return [t["item"] for t in (found["top"] or []) if t["count"] >= floor]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join to a side that has one row per key, when the left side may have hot keys.

    Rows of the hot keys meet a broadcast of their (at most 1/share) right rows and
    are never shuffled; all other rows take the ordinary join."""
    keys = list(keys)
    hot = hot_key_hashes(left, keys, share, min_rows)
    if not hot:
        return left.join(right, keys, how)
    is_hot = key_hash(keys).isin(hot)
    # null keys are never hot: their hash is in the list only by collision, so test them first
    left_hot = left.filter(_keys_present(keys) & is_hot)
    left_rest = left.filter(~_keys_present(keys) | ~is_hot)
    few = right.filter(is_hot)
    return left_rest.join(right.filter(~is_hot), keys, how).unionByName(
        left_hot.join(F.broadcast(few), keys, how)
    )


def fanout_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to a side with many rows per key, when one key may hold a third of them.

    Adaptive execution cannot split the right side of a left outer join. Hot keys
    are known to have right rows, so for them the left join equals an inner join,
    which reads the right rows in place against a broadcast of the left ones."""
    keys = list(keys)
    hot = hot_key_hashes(right, keys, share, min_rows)
    if not hot:
        return left.join(right, keys, "left")
    is_hot = key_hash(keys).isin(hot)
    present = _keys_present(keys)
    left_hot, left_rest = left.filter(present & is_hot), left.filter(~present | ~is_hot)
    right_hot, right_rest = right.filter(present & is_hot), right.filter(present & ~is_hot)
    rest = left_rest.join(right_rest, keys, "left")
    hot_left_rows = left_hot.limit(FEW_ROWS + 1).count()
    small = F.broadcast(left_hot) if hot_left_rows <= FEW_ROWS else left_hot
    matched = right_hot.join(small, keys, "inner").select(*rest.columns)
    # a key without right rows gets here only when its hash equals that of a hot key
    unmatched = left_hot.join(F.broadcast(right_hot.select(*keys).distinct()), keys, "left_anti")
    return rest.unionByName(matched).unionByName(unmatched, allowMissingColumns=True)
