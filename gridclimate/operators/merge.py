"""Keep-first merging of observations.

Everything here is a hash aggregate with map-side combining, not a ranking
window: a stamp delivered a billion times collapses before the shuffle instead
of landing in one sorted task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: str, values: list[str] | None = None) -> DataFrame:
    """One row per key: the one with the smallest `order`, NULL values included."""
    values = values or [c for c in df.columns if c not in (*keys, order)]
    return df.groupBy(*keys).agg(*[F.min_by(v, order).alias(v) for v in values], F.min(order).alias(order))


def merge_keep_first(frames: list[DataFrame], keys: list[str], order: str, value: str = "value") -> DataFrame:
    """Merge frames where an earlier frame wins, even with a NULL value.

    Within a frame the smallest `order` wins. The winner's frame number is
    returned as `source`.
    """
    tagged = [f.select(*keys, order, value, F.lit(i).alias("_src")) for i, f in enumerate(frames)]
    stacked = reduce(DataFrame.unionByName, tagged)
    mine = [F.when(F.col("_src") == i, F.col(order)) for i in range(len(frames))]
    merged = stacked.groupBy(*keys).agg(
        F.min("_src").alias("source"),
        *[F.min_by(value, o).alias(f"_v{i}") for i, o in enumerate(mine)])
    pick = reduce(lambda acc, i: acc.when(F.col("source") == i, F.col(f"_v{i}")),
                  range(1, len(frames)), F.when(F.col("source") == 0, F.col("_v0")))
    return merged.select(*keys, pick.alias(value), "source")


def fill_null_merge(df: DataFrame, keys: list[str], order: str, value: str = "value") -> DataFrame:
    """One row per key: the first non-NULL value by `order`, NULL if there is none."""
    present = F.when(F.col(value).isNotNull(), F.col(order))
    return df.groupBy(*keys).agg(F.min_by(value, present).alias(value), F.min(order).alias(order))


def not_held(rows: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not held yet; `rows` must be unique per key.

    The held side is first cut to the keys the rows mention. That semi join
    streams the big side past the small one, so the store is neither built into
    a hash table nor, when the batch is small, shuffled.
    """
    touched = held.select(*keys).join(rows.select(*keys), keys, "left_semi")
    return rows.join(touched, keys, "left_anti")


def new_rows(batch: DataFrame, held: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of the batch, first one per key, whose key is not held yet."""
    return not_held(keep_first(batch, keys, order), held, keys)


def union_columns(*frames: DataFrame) -> DataFrame:
    """Stack frames with different columns; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
