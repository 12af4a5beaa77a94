"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order; NULL keys count as equal.

    ``row_number() = 1`` is planned with a group limit on both sides of the exchange: each map task
    sends at most one row per key, so a key with a third of all rows costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def count_distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys, NULLs counted as a value, as a one-row frame ``n``."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n"))


def repeated_keys(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Keys that occur more than once (as ``_k0``, ``_k1``, ...) with their first position ``_first``."""
    return (
        df.groupBy(*keys)
        .agg(F.min(seq).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
    )


def later_copies(
    df: DataFrame, keys: Sequence[str], seq: str, flag: str, repeats: DataFrame | None = None
) -> DataFrame:
    """Boolean column: true on the second and later occurrence of a key in ``seq`` order, NULLs equal.

    Every row stays, so a window would gather a hot key in one task. Instead the first position of
    each *repeated* key is found with a map-side aggregate and joined back: usually a small side,
    otherwise a shuffled join whose hot partitions the adaptive plan splits.
    """
    firsts = repeated_keys(df, keys, seq) if repeats is None else repeats
    same_key = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = df.join(firsts, same_key, "left")
    is_copy = F.coalesce(F.col(seq) > F.col("_first"), F.lit(False))
    return joined.withColumn(flag, is_copy).drop("_first", *[f"_k{i}" for i in range(len(keys))])
