"""Exact quantiles that never gather a column in one task.

Every column goes the same way, and neighbouring ranks are interpolated by one formula. A column is
narrowed while more than a bounded number of its values may hold a wanted rank: a pass asks mergeable
sketches for two edges around each wanted rank, a second pass counts the rows at and below those edges
exactly, and only what lies strictly between them goes on. A value that fills a large part of the column
ends the search at once, because the counts show the wanted rank to be that value. All columns and ranks
share the passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GATHER_LIMIT = 1_000_000
SKETCH_ACCURACY = 10_000


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], limit: int = GATHER_LIMIT
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles per column, NULLs ignored; None for a column without values.

    The driver receives counts and edges only. The input is scanned a few times: stage it when it is
    expensive to compute.
    """
    names = [f"v{i}" for i in range(len(columns))]
    values = df.select(*[F.col(c).cast("double").alias(v) for c, v in zip(columns, names)])
    counts = values.agg(*[F.count(v).alias(v) for v in names]).first()
    found: dict[str, list[float | None]] = {v: [None] * len(probabilities) for v in names}
    filled = {v: counts[v] for v in names if counts[v]}
    if filled:
        found |= _interpolated(values, filled, probabilities, limit)
    return {c: found[v] for c, v in zip(columns, names)}


def _interpolated(
    values: DataFrame, counts: dict[str, int], probabilities: Sequence[float], limit: int
) -> dict[str, list[float]]:
    wanted = {v: [(n - 1) * p for p in probabilities] for v, n in counts.items()}
    ranks = {v: sorted({(math.floor(x), math.ceil(x)) for x in xs}) for v, xs in wanted.items()}
    at = values_at_ranks(values, counts, ranks, limit)

    def between(v: str, x: float) -> float:
        low, high = at[v, math.floor(x)], at[v, math.ceil(x)]
        return low + (high - low) * (x - math.floor(x))

    return {v: [between(v, x) for x in xs] for v, xs in wanted.items()}


@dataclass
class _Search:
    """Neighbouring ranks of one column and the open interval that still holds them."""

    column: str
    ranks: list[int]
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    margin: float = 4.0 / SKETCH_ACCURACY
    edges: tuple[float, float] = field(default=(0.0, 0.0))

    def held(self) -> Column:
        """The column's value where it lies in the interval, else NULL."""
        v = F.col(self.column)
        test = v.isNotNull()
        if self.low is not None:
            test = test & (v > self.low)
        if self.high is not None:
            test = test & (v < self.high)
        return F.when(test, v)

    def shares(self) -> list[float]:
        first = (min(self.ranks) - self.below) / self.inside - self.margin
        last = (max(self.ranks) - self.below) / self.inside + self.margin
        return [max(0.0, first), min(1.0, last)]

    def narrow(self, counted: Sequence[int]) -> dict[tuple[str, int], float]:
        """Take the exact counts around the edges; returns the ranks they settle."""
        (a, b), (lt_a, le_a, lt_b, le_b) = self.edges, (self.below + n for n in counted)
        if min(self.ranks) < lt_a or max(self.ranks) >= le_b:
            self.margin = min(1.0, self.margin * 4)  # the sketch missed: look wider
            return {}
        settled = {r: a for r in self.ranks if r < le_a} | {r: b for r in self.ranks if r >= lt_b}
        self.ranks = [r for r in self.ranks if r not in settled]
        self.low, self.high, self.below, self.inside = a, b, le_a, lt_b - le_a
        self.margin = 4.0 / SKETCH_ACCURACY
        return {(self.column, r): value for r, value in settled.items()}


def values_at_ranks(
    values: DataFrame, counts: dict[str, int], ranks: dict[str, list[tuple[int, ...]]], limit: int = GATHER_LIMIT
) -> dict[tuple[str, int], float]:
    """Exact value at zero-based ascending ranks, for groups of neighbouring ranks per column."""
    searches = [_Search(v, sorted(set(group)), counts[v]) for v, groups in ranks.items() for group in groups]
    found: dict[tuple[str, int], float] = {}
    while wide := [s for s in searches if s.ranks and s.inside > limit]:
        sketched = values.agg(
            *[F.percentile_approx(s.held(), s.shares(), SKETCH_ACCURACY).alias(f"e{i}") for i, s in enumerate(wide)]
        ).first()
        for i, search in enumerate(wide):
            search.edges = tuple(sketched[f"e{i}"])
        counted = values.agg(
            *[F.count_if(test) for s in wide for edge in s.edges for test in (s.held() < edge, s.held() <= edge)]
        ).first()
        for i, search in enumerate(wide):
            found |= search.narrow(counted[4 * i : 4 * i + 4])
    rest = [s for s in searches if s.ranks]
    return found | (_gathered(values, rest) if rest else {})


def _gathered(values: DataFrame, searches: list[_Search]) -> dict[tuple[str, int], float]:
    """Settle ranks in intervals of bounded size: equal values are merged before the running total."""
    entries = [
        F.when(s.held().isNotNull(), F.struct(F.lit(i).alias("search"), s.held().alias("v")))
        for i, s in enumerate(searches)
    ]
    merged = values.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("search", "v").agg(
        F.count(F.lit(1)).alias("n")
    )
    running = merged.withColumn("upto", F.sum("n").over(Window.partitionBy("search").orderBy("v")))
    wanted = [
        (i, r, F.min(F.when((F.col("search") == i) & (F.col("upto") > r - s.below), F.col("v"))))
        for i, s in enumerate(searches)
        for r in s.ranks
    ]
    row = running.agg(*[value for _, _, value in wanted]).first()
    return {(searches[i].column, r): row[k] for k, (i, r, _) in enumerate(wanted)}
