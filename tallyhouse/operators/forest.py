"""Isolation Forest (Liu, Ting, Zhou 2008) as Spark jobs.

Fitting samples by hash inside the executors and builds each tree from its at most 256 rows in a
grouped task. The fitted forest is a table of nodes whose size depends on the number of trees alone.
Scoring is a map over Arrow batches. Every random choice is a digest of seed, row and node, so the
result is the same for any partitioning, retry or cluster size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.hashing import unit_interval

NODE_SCHEMA = (
    "tree INT, node INT, feature INT, split DOUBLE, sample_size INT, depth INT, path_nano BIGINT"
)
NANO = 1_000_000_000
_OVERSAMPLE = 3
_EULER = 0.5772156649015329


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


def sample_per_tree(
    features: DataFrame, n_rows: int, n_estimators: int, seed: int, max_samples: int, row_id: str
) -> DataFrame:
    """Rows of every tree's subsample, without replacement, as ``tree`` plus the input columns.

    A hash spreads the rows over slices of about 3 * max_samples each, and tree j draws from slice
    ``j mod slices``: only slices that feed a tree leave the scan, so a huge table sends about
    3 * max_samples * trees rows however large it is. Within its slice a tree takes the rows with the
    smallest per-tree hashes.
    """
    slices = max(1, n_rows // (_OVERSAMPLE * max_samples))
    slice_of_row = F.floor(unit_interval(seed, F.col(row_id)) * F.lit(float(slices)))
    pool = features.filter(slice_of_row < min(slices, n_estimators))
    long = lambda n: F.lit(n).cast("bigint")
    trees = F.sequence(slice_of_row, long(n_estimators - 1), long(slices))
    candidates = pool.select("*", F.explode(trees).alias("tree")).withColumn("tree", F.col("tree").cast("int"))
    draw = unit_interval(seed, F.col("tree"), F.col(row_id))
    order = Window.partitionBy("tree").orderBy("_draw", row_id)
    return (
        candidates.withColumn("_draw", draw)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= max_samples)
        .drop("_draw", "_rank")
    )


def fit_isolation_forest(
    features: DataFrame,
    columns: Sequence[str] = S.FEATURES,
    n_estimators: int = S.N_ESTIMATORS,
    seed: int = S.SEED,
    max_samples: int = S.MAX_SAMPLES,
    n_rows: int | None = None,
    row_id: str = "row_seq",
) -> DataFrame:
    """Node table of the fitted forest, lazily. ``n_rows`` saves a count when it is known."""
    if n_estimators < 1:
        raise ValueError("n_estimators must be at least 1")
    n = features.count() if n_rows is None else n_rows
    psi = max(1, min(max_samples, n))
    height = math.ceil(math.log2(max(psi, 2)))
    inputs = features.select(row_id, *[F.col(c).cast("double").alias(c) for c in columns])
    sample = sample_per_tree(inputs, n, n_estimators, seed, psi, row_id)
    build = _tree_builder(tuple(columns), seed, height, row_id)
    return sample.groupBy("tree").applyInPandas(build, NODE_SCHEMA)


def _tree_builder(columns: tuple[str, ...], seed: int, height: int, row_id: str):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        points = rows.sort_values(row_id)[list(columns)].to_numpy(dtype="float64")
        nodes = list(_grow(points, tree, seed, height))
        return pd.DataFrame(nodes, columns=[f.split()[0] for f in NODE_SCHEMA.split(", ")])

    return build


def _grow(points: np.ndarray, tree: int, seed: int, height: int) -> Iterator[tuple]:
    """Nodes of one tree, numbered as in a heap (children of k are 2k+1 and 2k+2)."""
    open_nodes = [(0, 0, points)]
    while open_nodes:
        node, depth, part = open_nodes.pop()
        size = len(part)
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth == height or size <= 1 or splittable.size == 0:
            path = math.floor((depth + expected_path(size)) * NANO + 0.5)
            yield tree, node, -1, None, size, depth, path
            continue
        pick, cut = _two_draws(seed, tree, node)
        feature = int(splittable[math.floor(pick * splittable.size)])
        lo, hi = float(low[feature]), float(high[feature])
        split = lo + cut * (hi - lo)
        if not split < hi:
            split = lo
        yield tree, node, feature, split, size, depth, None
        left = part[:, feature] <= split
        open_nodes.append((2 * node + 1, depth + 1, part[left]))
        open_nodes.append((2 * node + 2, depth + 1, part[~left]))


def _two_draws(seed: int, tree: int, node: int) -> tuple[float, float]:
    digest = hashlib.md5(f"{seed}|{tree}|{node}|node".encode()).hexdigest()
    return int(digest[:8], 16) / 2.0**32, int(digest[8:16], 16) / 2.0**32


class ForestModel:
    """Fitted forest on the driver: node arrays of trees * (2^(height+1) - 1) slots, no data rows."""

    def __init__(self, nodes: pd.DataFrame, columns: Sequence[str]):
        self.columns = tuple(columns)
        self.trees = int(nodes["tree"].max()) + 1
        self.sample_size = int(nodes.loc[nodes["node"] == 0, "sample_size"].max())
        self.height = int(nodes["depth"].max())
        slots = 2 ** (self.height + 1) - 1
        at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
        inner = nodes["feature"].to_numpy() >= 0
        # Leaves lead back to themselves, so every walk takes the same number of steps.
        self.feature = np.zeros((self.trees, slots), dtype=np.int64)
        self.split = np.full((self.trees, slots), np.inf)
        self.path = np.zeros((self.trees, slots), dtype=np.int64)
        self.left = np.tile(np.arange(slots), (self.trees, 1))
        self.feature[at] = np.where(inner, nodes["feature"].to_numpy(), 0)
        self.split[at] = np.where(inner, nodes["split"].to_numpy(dtype="float64"), np.inf)
        self.path[at] = nodes["path_nano"].fillna(0).to_numpy(dtype=np.int64)
        self.left[at] = np.where(inner, 2 * at[1] + 1, at[1])

    @classmethod
    def collect(cls, nodes: DataFrame, columns: Sequence[str] = S.FEATURES) -> ForestModel:
        """Bring the node table to the driver (at most 511 small rows per tree)."""
        return cls(nodes.toPandas(), columns)

    def path_sums(self, points: np.ndarray) -> np.ndarray:
        """Sum over the trees of each row's path length, in billionths (an exact integer).

        All steps write into the same arrays, and the first one, which all rows take from the root, needs no
        look-ups. Places are always inside the tables, so that ``clip`` only leaves out their check.
        """
        n = len(points)
        total, node, other = (np.zeros(n, dtype=np.int64) for _ in range(3))
        value, bound, right = np.empty(n), np.empty(n), np.empty(n, dtype=bool)
        flat = np.ascontiguousarray(points, dtype=np.float64).ravel()
        columns = np.ascontiguousarray(np.asarray(points, dtype=np.float64).T)
        first = np.arange(n) * points.shape[1]
        for feature, split, left, path in zip(self.feature, self.split, self.left, self.path):
            np.greater(columns[feature[0]], split[0], out=right)
            np.add(right, left[0], out=node)
            for _ in range(self.height - 1):
                np.take(feature, node, out=other, mode="clip")
                np.add(other, first, out=other)
                np.take(flat, other, out=value, mode="clip")
                np.take(split, node, out=bound, mode="clip")
                np.greater(value, bound, out=right)
                np.take(left, node, out=other, mode="clip")
                np.add(other, right, out=node)
            np.take(path, node, out=other, mode="clip")
            total += other
        return total


def raw_score(path_sum: Column, trees: int, sample_size: int) -> Column:
    """Negated anomaly score -2^(-E[h]/c): the lower, the more anomalous."""
    unit = expected_path(sample_size) or 1.0
    return -F.pow(F.lit(2.0), -(path_sum.cast("double") / F.lit(float(trees) * NANO)) / F.lit(unit))


def score_forest(features: DataFrame, model: ForestModel, name: str = "raw_score") -> DataFrame:
    """Add ``path_sum`` and the raw score to every row; a map over Arrow batches, no shuffle."""

    @F.pandas_udf("bigint")
    def path_sum(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(model.path_sums(np.column_stack([c.to_numpy(dtype="float64") for c in columns])))

    inputs = [F.col(c).cast("double") for c in model.columns]
    scored = features.withColumn("path_sum", path_sum(*inputs))
    return scored.withColumn(name, raw_score(F.col("path_sum"), model.trees, model.sample_size))
