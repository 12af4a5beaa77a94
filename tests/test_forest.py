"""Isolation Forest: properties, and independence of partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.operators import forest, scoring
from tallyhouse.plans import anomaly_report

COLUMNS = ("x", "y")


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))]
    rows += [(3000 + i, 40.0 + i, -35.0 - i) for i in range(10)]
    return spark.createDataFrame(rows, "row_seq BIGINT, x DOUBLE, y DOUBLE")


def fit(df, **options):
    return forest.ForestModel.collect(forest.fit_isolation_forest(df, COLUMNS, **options), COLUMNS)


def test_planted_outliers_score_worst(points):
    scored = forest.score_forest(points, fit(points))
    worst = {r.row_seq for r in scored.orderBy("raw_score").limit(10).collect()}
    assert worst == set(range(3000, 3010))
    low, high = scored.agg(F.min("raw_score"), F.max("raw_score")).first()
    assert -1.0 <= low < high < 0.0


def test_any_partitioning_gives_the_same_forest_and_scores(points):
    nodes = [sorted(map(tuple, forest.fit_isolation_forest(df, COLUMNS, n_estimators=20).collect()), key=lambda n: n[:2])
             for df in (points.coalesce(1), points.repartition(13, "x"))]
    assert nodes[0] == nodes[1]
    model = fit(points, n_estimators=20)
    a = forest.score_forest(points.coalesce(1), model).orderBy("row_seq").collect()
    b = forest.score_forest(points.repartition(9), model).orderBy("row_seq").collect()
    assert a == b


def test_seed_changes_the_forest(points):
    a, b = (forest.fit_isolation_forest(points, COLUMNS, n_estimators=3, seed=s).collect() for s in (1, 2))
    assert sorted(map(str, a)) != sorted(map(str, b))


def test_every_tree_gets_a_full_sample_without_repeats(points):
    sample = forest.sample_per_tree(points, 3010, 40, 42, 256, "row_seq")
    per_tree = sample.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("row_seq").alias("d")).collect()
    assert len(per_tree) == 40 and {(r.n, r.d) for r in per_tree} == {(256, 256)}


def test_only_the_feeding_slices_leave_a_large_scan(spark):
    big = spark.range(2_000_000).select(F.col("id").alias("row_seq"), F.col("id").cast("double").alias("x"))
    sample = forest.sample_per_tree(big, 2_000_000, 4, 42, 16, "row_seq")
    assert sample.groupBy("tree").count().collect() and sample.count() == 4 * 16
    assert sample.agg(F.avg("row_seq")).first()[0] == pytest.approx(1_000_000, rel=0.3)


def test_tree_shape(points):
    nodes = forest.fit_isolation_forest(points, COLUMNS, n_estimators=5).toPandas()
    assert nodes["depth"].max() <= 8
    for _, tree in nodes.groupby("tree"):
        by_node = tree.set_index("node")
        inner = tree[tree["feature"] >= 0]
        for row in inner.itertuples():
            children = by_node.loc[[2 * row.node + 1, 2 * row.node + 2], "sample_size"]
            assert (children > 0).all() and children.sum() == row.sample_size


@pytest.mark.parametrize("n", [1, 2, 5])
def test_tiny_and_constant_inputs(spark, n):
    df = spark.range(n).select(F.col("id").alias("row_seq"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    scored = forest.score_forest(df, fit(df, n_estimators=4))
    assert scored.select("raw_score").distinct().count() == 1
    normal = scoring.normalize_scores(scored)
    assert {r.severity for r in normal.collect()} == {0.0}


def test_expected_path_lengths():
    assert [forest.expected_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert forest.expected_path(256) == pytest.approx(10.244770920119)


def test_contamination_share_and_status(points):
    scored = forest.score_forest(points, fit(points)).withColumn("dq_issue_flag", F.col("row_seq") == 3000)
    classified = anomaly_report.classify_lines(scored, 0.05)
    shares = {r.system_status: r["count"] for r in classified.groupBy("system_status").count().collect()}
    assert shares[S.STATUS_QUALITY] == 1
    assert abs((shares[S.STATUS_ANOMALY] + 1) / 3010 - 0.05) < 0.01
    row = classified.filter("row_seq = 3000").first()
    assert (row.ml_anomaly_pred, row.ml_anomaly_label) == (-1, S.LABEL_ANOMALY)
    ends = classified.agg(F.min("severity"), F.max("severity")).first()
    assert tuple(ends) == (0.0, 1.0)


def test_histogram_always_has_ten_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.95,), (1.0,)], "severity DOUBLE")
    rows = scoring.score_histogram(df).collect()
    assert [r["count"] for r in rows] == [2] + [0] * 8 + [2]
    assert [r.bin_end for r in rows if r.flagged] == [0.7, 0.8, 0.9, 1.0]


def test_ties_at_the_cut_stay_normal(spark):
    df = spark.createDataFrame([(-1.0,)] * 3 + [(-0.5,)] * 7, "raw_score DOUBLE")
    cut = scoring.threshold(df, 0.2)
    assert cut == -1.0
    assert scoring.predict(df, cut).filter("ml_anomaly_pred = -1").count() == 0
    with pytest.raises(ValueError):
        scoring.threshold(df, 0.0)
