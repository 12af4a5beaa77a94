"""Quality rules and features of retail lines."""

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.operators import features, quality
from tallyhouse.sources.staging import stage

COLUMNS = "row_seq BIGINT, InvoiceNo STRING, StockCode STRING, Description STRING, Quantity STRING, InvoiceDate STRING, UnitPrice STRING, CustomerID STRING, Country STRING"
GOOD = ("536365", "85123A", "HOLDER", "6", "2010-12-01 08:26:00", "2.55", "17850", "France")
FIELDS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country")


def lines(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = dict(zip(FIELDS, GOOD)) | {"InvoiceNo": str(100 + i)} | change
        rows.append((i, *[row[f] for f in FIELDS]))
    return spark.createDataFrame(rows, COLUMNS)


CASES = [
    ({}, []),
    ({"CustomerID": None}, [S.MISSING_CUSTOMER]),
    ({"Description": " \t"}, [S.MISSING_DESCRIPTION]),
    ({"Description": None}, [S.MISSING_DESCRIPTION]),
    ({"Quantity": "-2"}, [S.NEGATIVE_QUANTITY]),
    ({"Quantity": "-2", "InvoiceNo": "C77"}, []),
    ({"Quantity": "many"}, [S.NEGATIVE_QUANTITY]),
    ({"Quantity": None}, [S.NEGATIVE_QUANTITY]),
    ({"Quantity": "1.0d"}, [S.NEGATIVE_QUANTITY]),
    ({"Quantity": "NaN"}, [S.NEGATIVE_QUANTITY]),
    ({"Quantity": "-2", "InvoiceNo": None}, [S.NEGATIVE_QUANTITY]),
    ({"UnitPrice": "0"}, [S.BAD_PRICE]),
    ({"UnitPrice": "0.005"}, []),
    ({"UnitPrice": "50000"}, []),
    ({"UnitPrice": "50000.01"}, [S.BAD_PRICE]),
    ({"UnitPrice": None}, [S.BAD_PRICE]),
    ({"InvoiceDate": "INVALID_TIMESTAMP"}, [S.BAD_DATE]),
    ({"InvoiceDate": "2024-99-99 25:99:99"}, [S.BAD_DATE]),
    ({"InvoiceDate": "12/1/2010 8:26"}, []),
    ({"InvoiceDate": "12/1/2010"}, []),
    ({"InvoiceDate": "12/01/2010 08:26:00"}, []),
    ({"InvoiceDate": "2010/12/01"}, []),
    ({"InvoiceDate": "1-Dec-2010"}, []),
    ({"InvoiceDate": "Dec 1, 2010"}, []),
    ({"InvoiceDate": "20101201"}, []),
    ({"InvoiceDate": "13/32/2010"}, [S.BAD_DATE]),
    ({"InvoiceDate": None}, []),
    ({"Country": "uk"}, [S.BAD_COUNTRY]),
    ({"Country": "U.K."}, [S.BAD_COUNTRY]),
    ({"Country": "France\t"}, [S.BAD_COUNTRY]),
    ({"Country": None}, []),
    (
        {"CustomerID": None, "Description": "", "Quantity": "-1", "UnitPrice": "-1", "InvoiceDate": "x", "Country": " a"},
        [S.MISSING_CUSTOMER, S.MISSING_DESCRIPTION, S.NEGATIVE_QUANTITY, S.BAD_PRICE, S.BAD_DATE, S.BAD_COUNTRY],
    ),
]


def test_each_rule(spark):
    df = lines(spark, *[change for change, _ in CASES])
    found = {r.row_seq: r.dq_reasons for r in quality.with_reasons(df).collect()}
    for i, (change, expected) in enumerate(CASES):
        assert found[i] == expected, change
    flags = {r.row_seq: (r.dq_issue_flag, r.dq_issue_reason) for r in quality.dq_flag(df).collect()}
    for i, (_, expected) in enumerate(CASES):
        assert flags[i] == (bool(expected), ", ".join(expected) or None)
    listed = {r.row_index: r.reasons for r in quality.dq_issue_list(df).collect()}
    assert listed == {i: e for i, (_, e) in enumerate(CASES) if e}
    counted = {r.rule: r.row_count for r in quality.dq_rule_breakdown(df).collect()}
    assert counted == {label: sum(label in e for _, e in CASES) for label in counted} and len(counted) == 6


def test_duplicates_are_later_rows_with_nulls_equal(spark):
    same = {"InvoiceNo": "9", "InvoiceDate": None}
    df = lines(spark, same, {}, same, dict(same, StockCode="other"), same).repartition(3)
    flags = {r.row_seq: r.dq_issue_reason for r in quality.dq_flag(df).collect()}
    assert flags == {0: None, 1: None, 2: S.DUPLICATE_ROW, 3: None, 4: S.DUPLICATE_ROW}
    assert {r.rule: r.row_count for r in quality.dq_rule_breakdown(df, True).collect()} == {S.DUPLICATE_ROW: 2}
    assert quality.dq_rule_breakdown(df).count() == 0


def test_hot_duplicate_key_against_brute_force(spark):
    rng = random.Random(3)
    keys = [("hot" if rng.random() < 0.4 else str(rng.randrange(300))) for _ in range(3000)]
    df = lines(spark, *[{"InvoiceNo": k} for k in keys]).repartition(5)
    seen, expected = set(), set()
    for i, k in enumerate(keys):
        (expected if k in seen else seen).add(i if k in seen else k)
    found = {r.row_seq for r in quality.flag_duplicates(df).filter("is_duplicate").select("row_seq").collect()}
    assert found == expected


def test_features_of_the_three_row_case(spark):
    rows = [
        (0, "10001", "85123A", "a", "2", None, "15.0", "12345", "United Kingdom"),
        (1, "10002", "71053", "b", "10", None, "50.0", "12345", "United Kingdom"),
        (2, "10003", "84406B", "c", "1", None, "5.0", "67890", "France"),
    ]
    got = features.line_features(spark.createDataFrame(rows, COLUMNS)).orderBy("row_seq").select(*S.FEATURES).collect()
    assert [tuple(r) for r in got] == [
        (30.0, 2.0, 15.0, 2.0, 530.0, 265.0, 2.0),
        (500.0, 10.0, 50.0, 2.0, 530.0, 265.0, 2.0),
        (5.0, 1.0, 5.0, 1.0, 5.0, 5.0, 1.0),
    ]


def test_feature_defaults_and_normalised_keys(spark):
    df = lines(
        spark,
        {"Quantity": "x", "UnitPrice": "2", "CustomerID": None, "Country": " france "},
        {"Quantity": "3", "UnitPrice": "1e999", "CustomerID": None, "Country": "FRANCE", "InvoiceNo": None},
        {"CustomerID": "7", "Country": None},
    )
    got = {r.row_seq: r for r in features.line_features(df).collect()}
    assert (got[0].Quantity, got[0].UnitPrice, got[1].UnitPrice) == (1.0, 2.0, 0.0)
    assert (got[0].CustomerPurchaseFrequency, got[1].CustomerTotalSpend) == (2.0, 2.0)
    assert (got[0].CountryTransactionCount, got[1].CountryTransactionCount, got[2].CountryTransactionCount) == (1.0, 1.0, 1.0)


SHUFFLED = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    spark__sql__adaptive__coalescePartitions__enabled="false",
    spark__sql__shuffle__partitions="12",
)


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("staged", [False, True])
def test_hot_customer_is_split_by_the_adaptive_plan(spark, conf, staged):
    """A third of the lines is anonymous; the shuffled join back must split their partition."""
    conf(**SHUFFLED)
    wide = spark.range(0, 40000, 1, 8).select(
        F.col("id").alias("row_seq"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("CustomerID"),
        F.lit(2.0).alias("TotalAmount"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    stats = stage(features.customer_stats(wide), "stats") if staged else None
    joined = features.customer_features(wide, stats)
    plan = executed_plan(joined)
    assert "skew=true" in plan.split("Initial Plan")[0]
    guests = joined.filter("CustomerID IS NULL").agg(F.count("*"), F.min("CustomerTotalSpend"), F.max("CustomerTotalSpend"))
    assert tuple(guests.first()) == (13334, 26668.0, 26668.0)
    assert joined.count() == 40000


def test_hot_repeated_line_is_split_by_the_adaptive_plan(spark, conf):
    conf(**SHUFFLED)
    n = F.col("id")
    wide = spark.range(0, 40000, 1, 8).select(
        n.alias("row_seq"),
        F.when(n % 3 == 0, F.lit("hot")).otherwise(n.cast("string")).alias("InvoiceNo"),
        F.lit("s").alias("StockCode"),
        F.lit(None).cast("string").alias("InvoiceDate"),
        F.sha2(n.cast("string"), 256).alias("payload"),
    )
    flagged = quality.flag_duplicates(wide)
    assert "skew=true" in executed_plan(flagged).split("Initial Plan")[0]
    assert flagged.filter("is_duplicate").count() == 13333


def test_median_imputation(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None), (10.0, None)], "a DOUBLE, b DOUBLE")
    got = [tuple(r) for r in features.impute_median(df, ["a", "b"]).collect()]
    assert got == [(1.0, 0.0), (4.0, 0.0), (4.0, 0.0), (10.0, 0.0)]


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_scaling(spark, limit):
    df = spark.createDataFrame([(float(x), 5.0) for x in range(9)], "a DOUBLE, b DOUBLE")
    got = features.robust_scale(df, ["a", "b"], limit=limit).orderBy("a").collect()
    assert [r.a_scaled for r in got] == [(x - 4) / 4 for x in range(9)]
    assert {r.b_scaled for r in got} == {0.0}
    standard = features.standard_scale(df, ["a", "b"]).orderBy("a").collect()
    assert abs(standard[8].a_scaled - 4 / (60 / 9) ** 0.5) < 1e-12
    assert standard[0].b_scaled == 0.0


def test_line_features_move_no_line(spark, tmp_path):
    """Statistics come from one pass; joining them back exchanges none of the lines."""
    rng = random.Random(8)
    changes = [{"CustomerID": rng.choice([None, "7", str(rng.randrange(50))]), "Country": rng.choice(["France", " uk", None]),
                "InvoiceNo": rng.choice([None, str(i)]), "UnitPrice": f"{i % 9}.25"} for i in range(600)]
    lines(spark, *changes).repartition(4).write.parquet(str(tmp_path / "lines"))
    df = spark.read.parquet(str(tmp_path / "lines"))
    featured = features.line_features(df)
    plan = executed_plan(featured).split("Initial Plan")[0]
    assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    amounts = features.line_amounts(df)
    apart = features.line_features(df, stage(features.customer_stats(amounts), "a"), stage(features.country_stats(df), "b"))
    assert sorted(map(str, featured.collect())) == sorted(map(str, apart.select(*featured.columns).collect()))
    spend = {}
    for c in changes:
        spend[c["CustomerID"]] = spend.get(c["CustomerID"], 0) + 6 * float(c["UnitPrice"])
    assert all(abs(r.CustomerTotalSpend - spend[r.CustomerID]) < 1e-9 for r in featured.collect())


def test_dates_are_read_as_by_every_layout(spark):
    """The marks of a layout leave out only texts that do not fit it; a text without marks costs no exception."""
    from tallyhouse.functions import rules

    texts = ["2010-12-01 08:26:00", "12/1/2010 8:26", "12/31/2010", "2010/1/2 3:04:05", "13/13/2010", "1-Dec-2010", "01-dec-2010 9:05",
             "1-12-2010", "Dec 1, 2010", "dec 31, 2010 10:00", "20101201", "+20101201", "-20101201", "20101301", "2010120", "x20101201",
             "2024-99-99 25:99:99", "INVALID_TIMESTAMP", "", " ", "/", "-", ",", "1", "2010-12", " 20101201", "1/2/10"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t STRING")
    every = F.coalesce(F.col("t").try_cast("timestamp"), *[F.try_to_timestamp("t", F.lit(x)) for x in rules.DATE_LAYOUTS])
    rows = df.select("t", rules.parse_date(F.col("t")).cast("string").alias("a"), every.cast("string").alias("b")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]
    assert sum(r.a is not None for r in rows) >= 11


def test_report_reads_the_lines_no_more_often_than_it_must(spark):
    """Statistics, repeats, sample and scores; the staged customers tell the number of lines and the gaps."""
    from tallyhouse.plans import anomaly_report

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    some = lines(spark, *[{"Quantity": str(k), "CustomerID": str(k % 7), "Country": f" C{k % 3} "} for k in range(40)]).coalesce(1)
    scored = anomaly_report.score_lines(some.mapInPandas(count, some.schema), anomaly_report.ModelSettings(n_estimators=3))
    assert scored.count() == 40 and scored.where("CountryTransactionCount BETWEEN 13 AND 14").count() == 40
    seen.value = 0
    stored = stage(anomaly_report.score_lines(some.mapInPandas(count, some.schema), anomaly_report.ModelSettings(n_estimators=3)), "scored")
    assert stored.count() == 40 and seen.value == 160


def test_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    from suite import feed, layers, sheets

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(feed, "ROWS_PER_TASK", 500)
    n = -(-feed.read(spark, folder, "lineitem").count() // 500)
    assert feed.read_lines(spark, folder, "l_orderkey").rdd.getNumPartitions() == n
    assert layers.Layers(spark, folder)["silver_sales"].rdd.getNumPartitions() == n
    monkeypatch.setattr(sheets, "ROWS_PER_TASK", 10)
    parts = spark.range(200).withColumn("x", F.lit("y"))
    books = sheets.as_workbooks(parts, "S", F.floor(F.col("id") / 5), ["id"])
    assert books.rdd.getNumPartitions() == 20 and books.count() == 40
