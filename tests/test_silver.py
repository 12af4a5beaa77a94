"""Cleansing, validation and deduplication."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import cleansing, dedup, validation
from tallyhouse.sources.staging import new_path
from tallyhouse.sources.tables import append_log, read_table

MOMENT = datetime(2024, 1, 2, 3, 4, 5)
SALES = "transaction_id STRING, quantity INT, unit_price DECIMAL(12,2), payment_method STRING, row_seq BIGINT"


def sales(spark, *rows):
    return spark.createDataFrame([(a, b, Decimal(c), d, i) for i, (a, b, c, d) in enumerate(rows)], SALES)


@pytest.fixture
def dirty(spark):
    return sales(
        spark,
        ("TXN-1", 2, "50.0", "Credit Card"),
        ("TXN-1", 2, "50.0", "Credit Card"),
        ("TXN-2", -5, "20.0", "Cash"),
        ("TXN-3", 1, "10.0", None),
    )


def test_sales_metrics_of_the_four_row_case(dirty):
    m = validation.sales_metrics(dirty).first()
    assert (m.initial_records, m.duplicates_removed, m.invalid_qty_removed, m.imputed_fields, m.final_records) == (
        4, 1, 1, 1, 2,
    )
    assert m.pass_rate == 50.0


def test_missing_quantity_is_dropped_and_counted_apart(spark):
    rows = sales(spark, ("A", None, "1.0", "Cash"), ("B", 0, "1.0", "Cash"), ("C", 1, "0.00", "Cash"))
    m = validation.sales_metrics(rows).first()
    assert (m.invalid_qty_removed, m.missing_qty_removed, m.final_records, m.invalid_price) == (1, 1, 1, 1)
    assert [r.transaction_id for r in cleansing.filter_quantity(rows).collect()] == ["C"]


def test_metrics_of_an_empty_feed_have_no_pass_rate(spark):
    m = validation.sales_metrics(spark.createDataFrame([], SALES)).first()
    assert (m.initial_records, m.final_records, m.pass_rate) == (0, 0, None)


def test_log_lists_violated_rules_only_and_a_rerun_does_not_double_it(spark, dirty):
    customers = spark.createDataFrame([("C1", None, 0), ("C2", "x@y.z", 1)], "customer_id STRING, email STRING, row_seq BIGINT")
    log = validation.full_validation_log(
        validation.sales_metrics(dirty), validation.customer_metrics(customers), "BATCH-1", MOMENT
    )
    rules = [(r.dataset, r.rule, r.severity, r.affected_records) for r in log.orderBy("seq").collect()]
    assert rules == [
        ("sales", "Deduplication", "HIGH", 1),
        ("sales", "Quantity Bounds Check", "HIGH", 1),
        ("sales", "Null Imputation", "MEDIUM", 1),
        ("customers", "Email Imputation", "LOW", 1),
    ]
    root = new_path(spark, "test-log")
    append_log(log, root)
    append_log(log, root)
    append_log(log.withColumn("batch_id", F.lit("BATCH-2")), root)
    stored = read_table(spark, "silver_validation_log", root)
    assert stored.count() == 8
    newest = validation.latest_validation_logs(stored, 1).first()
    assert (newest.batch_id, newest.rule) == ("BATCH-2", "Email Imputation")


def test_standardised_sales(spark):
    rows = spark.createDataFrame(
        [("2024-03-05 17:08:09", 3, Decimal("19.99"))], "timestamp STRING, quantity INT, unit_price DECIMAL(12,2)"
    )
    r = cleansing.standardize_sales(rows).first()
    assert (str(r.transaction_date), r.transaction_hour, r.gross_amount) == ("2024-03-05", 17, Decimal("59.97"))


def test_unreadable_sale_timestamp_aborts(spark):
    rows = spark.createDataFrame([("no date", 3, Decimal("1"))], "timestamp STRING, quantity INT, unit_price DECIMAL(12,2)")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleansing.standardize_sales(rows).collect()


def test_emails_margins_and_reorder_status(spark):
    people = spark.createDataFrame(
        [("Ann", "Lee", None), (None, "LEE", None), ("Bo", "Ek", "b@e.x")], "first_name STRING, last_name STRING, email STRING"
    )
    assert [r.email for r in cleansing.impute_email(people).collect()] == [
        "ann.lee@placeholder.com", "none.lee@placeholder.com", "b@e.x",
    ]
    goods = spark.createDataFrame(
        [(Decimal("10"), Decimal("6")), (Decimal("0"), Decimal("6")), (None, Decimal("6"))],
        "suggested_retail_price DECIMAL(12,2), unit_cost DECIMAL(12,2)",
    )
    assert [r.profit_margin_pct for r in cleansing.product_margin(goods).collect()] == [40.0, None, None]
    stock = spark.createDataFrame([(5, 5), (6, 5), (None, 5)], "stock_on_hand INT, reorder_point INT")
    assert [r.reorder_status for r in cleansing.with_reorder_status(stock).collect()] == [
        "REORDER_NEEDED", "HEALTHY", "HEALTHY",
    ]


def test_keep_first_against_brute_force_with_null_and_hot_keys(spark):
    rng = random.Random(5)
    keys = ["hot"] * 400 + [None] * 100 + [f"k{rng.randrange(200)}" for _ in range(700)]
    rng.shuffle(keys)
    rows = [(k, rng.randrange(50), i) for i, k in enumerate(keys)]
    best = {}
    for k, o, i in rows:
        if k not in best or (o, i) < best[k]:
            best[k] = (o, i)
    df = spark.createDataFrame(rows, "k STRING, o INT, i INT").repartition(7)
    kept = {r.k: (r.o, r.i) for r in dedup.keep_first(df, ["k"], ["o", "i"]).collect()}
    assert kept == best
    assert dedup.count_distinct_keys(df, ["k"]).first().n == len(best)


def test_keep_first_sends_one_row_per_key_and_map_task(spark):
    rows = spark.range(0, 100, 1, 4).selectExpr("id % 3 AS k", "id AS o")
    plan = dedup.keep_first(rows, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below, "the group limit must also sit below the exchange"


def test_declared_rules_count_without_filtering(spark):
    people = spark.createDataFrame([("1", "Gold"), ("2", "Basic"), ("3", None)], "customer_id STRING, loyalty_tier STRING")
    found = {r.rule: r.affected_records for r in validation.rule_set(people, "customers").collect()}
    assert found["valid_tiers"] == 1
    assert found["required column loyalty_tier"] == 1
    assert found["required column email"] == 3  # the column is absent
