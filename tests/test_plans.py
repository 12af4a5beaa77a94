"""Executed plans between written tables: hot keys, pushdown, pruning."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import star
from tallyhouse.plans import kpis
from tallyhouse.sources.staging import new_path, stage
from tallyhouse.sources.tables import read_table, write_layer
from test_lines import SHUFFLED, executed_plan


@pytest.fixture(scope="module")
def sales(spark):
    """A third of all sales is of one product."""
    n = F.col("id")
    return stage(
        spark.range(0, 40000, 1, 8).select(
            F.concat(F.lit("T"), n.cast("string")).alias("transaction_id"),
            F.to_timestamp(F.lit("2024-01-01")).alias("timestamp"),
            F.date_add(F.lit("2024-01-01").cast("date"), (n % 90).cast("int")).alias("transaction_date"),
            F.lit(8).alias("transaction_hour"),
            F.sha2(n.cast("string"), 256).alias("customer_id"),
            F.when(n % 3 == 0, F.lit("hot")).otherwise(n.cast("string")).alias("product_id"),
            F.lit("S1").alias("store_id"),
            F.lit(2).alias("quantity"),
            F.lit("3.00").cast("decimal(12,2)").alias("unit_price"),
            F.lit("6.00").cast("decimal(18,2)").alias("gross_amount"),
            F.lit("Cash").alias("payment_method"),
            F.lit("Online").alias("channel"),
        ),
        "sales",
    )


@pytest.fixture(scope="module")
def products(spark):
    ids = spark.range(40000).filter("id % 3 <> 0").selectExpr("cast(id AS STRING) AS product_id")
    named = ids.union(spark.sql("SELECT 'hot' AS product_id"))
    return stage(named.select("product_id", F.lit("1.00").cast("decimal(12,2)").alias("unit_cost")), "products")


def test_cost_of_a_hot_product_is_joined_by_several_tasks(spark, conf, sales, products):
    conf(**SHUFFLED)
    fact = star.fact_sales(sales, products)
    assert "skew=true" in executed_plan(fact).split("Initial Plan")[0]
    assert tuple(fact.agg(F.count("*"), F.sum("cogs")).first()) == (40000, 80000)


def test_monthly_kpi_reads_few_columns_and_shuffles_groups_only(sales, products):
    fact = stage(star.fact_sales(sales, products), "fact")
    plan = kpis.monthly_performance({"fact_sales": fact})._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "customer_id" not in scan and "channel" not in scan
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_sum" in below and "Expand" not in plan  # combined before the shuffle, no distinct plan


def test_month_partitions_are_pruned_and_filters_reach_the_scan(spark, sales):
    root = new_path(spark, "plans")
    write_layer(sales.withColumn("sales_month", F.date_format("transaction_date", "yyyy-MM")), root, "silver_sales", partition_by="sales_month")
    march = read_table(spark, "silver_sales", root).filter("sales_month = '2024-03' AND product_id = 'hot'")
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(product_id,hot)" in plan and "2024-03" in plan[plan.index("PartitionFilters"):]
    assert march.count() == sum(1 for n in range(0, 40000, 3) if n % 90 >= 60)
