"""Silver to gold: dimensions, facts, marts and their integrity."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse import schemas
from tallyhouse.functions.numbers import mean_amount, money, percent, total_money
from tallyhouse.functions.segments import rfm_segment

Tables = Mapping[str, DataFrame]


def attach(fact: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join a few columns of a keyed dimension.

    No broadcast is forced: the optimizer broadcasts a side it knows to be small, and otherwise
    shuffles. Between written tables the adaptive plan then splits the partitions of a hot key.
    """
    return fact.join(dimension.select(key, *columns), key, "left")


def order_count(unique: bool = False) -> Column:
    """Number of distinct transactions.

    ``unique=True`` is for facts that are known to hold one row per transaction, as the layer run's are
    (silver keeps one row per id and the joined dimensions are unique): counting ids is then the distinct
    count without its extra shuffle of the whole fact table.
    """
    return F.count("transaction_id") if unique else F.count_distinct("transaction_id")


def total(column: str) -> Column:
    """Exact sum that reads 0, not NULL, where every value is missing."""
    return total_money(F.coalesce(F.sum(column), F.lit(0)))


# --- dimensions -------------------------------------------------------------------------------
def customer_aggregate(sales: DataFrame, unique: bool = False) -> DataFrame:
    """Orders, spend, exact sum parts of the mean, and last purchase per known customer."""
    return (
        sales.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            order_count(unique).alias("total_orders"),
            total_money(F.sum("gross_amount")).alias("total_spend"),
            mean_amount(F.col("gross_amount")).alias("avg_order_value"),
            F.max("transaction_date").alias("last_purchase_date"),
        )
    )


def latest_sale(sales: DataFrame) -> Column:
    """Latest transaction date in the data, as a scalar subquery."""
    return sales.agg(F.max("transaction_date")).scalar()


def with_recency(customers: DataFrame, anchor: Column) -> DataFrame:
    """Days from the last purchase to the anchor date; 999 for customers without one."""
    days = F.datediff(anchor, F.col("last_purchase_date"))
    return customers.withColumn(
        "days_since_last_purchase", F.coalesce(days, F.lit(S.NEVER_PURCHASED_DAYS))
    )


def customer_profile(customers: DataFrame, aggregate: DataFrame) -> DataFrame:
    """All customers with their aggregate; zeros for those without sales."""
    return customers.join(aggregate, "customer_id", "left").withColumns(
        {
            "total_orders": F.coalesce("total_orders", F.lit(0)),
            "total_spend": F.coalesce("total_spend", money(F.lit(0))),
            "avg_order_value": F.coalesce("avg_order_value", F.lit(0.0)),
        }
    )


def dim_customers(
    customers: DataFrame, sales: DataFrame, thresholds: S.RfmThresholds = S.RfmThresholds(), unique: bool = False
) -> DataFrame:
    profile = with_recency(customer_profile(customers, customer_aggregate(sales, unique)), latest_sale(sales))
    segment = rfm_segment(F.col("total_spend"), F.col("days_since_last_purchase"), thresholds)
    return profile.withColumn("rfm_segment", segment).select(*schemas.DIM_CUSTOMERS)


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(*schemas.DIM_PRODUCTS)


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.select(*schemas.DIM_STORES)


def dim_date(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """Every calendar day from start to end."""
    days = spark.range(1).select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
    )


def dim_date_of(sales: DataFrame) -> DataFrame:
    """Calendar over the whole years that the sales touch."""
    first = F.trunc(sales.agg(F.min("transaction_date")).scalar(), "year")
    last = F.date_add(F.add_months(F.trunc(latest_sale(sales), "year"), 12), -1)
    return dim_date(sales.sparkSession, first, last)


# --- facts ------------------------------------------------------------------------------------
def fact_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with cost and profit; an unknown product keeps its row with NULL cost."""
    gross, quantity = F.col("gross_amount"), F.col("quantity")
    costed = attach(sales, products, "product_id", ["unit_cost"])
    costed = costed.withColumn("cogs", money(quantity * F.col("unit_cost")))
    costed = costed.withColumn("net_profit", money(gross - F.col("cogs")))
    margin = F.when(gross > 0, percent(F.col("net_profit"), gross)).otherwise(F.lit(0.0))
    return costed.withColumn("profit_margin_pct", margin).select(*schemas.FACT_SALES)


def fact_inventory_snapshot(inventory: DataFrame, products: DataFrame) -> DataFrame:
    valued = attach(inventory, products, "product_id", ["unit_cost"])
    valuation = money(F.col("stock_on_hand") * F.col("unit_cost"))
    return valued.withColumn("inventory_valuation", valuation).select(*schemas.FACT_INVENTORY)


# --- marts ------------------------------------------------------------------------------------
def daily_sales_summary(fact: DataFrame, unique: bool = False) -> DataFrame:
    return (
        fact.groupBy("transaction_date")
        .agg(
            total("gross_amount").alias("total_revenue"),
            total("net_profit").alias("total_net_profit"),
            order_count(unique).alias("total_transactions"),
            F.sum("quantity").alias("total_items_sold"),
            mean_amount(F.col("gross_amount")).alias("avg_order_value"),
        )
        .orderBy("transaction_date")
    )


def category_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per category; sales without a category drop out.

    Added up per product first, so the join carries products, not sales.
    """
    per_product = fact.groupBy("product_id").agg(
        F.sum("gross_amount").alias("revenue"),
        F.sum("net_profit").alias("profit"),
        F.sum("quantity").alias("units"),
        F.count("transaction_id").alias("transactions"),
    )
    return (
        attach(per_product, products, "product_id", ["category"])
        .filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            total("revenue").alias("total_revenue"),
            total("profit").alias("total_profit"),
            F.sum("units").alias("total_units_sold"),
            F.sum("transactions").alias("transaction_count"),
        )
        .withColumn("profit_margin_pct", percent(F.col("total_profit"), F.col("total_revenue")))
    )


# Table -> function of (all layer tables, segment thresholds). Gold tables may use other gold tables.
GOLD_BUILDERS: dict[str, Callable[[Tables, S.RfmThresholds], DataFrame]] = {
    "dim_products": lambda t, _: dim_products(t["silver_products"]),
    "dim_stores": lambda t, _: dim_stores(t["silver_stores"]),
    "dim_customers": lambda t, limits: dim_customers(t["silver_customers"], t["silver_sales"], limits, unique=True),
    "dim_date": lambda t, _: dim_date_of(t["silver_sales"]),
    "fact_sales": lambda t, _: fact_sales(t["silver_sales"], t["silver_products"]),
    "fact_inventory_snapshot": lambda t, _: fact_inventory_snapshot(t["silver_inventory"], t["silver_products"]),
    "gold_daily_sales_summary": lambda t, _: daily_sales_summary(t["fact_sales"], unique=True),
    "gold_category_performance": lambda t, _: category_performance(t["fact_sales"], t["silver_products"]),
}


# --- checks and summaries ---------------------------------------------------------------------
def check_referential_integrity(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL fact keys missing from the dimension, the fact rows they hold, NULL keys,
    and dimension keys that occur more than once.

    Fact keys are counted first, so the anti join moves keys rather than fact rows.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.filter(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
    repeated = dimension.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    missing = per_key.filter(F.col(key).isNull())
    return orphans.agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")
    ).select(
        "orphan_keys",
        "orphan_rows",
        F.coalesce(missing.agg(F.sum("n")).scalar(), F.lit(0)).alias("null_rows"),
        repeated.agg(F.count(F.lit(1))).scalar().alias("repeated_dimension_keys"),
    )


def integrity_report(tables: Tables) -> DataFrame:
    """The check over every relation of the star."""
    report = None
    for fact, dimension, key in schemas.RELATIONS:
        part = check_referential_integrity(tables[fact], tables[dimension], key).select(
            F.lit(fact).alias("fact_table"), F.lit(dimension).alias("dimension"), "*"
        )
        report = part if report is None else report.unionByName(part)
    return report


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def gold_summary(tables: Tables, unique: bool = False) -> DataFrame:
    """Headline totals and row counts, one row."""
    totals = tables["fact_sales"].agg(
        total("gross_amount").alias("total_revenue"),
        total("net_profit").alias("total_profit"),
        order_count(unique).alias("total_transactions"),
        F.count(F.lit(1)).alias("gold_fact_sales_rows"),
    )
    inventory = tables["fact_inventory_snapshot"]
    reorder = inventory.agg(F.count_if(F.col("reorder_status") == S.REORDER_NEEDED)).scalar()
    return totals.select(
        "total_revenue",
        "total_profit",
        "total_transactions",
        reorder.alias("items_requiring_reorder"),
        "gold_fact_sales_rows",
        _count(inventory).alias("gold_fact_inventory_rows"),
        _count(tables["dim_customers"]).alias("gold_dim_customers_rows"),
        _count(tables["dim_products"]).alias("gold_dim_products_rows"),
        _count(tables["dim_stores"]).alias("gold_dim_stores_rows"),
    )


# Output column -> table, in output order.
MEDALLION_COUNTS = {
    "bronze_sales": "bronze_sales_raw",
    "bronze_customers": "bronze_customers_raw",
    "bronze_inventory": "bronze_inventory_raw",
    "silver_sales": "silver_sales",
    "silver_customers": "silver_customers",
    "silver_products": "silver_products",
    "silver_inventory": "silver_inventory",
    "gold_fact_sales": "fact_sales",
    "gold_dim_customers": "dim_customers",
    "gold_dim_products": "dim_products",
    "gold_dim_stores": "dim_stores",
    "gold_fact_inventory": "fact_inventory_snapshot",
}


def medallion_summary(tables: Tables) -> DataFrame:
    """Twelve row counts in one row, each a scalar subquery (a footer read on Parquet tables)."""
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(*[_count(tables[t]).alias(name) for name, t in MEDALLION_COUNTS.items()])
