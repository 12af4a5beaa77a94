"""Business KPI queries over the gold tables, each ``name(tables) -> DataFrame``.

Facts are added up by their own key before a dimension is joined, so that joins carry groups rather
than sales. Sums of exact amounts and counts can be added up twice without changing the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.numbers import mean_amount, money, percent, round_half_up, safe_ratio, total_money
from tallyhouse.operators.star import order_count

Tables = Mapping[str, DataFrame]


def month_start() -> Column:
    """Grouping key: first day of the month, a machine word. Texts are made after the aggregate."""
    return F.trunc("transaction_date", "month").alias("_month")


def month_text() -> Column:
    return F.date_format("_month", "yyyy-MM")


def monthly_performance(tables: Tables, unique: bool = False) -> DataFrame:
    months = (
        tables["fact_sales"]
        .groupBy(month_start())
        .agg(
            order_count(unique).alias("total_orders"),
            F.sum("quantity").alias("total_units_sold"),
            total_money(F.sum("gross_amount")).alias("gross_revenue"),
            total_money(F.sum("net_profit")).alias("net_profit"),
            mean_amount(F.col("gross_amount")).alias("avg_order_value"),
        )
    )
    return months.select(
        month_text().alias("sales_month"),
        "total_orders",
        "total_units_sold",
        "gross_revenue",
        "net_profit",
        percent(F.col("net_profit"), F.col("gross_revenue")).alias("overall_margin_pct"),
        "avg_order_value",
    ).orderBy("sales_month")


def rfm_summary(tables: Tables) -> DataFrame:
    days = F.col("days_since_last_purchase")
    return (
        tables["dim_customers"]
        .groupBy("rfm_segment")
        .agg(
            F.count("customer_id").alias("customer_count"),
            mean_amount(F.col("total_spend")).alias("avg_lifetime_spend"),
            total_money(F.sum("total_spend")).alias("segment_total_spend"),
            round_half_up(safe_ratio(F.sum(days), F.count(days)), 1).alias("avg_recency_days"),
        )
        .orderBy(F.desc("segment_total_spend"), "rfm_segment")
    )


def reorder_matrix(tables: Tables) -> DataFrame:
    """Stock below its reorder point, largest deficit first. The filter runs before both joins."""
    low = tables["fact_inventory_snapshot"].filter(F.col("reorder_status") == S.REORDER_NEEDED)
    products = tables["dim_products"].select("product_id", "category", "product_name")
    stores = tables["dim_stores"].select("store_id", "store_name", "region")
    return (
        low.join(products, "product_id")
        .join(stores, "store_id")
        .withColumn("deficit_quantity", F.col("reorder_point") - F.col("stock_on_hand"))
        .orderBy(F.desc("deficit_quantity"), "product_id", "store_id")
        .select(
            "category", "product_name", "store_name", "region", "stock_on_hand", "reorder_point",
            "safety_stock", "deficit_quantity", "inventory_valuation",
        )
    )


def _per_key(fact: DataFrame, key: str, unique: bool) -> DataFrame:
    return fact.groupBy(key).agg(
        order_count(unique).alias("_orders"),
        F.sum("quantity").alias("_units"),
        F.sum("gross_amount").alias("_revenue"),
        F.sum("net_profit").alias("_profit"),
    )


def top_margin_products(tables: Tables, k: int = 10) -> DataFrame:
    products = tables["dim_products"].select("product_id", "product_name", "category", "profit_margin_pct")
    return (
        _per_key(tables["fact_sales"], "product_id", True)
        .join(products, "product_id")
        .select(
            "product_id",
            "product_name",
            "category",
            F.col("_units").alias("total_units_sold"),
            total_money(F.col("_revenue")).alias("total_revenue"),
            total_money(F.col("_profit")).alias("total_profit"),
            F.col("profit_margin_pct").alias("catalog_margin_pct"),
        )
        .orderBy(F.desc_nulls_last("total_profit"), "product_id")
        .limit(k)
    )


def store_profitability(tables: Tables, unique: bool = False) -> DataFrame:
    """Totals per region, store name and city; stores that share all three are one row.

    The distinct transactions of such stores add up, as a unique transaction belongs to one store.
    Without that guarantee the sales themselves are joined and counted distinctly.
    """
    stores = tables["dim_stores"].select("store_id", "region", "store_name", "city")
    keys = ["region", "store_name", "city"]
    if unique:
        rows, orders = _per_key(tables["fact_sales"], "store_id", True).join(stores, "store_id"), F.sum("_orders")
        revenue, profit = F.sum("_revenue"), F.sum("_profit")
    else:
        rows, orders = tables["fact_sales"].join(stores, "store_id"), order_count(False)
        revenue, profit = F.sum("gross_amount"), F.sum("net_profit")
    return (
        rows.groupBy(*keys)
        .agg(
            orders.alias("transaction_count"),
            total_money(revenue).alias("store_revenue"),
            total_money(profit).alias("store_profit"),
        )
        .withColumn("store_margin_pct", percent(F.col("store_profit"), F.col("store_revenue")))
        .orderBy(F.desc_nulls_last("store_revenue"), *keys)
    )


def financial_kpis(tables: Tables, unique: bool = False) -> DataFrame:
    zero = F.lit(0)
    gross = F.col("gross_amount")
    return tables["fact_sales"].agg(
        total_money(F.coalesce(F.sum(gross), zero)).alias("total_revenue"),
        total_money(F.coalesce(F.sum("net_profit"), zero)).alias("total_profit"),
        F.coalesce(safe_ratio(F.sum(gross), F.count(gross)), F.lit(0.0)).alias("avg_order_value"),
        order_count(unique).alias("total_transactions"),
        F.coalesce(F.sum("quantity"), zero).alias("total_units_sold"),
    )


def inventory_kpis(tables: Tables) -> DataFrame:
    zero = F.lit(0)
    return tables["fact_inventory_snapshot"].agg(
        F.count(F.lit(1)).alias("total_skus"),
        F.coalesce(F.sum("stock_on_hand"), zero).alias("total_stock"),
        total_money(F.coalesce(F.sum("inventory_valuation"), zero)).alias("total_inventory_value"),
        F.count_if(F.col("reorder_status") == S.REORDER_NEEDED).alias("reorder_alerts"),
    )


def rfm_distribution(tables: Tables) -> DataFrame:
    return (
        tables["dim_customers"]
        .groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("count"),
            total_money(F.coalesce(F.sum("total_spend"), F.lit(0))).alias("spend"),
        )
    )


def monthly_trend(tables: Tables, unique: bool = False) -> DataFrame:
    return (
        tables["fact_sales"]
        .groupBy(month_start())
        .agg(
            total_money(F.sum("gross_amount")).alias("revenue"),
            total_money(F.sum("net_profit")).alias("profit"),
            order_count(unique).alias("orders"),
        )
        .select(month_text().alias("month"), "revenue", "profit", "orders")
        .orderBy("month")
    )


def category_kpis(tables: Tables) -> DataFrame:
    return (
        tables["gold_category_performance"]
        .groupBy("category")
        .agg(
            total_money(F.sum("total_revenue")).alias("revenue"),
            total_money(F.sum("total_profit")).alias("profit"),
            F.sum("total_units_sold").alias("units"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


# The workbench's named queries: three of them show fewer columns than the KPI they come from.
PRESETS: dict[str, Callable[[Tables], DataFrame]] = {
    "mom": lambda tables: monthly_performance(tables).drop("avg_order_value"),
    "rfm": rfm_summary,
    "reorder": lambda tables: reorder_matrix(tables).drop("safety_stock"),
    "margin": top_margin_products,
    "regional": lambda tables: store_profitability(tables).drop("store_margin_pct"),
}


def preset(name: str, tables: Tables) -> DataFrame:
    if name not in PRESETS:
        raise ValueError(f"unknown preset '{name}', expected one of {', '.join(PRESETS)}")
    return PRESETS[name](tables)
