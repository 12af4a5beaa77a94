"""Bronze to silver: filters, imputation, typing, derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.numbers import money, percent
from tallyhouse.functions.segments import reorder_status
from tallyhouse.functions.text import fallback_email
from tallyhouse.operators.dedup import keep_first

DEFAULT_ORDER = ("row_seq",)


def filter_quantity(df: DataFrame) -> DataFrame:
    """Drop rows whose quantity is zero, negative or missing."""
    return df.filter(F.col("quantity") > 0)


def impute_constant(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.fillna({column: value})


def impute_email(df: DataFrame) -> DataFrame:
    fallback = fallback_email(F.col("first_name"), F.col("last_name"), S.EMAIL_DOMAIN)
    return df.withColumn("email", F.coalesce("email", fallback))


def standardize_sales(df: DataFrame) -> DataFrame:
    """Typed timestamp, its date and hour, and the gross amount. An unreadable timestamp aborts."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumns(
        {
            "transaction_date": F.to_date("timestamp"),
            "transaction_hour": F.hour("timestamp"),
            "gross_amount": money(F.col("quantity") * F.col("unit_price")),
        }
    )


def standardize_customers(df: DataFrame) -> DataFrame:
    return df.withColumn("signup_date", F.to_date(F.col("signup_date").cast("timestamp")))


def product_margin(df: DataFrame) -> DataFrame:
    """Catalogue margin in percent; NULL where the retail price is zero or missing."""
    retail = F.col("suggested_retail_price")
    return df.withColumn("profit_margin_pct", percent(retail - F.col("unit_cost"), retail))


def with_reorder_status(df: DataFrame) -> DataFrame:
    return df.withColumn("reorder_status", reorder_status(F.col("stock_on_hand"), F.col("reorder_point")))


# --- whole tables -----------------------------------------------------------------------------
Order = Sequence[str | Column]


def silver_sales(bronze: DataFrame, order: Order = DEFAULT_ORDER) -> DataFrame:
    first = keep_first(bronze, ["transaction_id"], order)
    return standardize_sales(impute_constant(filter_quantity(first), "payment_method", S.MISSING_PAYMENT))


def silver_customers(bronze: DataFrame, order: Order = DEFAULT_ORDER) -> DataFrame:
    return standardize_customers(impute_email(keep_first(bronze, ["customer_id"], order)))


def silver_products(bronze: DataFrame, order: Order = DEFAULT_ORDER) -> DataFrame:
    return product_margin(keep_first(bronze, ["product_id"], order))


def silver_stores(bronze: DataFrame, order: Order = DEFAULT_ORDER) -> DataFrame:
    return keep_first(bronze, ["store_id"], order)


def silver_inventory(bronze: DataFrame, order: Order = DEFAULT_ORDER) -> DataFrame:
    return with_reorder_status(keep_first(bronze, ["product_id", "store_id"], order))


SILVER_BUILDERS = {
    "silver_sales": ("bronze_sales_raw", silver_sales),
    "silver_customers": ("bronze_customers_raw", silver_customers),
    "silver_products": ("bronze_products_raw", silver_products),
    "silver_stores": ("bronze_stores_raw", silver_stores),
    "silver_inventory": ("bronze_inventory_raw", silver_inventory),
}
