"""Validation counts, the audit log and declarative rule checks.

All counts of a dataset come from one aggregate over its deduplicated rows. They are aggregates, not
accumulators, so a re-run task cannot count twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.numbers import percent
from tallyhouse.operators.dedup import keep_first
from tallyhouse.schemas import VALIDATION_LOG


def _row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def check_bounds(df: DataFrame, column: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """Rows below ``low`` and above ``high``; nothing is filtered."""
    value = F.col(column)
    below = F.count_if(value < F.lit(low).cast("decimal(12,2)")) if low is not None else F.lit(0).cast("bigint")
    above = F.count_if(value > F.lit(high).cast("decimal(12,2)")) if high is not None else F.lit(0).cast("bigint")
    return df.agg(below.alias("below"), above.alias("above"))


def sales_metrics(bronze: DataFrame, order: Sequence[str | Column] = ("row_seq",)) -> DataFrame:
    """One row: what cleansing removes and fills in, and the share of rows that pass."""
    quantity = F.col("quantity")
    good = quantity > 0
    needed = ["transaction_id", "quantity", "unit_price", "payment_method"]
    kept = keep_first(bronze, ["transaction_id"], order).select(*needed)
    counted = kept.agg(
        F.count(F.lit(1)).alias("_distinct"),
        F.count_if(quantity <= 0).alias("invalid_qty_removed"),
        F.count_if(quantity.isNull()).alias("missing_qty_removed"),
        F.count_if(good & F.col("payment_method").isNull()).alias("imputed_fields"),
        F.count_if(good & (F.col("unit_price") < F.lit(S.MIN_UNIT_PRICE).cast("decimal(12,2)"))).alias(
            "invalid_price"
        ),
        F.count_if(good).alias("final_records"),
    )
    counted = counted.withColumn("initial_records", _row_count(bronze))
    return counted.select(
        "initial_records",
        (F.col("initial_records") - F.col("_distinct")).alias("duplicates_removed"),
        "invalid_qty_removed",
        "missing_qty_removed",
        "imputed_fields",
        "invalid_price",
        "final_records",
        percent(F.col("final_records"), F.col("initial_records")).alias("pass_rate"),
    )


def customer_metrics(bronze: DataFrame, order: Sequence[str | Column] = ("row_seq",)) -> DataFrame:
    kept = keep_first(bronze, ["customer_id"], order).select("customer_id", "email")
    counted = kept.agg(
        F.count(F.lit(1)).alias("final_records"), F.count_if(F.col("email").isNull()).alias("emails_imputed")
    ).withColumn("initial_records", _row_count(bronze))
    return counted.select(
        "initial_records",
        (F.col("initial_records") - F.col("final_records")).alias("duplicates_removed"),
        "emails_imputed",
        "final_records",
        percent(F.col("final_records"), F.col("initial_records")).alias("pass_rate"),
    )


# Fixed values: (metric column, rule, severity, details).
SALES_RULES = (
    ("duplicates_removed", "Deduplication", "HIGH", "Found duplicate transaction_ids"),
    ("invalid_qty_removed", "Quantity Bounds Check", "HIGH", "Filtered transactions with quantity <= 0"),
    ("missing_qty_removed", "Quantity Missing", "HIGH", "Filtered transactions without a quantity"),
    ("imputed_fields", "Null Imputation", "MEDIUM", "Imputed missing payment_method with 'Unknown'"),
    ("invalid_price", "Price Bounds Check", "MEDIUM", "Unit price below minimum 0.01"),
)
CUSTOMER_RULES = (
    ("duplicates_removed", "Deduplication", "HIGH", "Removed duplicate customer IDs"),
    ("emails_imputed", "Email Imputation", "LOW", "Generated missing synthetic fallback emails"),
)


def validation_log(
    metrics: DataFrame,
    dataset: str,
    rules: Sequence[tuple[str, str, str, str]],
    batch_id: str,
    moment: datetime,
    layer: str = "Silver",
    first_seq: int = 0,
) -> DataFrame:
    """One row per rule that some record violates, made from the one-row metrics frame."""
    entries = [
        F.struct(
            F.lit(first_seq + i).alias("seq"),
            F.lit(rule).alias("rule"),
            F.lit(severity).alias("severity"),
            F.col(column).cast("bigint").alias("affected_records"),
            F.lit(details).alias("details"),
        )
        for i, (column, rule, severity, details) in enumerate(rules)
    ]
    rows = metrics.select(F.inline(F.array(*entries))).filter(F.col("affected_records") > 0)
    return rows.select(
        F.lit(batch_id).alias("batch_id"),
        "seq",
        F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp").alias("timestamp"),
        F.lit(layer).alias("layer"),
        F.lit(dataset).alias("dataset"),
        "rule",
        "severity",
        "affected_records",
        "details",
    ).select(*VALIDATION_LOG)


def full_validation_log(
    sales: DataFrame, customers: DataFrame, batch_id: str, moment: datetime
) -> DataFrame:
    """The batch's audit rows from the metrics of both datasets."""
    first = validation_log(sales, "sales", SALES_RULES, batch_id, moment)
    second = validation_log(
        customers, "customers", CUSTOMER_RULES, batch_id, moment, first_seq=len(SALES_RULES)
    )
    return first.unionByName(second)


def latest_validation_logs(log: DataFrame, n: int = 50) -> DataFrame:
    return log.orderBy(F.desc("timestamp"), F.desc("batch_id"), F.desc("seq")).limit(n)


def rule_set(df: DataFrame, dataset: str) -> DataFrame:
    """Violations of the declared but unenforced rules, as ``(dataset, rule, affected_records)``.

    A required column that is absent counts every row; one that is present counts its NULLs.
    """
    always = F.count(F.lit(1))
    checks: list[tuple[str, Column]] = [
        (f"required column {c}", F.count_if(F.col(c).isNull()) if c in df.columns else always)
        for c in S.REQUIRED_COLUMNS[dataset]
    ]
    if dataset == "sales":
        price = F.col("unit_price")
        checks += [
            ("min_unit_price", F.count_if(price < F.lit(S.MIN_UNIT_PRICE).cast("decimal(12,2)"))),
            ("max_unit_price", F.count_if(price > F.lit(S.MAX_UNIT_PRICE).cast("decimal(12,2)"))),
            ("min_quantity", F.count_if(F.col("quantity") < S.MIN_QUANTITY)),
        ]
    elif dataset == "inventory":
        checks.append(("min_stock", F.count_if(F.col("stock_on_hand") < S.MIN_STOCK)))
    elif dataset == "customers":
        checks.append(("valid_tiers", F.count_if(~F.col("loyalty_tier").isin(*S.VALID_TIERS))))
    counted = df.agg(*[count.alias(f"c{i}") for i, (_, count) in enumerate(checks)])
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("affected_records"))
        for i, (name, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*entries))).select(
        F.lit(dataset).alias("dataset"), "rule", "affected_records"
    )
