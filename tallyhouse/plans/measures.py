"""BI measures: aggregates that work over the whole model or under any group-by."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import settings as S
from tallyhouse.functions.numbers import ratio_or_zero, round_half_up, total_money
from tallyhouse.schemas import RELATIONS

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Measure:
    """What a measure adds up over its table, and how its value comes from the sums.

    ``parts`` are aggregates that can be added up again, so that a table is first added up by the keys of its
    dimensions. ``distinct`` names a column whose different values are counted; the count is part ``distinct``
    of the value, named after the column.
    """

    table: str
    parts: Mapping[str, Callable[[], Column]]
    value: Callable[[], Column]
    distinct: str | None = None


def _sum(column: str) -> Callable[[], Column]:
    return lambda: F.sum(column)


def _amount(table: str, column: str) -> Measure:
    return Measure(table, {column: _sum(column)}, lambda: total_money(F.col(column)))


def _count(table: str, name: str, test: Callable[[], Column]) -> Measure:
    return Measure(table, {name: lambda: F.count_if(test())}, lambda: F.col(name))


def _plain(table: str, column: str) -> Measure:
    return Measure(table, {column: _sum(column)}, lambda: F.col(column))


def _in_segment(segment: str, name: str) -> Measure:
    return _count("dim_customers", name, lambda: F.col("rfm_segment") == segment)


MEASURES = {
    "total_sales": _amount("fact_sales", "gross_amount"),
    "total_cogs": _amount("fact_sales", "cogs"),
    "total_net_profit": _amount("fact_sales", "net_profit"),
    "profit_margin_pct": Measure(
        "fact_sales",
        {"net_profit": _sum("net_profit"), "gross_amount": _sum("gross_amount")},
        lambda: round_half_up(ratio_or_zero(F.col("net_profit"), F.col("gross_amount")) * 100.0),
    ),
    "total_units_sold": _plain("fact_sales", "quantity"),
    "total_transactions": Measure("fact_sales", {}, lambda: F.col("transaction_id"), "transaction_id"),
    "average_order_value": Measure(
        "fact_sales",
        {"gross_amount": _sum("gross_amount")},
        lambda: round_half_up(ratio_or_zero(F.col("gross_amount"), F.col("transaction_id"))),
        "transaction_id",
    ),
    # A missing customer is no customer: SQL semantics, where the BI tool would count the blank.
    "active_customer_count": Measure("fact_sales", {}, lambda: F.col("customer_id"), "customer_id"),
    "total_stock_on_hand": _plain("fact_inventory_snapshot", "stock_on_hand"),
    "total_inventory_valuation": _amount("fact_inventory_snapshot", "inventory_valuation"),
    "reorder_alert_count": _count(
        "fact_inventory_snapshot", "reorder_alerts", lambda: F.col("reorder_status") == S.REORDER_NEEDED
    ),
    "avg_customer_lifetime_value": Measure(
        "dim_customers",
        {"total_spend": _sum("total_spend"), "with_spend": lambda: F.count("total_spend")},
        lambda: round_half_up(ratio_or_zero(F.col("total_spend"), F.col("with_spend"))),
    ),
    "champions_count": _in_segment("Champions", "champions"),
    "at_risk_customers": _in_segment("At Risk", "at_risk"),
}


def _dimension_columns(tables: Tables, table: str, group_by: Sequence[str]) -> list[tuple[str, str, list[str]]]:
    """Dimension, key and group-by columns of it, for those columns that the table itself lacks."""
    missing, joins = [c for c in group_by if c not in tables[table].columns], []
    for fact, dimension, key in RELATIONS:
        found = [c for c in missing if fact == table and c in tables[dimension].columns]
        if found:
            joins.append((dimension, key, found))
            missing = [c for c in missing if c not in found]
    if missing:
        raise ValueError(f"no table related to {table} has the column(s) {', '.join(missing)}")
    return joins


def measures(tables: Tables, names: Sequence[str], group_by: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Several measures of one table.

    Where a group-by column is on a dimension, the table is first added up by the keys of its dimensions, so
    that the join gets one row per key; for distinct counts it gets the different pairs of key and id as
    well. ``unique=True`` takes one row per transaction for granted, and then its ids are plainly counted.
    """
    sources = {MEASURES[n].table for n in names}
    if len(sources) != 1:
        raise ValueError("measures of one call must come from one table")
    table = sources.pop()
    frame, joins = tables[table], _dimension_columns(tables, table, group_by)
    parts = {p: make for n in names for p, make in MEASURES[n].parts.items()}
    ids = sorted({d for n in names if (d := MEASURES[n].distinct)})
    if unique and "transaction_id" in ids:
        ids.remove("transaction_id")
        parts["transaction_id"] = lambda: F.count("transaction_id")
    own = [c for c in group_by if c in frame.columns]
    # Parts and ids get names of their own, as a group-by column may have the name of a summed one.
    if not joins:
        made = [make().alias(f"_{p}") for p, make in parts.items()] + [F.count_distinct(d).alias(f"_{d}") for d in ids]
        added = frame.groupBy(*group_by).agg(*made) if group_by else frame.agg(*made)
    else:
        keys = [*own, *[k for _, k, _ in joins if k not in own]]
        rows = frame.groupBy(*keys).agg(*[make().alias(f"_{p}") for p, make in parts.items()]) if parts else None
        for d in ids:
            pairs = frame.select(*keys, F.col(d).alias(f"_{d}")).distinct()
            rows = pairs if rows is None else rows.unionByName(pairs, allowMissingColumns=True)
        for dimension, key, found in joins:
            rows = rows.join(tables[dimension].select(key, *found), key, "left")
        again = [F.sum(f"_{p}").alias(f"_{p}") for p in parts] + [F.count_distinct(f"_{d}").alias(f"_{d}") for d in ids]
        added = rows.groupBy(*group_by).agg(*again)
    named = [F.col(f"_{c}").alias(c) for c in (*parts, *ids)]
    groups = [F.col(c).alias(f"__{c}") for c in group_by]
    values = [MEASURES[n].value().alias(n) for n in names]
    return added.select(*groups, *named).select(*[F.col(f"__{c}").alias(c) for c in group_by], *values)


def measure(tables: Tables, name: str, group_by: Sequence[str] = (), unique: bool = False) -> DataFrame:
    return measures(tables, [name], group_by, unique)


def stock_turnover_ratio(tables: Tables, group_by: Sequence[str] = ()) -> DataFrame:
    """Cost of goods sold over inventory value; each fact is aggregated before the two meet."""
    value = measure(tables, "total_inventory_valuation", group_by)
    cost = measure(tables, "total_cogs", group_by)
    if group_by:
        both = cost.join(value, list(group_by), "full")
    else:
        both = cost.withColumn("total_inventory_valuation", value.scalar())
    ratio = ratio_or_zero(F.col("total_cogs"), F.col("total_inventory_valuation"))
    return both.select(*group_by, round_half_up(ratio, 4).alias("stock_turnover_ratio"))


# --- time intelligence ------------------------------------------------------------------------
def monthly_sales(tables: Tables) -> DataFrame:
    """Total sales per calendar month, months without sales included; one row per month, in one pass over the facts.

    The calendar has one row per month, whatever the facts hold, so that windows over it stay small.
    """
    month = F.trunc("transaction_date", "month").alias("month_start")
    totals = tables["fact_sales"].groupBy(month).agg(F.sum("gross_amount").alias("_sales")).withColumn("_sold", F.col("month_start"))
    calendar = tables["dim_date"].filter(F.col("day") == 1).select(F.col("date").alias("month_start"))
    ends = [f(F.col("_sold")).over(Window.partitionBy()) for f in (F.min, F.max)]
    months = calendar.join(totals, "month_start", "left").withColumn("_in", F.col("month_start").between(*ends))
    return months.filter("_in").select("month_start", total_money(F.coalesce("_sales", F.lit(0))).alias("total_sales"))


def sales_ytd(tables: Tables) -> DataFrame:
    """Running total within each year, over monthly totals."""
    year = Window.partitionBy(F.year("month_start")).orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    running = total_money(F.sum("total_sales").over(year))
    return monthly_sales(tables).select("month_start", "total_sales", running.alias("sales_ytd")).orderBy("month_start")


def sales_previous_month(tables: Tables) -> DataFrame:
    """Sales of the calendar month before; NULL for the first month."""
    before = F.lag("total_sales").over(Window.orderBy("month_start"))
    return monthly_sales(tables).select("month_start", "total_sales", before.alias("sales_previous_month")).orderBy("month_start")


def mom_sales_growth(tables: Tables) -> DataFrame:
    """Change against the previous month in percent; 0 where there is none."""
    current, previous = F.col("total_sales"), F.col("sales_previous_month")
    growth = round_half_up(ratio_or_zero(current - previous, previous) * 100.0)
    return sales_previous_month(tables).select(
        "month_start", "total_sales", "sales_previous_month", growth.alias("mom_growth_pct")
    ).orderBy("month_start")


# --- dashboard visuals ------------------------------------------------------------------------
def revenue_by_channel(tables: Tables) -> DataFrame:
    return measure(tables, "total_sales", ["channel"])


def top_category_products(tables: Tables, k: int = 10) -> DataFrame:
    """The k best-selling (category, product name) pairs; added up per product before the join."""
    products = tables["dim_products"].select("product_id", "category", "product_name")
    per_product = tables["fact_sales"].groupBy("product_id").agg(F.sum("gross_amount").alias("_sales"))
    keys = ["category", "product_name"]
    return (
        per_product.join(products, "product_id")
        .groupBy(*keys)
        .agg(total_money(F.sum("_sales")).alias("total_sales"))
        .orderBy(F.desc("total_sales"), *keys)
        .limit(k)
    )


def sales_by_location(tables: Tables) -> DataFrame:
    stores = tables["dim_stores"].select("store_id", "state", "city")
    per_store = tables["fact_sales"].groupBy("store_id").agg(F.sum("gross_amount").alias("_sales"))
    return (
        per_store.join(stores, "store_id")
        .groupBy("state", "city")
        .agg(total_money(F.sum("_sales")).alias("total_sales"))
    )


def valuation_by_category(tables: Tables) -> DataFrame:
    products = tables["dim_products"].select("product_id", "category")
    per_product = (
        tables["fact_inventory_snapshot"].groupBy("product_id").agg(F.sum("inventory_valuation").alias("_value"))
    )
    return (
        per_product.join(products, "product_id")
        .groupBy("category")
        .agg(total_money(F.sum("_value")).alias("total_inventory_valuation"))
    )


def stock_scatter(tables: Tables) -> DataFrame:
    """Stock against reorder point, per product over its stores."""
    return (
        tables["fact_inventory_snapshot"]
        .groupBy("product_id")
        .agg(F.sum("stock_on_hand").alias("stock_on_hand"), F.sum("reorder_point").alias("reorder_point"))
    )


def recency_spend_scatter(tables: Tables) -> DataFrame:
    return tables["dim_customers"].select("customer_id", "days_since_last_purchase", "total_spend")


def customer_roster(tables: Tables) -> DataFrame:
    return tables["dim_customers"].select("customer_id", "email", "loyalty_tier", "total_orders", "rfm_segment")
