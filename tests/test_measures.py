"""Measures over dimensions, months and very large amounts."""

import datetime
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import star
from tallyhouse.plans import kpis, measures
from tallyhouse.sources.staging import stage

SALES = (
    "transaction_id STRING, transaction_date DATE, customer_id STRING, product_id STRING, store_id STRING, quantity INT, "
    "gross_amount DECIMAL(18,2), cogs DECIMAL(18,2), net_profit DECIMAL(18,2), channel STRING"
)


def day(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        (f"T{k // 2}", day(f"2023-{1 + k % 3 * 4:02d}-0{1 + k % 9}"), [None, "c1", "c2"][k % 3], f"p{k % 7}", f"s{k % 4}", k,
         D(k), D(1), D(k - 1), ["web", "shop"][k % 2])
        for k in range(60)
    ]
    products = spark.createDataFrame([(f"p{k}", ["x", "y", None][k % 3], f"n{k}") for k in range(5)], "product_id STRING, category STRING, product_name STRING")
    stores = spark.createDataFrame([(f"s{k}", ["north", "south"][k % 2]) for k in range(4)], "store_id STRING, region STRING")
    months = spark.sql("SELECT explode(sequence(DATE'2022-11-01', DATE'2024-02-01', INTERVAL 1 DAY)) AS date")
    dates = months.select("date", F.dayofmonth("date").alias("day"))
    found = {"fact_sales": spark.createDataFrame(rows, SALES), "dim_products": products, "dim_stores": stores, "dim_date": dates}
    found["dim_customers"] = spark.createDataFrame([("c1", "Gold")], "customer_id STRING, loyalty_tier STRING")
    return {n: stage(df, n) for n, df in found.items()}


NAMES = [n for n, m in measures.MEASURES.items() if m.table == "fact_sales"]


def by_hand(tables, group):
    """Each measure from the joined fact rows."""
    joined = tables["fact_sales"].join(tables["dim_products"], "product_id", "left").join(tables["dim_stores"], "store_id", "left")
    out = {}
    for r in joined.collect():
        out.setdefault(tuple(r[g] for g in group), []).append(r)
    rows = {}
    for k, rs in out.items():
        gross, profit, orders = sum(r.gross_amount for r in rs), sum(r.net_profit for r in rs), len({r.transaction_id for r in rs})
        rows[k] = {
            "total_sales": gross, "total_cogs": sum(r.cogs for r in rs), "total_net_profit": profit,
            "total_units_sold": sum(r.quantity for r in rs), "total_transactions": orders,
            "active_customer_count": len({r.customer_id for r in rs} - {None}),
            "average_order_value": pytest.approx(float(gross) / orders, abs=0.006),
            "profit_margin_pct": pytest.approx(float(profit / gross) * 100 if gross else 0.0, abs=0.006),
        }
    return rows


@pytest.mark.parametrize("group", [["category"], ["region", "channel"], ["region", "category"], ["channel"]])
def test_any_group_is_that_of_the_joined_facts(tables, group):
    got = measures.measures(tables, NAMES, group).collect()
    assert {tuple(r[g] for g in group): {n: r[n] for n in NAMES} for r in got} == by_hand(tables, group)


def test_facts_are_added_up_before_the_join(tables):
    """Every join lies above an aggregate of the facts; without distinct counts there is one fact scan."""
    df = measures.measures(tables, ["total_sales", "profit_margin_pct"], ["region", "category"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    depth = lambda x: re.search(r"[A-Z]", x).start()
    scans = [k for k, x in enumerate(lines) if "gross_amount" in x and "Relation" in x]
    assert len(scans) == 1
    above, at = [], depth(lines[scans[0]])
    for x in reversed(lines[: scans[0]]):
        if depth(x) < at:
            above.append(x.strip(" :+-"))
            at = depth(x)
    kinds = [a.split()[0] for a in above if a.split()[0] in ("Aggregate", "Join")]
    assert kinds == ["Aggregate", "Join", "Join", "Aggregate"]


def test_unique_transactions_need_no_pairs(tables):
    one = dict(tables, fact_sales=tables["fact_sales"].withColumn("transaction_id", F.concat("transaction_id", F.col("quantity").cast("string"))))
    slow, fast = (measures.measures(one, NAMES, ["category"], unique=u) for u in (False, True))
    assert sorted(map(repr, slow.collect())) == sorted(map(repr, fast.collect()))
    assert measures.measure(one, "total_transactions", ["category"], unique=True)._jdf.queryExecution().toString().count("Union") == 0


@pytest.mark.parametrize("query", [measures.sales_ytd, measures.sales_previous_month, measures.mom_sales_growth])
def test_months_take_one_pass_over_the_facts(tables, query):
    plan = query(tables)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^\]]*gross_amount", plan)) == 1


def test_months_without_sales_are_months(tables):
    rows = measures.mom_sales_growth(tables).collect()
    assert [r.month_start.month for r in rows] == list(range(1, 10))
    assert [r.total_sales for r in rows][1] == 0 and rows[0].sales_previous_month is None and rows[5].sales_previous_month > 0
    assert measures.sales_ytd(tables).collect()[-1].sales_ytd == sum(range(60))
    empty = dict(tables, fact_sales=tables["fact_sales"].limit(0))
    assert measures.sales_ytd(empty).count() == 0


def test_totals_beyond_eighteen_digits(spark, tables):
    """Thirty sales of 9e14: every total is above 1e16."""
    large = D("900000000000000.00")
    rows = [(f"T{k}", day("2023-01-05"), "c1", "p1", "s1", 1, large, D(0), large, "web") for k in range(30)]
    sales = spark.createDataFrame(rows, SALES)
    stock = spark.createDataFrame([("p1", "s1", 5, 9, "REORDER_NEEDED", large)] * 30,
                                  "product_id STRING, store_id STRING, stock_on_hand INT, reorder_point INT, reorder_status STRING, inventory_valuation DECIMAL(18,2)")
    customers = spark.createDataFrame([("c1", "Champions", large, 3)] * 30, "customer_id STRING, rfm_segment STRING, total_spend DECIMAL(18,2), days_since_last_purchase INT")
    stores = spark.createDataFrame([("s1", "north", "n", "c")], "store_id STRING, region STRING, store_name STRING, city STRING")
    products = spark.createDataFrame([("p1", "x", "n", 1.0)], "product_id STRING, category STRING, product_name STRING, profit_margin_pct DOUBLE")
    t = dict(tables, fact_sales=sales, fact_inventory_snapshot=stock, dim_customers=customers, dim_stores=stores, dim_products=products)
    total = 30 * large
    assert kpis.financial_kpis(t).first().total_revenue == total
    assert kpis.inventory_kpis(t).first().total_inventory_value == total
    assert kpis.rfm_distribution(t).first().spend == total
    assert kpis.store_profitability(t).first().store_revenue == total and kpis.store_profitability(t, unique=True).first().store_profit == total
    assert kpis.top_margin_products(t).first().total_profit == total
    assert kpis.monthly_performance(t).first().gross_revenue == total
    assert measures.sales_ytd(t).first().sales_ytd == total and measures.mom_sales_growth(t).first().total_sales == total
    assert measures.measure(t, "total_sales", ["region"]).first().total_sales == total
    assert sales.agg(star.total("gross_amount")).first()[0] == total
