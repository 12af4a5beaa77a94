"""The given tables, read as the raw feeds of a retailer.

Defects (duplicates, bad quantities, missing values, odd spellings) are made by key arithmetic that any
engine can evaluate; ``feed_sql`` states the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Total orders that decide which copy of a key is the first.
SALES_ORDER = (
    "timestamp", "product_id", "store_id", "quantity", "unit_price", "customer_id", "payment_method", "channel",
)
CUSTOMER_ORDER = ("feed_seq",)
PRODUCT_ORDER = ("feed_seq",)
STORE_ORDER = ("store_id",)
INVENTORY_ORDER = ("last_restock_date",)

ROWS_PER_TASK = 500_000  # order lines that one task gets, about


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def read_lines(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Order lines, pruned to some columns.

    The given table may be one file that only one task can scan. Where it has fewer files than the
    session has cores, the rows are spread by order; a table of many files is left as it is. The tasks grow
    with the rows (which the footers tell): joins and sorts after this keep the dealing, so that a fixed number
    of tasks would have each of them sort ever more.
    """
    lines = read(spark, sf_dir, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    few_files = len(lines.inputFiles()) < cores
    chosen = lines.select(*columns)
    return chosen.repartition(line_tasks(lines), "l_orderkey") if few_files else chosen


def line_tasks(lines: DataFrame) -> int:
    """Tasks for the order lines: one for each core at least, and more with more rows."""
    return max(lines.sparkSession.sparkContext.defaultParallelism, -(-lines.count() // ROWS_PER_TASK))


def sales_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales dealt by their key, for the deduplication, in tasks that grow with the rows.

    Merged by their bytes or dealt to a fixed number of tasks, each would sort and count ever more of them.
    """
    return bronze_sales(spark, sf_dir).repartition(line_tasks(read(spark, sf_dir, "lineitem")), "transaction_id")


def _cents(value: Column) -> Column:
    return (F.floor(value * 100 + 0.5) / 100).cast("decimal(12,2)")


def _line_price() -> Column:
    return _cents(F.col("l_extendedprice") / F.col("l_quantity"))


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read_lines(
        spark, sf_dir,
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
    )
    order = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    method = F.element_at(
        F.array(F.lit("Credit Card"), F.lit("PayPal"), F.lit("Cash")), (F.col("l_linenumber") % 3 + 1).cast("int")
    )
    priority = F.col("o_orderpriority")
    return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.when((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 150 == 0, F.lit(-2))
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("quantity"),
        _line_price().alias("unit_price"),
        F.when((F.col("l_orderkey") + F.col("l_suppkey")) % 120 != 0, method).alias("payment_method"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "Online")
        .when(priority == "3-MEDIUM", "Mobile App")
        .otherwise("In-Store")
        .alias("channel"),
    )


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 40th customer comes twice, the second time with another email."""
    key = F.col("c_custkey")
    first, last = F.split("c_name", "#")[0], F.split("c_name", "#")[1]
    tiers = F.array(*[F.lit(t) for t in ("Bronze", "Silver", "Gold", "Platinum", "VIP", "Basic")])
    copies = F.when(key % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    seq = F.col("feed_seq")
    email = F.concat(F.lower(first), F.lit("."), last, seq.cast("string"), F.lit("@example.com"))
    return (
        read(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_nationkey", F.explode(copies).alias("feed_seq"))
        .select(
            key.alias("customer_id"),
            first.alias("first_name"),
            last.alias("last_name"),
            F.when(key % 20 != 5, email).alias("email"),
            F.concat(F.lit("+1-555-"), (key % 900 + 100).cast("string")).alias("phone"),
            F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int")), "yyyy-MM-dd").alias(
                "signup_date"
            ),
            F.element_at(tiers, (key % 6 + 1).cast("int")).alias("loyalty_tier"),
            F.concat(F.lit("CITY_"), F.col("c_nationkey").cast("string")).alias("city"),
            (key % 119 + 2).cast("int").alias("web_sessions_count"),
            (key % 2 == 0).alias("opt_in_marketing"),
            "feed_seq",
        )
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th part is unknown to the catalogue; every 50th comes twice, then with another name."""
    key = F.col("p_partkey")
    copies = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        read(spark, sf_dir, "part")
        .filter(key % 97 != 0)
        .select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice", F.explode(copies).alias("feed_seq"))
        .select(
            key.alias("product_id"),
            F.when(F.col("feed_seq") == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" (copy)"))).alias(
                "product_name"
            ),
            F.col("p_type").alias("category"),
            (F.floor(F.col("p_retailprice") * (50 + key % 36) + 0.5) / 100).cast("decimal(12,2)").alias("unit_cost"),
            _cents(F.col("p_retailprice")).alias("suggested_retail_price"),
            F.col("p_brand").alias("supplier"),
            "feed_seq",
        )
    )


def bronze_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier")
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    key = F.col("s_suppkey")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.concat(F.lit("CITY_"), (key % 7).cast("string")).alias("city"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("region"),
            (key * 37 % 35001 + 15000).cast("int").alias("square_feet"),
            (key % 9 + 2015).cast("int").alias("opened_year"),
        )
    )


def bronze_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per order line, so that pairs repeat; the earliest restock is the first."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    return read_lines(spark, sf_dir, "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate").select(
        p.alias("product_id"),
        s.alias("store_id"),
        ((p * 7 + s * 13) % 251).cast("int").alias("stock_on_hand"),
        ((p + s) % 26 + 15).cast("int").alias("reorder_point"),
        ((p * 3 + s) % 16 + 10).cast("int").alias("safety_stock"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("last_restock_date"),
    )


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines as text, with ``row_seq`` from the position in the file."""
    line = read_lines(
        spark, sf_dir,
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
        F.col("_metadata.row_index").alias("row_seq"),
    )
    order = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    negative = (ok % 50 == 0) | ((ok + sk) % 20 == 0)
    quantity = F.col("l_quantity").cast("int")
    day = (ok + pk) % 60
    cell = (pk + sk) % 70
    spelling = ok % 90
    return (
        line.join(order, ok == F.col("o_orderkey"))
        .join(part, pk == F.col("p_partkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "row_seq",
            F.concat(F.when(ok % 50 == 0, "C").otherwise(""), ok.cast("string")).alias("InvoiceNo"),
            pk.cast("string").alias("StockCode"),
            F.when(pk % 16 != 0, F.col("p_name")).alias("Description"),
            F.when(negative, -quantity).otherwise(quantity).cast("string").alias("Quantity"),
            F.when(day == 0, "INVALID_TIMESTAMP")
            .when(day == 30, "2024-99-99 25:99:99")
            .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
            .alias("InvoiceDate"),
            F.when(cell == 0, "95000.0").when(cell == 35, "-15.5").otherwise(_line_price().cast("string")).alias(
                "UnitPrice"
            ),
            F.when(F.col("o_custkey") % 12 != 0, F.col("o_custkey").cast("string")).alias("CustomerID"),
            F.when(spelling == 18, "uk")
            .when(spelling == 36, "UNKNOWN_COUNTRY")
            .when(spelling == 54, "  Germany  ")
            .otherwise(F.col("n_name"))
            .alias("Country"),
        )
    )


BUILDERS = {
    "bronze_sales_raw": bronze_sales,
    "bronze_customers_raw": bronze_customers,
    "bronze_inventory_raw": bronze_inventory,
    "bronze_products_raw": bronze_products,
    "bronze_stores_raw": bronze_stores,
}


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}
