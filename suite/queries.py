"""The registered queries: name -> function of (session, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import feed, layers, sheets
from suite.canonical import canonical
from tallyhouse import schemas
from tallyhouse import settings as S
from tallyhouse.functions.hashing import row_hash
from tallyhouse.functions.rules import LINE_RULES
from tallyhouse.functions.sqlcompat import register_strftime
from tallyhouse.operators import (
    cleansing,
    dedup,
    features,
    forest,
    lineage,
    quality,
    scoring,
    star,
    validation,
)
from tallyhouse.plans import anomaly_report, kpis, measures, medallion, workbench
from tallyhouse.sources import files, tables, workbook
from tallyhouse.session import ship_package, shuffles_removed
from tallyhouse.sources.staging import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCH = "BATCH-20240630120000"
MOMENT = datetime(2024, 6, 30, 12, 0, 0)


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; its result is given in plain types."""

    def register(fn: Query) -> Query:
        assert name not in QUERIES, name
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return canonical(fn(spark, sf_dir))

        QUERIES[name] = run
        return fn

    return register


def over_layers(name: str, fn: Callable[[layers.Layers], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: fn(layers.Layers(spark, sf_dir)))


def over_lines(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: fn(feed.retail_lines(spark, sf_dir)))


# --- sources and sinks ------------------------------------------------------------------------
def _feed_files(df: DataFrame, label: str, kind: str, **options: bool) -> str:
    """Packed part files, which are not split when read; each is one task's work, so their rows are bounded."""
    path = new_path(df.sparkSession, label)
    packed = df.write.format(kind).options(compression="gzip", maxRecordsPerFile=feed.ROWS_PER_TASK, **options)
    with shuffles_removed(df.sparkSession):
        packed.save(path)
    return path


def _sales_files(spark: SparkSession, sf_dir: str) -> str:
    """The sales feed as CSV part files, in the order that decides which copy is first."""
    sales = feed.bronze_sales(spark, sf_dir).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    ).orderBy(*[F.col(c).asc_nulls_first() for c in feed.SALES_ORDER])
    return _feed_files(sales, "sales-csv", "csv", header=True)


def _customer_files(spark: SparkSession, sf_dir: str) -> str:
    customers = feed.bronze_customers(spark, sf_dir).orderBy("customer_id", "feed_seq").drop("feed_seq").withColumn(
        "customer_id", F.col("customer_id").cast("string")
    )
    return _feed_files(customers, "customers-json", "json")


def _product_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = feed.bronze_products(spark, sf_dir)
    book = F.floor(F.col("product_id") / 500)  # ranges of a unique key, each at most twice 500 rows
    return workbook.read_cell_rows(
        sheets.as_workbooks(products, "Products_Master", book, ["product_id", "feed_seq"])
    )


def _store_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = feed.bronze_stores(spark, sf_dir)
    book = F.floor(F.col("store_id") / 500)
    return workbook.read_cell_rows(sheets.as_workbooks(stores, "Stores_Master", book, ["store_id"]))


@query("sales_csv_source")
def _(spark, sf_dir):
    return files.ingest_csv(spark, _sales_files(spark, sf_dir)).drop("row_seq", "source_file")


@query("customers_json_source")
def _(spark, sf_dir):
    path = _customer_files(spark, sf_dir)
    return files.ingest_json(spark, path, schemas.CUSTOMERS_RAW, array_file=False).drop("row_seq", "source_file")


@query("products_workbook_source")
def _(spark, sf_dir):
    cells = _product_cells(spark, sf_dir)
    return workbook.sheet_table(cells, "Products_Master", schemas.PRODUCTS_RAW).drop("row_seq", "source_file")


@query("retail_lines_source")
def _(spark, sf_dir):
    path = new_path(spark, "lines-csv")
    files.export_csv(feed.retail_lines(spark, sf_dir).drop("row_seq"), path)
    return files.read_retail_lines(spark, "unheard-of.csv", {"online_retail.csv": path}).drop("row_seq")


@query("file_order_sequence")
def _(spark, sf_dir):
    """Files written in sort order: the sequence must be unique and grow with the sort order."""
    rows = files.ingest_csv(spark, _sales_files(spark, sf_dir))
    per_day = rows.groupBy("timestamp").agg(
        F.min("row_seq").alias("first"), F.max("row_seq").alias("last"), F.count_distinct("row_seq").alias("n")
    )
    # One row per day: the window is over days, not over sales.
    before = "max(last) OVER (ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return per_day.withColumn("before", F.expr(before)).select(
        "timestamp", "n", F.coalesce(F.col("first") > F.col("before"), F.lit(True)).alias("in_order")
    )


@query("layer_write_and_read")
def _(spark, sf_dir):
    root = new_path(spark, "warehouse")
    sales = layers.silver(spark, sf_dir)["silver_sales"]
    month = sales.withColumn("sales_month", F.date_format("transaction_date", "yyyy-MM"))
    tables.write_layer(month, root, "silver_sales", partition_by="sales_month")
    return tables.read_table(spark, "silver_sales", root).withColumn("sales_month", F.col("sales_month").cast("string"))


@query("csv_export")
def _(spark, sf_dir):
    path = new_path(spark, "export")
    parts = feed.bronze_products(spark, sf_dir).select("product_id", "product_name", "category", "feed_seq")
    parts = parts.withColumn("product_name", F.concat(F.lit(' the "'), "product_name", F.lit('", new ')))
    files.export_csv(parts, path)
    return spark.read.schema(parts.schema).csv(path, header=True, escape='"')


@query("dataset_catalog")
def _(spark, sf_dir):
    sales = _sales_files(spark, sf_dir)
    named = {"online_retail.csv": sales, "sample_dirty_data.csv": sales + "-absent"}
    found = files.dataset_catalog(spark, named, dirty=("sample_dirty_data.csv",))
    return found.select("filename", "records", (F.col("size_kb") > 0).alias("has_size"), "is_dirty_sample")


@query("table_listing")
def _(spark, sf_dir):
    named = layers.Layers(spark, sf_dir).only(schemas.GOLD_TABLES)
    tables.register_tables(named)
    listed = tables.list_tables(spark).filter(F.col("table_name").isin(*schemas.GOLD_TABLES))
    return tables.table_counts(named).join(listed, "table_name").select("table_name", "row_count", "status")


@query("table_sample")
def _(spark, sf_dir):
    tables.register_tables({"fact_sales": layers.Layers(spark, sf_dir)["fact_sales"]})
    return tables.table_sample(spark, "fact_sales", 900)


# --- bronze -----------------------------------------------------------------------------------
@query("audit_columns")
def _(spark, sf_dir):
    return lineage.add_audit_columns(feed.bronze_stores(spark, sf_dir), BATCH, MOMENT, "book.xlsx::Stores_Master")


@query("row_hash")
def _(spark, sf_dir):
    lines = feed.retail_lines(spark, sf_dir)
    return lines.select("row_seq", row_hash(schemas.RETAIL_LINES.names).alias("row_hash"))


@query("bronze_summary")
def _(spark, sf_dir):
    return lineage.bronze_summary(feed.bronze(spark, sf_dir), BATCH)


# --- silver -----------------------------------------------------------------------------------
@query("dedup_sales")
def _(spark, sf_dir):
    return dedup.keep_first(feed.bronze_sales(spark, sf_dir), ["transaction_id"], feed.SALES_ORDER)


@query("dedup_customers")
def _(spark, sf_dir):
    return dedup.keep_first(feed.bronze_customers(spark, sf_dir), ["customer_id"], feed.CUSTOMER_ORDER)


@query("dedup_products")
def _(spark, sf_dir):
    return dedup.keep_first(feed.bronze_products(spark, sf_dir), ["product_id"], feed.PRODUCT_ORDER)


@query("dedup_inventory")
def _(spark, sf_dir):
    return dedup.keep_first(feed.bronze_inventory(spark, sf_dir), ["product_id", "store_id"], feed.INVENTORY_ORDER)


@query("quantity_filter")
def _(spark, sf_dir):
    return cleansing.filter_quantity(feed.bronze_sales(spark, sf_dir)).groupBy("channel").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("quantity")
    )


@query("payment_imputation")
def _(spark, sf_dir):
    filled = cleansing.impute_constant(feed.bronze_sales(spark, sf_dir), "payment_method", S.MISSING_PAYMENT)
    return filled.groupBy("payment_method").agg(F.count(F.lit(1)).alias("row_count"))


@query("email_imputation")
def _(spark, sf_dir):
    return cleansing.impute_email(feed.bronze_customers(spark, sf_dir)).select("customer_id", "feed_seq", "email")


@query("price_bounds")
def _(spark, sf_dir):
    return validation.check_bounds(feed.bronze_sales(spark, sf_dir), "unit_price", "1000.00", "1900.00")


@query("rule_checks")
def _(spark, sf_dir):
    raw = feed.bronze(spark, sf_dir)
    checked = validation.rule_set(raw["bronze_sales_raw"], "sales")
    checked = checked.unionByName(validation.rule_set(raw["bronze_inventory_raw"], "inventory"))
    return checked.unionByName(validation.rule_set(raw["bronze_customers_raw"], "customers"))


def _metrics(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    raw = feed.bronze(spark, sf_dir)
    return (
        validation.sales_metrics(raw["bronze_sales_raw"], feed.SALES_ORDER),
        validation.customer_metrics(raw["bronze_customers_raw"], feed.CUSTOMER_ORDER),
    )


query("sales_metrics")(lambda spark, sf_dir: _metrics(spark, sf_dir)[0])
query("customer_metrics")(lambda spark, sf_dir: _metrics(spark, sf_dir)[1])


@query("validation_log")
def _(spark, sf_dir):
    return validation.full_validation_log(*_metrics(spark, sf_dir), BATCH, MOMENT)


@query("latest_validation_logs")
def _(spark, sf_dir):
    """Two batches appended to a log, one of them twice, then the newest entries."""
    root = new_path(spark, "warehouse")
    sales, customers = _metrics(spark, sf_dir)
    for batch, moment in ((BATCH, MOMENT), (BATCH, MOMENT), ("BATCH-20240701120000", datetime(2024, 7, 1, 12))):
        tables.append_log(validation.full_validation_log(sales, customers, batch, moment), root)
    return validation.latest_validation_logs(tables.read_table(spark, "silver_validation_log", root), 6)


for _name in schemas.SILVER_TABLES:
    over_layers(_name, lambda t, n=_name: t[n])


@query("silver_summary")
def _(spark, sf_dir):
    sales, customers = _metrics(spark, sf_dir)
    return medallion.silver_summary(layers.silver(spark, sf_dir), {"sales": sales, "customers": customers})


# --- gold -------------------------------------------------------------------------------------
over_layers("customer_aggregate", lambda t: star.customer_aggregate(t["silver_sales"]))
over_layers(
    "customer_profile",
    lambda t: star.customer_profile(t["silver_customers"], star.customer_aggregate(t["silver_sales"])).select(
        "customer_id", "total_orders", "total_spend", "avg_order_value", "last_purchase_date"
    ),
)
over_layers(
    "customer_recency",
    lambda t: star.with_recency(
        star.customer_profile(t["silver_customers"], star.customer_aggregate(t["silver_sales"])),
        star.latest_sale(t["silver_sales"]),
    ).select("customer_id", "last_purchase_date", "days_since_last_purchase"),
)
over_layers(
    "rfm_segments_default",
    lambda t: star.dim_customers(t["silver_customers"], t["silver_sales"])
    .groupBy("rfm_segment")
    .agg(F.count(F.lit(1)).alias("customers")),
)
for _name in schemas.GOLD_TABLES:
    over_layers(_name, lambda t, n=_name: t[n])
over_layers("referential_integrity", star.integrity_report)
over_layers("gold_summary", star.gold_summary)
over_layers("medallion_summary", star.medallion_summary)

# --- KPIs -------------------------------------------------------------------------------------
over_layers("monthly_performance", kpis.monthly_performance)
over_layers("rfm_summary", kpis.rfm_summary)
over_layers("reorder_matrix", kpis.reorder_matrix)
over_layers("top_margin_products", kpis.top_margin_products)
over_layers("store_profitability", lambda t: kpis.store_profitability(t, unique=True))
over_layers("store_profitability_exact_distinct", lambda t: kpis.store_profitability(t, unique=False))
over_layers("financial_kpis", kpis.financial_kpis)
over_layers("inventory_kpis", kpis.inventory_kpis)
over_layers("rfm_distribution", kpis.rfm_distribution)
over_layers("monthly_trend", kpis.monthly_trend)
over_layers("category_kpis", kpis.category_kpis)
for _name in kpis.PRESETS:
    over_layers(f"preset_{_name}", lambda t, n=_name: kpis.preset(n, t))

# --- measures ---------------------------------------------------------------------------------
FACT_MEASURES = [n for n, m in measures.MEASURES.items() if m.table == "fact_sales"]
STOCK_MEASURES = [n for n, m in measures.MEASURES.items() if m.table == "fact_inventory_snapshot"]
CUSTOMER_MEASURES = [n for n, m in measures.MEASURES.items() if m.table == "dim_customers"]
over_layers("sales_measures", lambda t: measures.measures(t, FACT_MEASURES))
over_layers("sales_measures_by_category", lambda t: measures.measures(t, FACT_MEASURES, ["category"]))
over_layers("sales_measures_by_region_channel", lambda t: measures.measures(t, FACT_MEASURES, ["region", "channel"]))
over_layers("inventory_measures", lambda t: measures.measures(t, STOCK_MEASURES))
over_layers("inventory_measures_by_region", lambda t: measures.measures(t, STOCK_MEASURES, ["region"]))
over_layers("customer_measures", lambda t: measures.measures(t, CUSTOMER_MEASURES))
over_layers("customer_measures_by_tier", lambda t: measures.measures(t, CUSTOMER_MEASURES, ["loyalty_tier"]))
over_layers("stock_turnover_ratio", measures.stock_turnover_ratio)
over_layers("stock_turnover_ratio_by_category", lambda t: measures.stock_turnover_ratio(t, ["category"]))
over_layers("sales_ytd", measures.sales_ytd)
over_layers("sales_previous_month", measures.sales_previous_month)
over_layers("mom_sales_growth", measures.mom_sales_growth)
over_layers("revenue_by_channel", measures.revenue_by_channel)
over_layers("top_category_products", measures.top_category_products)
over_layers("sales_by_location", measures.sales_by_location)
over_layers("valuation_by_category", measures.valuation_by_category)
over_layers("stock_scatter", measures.stock_scatter)
over_layers("recency_spend_scatter", measures.recency_spend_scatter)
over_layers("customer_roster", measures.customer_roster)

# --- ad-hoc SQL -------------------------------------------------------------------------------
ADHOC = """
WITH lines AS (
  SELECT STRFTIME('%Y-%m', transaction_date) AS sales_month, channel, gross_amount FROM fact_sales WHERE quantity > 1
)
SELECT channel, sales_month, COUNT(*) AS n_lines, SUM(gross_amount) AS revenue
FROM lines GROUP BY channel, sales_month HAVING COUNT(*) > 2
"""


@query("adhoc_sql")
def _(spark, sf_dir):
    return workbench.run_query(spark, ADHOC, {"fact_sales": layers.Layers(spark, sf_dir)["fact_sales"]})


@query("strftime_shim")
def _(spark, sf_dir):
    register_strftime(spark)
    purchases = feed.read(spark, sf_dir, "events").filter("event_type = 'purchase'")
    purchases.createOrReplaceTempView("purchases")
    return spark.sql(
        "SELECT strftime('%Y-%m-%d %H:%M', ts) AS minute, count(*) AS n FROM purchases "
        "GROUP BY strftime('%Y-%m-%d %H:%M', ts)"
    )


@query("purchases_by_hour")
def _(spark, sf_dir):
    """Hour of the day, on events as the only table with times."""
    events = feed.read(spark, sf_dir, "events").filter("event_type = 'purchase'")
    rows = events.select(F.col("ts").alias("timestamp"), F.lit(1).alias("quantity"),
                         F.col("value").cast("decimal(12,2)").alias("unit_price"))
    return cleansing.standardize_sales(rows).groupBy("transaction_hour").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("gross_amount").alias("amount")
    )


# --- quality rules ----------------------------------------------------------------------------
RULE_NAMES = dict(
    zip(LINE_RULES, ("missing_customer", "missing_description", "negative_quantity", "unit_price_bounds",
                     "invalid_date", "inconsistent_country"))
)
for _label, _short in RULE_NAMES.items():
    over_lines(f"rule_{_short}", lambda lines, rule=LINE_RULES[_label]: lines.filter(rule()).select("row_seq"))
over_lines("rule_duplicate_row", lambda lines: quality.flag_duplicates(lines).filter("is_duplicate").select("row_seq"))
over_lines(
    "quality_flags", lambda lines: quality.dq_flag(lines).select("row_seq", "dq_issue_flag", "dq_issue_reason")
)
over_lines("quality_issue_list", quality.dq_issue_list)
over_lines("quality_rule_breakdown", quality.dq_rule_breakdown)
over_lines("quality_rule_breakdown_all", lambda lines: quality.dq_rule_breakdown(lines, include_duplicates=True))

# --- features ---------------------------------------------------------------------------------
over_lines(
    "numeric_coercion", lambda lines: features.coerce_numeric(lines).select("row_seq", "Quantity", "UnitPrice")
)
over_lines(
    "total_amount",
    lambda lines: features.with_total_amount(features.coerce_numeric(lines)).select("row_seq", "TotalAmount"),
)
over_lines(
    "customer_features",
    lambda lines: features.customer_features(features.with_total_amount(features.coerce_numeric(lines))).select(
        "row_seq", "CustomerPurchaseFrequency", "CustomerTotalSpend", "AverageTransactionValue"
    ),
)
over_lines(
    "country_feature", lambda lines: features.country_feature(lines).select("row_seq", "CountryTransactionCount")
)
over_lines("line_features", lambda lines: features.line_features(lines).select("row_seq", *S.FEATURES))


def _gappy(lines: DataFrame) -> DataFrame:
    """Features with holes, so that imputation has something to fill."""
    hole = F.col("row_seq") % 11 == 3
    featured = features.line_features(lines).select("row_seq", *S.FEATURES)
    return featured.withColumns({c: F.when(~hole, F.col(c)) for c in ("TotalAmount", "UnitPrice")})


def _rounded(df: DataFrame) -> DataFrame:
    from tallyhouse.functions.numbers import round_half_up

    return df.select("row_seq", *[round_half_up(F.col(c), 6).alias(c) for c in df.columns if c != "row_seq"])


over_lines(
    "median_imputation",
    lambda lines: _rounded(features.impute_median(stage(_gappy(lines), "gappy")).select("row_seq", *S.FEATURES)),
)
SCALED = [c + "_scaled" for c in S.FEATURES]


def _features(lines: DataFrame) -> DataFrame:
    return stage(features.line_features(lines).select("row_seq", *S.FEATURES), "features")


over_lines("robust_scaling", lambda lines: _rounded(features.robust_scale(_features(lines)).select("row_seq", *SCALED)))
over_lines(
    "robust_scaling_narrowed",
    lambda lines: _rounded(features.robust_scale(_features(lines), limit=2000).select("row_seq", *SCALED)),
)
over_lines(
    "standard_scaling", lambda lines: _rounded(features.standard_scale(_features(lines)).select("row_seq", *SCALED))
)

# --- anomaly model ----------------------------------------------------------------------------
CONTAMINATION = 0.05


def _stand_in(lines: DataFrame) -> DataFrame:
    """Quality flags and features with a raw score by arithmetic instead of by a forest."""
    scored = features.with_total_amount(features.coerce_numeric(quality.dq_flag(lines)))
    mixed = (F.col("row_seq") * 7919 + F.col("StockCode").cast("bigint") * 104729) % 1000003
    return scored.withColumn("raw_score", -mixed.cast("double") / F.lit(1000003.0))


def over_stand_in(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = stage(_stand_in(feed.retail_lines(spark, sf_dir)), "stand-in")
        return fn(anomaly_report.classify_lines(scored, CONTAMINATION))

    query(name)(run)


over_stand_in(
    "anomaly_classification",
    lambda c: c.select("row_seq", "ml_anomaly_pred", "ml_anomaly_label", "ml_anomaly_score", "system_status"),
)
over_stand_in("anomaly_kpi_summary", scoring.kpi_summary)
over_stand_in("anomaly_score_histogram", scoring.score_histogram)
over_stand_in("anomalies_by_country", scoring.anomalies_by_country)
over_stand_in("anomalies_by_product", scoring.anomalies_by_product)
over_stand_in("top_suspicious", scoring.top_suspicious)
over_stand_in(
    "suspicious_filter",
    lambda c: scoring.filter_suspicious(scoring.suspicious_view(c), S.STATUS_ANOMALY, " NATION_1 ").select(
        "transaction_index", "invoice_no", "country", "system_status"
    ),
)
over_stand_in("transaction_lookup", lambda c: scoring.find_transaction(scoring.suspicious_view(c), 4242))
over_stand_in(
    "score_bands",
    lambda c: scoring.with_score_band(scoring.suspicious_view(c)).groupBy("score_band").agg(
        F.count(F.lit(1)).alias("lines")
    ),
)


def _line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as a stored table, which the model scans several times."""
    return stage(feed.retail_lines(spark, sf_dir), "lines")


def _forest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_table(spark, sf_dir)
    return forest.fit_isolation_forest(features.line_features(lines), n_rows=lines.count())


query("forest_nodes")(_forest_nodes)


@query("forest_scores")
def _(spark, sf_dir):
    lines = _line_table(spark, sf_dir)
    scored = anomaly_report.score_lines(lines)
    return scored.select("row_seq", "path_sum", F.floor(F.col("raw_score") * 1e6 + 0.5).alias("raw_score_micro"))


@query("anomaly_report_kpis")
def _(spark, sf_dir):
    return anomaly_report.anomaly_report(_line_table(spark, sf_dir), "online_retail.csv")["kpi_summary"]


@query("anomaly_report_top_suspicious")
def _(spark, sf_dir):
    settings = anomaly_report.ModelSettings(contamination=0.1, n_estimators=50, seed=7)
    report = anomaly_report.anomaly_report(_line_table(spark, sf_dir), "online_retail.csv", settings)
    return report["top_suspicious_transactions"]


# --- the whole run ----------------------------------------------------------------------------
@query("medallion_run")
def _(spark, sf_dir):
    """Raw files derived from the given tables, through all layers on storage; the written counts."""
    stock = feed.bronze_inventory(spark, sf_dir).orderBy("last_restock_date")
    inventory = _feed_files(stock, "inventory-csv", "csv", header=True)
    raw = {
        "bronze_sales_raw": files.ingest_csv(spark, _sales_files(spark, sf_dir)),
        "bronze_customers_raw": files.ingest_json(
            spark, _customer_files(spark, sf_dir), schemas.CUSTOMERS_RAW, array_file=False
        ),
        "bronze_inventory_raw": files.read_delimited(spark, inventory, schemas.INVENTORY_RAW),
        "bronze_products_raw": workbook.sheet_table(
            _product_cells(spark, sf_dir), "Products_Master", schemas.PRODUCTS_RAW
        ),
        "bronze_stores_raw": workbook.sheet_table(_store_cells(spark, sf_dir), "Stores_Master", schemas.STORES_RAW),
    }
    root = new_path(spark, "warehouse")
    medallion.run_layers(raw, root, BATCH, MOMENT, layers.SCALED_RFM)
    written = {n: tables.read_table(spark, n, root)
               for n in (*schemas.BRONZE_TABLES, *schemas.SILVER_TABLES, *schemas.GOLD_TABLES)}
    return star.gold_summary(written).select("*", *[
        star.medallion_summary(written).select(F.struct("*")).scalar()[c].alias(c) for c in star.MEDALLION_COUNTS
    ])
