"""What a run holds on disk besides its tables: shuffle files, feeds, and the codec of the tables."""

import glob
import gzip
import os
import time
from datetime import datetime
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from suite import feed, queries
from tallyhouse import schemas
from tallyhouse.plans import medallion
from tallyhouse.session import shuffles_removed
from tallyhouse.sources import files, tables

REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MOMENT = datetime(2024, 9, 1)


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {os.path.join(at, n) for f in folders for at, _, names in os.walk(f) for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_over(spark, before: set[str]) -> int:
    """Bytes of shuffles that came since and are still there; executors are told to remove them, not waited for."""
    for _ in range(20):
        if not (left := sum(os.path.getsize(f) for f in shuffle_files(spark) - before if os.path.exists(f))):
            break
        time.sleep(0.1)
    return left


@pytest.fixture(scope="module")
def raw(spark):
    """Sales with copies, also of the missing id, and stock with copies of a pair."""
    def numbered(rows, schema):
        fields = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields]
        rows = [(*row, i, f"part-{i % 3}.csv") for i, row in enumerate(rows)]
        return spark.createDataFrame(rows, ", ".join([*fields, "row_seq bigint", "source_file string"]))

    sales = [
        (None if i % 50 == 0 else f"T{i // 2 if i % 10 == 0 else i}", f"2024-{i % 3 + 1:02d}-{i % 28 + 1:02d} 10:00:00", f"C{i % 9}",
         None if i % 40 == 1 else f"P{i % 12}", f"S{i % 4}", i % 6, Decimal(i % 70) / 4, None if i % 8 == 0 else "Cash", "Online")
        for i in range(600)
    ]
    people = [(f"C{i % 9}", "A", "B", None if i % 2 else "a@b.c", "1", "2023-05-06", "Gold", "Ulm", 3, False) for i in range(11)]
    stock = [(None if i % 45 == 7 else f"P{i % 12}", f"S{i % 7}", i % 30, 10, 2, "2024-01-01") for i in range(200)]
    products = [(f"P{i}", f"Item {i}", "ab"[i % 2], Decimal("0.75"), Decimal(3), "X") for i in range(10)]
    stores = [(f"S{i}", f"Shop {i}", "Ulm", "BW", "South", 100, 2000) for i in range(4)]
    return {
        "bronze_sales_raw": numbered(sales, schemas.SALES_RAW),
        "bronze_customers_raw": numbered(people, schemas.CUSTOMERS_RAW),
        "bronze_inventory_raw": numbered(stock, schemas.INVENTORY_RAW),
        "bronze_products_raw": numbered(products, schemas.PRODUCTS_RAW),
        "bronze_stores_raw": numbered(stores, schemas.STORES_RAW),
    }


def run(raw, root):
    report = medallion.run_layers(raw, root, moment=MOMENT)
    return {k: v for k, v in report.items() if k != "execution_time_seconds"}


def rows(spark, root, name):
    table = tables.read_table(spark, name, root)
    return sorted(map(str, table.select(*sorted(table.columns)).collect()))


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    numbers = spark.range(20_000).select((F.col("id") % 7).alias("month"), (F.col("id") * 7 % 5003).alias("k"))
    for name, month in (("silver_a", None), ("silver_b", "month")):
        before = shuffle_files(spark)
        tables.write_layer(numbers.groupBy("month", "k").count().orderBy("k"), str(tmp_path), name, partition_by=month)
        assert not left_over(spark, before), name
        assert tables.read_table(spark, name, str(tmp_path)).agg(F.sum("count")).first()[0] == 20_000


def test_layers_leave_no_shuffled_rows(spark, raw, tmp_path):
    """Only counts of rows may stay: one number a task."""
    before = shuffle_files(spark)
    medallion.build_gold_layer(medallion.build_silver_layer(
        medallion.build_bronze_layer(raw, str(tmp_path), "B", MOMENT), str(tmp_path), "B", MOMENT)[0], str(tmp_path))
    assert left_over(spark, before) < 1000


def test_setting_is_restored(spark, conf):
    default = spark.conf.get(REMOVE)
    with shuffles_removed(spark):
        assert spark.conf.get(REMOVE) == "true"
    assert spark.conf.get(REMOVE) == default
    conf(**{REMOVE.replace(".", "__"): "true"})
    with pytest.raises(KeyError), shuffles_removed(spark):
        raise KeyError
    assert spark.conf.get(REMOVE) == "true"


@pytest.mark.parametrize("partition_by", [None, "month"])
def test_layer_tables_are_packed_well(spark, tmp_path, partition_by):
    tables.write_layer(spark.range(100).withColumn("month", F.col("id") % 2), str(tmp_path), "silver_a", partition_by=partition_by)
    written = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    assert written and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in written} == {"ZSTD"}


@pytest.mark.parametrize("keys", [("transaction_id",), ("customer_id", "transaction_id")])
def test_rounds_are_the_table_in_whole_keys(spark, raw, monkeypatch, keys):
    sales = raw["bronze_sales_raw"]
    assert len(medallion.rounds(sales, keys)) == 1
    monkeypatch.setattr(medallion, "ROUND_ROWS", 150)
    parts = [part.collect() for part in medallion.rounds(sales, keys)]
    assert len(parts) == 4 and all(parts)
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, sales.collect()))
    found = [{tuple(r[k] for k in keys) for r in part} for part in parts]
    assert sum(map(len, found)) == len(set().union(*found))
    monkeypatch.setattr(medallion, "ROUND_ROWS", 1)
    assert len(medallion.rounds(sales, keys)) == medallion.MOST_ROUNDS
    assert len(medallion.rounds(sales.limit(0), keys)) == 1


def test_rounds_write_the_same_tables(spark, raw, tmp_path, monkeypatch):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    expected = run(raw, whole)
    monkeypatch.setattr(medallion, "ROUND_ROWS", 70)
    written = []
    write = tables.write_layer
    monkeypatch.setattr(medallion, "write_layer", lambda df, root, name, *a, **k: (written.append(name), write(df, root, name, *a, **k)))
    for _ in range(2):  # a second run replaces the first
        written.clear()
        assert run(raw, parts) == expected
        assert {n: written.count(n) for n in medallion.BY_KEY} == {
            "silver_sales": 8, "silver_inventory": 3, "fact_sales": 7, "fact_inventory_snapshot": 2,
        }
    for name in (*schemas.BRONZE_TABLES, *schemas.SILVER_TABLES, *schemas.GOLD_TABLES):
        assert rows(spark, parts, name) == rows(spark, whole, name), name


def test_feed_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    """Lines of few orders, some twice; what is read back is what was fed, numbered in the feed's order."""
    lines = [(i // 3, i % 20, i % 4, i % 3, float(i % 5 + 1), 100.0 + i % 9, datetime(2024, 1, 1 + i % 28)) for i in range(0, 900)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    spark.createDataFrame(lines + lines[:30], names).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(i, i % 60, ("1-URGENT", "3-MEDIUM", None)[i % 3]) for i in range(300)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, f"Customer#{i}", i % 5) for i in range(90)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(feed, "ROWS_PER_TASK", 100)
    before = shuffle_files(spark)
    sales, people = (make(spark, str(tmp_path)).removeprefix("file:") for make in (queries._sales_files, queries._customer_files))
    assert not left_over(spark, before)
    for path, header in ((sales, 1), (people, 0)):
        parts = [os.path.join(path, n) for n in os.listdir(path) if n.startswith("part-")]
        assert parts and all(p.endswith(".gz") for p in parts)
        assert max(len(gzip.open(p).readlines()) for p in parts) <= 100 + header
    read = files.ingest_csv(spark, sales)
    fed = feed.bronze_sales(spark, str(tmp_path)).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    columns = [F.col(c).cast("string") for c in schemas.SALES_RAW.names]
    assert sorted(map(str, read.select(*columns).collect())) == sorted(map(str, fed.select(*columns).collect()))
    numbered = read.orderBy("row_seq").collect()
    assert len({r.row_seq for r in numbered}) == 930
    assert [r.timestamp for r in numbered] == sorted(r.timestamp for r in numbered)
    customers = files.ingest_json(spark, people, schemas.CUSTOMERS_RAW, array_file=False)
    assert customers.count() == feed.bronze_customers(spark, str(tmp_path)).count() == 93


def test_months_are_written_in_order(spark, tmp_path):
    mixed = spark.range(5000).select((F.col("id") % 3).alias("month"), (F.col("id") * 7919 % 5003).alias("k"), "id").repartition(4)
    tables.write_layer(mixed, str(tmp_path), "silver_a", partition_by="month", order=("k",))
    written = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    found = [pq.ParquetFile(f).read().column("k").to_pylist() for f in written]
    assert sum(map(len, found)) == 5000 and all(k == sorted(k) for k in found)
