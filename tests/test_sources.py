"""Files, workbooks, tables, ad-hoc SQL."""

import json
import zipfile
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql import functions as F

from suite.sheets import workbook_bytes
from tallyhouse import schemas
from tallyhouse.functions.sqlcompat import register_strftime
from tallyhouse.operators import lineage
from tallyhouse.plans.workbench import RejectedStatement, run_query
from tallyhouse.sources import files, tables, workbook

HEADER = "transaction_id,timestamp,customer_id,product_id,store_id,quantity,unit_price,payment_method,channel"


def write_sales(folder, parts):
    folder.mkdir(exist_ok=True)
    for name, rows in parts.items():
        (folder / name).write_text("\n".join([HEADER, *rows]) + "\n")
    return str(folder)


def test_csv_reads_missing_value_words_and_keeps_blanks(spark, tmp_path):
    path = write_sales(tmp_path / "s", {"a.csv": ['T1,2024-01-01 10:00:00,NA,P1,S1,2,9.5,null," On, line "', "T2,x,,P,S,,1,N/A,nan"]})
    a, b = files.ingest_csv(spark, path).orderBy("row_seq").collect()
    assert (a.customer_id, a.payment_method, a.channel, a.quantity, str(a.unit_price)) == (None, None, " On, line ", 2, "9.50")
    assert (b.customer_id, b.quantity, b.payment_method, b.channel, b.row_seq, b.source_file) == (None, None, None, None, 1, "a.csv")


def test_csv_with_a_bad_number_aborts(spark, tmp_path):
    path = write_sales(tmp_path / "s", {"a.csv": ["T1,t,c,p,s,two,1,m,c"]})
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        files.ingest_csv(spark, path).collect()


def test_sequence_follows_files_and_lines_over_many_splits(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="700", spark__sql__files__openCostInBytes="1")
    parts = {f"{n}.csv": [f"{n}-{i:04d},t,c,p,s,1,1,m,c" for i in range(size)] for n, size in (("a", 150), ("b", 9), ("c", 300))}
    rows = files.ingest_csv(spark, write_sales(tmp_path / "s", parts))
    assert rows.rdd.getNumPartitions() > 4
    ordered = [r.transaction_id for r in rows.orderBy("row_seq").collect()]
    assert ordered == [f"{n}-{i:04d}" for n, size in (("a", 150), ("b", 9), ("c", 300)) for i in range(size)]
    assert rows.select("row_seq").distinct().count() == 459


def test_numbering_moves_no_row_and_reads_once(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    path = write_sales(tmp_path / "s p", {"a b.csv": ["T1,t,c,p,s,1,1,m,c"], "b%20é.csv": ["T2,t,c,p,s,1,1,m,c"]})
    rows = files.ingest_csv(spark, path)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan and plan.count("FileScan") == 1
    assert [r.transaction_id for r in rows.orderBy("row_seq").collect()] == ["T1", "T2"]


def test_json_array_file(spark, tmp_path):
    people = [{"customer_id": f"C{i}", "email": None if i else "a@b", "web_sessions_count": i, "opt_in_marketing": True} for i in range(3)]
    (tmp_path / "customers.json").write_text(json.dumps(people, indent=2))
    rows = files.ingest_json(spark, str(tmp_path / "customers.json"), schemas.CUSTOMERS_RAW).orderBy("row_seq").collect()
    assert [(r.customer_id, r.email, r.web_sessions_count, r.opt_in_marketing) for r in rows] == [
        ("C0", "a@b", 0, True), ("C1", None, 1, True), ("C2", None, 2, True),
    ]


def test_unknown_dataset_falls_back_to_the_default(spark, tmp_path):
    (tmp_path / "full.csv").write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\nC1,2,x,-1,d,1.0,,UK\n")
    row = files.read_retail_lines(spark, "other.csv", {"online_retail.csv": str(tmp_path / "full.csv")}).first()
    assert (row.InvoiceNo, row.Quantity, row.CustomerID, row.row_seq) == ("C1", "-1", None, 0)


def test_catalog_gives_zeros_for_absent_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n" + "x\n" * 1500)
    got = files.dataset_catalog(spark, {"full": str(tmp_path / "a.csv"), "dirty": str(tmp_path / "no.csv")}, ("dirty",))
    assert [tuple(r) for r in got.collect()] == [("full", 1500, 2.93, False), ("dirty", 0, 0.0, True)]


def test_export_quotes_everything_and_keeps_zero_and_false(spark, tmp_path):
    df = spark.createDataFrame([(0, False, ' say "hi", you ')], "n INT, b BOOLEAN, t STRING")
    files.export_csv(df, str(tmp_path / "out"))
    text = max(((tmp_path / "out").glob("part-*")), key=lambda p: p.stat().st_size).read_text()
    assert text == '"n","b","t"\n"0","false"," say ""hi"", you "\n'


def test_many_workbooks_with_missing_sheets(spark, tmp_path):
    stock = [["product_id", "store_id", "stock_on_hand", "reorder_point", "safety_stock", "last_restock_date"]]
    goods = [["product_id", "product_name", "category", "unit_cost", "suggested_retail_price", "supplier"], ["P1", "A & <B>", "c", 1.5, 2.25, None]]
    for i in range(3):
        sheets = {"Inventory_Levels": stock + [[f"P{i}", "S1", 10 * i, 5, 2, "2024-01-02"]], "Notes": [["x"], ["y"]]}
        if i == 0:
            sheets["Products_Master"] = goods
        (tmp_path / f"b{i}.xlsx").write_bytes(workbook_bytes(sheets))
    got = workbook.ingest_workbook(spark, str(tmp_path / "*.xlsx"))
    rows = got["bronze_inventory_raw"].orderBy("source_file").collect()
    assert [(r.product_id, r.stock_on_hand, r.source_file) for r in rows] == [
        (f"P{i}", 10 * i, f"b{i}.xlsx::Inventory_Levels") for i in range(3)
    ]
    product = got["bronze_products_raw"].first()
    assert (product.product_name, str(product.unit_cost), str(product.suggested_retail_price), product.supplier) == ("A & <B>", "1.50", "2.25", None)
    assert got["bronze_stores_raw"].count() == 0


def test_workbook_with_shared_texts_and_date_cells(tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    path = tmp_path / "d.xlsx"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="p"><Relationship Id="r1" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>day</t></si><si><r><t>no</t></r><r><t>te</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
                   '<row><c r="A2" s="1"><v>45293</v></c><c r="C2"><v>7</v></c></row></sheetData></worksheet>')
    assert list(workbook._rows_of(path.read_bytes())) == [("S", 0, {"day": "2024-01-02", "note": "7"})]


def test_row_hash_keeps_over_batches_unless_audit_is_included(spark):
    df = spark.createDataFrame([("a", None, 1)], "x STRING, y STRING, n INT")
    one, two = (lineage.add_audit_columns(df, f"B{i}", datetime(2024, 1, i), "f.csv") for i in (1, 2))
    digest = lambda d, **o: lineage.add_row_hash(d, **o).first().row_hash
    import hashlib

    assert digest(one) == digest(two) == hashlib.sha256(b"a|nan|1").hexdigest()[:16]
    assert digest(one, include_audit=True) != digest(two, include_audit=True)
    assert digest(one, null_token="None") == hashlib.sha256(b"a|None|1").hexdigest()[:16]


@pytest.mark.parametrize(
    "text",
    ["", "  ; ", "DROP TABLE t", "DELETE FROM t", "INSERT INTO t VALUES (1)", "UPDATE t SET a = 1", "TRUNCATE TABLE t",
     "SELECT 1; DROP TABLE t", "SELECT 1) x; DROP TABLE t --", "CREATE TABLE z AS SELECT 1", "SET a=b"],
)
def test_workbench_rejects_everything_but_a_query(spark, text):
    with pytest.raises(RejectedStatement):
        run_query(spark, text)


@pytest.mark.parametrize("name", ["reflect", "java_method", "try_reflect", "`reflect`"])
def test_workbench_rejects_calls_of_the_jvm(spark, name):
    call = f"{name}('java.lang.System', 'getProperty', 'user.dir')"
    for text in (f"SELECT {call}", f"SELECT 1 WHERE EXISTS (SELECT {call})", f"WITH a AS (SELECT {call} AS x) SELECT x FROM a"):
        with pytest.raises(RejectedStatement):
            run_query(spark, text)


def test_workbench_reads_registered_tables_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        run_query(spark, f"SELECT * FROM parquet.`{tmp_path}/t`")
    assert spark.sql(f"SELECT * FROM parquet.`{tmp_path}/t`").count() == 3


def test_words_for_missing_cells(spark):
    rows = [("a.xlsx", "S", 0, {"n": "N/A", "s": "NA"}), ("a.xlsx", "S", 1, {"n": "7", "s": "x"})]
    cells = spark.createDataFrame(rows, workbook.CELL_ROWS)
    got = workbook.sheet_table(cells, "S", StructType([StructField("n", IntegerType()), StructField("s", StringType())]))
    assert [(r.n, r.s) for r in got.orderBy("row_seq").collect()] == [(None, None), (7, "x")]


def test_workbench_runs_queries(spark):
    t = spark.createDataFrame([("2024-02-03",), ("2024-02-04",)], "d STRING").select(F.to_date("d").alias("d"))
    got = run_query(spark, "WITH m AS (SELECT STRFTIME('%Y-%m', d) AS k FROM sold) SELECT k, COUNT(*) AS cnt FROM m GROUP BY k -- months\n;\n", {"sold": t})
    assert [tuple(r) for r in got.collect()] == [("2024-02", 2)]
    register_strftime(spark)
    assert spark.sql("SELECT strftime('%H:%M:%S', timestamp'2024-01-01 05:06:07')").first()[0] == "05:06:07"


def test_table_sample_and_listing(spark):
    spark.range(900).createOrReplaceTempView("sampled")
    assert tables.table_sample(spark, "sampled").count() == 50
    assert tables.table_sample(spark, "sampled", 9999).count() == 900
    with pytest.raises(ValueError, match="does not exist"):
        tables.table_sample(spark, "nowhere")
    assert "sampled" in {r.table_name for r in tables.list_tables(spark).collect()}


def test_staging_without_a_configured_folder(spark, monkeypatch):
    from tallyhouse.sources import staging

    class Unset:
        sparkContext = spark.sparkContext
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    first, second = staging.shared_folder(Unset), staging.shared_folder(Unset)
    assert first == second and first.count("tallyhouse-") == 1


def test_catalog_counts_all_datasets_in_one_job(spark, tmp_path):
    (tmp_path / "parts").mkdir()
    (tmp_path / "a b.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "parts" / "1.csv").write_text("x\n1\n")
    (tmp_path / "parts" / "2.csv").write_text("x,y,z\n1,2,3\n4,5,6\n")
    (tmp_path / "header.csv").write_text("x,y\n")
    named = {"a": f"{tmp_path}/a b.csv", "all": f"{tmp_path}/parts", "second": f"{tmp_path}/parts/2.csv",
             "header": f"{tmp_path}/header.csv", "absent": f"{tmp_path}/none.csv"}
    spark.sparkContext.setJobGroup("catalog", "")
    found = files.dataset_catalog(spark, named, dirty=("a",))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("catalog")  # nothing runs before the result is asked for
    rows = {r.filename: (r.records, r.size_kb, r.is_dirty_sample) for r in found.collect()}
    spark.sparkContext._jsc.sc().clearJobGroup()
    kb = lambda n: round(n / 1024, 2)
    assert rows == {"a": (2, kb(12), True), "all": (3, kb(22), False), "second": (2, kb(18), False),
                    "header": (0, kb(4), False), "absent": (0, 0.0, False)}


@pytest.mark.parametrize("word", ["TryReflect", "CallMethodViaReflection", "org.apache.TryReflect"])
def test_workbench_takes_texts_for_texts(spark, word):
    assert run_query(spark, f"SELECT '{word}' AS a, struct('{word}' AS class) AS b").first().a == word


def test_workbench_rejects_calls_of_the_jvm_inside_subqueries(spark):
    call = "reflect('java.lang.System', 'getProperty', 'user.home')"
    for text in (f"SELECT (SELECT {call}) AS a", f"SELECT 1 AS a WHERE EXISTS (SELECT {call} AS b)", f"WITH w AS (SELECT {call} AS b) SELECT * FROM w"):
        with pytest.raises(RejectedStatement):
            run_query(spark, text)


def test_strftime_directives(spark):
    import sqlite3

    from tallyhouse.functions.sqlcompat import register_strftime

    register_strftime(spark)
    moments = ["2024-01-01 00:00:00", "2023-12-31 23:59:58", "2024-02-29 07:08:09", "2021-01-03 12:00:00"]
    formats = ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m", "week %W, day %j of '%Y'", "100%% %w%W", "%f", "%s", "", "no directive", "%d.%m.%Y", "Q\n%m"]
    lite = sqlite3.connect(":memory:")
    for fmt in formats:
        expected = [lite.execute("SELECT strftime(?, ?)", (fmt, m)).fetchone()[0] for m in moments]
        df = spark.createDataFrame([(fmt, m) for m in moments], "f STRING, m STRING")
        assert [r[0] for r in df.selectExpr("strftime(f, CAST(m AS TIMESTAMP)) AS s").collect()] == expected
        literal = fmt.replace("'", "''")
        got = spark.sql("SELECT strftime('" + literal.replace("\n", "\\n") + "', TIMESTAMP'2024-02-29 07:08:09')").first()[0]
        assert got == expected[2]
    assert spark.sql("SELECT strftime('%Y', NULL) IS NULL AND strftime('x%Y', NULL) IS NULL").first()[0]
    with pytest.raises(Exception, match="unknown directive"):
        spark.sql("SELECT strftime('%q', TIMESTAMP'2024-02-29 07:08:09')").collect()


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    names = HEADER.split(",")
    swapped = ["channel", "note", *names[1:6], "transaction_id", "payment_method", "unit_price"]
    (tmp_path / "s").mkdir()
    row = {**{n: n[0] for n in names}, "quantity": "3", "unit_price": "1.25", "note": "x"}
    (tmp_path / "s" / "a.csv").write_text(",".join(swapped) + "\n" + ",".join(row[n] for n in swapped) + "\n")
    got = files.ingest_csv(spark, str(tmp_path / "s"))
    assert got.columns == [*names, "row_seq", "source_file"]
    r = got.first()
    assert (r.transaction_id, r.quantity, str(r.unit_price), r.payment_method, r.channel) == ("t", 3, "1.25", "p", "c")
    assert got.select("channel").first().channel == "c" and got.count() == 1
    (tmp_path / "s" / "b.csv").write_text(HEADER + "\n" + ",".join(row[n] for n in names) + "\n")
    with pytest.raises(Exception, match="header"):
        files.ingest_csv(spark, str(tmp_path / "s")).collect()
    with pytest.raises(ValueError, match="no column transaction_id"):
        (tmp_path / "c.csv").write_text(HEADER.replace("transaction_id", "id") + "\n")
        files.ingest_csv(spark, str(tmp_path / "c.csv"))


def test_csv_without_any_line(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "header.csv").write_text(HEADER + "\n")
    for name in ("none.csv", "header.csv"):
        assert files.ingest_csv(spark, str(tmp_path / name)).collect() == []


def test_csv_with_line_breaks_inside_quotes(spark, tmp_path):
    rows = ['T1,t,c,p,s,1,1,"two\nlines, ""quoted""",web', "T2,t,c,p,s,2,1,m,shop"]
    path = write_sales(tmp_path / "s", {"a.csv": rows})
    a, b = files.ingest_csv(spark, path, multi_line=True).orderBy("row_seq").collect()
    assert (a.payment_method, a.channel, a.row_seq) == ('two\nlines, "quoted"', "web", 0)
    assert (b.transaction_id, b.quantity, b.row_seq) == ("T2", 2, 1)


def test_more_files_than_the_first_bits_hold_are_numbered(spark, tmp_path):
    """The listing names 200,000 files before those that hold rows."""
    parts = {f"{n}.csv": [f"{n}-{i:02d},t,c,p,s,1,1,m,c" for i in range(20)] for n in "abc"}
    read = spark.read.schema(schemas.SALES_RAW).csv(write_sales(tmp_path / "s", parts), header=True)

    class Listed:
        def inputFiles(self):
            return [f"/a/{i:06d}.csv" for i in range(200_000)] + read.inputFiles()

        def __getattr__(self, name):
            return getattr(read, name)

    rows = lineage.assign_row_seq(Listed())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan
    ordered = [(r.row_seq, r.transaction_id) for r in rows.select("row_seq", "transaction_id").orderBy("row_seq").collect()]
    assert [t for _, t in ordered] == [f"{n}-{i:02d}" for n in "abc" for i in range(20)]
    assert len({s for s, _ in ordered}) == 60 and ordered[0][0] > 199_999 << 45
