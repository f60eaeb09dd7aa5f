import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.params import Params
from ledgerloom.plans import ledger, versions
from ledgerloom.session import cut, ensure_checkpoint_dir, scratch
from ledgerloom.sources.catalog import DatabaseSource, FolderSource, StandInSource, literal_row
from ledgerloom.sources.schemas import SchemaError, check, kind_of
from ledgerloom.sources.sinks import Folder, run_report, write_once, write_report
from ledgerloom.sources.standins import STANDINS, as_cte, references
from tests.conftest import rows


def test_folder_source_reads_exact_money(spark, tmp_path):
    spark.createDataFrame([(1, 2.345, "x")], "id int, amount double, note string").write.parquet(str(tmp_path / "t"))
    src = FolderSource(spark, str(tmp_path))
    assert rows(src.scan("t", "id amount:money")) == [(1, Decimal("2.3450000000"))]  # as held: scale is no matter of the column's name
    assert src.scan("t", "id note", prefix="p_").columns == ["p_id", "p_note"]


def test_declared_kinds(spark, small, tmp_path):
    """A missing or differently typed column is a named error; exact columns stay as they are, so filters reach the files."""
    spark.createDataFrame([(1, "7", 0.1, 52.5, "x")], "invoice_id int, vendor_id string, invoice_amount double, latitude double, invoice_num string").withColumn(
        "tax_amount", F.lit(Decimal("1.234")).cast("decimal(20,3)")).write.parquet(str(tmp_path / "ap_invoices_all"))
    src = FolderSource(spark, str(tmp_path))
    with pytest.raises(SchemaError, match="table ap_invoices_all has no column org_id"):
        src.scan("ap_invoices_all", "invoice_id org_id:unit")
    with pytest.raises(SchemaError, match="column vendor_id of table ap_invoices_all must hold whole number, not string"):
        src.scan("ap_invoices_all", "vendor_id")
    got = src.scan("ap_invoices_all", "invoice_id invoice_amount tax_amount latitude").filter(F.col("tax_amount") > 1)
    assert dict(got.dtypes) == {"invoice_id": "int", "invoice_amount": "decimal(28,10)", "tax_amount": "decimal(20,3)", "latitude": "double"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(tax_amount), GreaterThan(tax_amount,1.000)]" in plan
    assert kind_of("approver_id") == "text" and kind_of("po_line_number") == "whole number" and kind_of("person_number") == "text" and kind_of("shape") is None
    for name in STANDINS:
        df = StandInSource(spark, small).table(name)
        check(name, df, df.columns)


def test_database_source(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS reports_test")
    spark.range(3).createOrReplaceTempView("plain")
    spark.sql("DROP TABLE IF EXISTS reports_test.t")
    spark.table("plain").write.saveAsTable("reports_test.t")
    assert DatabaseSource(spark, "reports_test").table("t").count() == 3
    spark.sql("DROP DATABASE reports_test CASCADE")


def test_scan_reaches_the_file_pruned(spark, small):
    df = FolderSource(spark, small, ".parquet").scan("orders", "o_orderkey o_orderpriority").filter(F.col("o_orderpriority") == "1-URGENT")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan


def test_stand_ins_are_complete(spark, small):
    src = StandInSource(spark, small)
    for name, sql in STANDINS.items():
        assert "WITH" in as_cte(f"SELECT * FROM {{{name}}}") and references(sql)
        assert src.table(name).columns
    assert src.table("li").groupBy("l_orderkey", "l_linenumber").count().filter("count > 1").isEmpty()


def test_failed_report_leaves_the_last_one(spark, tmp_path):
    """A job that fails in the middle of writing, and a move that the file system refuses."""
    path = str(tmp_path / "report")
    write_report(spark.range(10), path)
    broken = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") == 3999, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_report(broken, path)
    assert spark.read.parquet(path).count() == 10 and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["report"]
    write_report(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["report"]
    assert not write_once(spark.range(5), path) and spark.read.parquet(path).count() == 3
    with pytest.raises(OSError):
        Folder(spark, str(tmp_path / "none")).move(Folder(spark, path))


def test_refused_move_puts_the_old_report_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    write_report(spark.range(10), path)
    move = Folder.move

    def refuse(self, target):
        if "-new-" in self.path:
            raise OSError("refused")
        move(self, target)

    monkeypatch.setattr(Folder, "move", refuse)
    with pytest.raises(OSError, match="refused"):
        write_report(spark.range(3), path)
    assert spark.read.parquet(path).count() == 10 and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["report"]


def test_intermediates_go_with_the_run(spark, small, tmp_path):
    """The order audit and the ledger leave their report and nothing else; so does a run that fails."""
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    p = Params(as_at=dt.date(1998, 3, 1), chosen={"po_num": [f"PO{k}" for k in range(40)], "entity": "1"})
    for name, report in (("audit", versions.order_changes), ("ledger", ledger.ledger_transactions)):
        run_report(spark, lambda report=report: report(StandInSource(spark, small), p), str(tmp_path / name))
        assert spark.read.parquet(str(tmp_path / name)).count() > 0
        assert {p.name for p in folder.iterdir()} == before
    with pytest.raises(ZeroDivisionError), scratch(spark) as outer:
        kept = cut(spark.range(3))
        with scratch(spark) as inner:
            cut(spark.range(4))
            assert Folder(spark, inner).exists()
        assert not Folder(spark, inner).exists() and kept.count() == 3 and Folder(spark, outer).exists()
        raise ZeroDivisionError
    assert {p.name for p in folder.iterdir()} == before


def test_sink_and_cut(spark, tmp_path):
    df = literal_row(spark, a=1, b="x,\"y\"")
    for fmt in ("parquet", "csv"):
        write_report(df, str(tmp_path / fmt), fmt)
    assert rows(spark.read.parquet(str(tmp_path / "parquet"))) == [(1, "x,\"y\"")]
    assert rows(spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))) == [("1", "x,\"y\"")]
    write_report(df, str(tmp_path / "parts"), partition_by=["b"])
    assert rows(cut(df)) == [(1, "x,\"y\"")]
    assert ensure_checkpoint_dir(spark)
