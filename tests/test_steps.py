"""Reports built in steps: what a step leaves on disk, and that rows dropped before a step are those dropped after it."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.params import Params
from ledgerloom.operators.relational import pack_texts
from ledgerloom.plans import invoices, ledger, orders, versions
from ledgerloom.session import cut, scratch, step
from ledgerloom.sources.catalog import StandInSource
from tests.conftest import rows

AT = dt.date(1998, 3, 1)


def local(folder):
    """The path of a scratch folder, which may be a URI."""
    return folder.removeprefix("file:")


def shuffle_files(spark):
    """Names of the shuffle files that this session's only executor holds."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_action(spark):
    before = shuffle_files(spark)
    with scratch(spark):
        made = cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.max("id").alias("top")).orderBy("k"))
        for _ in range(50):
            left = shuffle_files(spark) - before
            if not left:
                break
            time.sleep(0.1)
        assert not left
        assert rows(made) == [(k, 994 + k if k < 6 else 993) for k in range(7)]


def test_a_step_leaves_its_result_only(spark):
    with scratch(spark) as folder:
        def build():
            inner = [cut(spark.range(5)), step(spark, lambda: cut(spark.range(3)))]
            return inner[0].join(inner[1], "id")

        kept = step(spark, build)
        assert [n.partition("-")[0] for n in os.listdir(local(folder))] == ["cut"]
        assert rows(kept) == [(0,), (1,), (2,)]


def test_stand_ins_outlive_the_step_that_asks_first(spark, small):
    with scratch(spark):
        src = StandInSource(spark, small, ("inv",))
        step(spark, lambda: src.table("inv").limit(1))
        assert src.table("inv").count() > 0


@pytest.mark.parametrize("report, most", [(orders.order_detail, 4), (orders.contractor_orders, 3), (orders.orders_with_contracts, 3), (orders.invoices_by_order, 3),
                                          (ledger.ledger_transactions, 4), (invoices.invoice_entry_lines, 4)])
def test_reports_keep_few_intermediates(spark, small, report, most):
    """The parts are gone when they have met; the stand-ins take two of the folders."""
    with scratch(spark) as folder:
        src = StandInSource(spark, small, ("li", "inv"))
        got = report(src, Params(as_at=AT))
        left = os.listdir(local(folder))
        assert len([n for n in left if n.startswith("cut-")]) <= most and not [n for n in left if n.startswith("run-")]
        assert got.count() > 0


CHOICES = [
    (orders.order_detail, {"po_number": "purchase_order_number", "po_line_num": "po_line_number"}),
    (orders.contractor_orders, {"business_unit": "businessunit", "categorycode": "category_code"}),
    (orders.orders_with_contracts, {"party_name": "supplier_name", "business_unit": "businessunit", "po_number": "ponumber",
                                    "po_value": "povalue", "contract_type": "contracttype"}),
    (orders.invoices_by_order, {"party_name": "supplier_name", "po_number": "purchase_order_number", "po_value": "purchase_order_value"}),
]


@pytest.mark.parametrize("report, name, column", [(r, n, c) for r, choices in CHOICES for n, c in choices.items()])
def test_choices_drop_rows_of_the_parts(spark, small, report, name, column):
    with scratch(spark):
        src = StandInSource(spark, small, ("li", "inv"))
        whole = cut(report(src, Params(as_at=AT)))
        value = whole.filter(F.col(column).isNotNull()).select(F.max(column)).first()[0]
        wanted = rows(whole.filter(F.col(column) == value))
        assert wanted and rows(report(src, Params(as_at=AT, chosen={name: [value]}))) == wanted


def test_packed_texts_come_back_as_they_were(spark):
    odd = ["", None, "plain", "\x1f", "\x1b", "\x1b2", "\x1b0", "\x1b1", "a\x1fb\x1b\x1f", "\u0101 \U0001f600", " "]
    df = spark.createDataFrame([(i, a, b, str(i)) for i, (a, b) in enumerate((a, b) for a in odd for b in odd)], "n int, a string, b string, own string")
    packed, unpack = pack_texts(df, ["own"])
    assert packed.columns == ["n", "own", "_texts"] and packed.select("_texts").distinct().count() == len(odd) ** 2
    assert rows(unpack(packed), "n", "a", "b", "own") == rows(df)
    absent = spark.range(1).withColumn("n", F.lit(-1)).join(packed, "n", "left")
    assert rows(unpack(absent), "a", "b") == [(None, None)]


def test_audit_shuffles_narrow_rows_once_at_the_end(spark, small):
    """Headers and lines meet in the ranges of the order: no join is left that shuffles the wide rows before it."""
    with scratch(spark) as folder:
        got = versions.order_changes(StandInSource(spark, small, ("li", "po_versions")), Params(as_at=AT))
        assert len(os.listdir(local(folder))) == 4  # two stand-ins, headers and lines
        plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
        executed = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert executed.count("Exchange ") == 1 and "Exchange rangepartitioning(po_number" in executed


def test_audit_in_small_pieces(spark, small):
    """Pieces of two line numbers give the rows and the order of whole versions."""
    def place(r):
        return tuple((v is None, v) for v in (r.po_number, r.co_num, r.line_num))

    with scratch(spark):
        src = StandInSource(spark, small, ("li", "po_versions"))
        whole, cut_up = (versions.order_changes(src, Params(as_at=AT), n).collect() for n in (10_000, 2))
        assert whole and sorted(map(str, whole)) == sorted(map(str, cut_up))
        assert all(list(map(place, rs)) == sorted(map(place, rs)) for rs in (whole, cut_up))
