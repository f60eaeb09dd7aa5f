"""What large tables rely on: each part is shuffled once, wide rows are not written, tasks are bounded."""

import contextlib

import pytest

from ledgerloom.checks.reports_finance import PLAIN
from ledgerloom.functions.params import Params
from ledgerloom.plans import invoices, ledger, lists, orders, versions
from ledgerloom.sources.catalog import StandInSource


@contextlib.contextmanager
def shuffled_plans(spark):
    """Plans as on tables that are too large for a broadcast."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_order_chain_shuffles_each_part_once(spark, small):
    with shuffled_plans(spark) as plan:
        text = plan(orders.po_chain(StandInSource(spark, small, ("li",))))
    assert text.count("Exchange hashpartitioning") == 5  # line, shipment, distribution; then the chain and the headers


def test_wide_order_rows_meet_lookups_once(spark, small):
    src = StandInSource(spark, small, ("li", "inv"))
    with shuffled_plans(spark) as plan:
        text = plan(orders.order_detail(src, PLAIN))
    wide = [x for x in text.splitlines() if "Join" in x and ("po_line_id" in x or "po_header_id" in x)]
    assert wide and not any("code_combination_id" in x and "po_line_id" in x for x in wide)
    top = next(x for x in text.splitlines() if "Join" in x)
    assert "po_header_id" in top  # the header comes last; accounts, requester, spend and contracts met narrow rows


def test_order_audit_writes_no_wide_states(spark, small, monkeypatch):
    written = []

    def noted(df):
        written.append(set(df.columns))
        return cut(df)

    cut = versions.cut
    monkeypatch.setattr(versions, "cut", noted)
    versions.order_changes(StandInSource(spark, small, ("li", "po_versions")), PLAIN)
    assert written and not any({"po_description", "item_description"} <= columns for columns in written)


def test_wide_journal_lines_pass_one_join_and_one_order(spark, small):
    """Repeats are dropped in the ranges of the order, and documents and invoices are met by the entries, not by the lines."""
    src = StandInSource(spark, small, ("li", "inv"))
    with shuffled_plans(spark) as plan:
        text = plan(ledger.ledger_transactions(src, Params(as_at=PLAIN.as_at, chosen={"entity": ["1", "2"]})))
    exchanges = [x for x in text.splitlines() if "Exchange " in x]
    assert "rangepartitioning" in exchanges[0] and "hashpartitioning(link" in exchanges[1]
    assert text.count("rangepartitioning") == 1


def test_wide_invoice_lines_meet_lookups_in_one_layout(spark, small):
    """Orders meet the distributions and suppliers the headers; invoice lines are shuffled by invoice, then by the order."""
    src = StandInSource(spark, small, ("li", "inv"))
    with shuffled_plans(spark) as plan:
        text = plan(invoices.invoice_entry_lines(src, PLAIN))
    top = [x for x in text.splitlines() if "Exchange " in x][:2]
    assert "rangepartitioning(invoice_num" in top[0] and "hashpartitioning(invoice_id" in top[1]
    joins = [x for x in text.splitlines() if "SortMergeJoin" in x]
    assert "_d_line" in joins[0] and "invoice_id" in joins[1] and "_d_line" not in joins[1]


@pytest.mark.parametrize("name", ["L08", "L09"])
def test_element_types_are_gathered_before_the_shuffle(spark, small, name):
    with shuffled_plans(spark) as plan:
        text = plan(lists.LISTS[name](StandInSource(spark, small), Params(as_at=PLAIN.as_at, chosen={"description_type": "Allowance"})))
    assert "HashAggregate(keys=[element_type_id" in text


def test_tasks_are_bounded(spark):
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
