import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.params import Params
from ledgerloom.sources.catalog import FrameSource
from ledgerloom.streaming import alerts as S
from tests.conftest import rows

HEAD = "requisition_header_id long, requisition_number string, description string, document_status string, submission_date timestamp"
LINE = "requisition_header_id long, line_number int, unit_price decimal(18,2), quantity decimal(18,2), uom_code string, suggested_vendor_name string, " \
       "suggested_vendor_site string, suggested_vendor_contact_phone string, suggested_vendor_contact_email string, suggested_supplier_item_number string, " \
       "new_supplier_flag string, creation_date timestamp"
HOUR, DAY = dt.timedelta(hours=1), dt.timedelta(days=1)


def head(n, when):
    return (n, f"R{n}", "d", "PENDING APPROVAL", when)


def line(n, when, flag="Y", number=1):
    return (n, number, None, None, "ea", "v", None, None, None, None, flag, when)


NOW = dt.datetime(2024, 5, 2)


def source(spark):
    heads = [(1, NOW - 23 * HOUR), (2, NOW - 25 * HOUR), (3, NOW - 2 * HOUR), (4, NOW - HOUR)]
    headers = spark.createDataFrame([(i, f"R{i}", "d", "IN PROCESS", t) for i, t in heads],
                                 "requisition_header_id int, requisition_number string, description string, document_status string, submission_date timestamp")
    rows_ = spark.createDataFrame([(1, "Y"), (1, "Y"), (2, "Y"), (3, "N"), (4, None)], "requisition_header_id int, new_supplier_flag string")
    blank = {c: F.lit(None).cast("string") for c in ("uom_code", "suggested_vendor_name", "suggested_vendor_site", "suggested_vendor_contact_phone",
                                                      "suggested_vendor_contact_email", "suggested_supplier_item_number")}
    lines = rows_.withColumns({"line_number": F.lit(1), "unit_price": F.lit(1), "quantity": F.lit(2), **blank})
    return FrameSource(spark, {"por_requisition_headers_all": headers, "por_requisition_lines_all": lines})


def test_batch_alert(spark):
    src, p = source(spark), Params(as_at=NOW.date())
    assert rows(S.new_supplier_alerts(src, p), "requisition_number", "status") == [("R1", "In process")]
    assert S.alert_trigger(src, p).count() == 2
    assert S.has_alerts(S.alert_trigger(src, p))
    assert not S.has_alerts(S.alert_trigger(src, Params(as_at=dt.date(2024, 6, 1))))
    assert not S.has_alerts(S.alert_trigger(src, Params(as_at=dt.date(1999, 1, 1))))  # not yet submitted


class Inbox:
    """The two tables as folders to which files are added, and the report of the stream over them."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        self.src = FrameSource(spark, {t: spark.createDataFrame([], kind) for t, kind in (("por_requisition_headers_all", HEAD), ("por_requisition_lines_all", LINE))})
        self.add()

    def add(self, heads=(), lines=()):
        for name, rows_, kind in (("por_requisition_headers_all", heads, HEAD), ("por_requisition_lines_all", lines, LINE)):
            self.spark.createDataFrame(list(rows_), kind).coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")

    def run(self, now=NOW, files=None):
        got = S.daily_alerts(self.src, Params(as_at=now), self.folder, files, state_partitions=2)
        return [r[0] for r in rows(got, "requisition_number")]

    def batch(self, now=NOW):
        tables = {t: self.spark.read.schema(kind).parquet(f"{self.folder}/{t}") for t, kind in (("por_requisition_headers_all", HEAD), ("por_requisition_lines_all", LINE))}
        return [r[0] for r in rows(S.new_supplier_alerts(FrameSource(self.spark, tables), Params(as_at=now)), "requisition_number")]


@pytest.mark.parametrize("files", [None, 1])
def test_stream_equals_the_batch_report(spark, tmp_path, files):
    """In one and in several micro-batches: old, future, unflagged and repeated rows, drafts of weeks before, lines before and after their header."""
    box = Inbox(spark, tmp_path)
    box.add([head(1, NOW - 30 * DAY), head(2, NOW - 23 * HOUR)], [line(1, NOW - 30 * DAY), line(2, NOW - 29 * DAY), line(5, NOW - 2 * HOUR), line(3, NOW - 3 * HOUR, "N")])
    box.add([head(3, NOW - 2 * HOUR), head(4, NOW - 25 * HOUR)], [line(2, NOW - 24 * HOUR), line(2, NOW - 24 * HOUR), line(4, NOW - 26 * HOUR)])
    box.add([head(5, NOW - HOUR), head(6, NOW + HOUR), head(7, NOW)], [line(6, NOW), line(7, NOW + 5 * HOUR), line(7, NOW, None, 2)])
    box.add([head(8, NOW - 20 * HOUR)], [line(8, NOW - 25 * DAY), line(None, NOW)])
    assert box.run(files=files) == box.batch() == ["R2", "R5", "R7", "R8"]
    assert box.run() == ["R2", "R5", "R7", "R8"]  # nothing new


def test_next_day_reports_new_rows_only(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.add([head(1, NOW - HOUR)], [line(1, NOW - HOUR), line(2, NOW - HOUR)])
    assert box.run() == ["R1"]
    box.add([head(2, NOW + HOUR), head(3, NOW - 3 * DAY)], [line(3, NOW - 3 * DAY)])  # the line of R2 came the day before; R3 is late by days
    assert box.run(NOW + DAY) == ["R1", "R2"]


def test_trigger_and_replay(spark, tmp_path):
    """A micro-batch without alerts leaves nothing, one that is replayed writes once."""
    row = spark.createDataFrame([("R1",)], "requisition_number string").select("requisition_number", *(F.lit("x").alias(c) for c in S.ALERT_COLUMNS[1:]))
    path = str(tmp_path / "alerts")
    assert not S.report_batch(row.limit(0), 0, path)
    assert S.report_batch(row, 1, path) and not S.report_batch(row, 1, path)
    assert S.report_batch(row, 2, path)
    assert sorted(p.name for p in (tmp_path / "alerts").iterdir()) == ["batch_id=1", "batch_id=2"]
    assert S.reported_alerts(spark, path, row.schema).count() == 2


def test_replayed_micro_batch_of_a_run(spark, tmp_path):
    """The last commit is lost, so Spark runs the micro-batch again: the report stays as it is."""
    box = Inbox(spark, tmp_path)
    box.add([head(1, NOW - HOUR), head(2, NOW - HOUR)], [line(1, NOW - HOUR), line(2, NOW - HOUR)])
    assert box.run() == ["R1", "R2"]
    last = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink()
    assert box.run() == ["R1", "R2"]
