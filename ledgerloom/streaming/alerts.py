"""New-supplier requisition alert: a batch report, its trigger and the streaming form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.functions import text as X
from ledgerloom.functions.params import Params
from ledgerloom.session import tune
from ledgerloom.sources.catalog import Source
from ledgerloom.sources.sinks import Folder, write_once

ALERT_COLUMNS = ("requisition_number", "description", "status", "line_number", "unit_price", "quantity", "uom", "suggested_vendor_name",
                 "site", "phone", "email", "item_number")
LINE_COLUMNS = ("line_number", "unit_price", "quantity", "uom_code", "suggested_vendor_name", "suggested_vendor_site", "suggested_vendor_contact_phone",
                "suggested_vendor_contact_email", "suggested_supplier_item_number", "new_supplier_flag")


def alert_rows(requisitions: DataFrame) -> DataFrame:
    """Requisition lines that ask for a supplier not known yet; keeps ``submission_date``."""
    return requisitions.filter(F.col("new_supplier_flag") == "Y").select(
        "requisition_number", "description", X.sentence_case(F.col("document_status")).alias("status"), "line_number", "unit_price", "quantity",
        F.col("uom_code").alias("uom"), "suggested_vendor_name", F.col("suggested_vendor_site").alias("site"),
        F.col("suggested_vendor_contact_phone").alias("phone"), F.col("suggested_vendor_contact_email").alias("email"),
        F.col("suggested_supplier_item_number").alias("item_number"), "submission_date")


def requisition_lines(src: Source) -> DataFrame:
    heads = src.scan("por_requisition_headers_all", "requisition_header_id requisition_number description document_status submission_date")
    return src.table("por_requisition_lines_all").join(heads, "requisition_header_id")


def recent(submitted: Column, now: Column) -> Column:
    """The 24 hours up to ``now``: a row is in the window of one daily run only."""
    return (submitted > now - F.expr("INTERVAL 1 DAY")) & (submitted <= now)


def new_supplier_alerts(src: Source, p: Params) -> DataFrame:
    rows = alert_rows(requisition_lines(src)).filter(recent(F.col("submission_date"), p.now()))
    return rows.select(*ALERT_COLUMNS).distinct().orderBy(F.desc_nulls_first("requisition_number"))


def alert_trigger(src: Source, p: Params) -> DataFrame:
    """One row 'true' per alert line, none if nothing is to be reported."""
    rows = alert_rows(requisition_lines(src)).filter(recent(F.col("submission_date"), p.now()))
    return rows.select(F.lit("true").alias("fired"))


def has_alerts(df: DataFrame) -> bool:
    return not df.isEmpty()


def alert_stream(heads: DataFrame, lines: DataFrame, p: Params, draft_days: int = 30, edit_days: int = 1) -> DataFrame:
    """The alert on streams of requisition headers and lines; a line may arrive before or after its header.

    A header counts if it was submitted in the 24 hours up to the run time, whenever it arrives.  A line meets its header if
    it was created from ``draft_days`` before the submission to ``edit_days`` after it.  Both streams are filtered before
    their watermarks are taken, so no watermark runs ahead of the run time: rows that can still be reported are never late,
    and what is older is dropped from the state.  Alerts that are equal in all columns come once.
    """
    new = (heads.select("requisition_header_id", "requisition_number", "description", "document_status", F.col("submission_date").cast("timestamp"))
           .filter(recent(F.col("submission_date"), p.now())).withWatermark("submission_date", "1 day"))
    asked = (lines.filter((F.col("new_supplier_flag") == "Y") & (F.col("creation_date") <= p.now() + F.expr(f"INTERVAL {edit_days} DAY")))
             .select(F.col("requisition_header_id").alias("_header"), *LINE_COLUMNS, F.col("creation_date").cast("timestamp"))
             .withWatermark("creation_date", f"{draft_days + edit_days + 1} days"))
    joined = new.join(asked, (F.col("requisition_header_id") == F.col("_header"))
                      & (F.col("creation_date") >= F.col("submission_date") - F.expr(f"INTERVAL {draft_days} DAY"))
                      & (F.col("creation_date") <= F.col("submission_date") + F.expr(f"INTERVAL {edit_days} DAY")))
    return alert_rows(joined.drop("creation_date")).dropDuplicatesWithinWatermark(list(ALERT_COLUMNS))


def report_batch(batch: DataFrame, batch_id: int, path: str) -> bool:
    """The event trigger: a micro-batch with alerts becomes the report ``path/batch_id=n``, one without leaves nothing.

    The report appears by one rename; a batch that is replayed after a failure finds it and does nothing.
    """
    rows = batch.select(*ALERT_COLUMNS).persist()
    try:
        return has_alerts(rows) and write_once(rows.orderBy(F.desc_nulls_first("requisition_number")), f"{path}/batch_id={batch_id}")
    finally:
        rows.unpersist()


def start_alerts(stream: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Run the alert stream; every micro-batch fires the trigger.  ``checkpoint`` belongs to ``path``."""
    Folder(stream.sparkSession, path).make()
    return (stream.writeStream.foreachBatch(lambda batch, batch_id: report_batch(batch, batch_id, path)).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def reported_alerts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All alerts reported so far; ``schema`` is that of the alert columns."""
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*ALERT_COLUMNS)


def daily_alerts(src: Source, p: Params, folder: str, files_per_batch: int | None = None, state_partitions: int = 8) -> DataFrame:
    """The daily run: all files of the two tables below ``folder`` go through the stream, then it ends.

    ``folder`` holds the tables as files, the reports and the checkpoint: a later run over the same folder reads new files
    only.  ``files_per_batch`` cuts the run into micro-batches, ``state_partitions`` is fixed with the first run.
    """
    session = tune(src.spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", state_partitions)
    streams = []
    for name in ("por_requisition_headers_all", "por_requisition_lines_all"):
        reader = session.readStream.schema(src.table(name).schema)
        streams.append((reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(f"{folder}/{name}"))
    stream = alert_stream(*streams, p)
    start_alerts(stream, f"{folder}/alerts", f"{folder}/checkpoint").awaitTermination()
    return reported_alerts(src.spark, f"{folder}/alerts", stream.select(*ALERT_COLUMNS).schema)
