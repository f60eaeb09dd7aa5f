"""General-ledger transactions with the sub-ledger documents behind them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import amounts as A, dates as D, text as X
from ledgerloom.functions.params import Params, optional_between
from ledgerloom.operators.relational import left_join_skewed, left_lookup, pack_texts
from ledgerloom.plans.invoices import approved_invoice_lines
from ledgerloom.session import cut, step
from ledgerloom.sources.catalog import Source

PAYABLES, RECEIVABLES, ASSETS, RECEIVING, CASH = 200, 222, 140, 10096, 260

# One shape for all sub-ledger documents.
DOCUMENT = {
    "entity_code": "string", "invoice_id": "bigint", "invoice_num": "string", "payment_status": "string", "invoice_currency": "string",
    "invoice_amount": "decimal(18,2)", "tax_amount": "decimal(18,2)", "po_number": "string", "po_vendor_name": "string",
    "invoice_date": "date", "created_by": "string", "creation_date": "timestamp", "hdr": "string", "vendor_num": "string",
    "appl_id": "int", "typ": "string",
}


def _document(df: DataFrame, entity: str | None, appl_id: int, typ: str, **columns: str) -> DataFrame:
    """Bring a branch to the common shape; columns it lacks become typed NULLs."""
    fixed = {"appl_id": F.lit(appl_id), "typ": F.lit(typ)}
    if entity:
        fixed["entity_code"] = F.lit(entity)
    return df.select(*(
        (fixed[c] if c in fixed else F.col(columns[c]) if c in columns else F.lit(None)).cast(t).alias(c)
        for c, t in DOCUMENT.items()))


def person_parties(src: Source) -> DataFrame:
    """Parties that are employees, with their person number."""
    parties = (src.scan("hz_parties", "party_id party_name party_type").filter(F.col("party_type") == "PERSON"))
    refs = (src.scan("hz_orig_sys_references", "owner_table_id:party_id orig_system_reference orig_system owner_table_name")
            .filter((F.col("orig_system") == "FUSION_HCM") & (F.col("owner_table_name") == "HZ_PARTIES")))
    people = src.table("per_all_people_f").select(F.col("person_id").cast("string").alias("orig_system_reference"), "person_number")
    return parties.join(refs, "party_id").join(people, "orig_system_reference").select("party_id", "party_name", "person_number")


def _only(df: DataFrame, wanted: DataFrame | None, entity: str, appl_id: int, key: str) -> DataFrame:
    """The rows whose documents are wanted: ``wanted`` has entity_code, application_id and id, None wants all.

    It stands next to the scan of the table that holds the key, so that all joins of a branch run on what is wanted.
    """
    if wanted is None:
        return df
    ids = wanted.filter((F.col("entity_code") == entity) & (F.col("application_id") == appl_id)).select(F.col("id").alias("_id"))
    return df.join(ids, F.col(key) == F.col("_id"), "left_semi")


def expense_claims(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    bills = _only(src.table("ap_invoices_all").filter(F.col("source") == "EMP_EXPENSE_REPORT"), wanted, "AP_INVOICES", PAYABLES, "invoice_id")
    return _document(bills.join(person_parties(src), "party_id"), "AP_INVOICES", PAYABLES, "Expense Claim",
                     invoice_id="invoice_id", invoice_num="invoice_num", payment_status="payment_status_flag",
                     invoice_currency="invoice_currency_code", invoice_amount="invoice_amount", tax_amount="total_tax_amount",
                     po_vendor_name="party_name", invoice_date="invoice_date", created_by="created_by", creation_date="creation_date",
                     hdr="description", vendor_num="person_number")


def _customer_names(src: Source) -> DataFrame:
    accounts = src.scan("hz_cust_accounts", "cust_account_id:customer party_id")
    return accounts.join(src.scan("hz_parties", "party_id party_name"), "party_id").drop("party_id")


def receivable_invoices(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    due = src.scan("ar_payment_schedules_all", "customer_trx_id customer_id:customer amount_due_original tax_original")
    bills = _only(src.table("ra_customer_trx_all"), wanted, "TRANSACTIONS", RECEIVABLES, "customer_trx_id")
    df = bills.join(due, "customer_trx_id").join(_customer_names(src), "customer")
    return _document(df, "TRANSACTIONS", RECEIVABLES, "AR Invoice", invoice_id="customer_trx_id", invoice_num="trx_number",
                     invoice_currency="invoice_currency_code", invoice_amount="amount_due_original", tax_amount="tax_original",
                     po_vendor_name="party_name", invoice_date="trx_date", created_by="created_by", creation_date="creation_date", hdr="comments")


def receipts(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    money = _only(src.table("ar_cash_receipts_all"), wanted, "RECEIPTS", RECEIVABLES, "cash_receipt_id")
    df = money.withColumnRenamed("pay_from_customer", "customer").join(_customer_names(src), "customer")
    return _document(df, "RECEIPTS", RECEIVABLES, "AR Receipts", invoice_id="cash_receipt_id", invoice_num="receipt_number",
                     invoice_currency="currency_code", invoice_amount="amount", tax_amount="tax_amount", po_vendor_name="party_name",
                     invoice_date="receipt_date", created_by="created_by", creation_date="creation_date", hdr="comments")


def _payment(df: DataFrame, typ: str, number: str) -> DataFrame:
    return _document(df, "AP_PAYMENTS", PAYABLES, typ, invoice_id="check_id", po_vendor_name="payee", created_by="created_by",
                     creation_date="creation_date", hdr="description", vendor_num=number)


def _checks(src: Source, wanted: DataFrame | None) -> DataFrame:
    return _only(src.table("ap_checks_all"), wanted, "AP_PAYMENTS", PAYABLES, "check_id").withColumnRenamed("vendor_name", "payee")


def invoice_payments(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    checks = _checks(src, wanted)
    return _payment(checks.join(src.scan("poz_suppliers_v", "vendor_id segment1"), "vendor_id"), "Invoice Payments", "segment1")


def expense_payments(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    checks = _checks(src, wanted)
    return _payment(checks.join(person_parties(src), "party_id"), "Expense Payments", "person_number")


def _asset(df: DataFrame, entity: str, key: str) -> DataFrame:
    return _document(df, entity, ASSETS, "FA", invoice_id=key, invoice_num="asset_number", created_by="created_by",
                     creation_date="creation_date", hdr="description")


def depreciation(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    return _asset(_only(src.table("fa_additions_vl"), wanted, "DEPRECIATION", ASSETS, "asset_id"), "DEPRECIATION", "asset_id")


def lease_expense(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    return _asset(_only(src.table("fa_additions_vl"), wanted, "LEASE_EXPENSE", ASSETS, "asset_id"), "LEASE_EXPENSE", "asset_id")


def asset_transactions(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    moves = _only(src.scan("fa_transaction_headers", "transaction_header_id asset_id"), wanted, "TRANSACTIONS", ASSETS, "transaction_header_id")
    return _asset(src.table("fa_additions_vl").join(moves, "asset_id"), "TRANSACTIONS", "transaction_header_id")


def _goods_receipts(src: Source, events: DataFrame) -> DataFrame:
    """``events``: entity_code, accounting_event_id, receipt_number, rcv_transaction_id."""
    moves = src.scan("rcv_transactions", "transaction_id:rcv_transaction_id po_header_id po_line_id created_by creation_date")
    heads = src.scan("po_headers_all", "po_header_id segment1 comments vendor_id")
    sellers = src.scan("poz_suppliers_v", "vendor_id vendor_name")
    lines = src.scan("po_lines_all", "po_line_id")
    df = events.join(moves, "rcv_transaction_id").join(lines, "po_line_id").join(heads, "po_header_id").join(sellers, "vendor_id")
    return _document(df, None, RECEIVING, "GRN", entity_code="entity_code", invoice_id="accounting_event_id", invoice_num="receipt_number",
                     po_number="segment1", po_vendor_name="vendor_name", created_by="created_by", creation_date="creation_date", hdr="comments")


def _receipt_events(src: Source, wanted: DataFrame | None, kind: str) -> DataFrame:
    """Events name the kind of their document themselves."""
    events = src.table("cmr_rcv_events").filter(F.col("event_txn_table_name") == kind)
    if wanted is None:
        return events
    ids = wanted.filter(F.col("application_id") == RECEIVING).select("entity_code", F.col("id").alias("accounting_event_id"))
    return events.join(ids, ["entity_code", "accounting_event_id"], "left_semi")


def receipts_of_goods(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    events = _receipt_events(src, wanted, "CMR_TRANSACTIONS")
    moves = src.scan("cmr_transactions", "transaction_id receipt_number rcv_transaction_id")
    return _goods_receipts(src, events.join(moves, "transaction_id").select(
        "entity_code", "accounting_event_id", "receipt_number", "rcv_transaction_id"))


def receipts_of_invoiced_goods(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    events = _receipt_events(src, wanted, "CMR_AP_INVOICE_DTLS").withColumnRenamed("event_transaction_id", "cmr_ap_invoice_dist_id")
    details = src.scan("cmr_ap_invoice_dtls", "cmr_ap_invoice_dist_id cmr_rcv_transaction_id")
    moves = src.scan("cmr_transactions", "cmr_rcv_transaction_id receipt_number rcv_transaction_id")
    return _goods_receipts(src, events.join(details, "cmr_ap_invoice_dist_id").join(moves, "cmr_rcv_transaction_id").select(
        "entity_code", "accounting_event_id", "receipt_number", "rcv_transaction_id"))


def cash_transactions(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    df = _only(src.table("ce_external_transactions"), wanted, "CE_EXTERNAL", CASH, "transaction_id").withColumn("number", F.col("transaction_id").cast("string"))
    return _document(df, "CE_EXTERNAL", CASH, "CE", invoice_id="transaction_id", invoice_num="number", created_by="created_by",
                     creation_date="creation_date")


BRANCHES: tuple[Callable[[Source, DataFrame | None], DataFrame], ...] = (
    expense_claims, receivable_invoices, receipts, invoice_payments, expense_payments, depreciation, lease_expense,
    asset_transactions, receipts_of_goods, receipts_of_invoiced_goods, cash_transactions)


def subledger_documents(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    """All branches in one shape; of each only the documents ``wanted`` (entity_code, application_id, id)."""
    return reduce(DataFrame.unionByName, (branch(src, wanted) for branch in BRANCHES))


def invoice_entries(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    """Approved item lines of orders with the entry line each distribution was posted to.

    ``wanted`` names entry lines (ae_header_id, ae_line_num); of these all distributions are kept.
    """
    lines = approved_invoice_lines(src).withColumnRenamed("po_line_id", "line_po_line_id")
    dists = src.scan("po_distributions_all", "po_distribution_id po_line_id")
    po_lines = src.scan("po_lines_all", "po_line_id po_header_id")
    links = (src.scan("xla_distribution_links", "applied_to_dist_id_num_1:invoice_distribution_id applied_to_source_id_num_1:invoice_id "
                      "ae_header_id ae_line_num application_id rounding_class_code unrounded_entered_dr unrounded_entered_cr")
             .filter((F.col("rounding_class_code") == "ITEM EXPENSE") & (F.col("application_id") == PAYABLES)))
    entries = (src.scan("xla_ae_lines", "ae_header_id ae_line_num gl_sl_link_id:entry_link entered_dr entered_cr accounting_class_code")
               .filter(F.col("accounting_class_code") == "ITEM EXPENSE"))
    heads = src.scan("xla_ae_headers", "ae_header_id")
    if wanted is not None:
        line = ["ae_header_id", "ae_line_num"]
        links, entries = links.join(wanted, line, "left_semi"), entries.join(wanted, line, "left_semi")
    # from the entry side, which the reduction makes small
    return (links.join(entries, ["ae_header_id", "ae_line_num"]).join(heads, "ae_header_id").join(lines, ["invoice_id", "invoice_distribution_id"])
            .join(dists, "po_distribution_id").filter(F.col("po_line_id") == F.col("line_po_line_id")).join(po_lines, "po_line_id"))


def mixed_entry_lines(entries: DataFrame) -> DataFrame:
    """Entry lines that cover more than one order."""
    return (entries.groupBy("ae_header_id", "ae_line_num").agg(F.count_distinct("po_header_id").alias("orders"))
            .filter(F.col("orders") > 1).select("ae_header_id", "ae_line_num", F.lit(True).alias("mixed")))


def order_invoice_amounts(src: Source, wanted: DataFrame | None = None) -> DataFrame:
    """Invoice documents by entry line (of those ``wanted``): a line that mixes orders is split by distribution."""
    entries = cut(invoice_entries(src, wanted).select(
        "invoice_id", "ae_header_id", "ae_line_num", "po_header_id", "vendor_id", "entry_link", "unrounded_entered_dr", "unrounded_entered_cr",
        "entered_dr", "entered_cr", "created_by", "invoice_desc"))
    orders = src.scan("po_headers_all", "po_header_id segment1:po_number")
    sellers = src.scan("poz_suppliers_v", "vendor_id vendor_name segment1:vendor_num")

    def net(debit: str, credit: str):
        zero = F.lit(0)
        return (F.coalesce(debit, zero) - F.coalesce(credit, zero)).cast("decimal(28,10)")

    df = (entries.join(mixed_entry_lines(entries), ["ae_header_id", "ae_line_num"], "left")
          .join(orders, "po_header_id").join(sellers, "vendor_id"))
    return df.select(
        F.col("invoice_id").alias("inv_id"), F.col("ae_header_id").alias("inv_ae_header"), F.col("ae_line_num").alias("inv_ae_line"),
        F.col("entry_link").alias("inv_link"),
        F.when(F.col("mixed"), net("unrounded_entered_dr", "unrounded_entered_cr"))
        .otherwise(net("entered_dr", "entered_cr")).alias("inv_amount"),
        F.col("po_number").alias("inv_po_number"), F.col("vendor_name").alias("inv_vendor"), F.col("vendor_num").alias("inv_vendor_num"),
        F.col("created_by").alias("inv_by"), F.col("invoice_desc").alias("inv_hdr")).distinct()


def account_descriptions(df: DataFrame, values: DataFrame, segments: list[str], name: str) -> DataFrame:
    """Join the description of each account segment, parts without one are left out."""
    texts = values.groupBy("flex_value").agg(F.max("description").alias("description"))
    for s in segments:
        df = left_lookup(df, texts, [(s, "flex_value")], {f"_{s}": "description"})
    return df.withColumn(name, F.concat_ws(".", *(f"_{s}" for s in segments))).drop(*(f"_{s}" for s in segments))


PARAMETERS = ("period", "source", "status", "costcentre", "accountcode", "activity", "future", "entity")


def ledger_transactions(src: Source, p: Params) -> DataFrame:
    """Journal lines with their sub-ledger documents.  A choice narrows the journals first, then what is read of the documents."""
    heads = src.scan("gl_je_headers", "je_header_id name:journal_name posting_acct_seq_value:accounting_sequence_number period_name "
                     "je_batch_id je_category:je_category_name je_source:je_source_name default_effective_date")
    heads = p.narrow(heads, period="period_name", source="je_source_name")
    lines = p.narrow(src.scan("gl_je_lines", "je_header_id je_line_num code_combination_id entered_dr:journal_dr entered_cr:journal_cr "
                              "currency_code:entered_currency status:status_type created_by:journal_by description:journal_text "
                              "gl_sl_link_id:line_link gl_sl_link_table:line_link_table"), status="status_type")
    codes = p.narrow(src.scan("gl_code_combinations", "code_combination_id segment1 segment2 segment3 segment4 segment5"),
                     costcentre="segment2", accountcode="segment3", activity="segment4", future="segment5", entity="segment1")
    codes = account_descriptions(codes, src.scan("fnd_flex_values_vl", "flex_value description"),
                                 [f"segment{i}" for i in range(1, 6)], "coa_desc")
    refs = src.scan("gl_import_references", "je_header_id je_line_num gl_sl_link_id:ref_link gl_sl_link_table:ref_link_table")
    entries = src.scan("xla_ae_lines", "gl_sl_link_id:entry_link gl_sl_link_table:entry_link_table ae_header_id ae_line_num "
                       "entered_dr:entry_dr entered_cr:entry_cr description:entry_text")
    entry_heads = src.scan("xla_ae_headers", "ae_header_id accounting_date doc_category_code:code doc_sequence_value entity_id")
    entities = src.scan("xla_transaction_entities", "entity_id source_id_int_1 application_id entity_code transaction_number")
    batches = src.scan("gl_je_batches", "je_batch_id name:batch_name posted_date")
    # a journal is completed before it meets its lines, and their references meet them in the layout of the journal
    heads = (heads.join(src.scan("gl_je_categories", "je_category_name user_je_category_name"), "je_category_name")
             .join(src.scan("gl_je_sources_b", "je_source_name je_source_key"), "je_source_name", "left")
             .join(batches, "je_batch_id", "left"))
    posted = cut(
        lines.join(codes, "code_combination_id").join(heads, "je_header_id").join(refs, ["je_header_id", "je_line_num"], "left")
        .withColumns({"link": F.coalesce("line_link", "ref_link"), "link_table": F.coalesce("line_link_table", "ref_link_table")})
        .drop("ref_link", "ref_link_table", "line_link_table", "code_combination_id", "je_category_name", "je_source_name"))
    narrowed = p.date_from or p.date_to or any(p.get(name) is not None for name in PARAMETERS)

    def entry_side() -> DataFrame:
        """Entry lines with their document and invoice; documents meet the entry headers and invoices the entry lines, all of it narrow."""
        lines_of = entries.withColumns({"link": F.col("entry_link"), "link_table": F.col("entry_link_table")}).drop("entry_link_table")
        heads_of, documents, entry_lines = entry_heads, None, None
        if narrowed:
            # what the chosen journals refer to decides what is read of the documents
            lines_of = cut(lines_of.join(posted.select("link", "link_table"), ["link", "link_table"], "left_semi"))
            heads_of = heads_of.join(lines_of.select("ae_header_id"), "ae_header_id", "left_semi")
        document_texts = src.scan("fnd_doc_sequence_categories", "code description:document_text")
        heads_of = heads_of.join(document_texts, "code", "left").join(entities, "entity_id", "left").drop("code", "entity_id")
        if narrowed:
            heads_of = cut(heads_of)
            # an entry without a day takes that of its journal; entries of other days stay, so that their journals are dropped with them below
            asked = heads_of.filter(F.col("accounting_date").isNull() | optional_between(F.col("accounting_date"), p.date_from, p.date_to))
            documents = cut(asked.select("entity_code", "application_id", F.col("source_id_int_1").alias("id")).dropna().distinct())
            bills = asked.filter((F.col("application_id") == PAYABLES) & (F.col("entity_code") == "AP_INVOICES"))
            entry_lines = cut(lines_of.join(bills.select("ae_header_id"), "ae_header_id", "left_semi")
                              .select("ae_header_id", "ae_line_num").dropna().distinct())
        inv = step(src.spark, lambda: order_invoice_amounts(src, entry_lines))
        docs = step(src.spark, lambda: subledger_documents(src, documents).select(
            F.col("invoice_id").alias("txn_id"), F.col("appl_id").alias("txn_appl"), F.col("entity_code").alias("txn_entity"),
            F.col("typ").alias("txn_typ"), F.col("created_by").alias("txn_by"), F.col("hdr").alias("txn_hdr"),
            F.col("po_vendor_name").alias("txn_vendor"), F.col("vendor_num").alias("txn_vendor_num")))
        completed = step(src.spark, lambda: heads_of.join(
            docs, (F.col("source_id_int_1") == F.col("txn_id")) & (F.col("application_id") == F.col("txn_appl"))
            & (F.col("entity_code") == F.col("txn_entity")), "left").drop("txn_id", "txn_appl", "txn_entity"))
        return (lines_of.join(completed, "ae_header_id", "left")
                .join(inv, (F.col("ae_header_id") == F.col("inv_ae_header")) & (F.col("ae_line_num") == F.col("inv_ae_line"))
                      & (F.col("source_id_int_1") == F.col("inv_id")) & (F.col("application_id") == PAYABLES)
                      & (F.col("entity_code") == "AP_INVOICES"), "left")
                .drop("ae_header_id", "source_id_int_1", "application_id", "entity_code", "inv_ae_header", "inv_ae_line"))

    # the wide journal lines pass one join, by link; their texts are packed for it and for the order
    journal_lines, texts_of_journal = pack_texts(posted, ["link", "link_table"], "_of_journal")
    entry_rows, texts_of_entry = pack_texts(step(src.spark, entry_side), ["link", "link_table"], "_of_entry")
    df = texts_of_entry(texts_of_journal(
        left_join_skewed(journal_lines, entry_rows, ["link", "link_table"], posted)
        .withColumn("gl_day", F.coalesce("accounting_date", "default_effective_date"))
        .filter(optional_between(F.col("gl_day"), p.date_from, p.date_to))))
    is_invoice, typ = F.col("inv_id").isNotNull(), F.col("txn_typ")
    paid, staff = typ == "Invoice Payments", typ.isin("Expense Claim", "Expense Payments")

    def seller(invoice: str, document: str):
        return F.when(is_invoice, F.col(invoice)).when(paid, F.col(document))

    out = df.select(
        "journal_name", "accounting_sequence_number", "period_name", "je_header_id", "entered_currency", "status_type",
        F.coalesce("entry_link", "line_link").alias("linkid"),
        A.journal_amount(F.col("inv_link"), F.col("inv_amount"), F.col("line_link"), F.col("entry_dr"), F.col("entry_cr"),
                         F.col("journal_dr"), F.col("journal_cr")).alias("entered_amount"),
        F.col("segment1").alias("entity_type"), F.col("segment2").alias("cost_centre"), F.col("segment3").alias("natural_account"),
        X.account_class(F.col("segment3")).alias("natural_account_classification"), F.col("segment4").alias("activity_type"),
        F.col("segment5").alias("future_type"), F.col("user_je_category_name").alias("journal_category"),
        F.col("je_source_key").alias("journal_source"), "batch_name", "je_batch_id", D.dmy(F.col("posted_date"), "/").alias("posted_date"),
        F.col("doc_sequence_value").alias("document_sequence_number"), "gl_day", "transaction_number",
        F.coalesce("inv_by", "txn_by", "journal_by").alias("createdby"),
        X.one_line(F.coalesce("inv_hdr", "txn_hdr", "entry_text", "journal_text")).alias("description"),
        F.coalesce(F.when(is_invoice, F.lit("AP Invoice")), typ, F.col("document_text"), F.lit("Journal")).alias("documenttype"),
        F.col("inv_po_number").alias("po_number"), F.coalesce("ae_line_num", "je_line_num").alias("journal_line"), "coa_desc",
        seller("inv_vendor", "txn_vendor").alias("suppliername"), F.when(staff, F.col("txn_vendor")).alias("employeename"),
        seller("inv_vendor_num", "txn_vendor_num").alias("suppliernum"), F.when(staff, F.col("txn_vendor_num")).alias("employeenum"),
    )
    # equal rows have the same place in the order, so the ranges of the order serve to drop repeats as well
    order = [F.asc_nulls_last(c) for c in ("gl_day", "journal_name", "transaction_number")]
    rows, texts = pack_texts(out, ["journal_name", "transaction_number"])
    return texts(rows.repartitionByRange(*order).distinct().orderBy(*order)).select(
        *(c for c in out.columns if c != "gl_day"), D.dmy(F.col("gl_day"), "/").alias("gl_date"))
