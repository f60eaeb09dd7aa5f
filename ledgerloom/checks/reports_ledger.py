"""Ledger, order audit and alert on the stand-in tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame

from ledgerloom.checks.registry import narrowed, register
from ledgerloom.checks.reports_finance import PLAIN, bills, d, sentence
from ledgerloom.functions.params import Params
from ledgerloom.plans import ledger as L, versions as V
from ledgerloom.session import ensure_checkpoint_dir
from ledgerloom.sources.catalog import Source
from ledgerloom.streaming import alerts as S

STAFF = """
    staff AS (
      SELECT p.party_id, p.party_name, w.person_number
      FROM {hz_orig_sys_references} r JOIN {hz_parties} p ON p.party_id = r.owner_table_id AND p.party_type = 'PERSON'
      JOIN {per_all_people_f} w ON cast(w.person_id AS varchar) = r.orig_system_reference
      WHERE r.orig_system = 'FUSION_HCM' AND r.owner_table_name = 'HZ_PARTIES')"""

# (entity, key, number, status, currency, amount, tax, po, seller, day, by, made, text, seller number, application, kind)
DOCS = f"""
    seller_of AS (SELECT a.cust_account_id, p.party_name FROM {{hz_cust_accounts}} a JOIN {{hz_parties}} p USING (party_id)),
    grn AS (
      SELECT e.entity_code, e.accounting_event_id, t.receipt_number, o.segment1, v.vendor_name, m.created_by, m.creation_date, o.comments
      FROM {{cmr_rcv_events}} e LEFT JOIN {{cmr_ap_invoice_dtls}} x
        ON e.event_txn_table_name = 'CMR_AP_INVOICE_DTLS' AND x.cmr_ap_invoice_dist_id = e.event_transaction_id
      JOIN {{cmr_transactions}} t ON CASE e.event_txn_table_name WHEN 'CMR_TRANSACTIONS' THEN t.transaction_id = e.transaction_id
                                       ELSE t.cmr_rcv_transaction_id = x.cmr_rcv_transaction_id END
      JOIN {{rcv_transactions}} m ON m.transaction_id = t.rcv_transaction_id JOIN {{po_lines_all}} l ON l.po_line_id = m.po_line_id
      JOIN {{po_headers_all}} o ON o.po_header_id = m.po_header_id JOIN {{poz_suppliers_v}} v ON v.vendor_id = o.vendor_id),
    docs(entity_code, invoice_id, invoice_num, payment_status, invoice_currency, invoice_amount, tax_amount, po_number, po_vendor_name,
         invoice_date, created_by, creation_date, hdr, vendor_num, appl_id, typ) AS (
      SELECT 'AP_INVOICES', i.invoice_id, i.invoice_num, i.payment_status_flag, i.invoice_currency_code, i.invoice_amount, i.total_tax_amount,
             cast(NULL AS varchar), s.party_name, i.invoice_date, i.created_by, i.creation_date, i.description, s.person_number, 200, 'Expense Claim'
      FROM {{ap_invoices_all}} i JOIN staff s USING (party_id) WHERE i.source = 'EMP_EXPENSE_REPORT'
      UNION ALL SELECT 'TRANSACTIONS', t.customer_trx_id, t.trx_number, NULL, t.invoice_currency_code, a.amount_due_original, a.tax_original, NULL,
             c.party_name, t.trx_date, t.created_by, t.creation_date, t.comments, NULL, 222, 'AR Invoice'
      FROM {{ra_customer_trx_all}} t JOIN {{ar_payment_schedules_all}} a USING (customer_trx_id) JOIN seller_of c ON c.cust_account_id = a.customer_id
      UNION ALL SELECT 'RECEIPTS', cash_receipt_id, receipt_number, NULL, currency_code, amount, tax_amount, NULL, c.party_name, receipt_date,
             created_by, creation_date, comments, NULL, 222, 'AR Receipts'
      FROM {{ar_cash_receipts_all}} JOIN seller_of c ON c.cust_account_id = pay_from_customer
      UNION ALL SELECT 'AP_PAYMENTS', check_id, NULL, NULL, NULL, NULL, NULL, NULL, k.vendor_name, NULL, k.created_by, k.creation_date, k.description,
             v.segment1, 200, 'Invoice Payments' FROM {{ap_checks_all}} k JOIN {{poz_suppliers_v}} v USING (vendor_id)
      UNION ALL SELECT 'AP_PAYMENTS', check_id, NULL, NULL, NULL, NULL, NULL, NULL, k.vendor_name, NULL, k.created_by, k.creation_date, k.description,
             s.person_number, 200, 'Expense Payments' FROM {{ap_checks_all}} k JOIN staff s USING (party_id)
      UNION ALL SELECT kind, asset_id, asset_number, NULL, NULL, NULL, NULL, NULL, NULL, NULL, created_by, creation_date, description, NULL, 140, 'FA'
      FROM (SELECT unnest(['DEPRECIATION', 'LEASE_EXPENSE']) AS kind, * FROM {{fa_additions_vl}})
      UNION ALL SELECT 'TRANSACTIONS', transaction_header_id, asset_number, NULL, NULL, NULL, NULL, NULL, NULL, NULL, created_by, creation_date,
             description, NULL, 140, 'FA' FROM {{fa_transaction_headers}} JOIN {{fa_additions_vl}} USING (asset_id)
      UNION ALL SELECT entity_code, accounting_event_id, receipt_number, NULL, NULL, NULL, NULL, segment1, vendor_name, NULL, created_by,
             creation_date, comments, NULL, 10096, 'GRN' FROM grn
      UNION ALL SELECT 'CE_EXTERNAL', transaction_id, cast(transaction_id AS varchar), NULL, NULL, NULL, NULL, NULL, NULL, NULL, created_by,
             creation_date, NULL, NULL, 260, 'CE' FROM {{ce_external_transactions}})"""

register("ledger_union", lambda s: L.subledger_documents(s).drop("creation_date"),
         f"WITH {STAFF}, {DOCS} SELECT * EXCLUDE (creation_date) FROM docs")

ENTRIES = """
    posted AS (
      SELECT b.invoice_id, b.vendor_id, b.created_by, b.about, k.ae_header_id, k.ae_line_num, a.gl_sl_link_id, l.po_header_id,
             coalesce(k.unrounded_entered_dr, 0) - coalesce(k.unrounded_entered_cr, 0) AS exact,
             coalesce(a.entered_dr, 0) - coalesce(a.entered_cr, 0) AS whole
      FROM (SELECT bill0.*, z.invoice_distribution_id, y.po_line_id AS line_po
            FROM bill0 JOIN {ap_invoice_distributions_all} z ON z.invoice_id = bill0.invoice_id AND z.invoice_line_number = bill0.line_number
            JOIN {ap_invoice_lines_all} y ON y.invoice_id = bill0.invoice_id AND y.line_number = bill0.line_number) b
      JOIN {po_distributions_all} q USING (po_distribution_id) JOIN {po_lines_all} l ON l.po_line_id = q.po_line_id AND l.po_line_id = b.line_po
      JOIN {xla_distribution_links} k ON k.applied_to_dist_id_num_1 = b.invoice_distribution_id AND k.applied_to_source_id_num_1 = b.invoice_id
      JOIN {xla_ae_lines} a ON a.ae_header_id = k.ae_header_id AND a.ae_line_num = k.ae_line_num
      WHERE k.application_id = 200 AND (k.rounding_class_code, a.accounting_class_code) = ('ITEM EXPENSE', 'ITEM EXPENSE'))"""

register("mixed_orders", lambda s: L.mixed_entry_lines(L.invoice_entries(s)).drop("mixed"), f"""
    WITH {bills("'ITEM'", "gross")}, {ENTRIES}
    SELECT ae_header_id, ae_line_num FROM posted GROUP BY ALL HAVING min(po_header_id) <> max(po_header_id)""")


def _ledger(where: str, since: str, until: str) -> str:
    return f"""
    WITH {bills("'ITEM'", "gross")}, {STAFF}, {DOCS}, {ENTRIES},
    booked AS (
      SELECT DISTINCT invoice_id, ae_header_id, ae_line_num, gl_sl_link_id,
             cast(if(mixed, exact, whole) AS decimal(28,10)) AS amount, o.segment1 AS po, v.vendor_name, v.segment1 AS num, created_by, about
      FROM (SELECT *, min(po_header_id) OVER w <> max(po_header_id) OVER w AS mixed FROM posted WINDOW w AS (PARTITION BY ae_header_id, ae_line_num)) x
      JOIN {{po_headers_all}} o USING (po_header_id) JOIN {{poz_suppliers_v}} v ON v.vendor_id = x.vendor_id),
    flex AS (SELECT flex_value, max(description) AS t FROM {{fnd_flex_values_vl}} GROUP BY 1),
    acct AS (
      SELECT g.*, concat_ws('.', f1.t, f2.t, f3.t, f4.t, f5.t) AS coa_desc FROM {{gl_code_combinations}} g
      {' '.join(f'LEFT JOIN flex f{i} ON f{i}.flex_value = g.segment{i}' for i in range(1, 6))} WHERE g.segment1 IN ('1', '2'))
    SELECT DISTINCT h.name AS journal_name, h.posting_acct_seq_value AS accounting_sequence_number, h.period_name, h.je_header_id,
           l.currency_code AS entered_currency, l.status AS status_type, coalesce(a.gl_sl_link_id, l.gl_sl_link_id) AS linkid,
           cast(CASE WHEN i.gl_sl_link_id IS NOT NULL THEN i.amount WHEN l.gl_sl_link_id IS NOT NULL THEN l.entered_dr - l.entered_cr
                ELSE coalesce(a.entered_dr, l.entered_dr, 0) - coalesce(a.entered_cr, l.entered_cr, 0) END AS decimal(28,10)) AS entered_amount,
           acct.segment1 AS entity_type, acct.segment2 AS cost_centre, acct.segment3 AS natural_account,
           acct.segment3[1] AS natural_account_classification, acct.segment4 AS activity_type, acct.segment5 AS future_type,
           c.user_je_category_name AS journal_category, src.je_source_key AS journal_source, b.name AS batch_name, h.je_batch_id,
           strftime(b.posted_date, '%d/%m/%Y') AS posted_date, x.doc_sequence_value AS document_sequence_number,
           strftime(coalesce(x.accounting_date, h.default_effective_date), '%d/%m/%Y') AS gl_date, e.transaction_number,
           coalesce(i.created_by, t.created_by, l.created_by) AS createdby,
           replace(replace(coalesce(i.about, t.hdr, a.description, l.description), chr(10), ' '), chr(13), ' ') AS description,
           coalesce(if(i.invoice_id IS NULL, NULL, 'AP Invoice'), t.typ, f.description, 'Journal') AS documenttype, i.po AS po_number,
           coalesce(a.ae_line_num, l.je_line_num) AS journal_line, acct.coa_desc,
           CASE WHEN i.invoice_id IS NOT NULL THEN i.vendor_name WHEN t.typ = 'Invoice Payments' THEN t.po_vendor_name END AS suppliername,
           if(t.typ LIKE 'Expense%', t.po_vendor_name, NULL) AS employeename,
           CASE WHEN i.invoice_id IS NOT NULL THEN i.num WHEN t.typ = 'Invoice Payments' THEN t.vendor_num END AS suppliernum,
           if(t.typ LIKE 'Expense%', t.vendor_num, NULL) AS employeenum
    FROM {{gl_je_lines}} l JOIN {{gl_je_headers}} h USING (je_header_id) JOIN acct USING (code_combination_id)
    JOIN {{gl_je_categories}} c ON c.je_category_name = h.je_category
    LEFT JOIN {{gl_je_sources_b}} src ON src.je_source_name = h.je_source LEFT JOIN {{gl_je_batches}} b ON b.je_batch_id = h.je_batch_id
    LEFT JOIN {{gl_import_references}} r ON (r.je_header_id, r.je_line_num) = (l.je_header_id, l.je_line_num)
    LEFT JOIN {{xla_ae_lines}} a ON a.gl_sl_link_id = coalesce(l.gl_sl_link_id, r.gl_sl_link_id)
         AND a.gl_sl_link_table = coalesce(l.gl_sl_link_table, r.gl_sl_link_table)
    LEFT JOIN {{xla_ae_headers}} x ON x.ae_header_id = a.ae_header_id LEFT JOIN {{xla_transaction_entities}} e ON e.entity_id = x.entity_id
    LEFT JOIN {{fnd_doc_sequence_categories}} f ON f.code = x.doc_category_code
    LEFT JOIN booked i ON i.invoice_id = e.source_id_int_1 AND e.application_id = 200 AND e.entity_code = 'AP_INVOICES'
         AND i.ae_header_id = x.ae_header_id AND i.ae_line_num = a.ae_line_num
    LEFT JOIN docs t ON t.invoice_id = e.source_id_int_1 AND t.appl_id = e.application_id AND t.entity_code = e.entity_code
    WHERE coalesce(x.accounting_date, h.default_effective_date) BETWEEN date '{since}' AND date '{until}' AND {where}"""


register("report_r16", lambda s: L.ledger_transactions(s, Params(as_at=dt.date(1998, 3, 1), date_from=dt.date(1996, 1, 1), chosen={"entity": ["1", "2"]})),
         _ledger("acct.segment1 IN ('1', '2')", "1996-01-01", "2100-01-01"), written=("li", "inv"))
NARROWED = Params(as_at=dt.date(1998, 3, 1), date_from=dt.date(1996, 3, 2), date_to=dt.date(1997, 4, 28), chosen={
    "period": ["1996-3", "1996-4", "1997-4"], "source": ["Payables", "Unlisted", "Manual"], "status": "P", "costcentre": ["427", "115"],
    "accountcode": [str(10000 * (1 + k % 4) + k) for k in range(0, 90)], "activity": [f"A{k}" for k in range(9)], "future": "000", "entity": "2"})
register("report_r16_narrowed", lambda s: L.ledger_transactions(s, NARROWED), _ledger(
    """h.period_name IN ('1996-3', '1996-4', '1997-4') AND h.je_source IN ('Payables', 'Unlisted', 'Manual') AND l.status = 'P' AND acct.segment2 IN ('427', '115')
    AND acct.segment3 IN (SELECT cast(10000 * (1 + k % 4) + k AS varchar) FROM range(90) r(k)) AND acct.segment4 IN (SELECT 'A' || k FROM range(9) r(k))
    AND acct.segment5 = '000' AND acct.segment1 = '2'""", "1996-03-02", "1997-04-28"), written=("li", "inv"))



# ---- order audit ----

# Fixed values, written out here too, so that a slip in the library's list shows.
_GROUPS = """WHEN g.segment2 = '115' THEN 'Chief Executive' WHEN g.segment2 = '999' THEN 'Suspense Account' WHEN g.segment2 = '991' THEN 'Multiple'
    WHEN g.segment2 = '810' THEN 'Place'
    WHEN g.segment2 IN ('901', '911', '215', '216', '217', '218', '219', '235', '821', '238', '861', '871', '246', '247', '249')
      THEN 'Intelligence and System Direction'
    WHEN g.segment2 IN ('401', '405', '406', '341', '261', '409', '361', '426', '427', '431', '432', '441', '331') THEN 'System Delivery and Performance'
    WHEN g.segment2 IN ('501', '511', '515', '541', '531', '525', '521', '551') THEN 'Tumuaki Te Tāhui'
    WHEN g.segment2 IN ('601', '621', '711', '631', '941', '721', '641', '661', '611', '615') THEN 'Organisational Performance'
    WHEN g.segment2 IN ('701', '651', '681', '741') THEN 'Office of Chief Executive'
    WHEN g.segment2 IN ('301', '231', '241', '841', '221', '851', '305', '351', '827', '835', '836', '931') THEN 'Solutions Design and Implementation'"""
_WORD = "CASE {t} WHEN 'I' THEN 'New' WHEN 'U' THEN 'Changed' WHEN 'C' THEN 'Changed' END"
_FILLED = V.FILLED

AUDIT = f"""
    ver AS (SELECT v.*, f.document_date AS first_date FROM {{po_versions}} v JOIN {{po_versions}} f ON f.po_header_id = v.po_header_id AND f.co_sequence = 0),
    who AS (SELECT person_id, display_name FROM {{per_person_names_f}}
            WHERE name_type = 'GLOBAL' AND date '1998-03-01' BETWEEN effective_start_date AND effective_end_date),
    hv AS (
      SELECT a.po_header_id, v.version_id, a.segment1 AS po_number, a.type_lookup_code, v.co_sequence AS header_co_sequence,
             trim(a.comments) AS po_description, coalesce(v.co_num, 0) AS co_num, v.change_order_desc, v.originator_id, v.originator_role,
             a.entity_change_type_code, {d('v.first_date')} AS po_date_display, {d('v.document_date')} AS po_changeorder_date,
             {d('v.creation_date')} AS version_date,
             CASE WHEN a.cancel_flag = 'Y' THEN 'Cancelled' WHEN a.from_co_seq = v.co_sequence THEN {_WORD.replace('{t}', 'a.entity_change_type_code')} END AS headerstatus,
             u.name AS businessunit, s.segment1 AS supplier_num, p.party_name AS supplier_name
      FROM {{po_headers_archive_all}} a JOIN ver v ON v.po_header_id = a.po_header_id AND v.co_sequence >= a.from_co_seq AND v.co_sequence < a.to_co_seq
      JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = a.prc_bu_id JOIN {{poz_suppliers}} s USING (vendor_id)
      JOIN {{hz_parties}} p ON p.party_id = s.party_id),
    opened AS (
      SELECT 'ship' AS kind, line_location_id, po_line_id, from_co_seq FROM {{po_line_locations_archive_all}} WHERE to_co_seq = 9999999
      UNION SELECT 'dist', line_location_id, po_line_id, from_co_seq FROM {{po_distributions_archive_all}} WHERE to_co_seq = 9999999),
    lv AS (
      SELECT l.*, v.version_id, v.co_sequence FROM {{po_lines_archive_all}} l JOIN ver v ON v.po_header_id = l.po_header_id
        AND v.co_sequence >= l.from_co_seq AND v.co_sequence < l.to_co_seq
      WHERE l.from_co_seq = v.co_sequence OR (l.to_co_seq = 9999999 AND (l.po_line_id, v.co_sequence) IN (SELECT (po_line_id, from_co_seq) FROM opened))),
    sv AS (
      SELECT k.*, v.version_id FROM {{po_line_locations_archive_all}} k JOIN ver v ON v.po_header_id = k.po_header_id
        AND v.co_sequence >= k.from_co_seq AND v.co_sequence < k.to_co_seq
      WHERE k.from_co_seq = v.co_sequence OR (k.to_co_seq = 9999999
        AND (k.line_location_id, v.co_sequence) IN (SELECT (line_location_id, from_co_seq) FROM opened WHERE kind = 'dist'))),
    lines AS (
      SELECT l.po_header_id, l.version_id, l.line_num, l.item_revision, l.item_description, who.display_name AS requester, l.vendor_product_num,
             t.line_type, l.shipping_uom_quantity AS quantity, l.uom_code AS pricing_uom_code, l.base_qty, l.base_uom, l.unit_price,
             sv.assessable_value AS po_ordered_amount, l.cancel_flag,
             if(l.from_co_seq = l.co_sequence, l.entity_change_type_code, 'C') AS entity_line_change_type_code,
             if(l.from_co_seq = l.co_sequence, if(l.cancel_flag = 'Y', 'CANCELLED', {_WORD.replace('{t}', 'l.entity_change_type_code')}), 'Changed') AS line_status,
             q.code_combination_id, g.segment1 AS entity, g.segment2 AS cost_centre, CASE {_GROUPS} END AS cost_centre_group,
             g.segment3 AS natural_account, g.segment4 AS activity, g.segment5 AS future, l.category_id, e.category_code AS categorycode
      FROM lv l JOIN {{po_line_types_vl}} t USING (line_type_id) JOIN sv USING (po_header_id, po_line_id, version_id)
      JOIN {{po_distributions_archive_all}} q ON q.po_header_id = l.po_header_id AND q.po_line_id = l.po_line_id
        AND q.line_location_id = sv.line_location_id AND l.co_sequence >= q.from_co_seq AND l.co_sequence < q.to_co_seq
      JOIN who ON who.person_id = q.deliver_to_person_id JOIN {{gl_code_combinations}} g USING (code_combination_id)
      JOIN {{egp_categories_b}} e ON e.category_id = l.category_id
      WHERE EXISTS (FROM {{po_headers_archive_all}} a WHERE a.po_header_id = l.po_header_id AND l.co_sequence >= a.from_co_seq AND l.co_sequence < a.to_co_seq)),
    filled AS (
      SELECT h.po_header_id, h.version_id, h.co_num, l.line_num, l.line_status,
             {', '.join(f"if(l.line_status IS NULL, coalesce(l.{c}, " + ", ".join(f"lag(l.{c}, {i}) OVER w" for i in range(1, 8)) + f"), l.{c}) AS {c}" for c in _FILLED)}
      FROM hv h LEFT JOIN lines l USING (po_header_id, version_id)
      WINDOW w AS (PARTITION BY h.po_header_id ORDER BY h.co_num, l.line_num NULLS LAST, l.code_combination_id NULLS LAST))"""

register("report_r08", lambda s: V.order_changes(s, PLAIN), f"""
    WITH {AUDIT}
    SELECT h.*, if(h.originator_role = 'SYSTEM', 'System', n.display_name) AS initiator_name,
           CASE WHEN l.line_status <> 'New' THEN 'Line Amended'
                WHEN l.line_status IS NULL AND coalesce(h.headerstatus, 'Changed') = 'Changed' THEN 'Header Amended'
                WHEN l.line_status = 'New' AND h.headerstatus = 'New' THEN 'Original Document'
                WHEN l.line_status = 'New' AND coalesce(h.headerstatus, 'Changed') = 'Changed' THEN 'Line Created' END AS status,
           l.* EXCLUDE (po_header_id, version_id, {', '.join(_FILLED)}),
           {', '.join(f'coalesce(cc.{c}, c.{c}) AS {c}' for c in _FILLED)}
    FROM hv h LEFT JOIN lines l USING (po_header_id, version_id)
    LEFT JOIN (FROM filled WHERE line_status IS NOT NULL) cc
      ON (cc.po_header_id, cc.version_id, cc.co_num, cc.line_num) = (h.po_header_id, h.version_id, h.co_num, l.line_num)
    LEFT JOIN (FROM filled WHERE line_status IS NULL) c ON (c.po_header_id, c.version_id, c.co_num) = (h.po_header_id, h.version_id, h.co_num)
    LEFT JOIN who n ON n.person_id = h.originator_id""", written=("li", "po_versions"))

narrowed("report_r08_narrowed", "report_r08", lambda s: V.order_changes(s, Params(as_at=PLAIN.as_at, chosen={
    "business_unit": ["Crown", "EUROPE"], "suppliernum": [f"S{k}" for k in range(60)], "costcentre": ["427", "115"], "category_code": [1, 2, 3, 5]})),
    """businessunit IN ('Crown', 'EUROPE') AND supplier_num IN (SELECT 'S' || k FROM range(60) r(k)) AND cost_centre IN ('427', '115')
       AND category_id IN (1, 2, 3, 5)""", written=("li", "po_versions"))

# ---- alert ----

NOW = Params(as_at=dt.datetime(2024, 1, 30, 17))
_REQ = """FROM {por_requisition_lines_all} l JOIN {por_requisition_headers_all} h USING (requisition_header_id)
          WHERE l.new_supplier_flag = 'Y' AND h.submission_date > timestamp '2024-01-29 17:00:00' AND h.submission_date <= timestamp '2024-01-30 17:00:00'"""
_ALERT = f"""SELECT DISTINCT h.requisition_number, h.description, {sentence('h.document_status')} AS status, l.line_number, l.unit_price, l.quantity,
        l.uom_code AS uom, l.suggested_vendor_name, l.suggested_vendor_site AS site, l.suggested_vendor_contact_phone AS phone,
        l.suggested_vendor_contact_email AS email, l.suggested_supplier_item_number AS item_number {_REQ}"""
register("report_r20", lambda s: S.new_supplier_alerts(s, NOW), _ALERT)


def _streamed_alerts(s: Source) -> DataFrame:
    """Headers and lines as files, in different order, then the stream over them in several micro-batches."""
    folder = f"{ensure_checkpoint_dir(s.spark)}/alerts-{uuid.uuid4().hex}"
    s.table("por_requisition_headers_all").repartition(3, "requisition_header_id").write.parquet(f"{folder}/por_requisition_headers_all")
    s.table("por_requisition_lines_all").repartition(4, "line_number", "requisition_header_id", "quantity").write.parquet(f"{folder}/por_requisition_lines_all")
    return S.daily_alerts(s, NOW, folder, files_per_batch=2)


register("daily_alerts", _streamed_alerts, _ALERT)
register("report_r21", lambda s: S.alert_trigger(s, NOW), f"SELECT 'true' AS fired {_REQ}")
