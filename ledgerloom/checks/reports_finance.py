"""Finance and purchasing reports on the stand-in tables, each with an oracle in DuckDB's dialect."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame

from ledgerloom.checks.registry import narrowed, register
from ledgerloom.functions.params import Params
from ledgerloom.plans import invoices as I, orders as O
from ledgerloom.session import ensure_checkpoint_dir
from ledgerloom.sources.catalog import Source
from ledgerloom.sources.sinks import run_report, write_report

AT = dt.date(1998, 3, 1)
PLAIN = Params(as_at=AT)
# Stand-ins that most tables of a purchasing report derive from: folded once, not once a table.
LINES = ("li", "inv")


def bills(kinds: str, exempt: str) -> str:
    """Named sub-result ``bill``: one row per approved line and distribution."""
    part = "gross" if exempt == "gross" else "net"
    return f"""
    bill0 AS (
      SELECT h.invoice_id, h.invoice_num, h.invoice_date, h.gl_date, h.created_by, h.creation_date AS made, h.description AS about,
             h.payment_status_flag AS paid, h.vendor_id, h.org_id, h.accts_pay_code_combination_id AS account, h.invoice_amount AS gross,
             l.period_name, l.created_by AS line_by, l.last_updated_by AS line_upd, l.creation_date AS line_made, l.description AS line_about,
             l.line_number, l.amount, d.po_distribution_id,
             coalesce(l.tax_classification_code IN ('GST ZERO', 'GST EXEMPT'), false) AS untaxed,
             cast(h.invoice_amount - coalesce(h.total_tax_amount, 0) AS decimal(18,2)) AS net
      FROM {{ap_invoices_all}} h
      JOIN (FROM {{ap_invoice_lines_all}} WHERE discarded_flag = 'N' AND line_type_lookup_code IN ({kinds})) l USING (invoice_id)
      JOIN (FROM {{ap_invoice_distributions_all}} WHERE line_type_lookup_code IN ({kinds})) d
        ON (d.invoice_id, d.invoice_line_number) = (l.invoice_id, l.line_number)
      WHERE h.approval_status = 'APPROVED'),
    bill AS (
      SELECT *, if(untaxed, if(gross = amount, amount, {part}), net) AS shown,
             if(untaxed, gross <> amount, amount <> net) AS own,
             year(gl_date) - if(month(gl_date) < 7, 1, 0) AS fyear
      FROM bill0)"""


FY = "fyear || '-' || (fyear + 1)"


def d(c: str) -> str:
    return f"strftime({c}, '%d-%m-%Y')"


def login(c: str, fixed: str = "WHEN 'Batch.Scheduler' THEN 'Batch Scheduler'") -> str:
    """First and last name parts of a login, by regular expression."""
    def up(t: str) -> str:
        return f"upper({t}[1]) || lower({t}[2:])"
    first, last = f"regexp_extract({c}, '^([^.@]*)\\.', 1)", f"regexp_extract({c}, '^[^.@]*\\.?([^@]*)@', 1)"
    return f"CASE {c} {fixed} ELSE {up(first)} || ' ' || {up(last)} END"


def sentence(c: str) -> str:
    return f"upper({c}[1]) || lower({c}[2:])"


ORDER_OF = """
    po_of AS (
      SELECT q.po_distribution_id, o.po_header_id, o.segment1 AS po, l.line_num
      FROM {po_distributions_all} q JOIN {po_lines_all} l USING (po_header_id, po_line_id) JOIN {po_headers_all} o USING (po_header_id))"""

register("report_r01", lambda s: I.invoice_entry(s, PLAIN), f"""
    WITH {bills("'ITEM','MISCELLANEOUS'", "net")}, {ORDER_OF},
    acts AS (
      SELECT invoice_id, CASE response WHEN 'ORA_AUTO APPROVED' THEN 'Auto Approved' ELSE
             {login('approver_id', "WHEN 'Batch.Scheduler' THEN 'Batch Scheduler' WHEN 'ORA_WORKFLOW SYSTEM' THEN 'Workflow System'")} END AS who,
             max(cast(action_date AS date)) AS day
      FROM {{ap_inv_aprvl_hist_all}}
      WHERE history_type = 'DOCUMENTAPPROVAL' AND response IN ('APPROVED', 'MANUALLY APPROVED', 'ORA_AUTO APPROVED') GROUP BY ALL),
    who AS (SELECT invoice_id, list(who ORDER BY day, who) AS names FROM acts GROUP BY invoice_id),
    pos AS (SELECT invoice_id, list(po ORDER BY po, po_header_id) AS numbers
            FROM (SELECT DISTINCT invoice_id, po, po_header_id FROM {{ap_invoice_distributions_all}} JOIN po_of USING (po_distribution_id))
            GROUP BY invoice_id),
    heads AS (
      SELECT DISTINCT b.invoice_id, invoice_num, shown AS invoice_amount, {d('invoice_date')} AS invoice_date, {FY} AS fy,
             {login('created_by')} AS created_by, {d('made')} AS invoice_creation_date, {d('gl_date')} AS gl_date, about AS invoice_desc,
             paid AS payment_status_flag, party_name AS supplier_name, s.segment1 AS supplier_num,
             coalesce(names[1], 'Not Required') AS approver_1, names[2] AS approver_2, names[3] AS approver_3, u.name AS business_unit,
             {', '.join(f'numbers[{i}] AS po_{i}' for i in range(1, 7))},
             CASE WHEN shown >= 100000 AND names = ['Auto Approved'] THEN 'ERROR' END AS autoapprovererror
      FROM bill b JOIN {{gl_code_combinations}} g ON g.code_combination_id = account
      JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = org_id
      LEFT JOIN {{poz_suppliers}} s USING (vendor_id) LEFT JOIN {{hz_parties}} p ON p.party_id = s.party_id
      LEFT JOIN who ON who.invoice_id = b.invoice_id LEFT JOIN pos ON pos.invoice_id = b.invoice_id
      WHERE shown <> 0)
    SELECT *, 999 + row_number() OVER (ORDER BY invoice_id, invoice_amount) AS unique_row_number FROM heads""")

register("report_r02", lambda s: I.invoice_entry_lines(s, PLAIN), f"""
    WITH {bills("'ITEM','MISCELLANEOUS'", "net")}, {ORDER_OF}
    SELECT invoice_id, period_name, invoice_num, shown AS invoice_amount, {d('invoice_date')} AS invoice_date, created_by,
           {d('made')} AS invoice_creation_date, {d('gl_date')} AS gl_date, {d('line_made')} AS invoice_line_creation_date,
           about AS invoice_desc, paid AS payment_status_flag, line_about AS invoice_line_description, b.po_distribution_id,
           line_by AS line_created_by, line_upd AS line_last_updated_by, if(own, amount, NULL) AS invoice_line_amount,
           if(own, line_number, NULL) AS invoice_line_number,
           if(len(list_distinct([created_by, line_by, line_upd, 'Batch.Scheduler'])) = 1, 'No Intervention', 'Intervention') AS intervention_status,
           CASE line_by = 'Batch.Scheduler' WHEN false THEN 'Manually Created Invoice'
                ELSE if(created_by = 'Batch.Scheduler', 'System Created Invoice', NULL) END AS creation_status,
           po AS purchase_order_number, line_num AS po_line_number, u.name AS business_unit, {FY} AS fy, s.segment1 AS supplier_num,
           party_name AS supplier_name
    FROM bill b JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = org_id
    LEFT JOIN {{poz_suppliers}} s USING (vendor_id) LEFT JOIN {{hz_parties}} p ON p.party_id = s.party_id
    LEFT JOIN po_of ON po_of.po_distribution_id = b.po_distribution_id
    WHERE gross <> 0""", written=LINES)

SPEND = f"""
    spend AS (
      SELECT po_distribution_id, cast(coalesce(sum(if(own, amount, shown)), 0) AS decimal(38,2)) AS total_po_spend,
             cast(coalesce(sum(if(own, amount, shown)) FILTER (fyear = 1997), 0) AS decimal(38,2)) AS total_po_spend_current_fy,
             count(DISTINCT invoice_id) AS invoice_count,
             coalesce(round(cast(sum(if(own, amount, shown)) AS double) / nullif(count(DISTINCT invoice_id), 0), 2), 0) AS average
      FROM bill GROUP BY po_distribution_id)"""

register("report_r11", lambda s: I.spend_per_distribution(s, PLAIN), f"""
    WITH {bills("'ITEM'", "gross")}, {SPEND}
    SELECT po_distribution_id, total_po_spend, total_po_spend_current_fy, invoice_count FROM spend""")

register("report_r13", lambda s: I.invoices_of_orders(s, PLAIN), f"""
    WITH {bills("'ITEM'", "gross")}
    SELECT invoice_id, invoice_num, about AS invoice_desc, po_distribution_id, created_by, {d('invoice_date')} AS invoice_date,
           cast(sum(if(own, amount, shown)) AS decimal(38,2)) AS invoice_amount
    FROM bill GROUP BY ALL""")


def _written(s: Source) -> DataFrame:
    """The report as its folder holds it after an older one was replaced."""
    path = f"{ensure_checkpoint_dir(s.spark)}/report-{uuid.uuid4().hex}"
    write_report(s.scan("ap_invoices_all", "invoice_id"), path)
    run_report(s.spark, lambda: I.invoices_of_orders(s, PLAIN), path)
    return s.spark.read.parquet(path)


narrowed("written_report", "report_r13", _written, "true")

# ---- contracts and orders ----

def contracts(either: bool) -> str:
    ids = "IN (l.line_id, l.id)" if either else "= l.line_id"
    return f"""
    owner AS (
      SELECT r.chr_id, r.major_version, p.party_name AS contract_owner
      FROM {{okc_contacts}} c JOIN {{okc_k_party_roles_vl}} r ON r.id = c.cpl_id
      JOIN {{hz_parties}} p ON p.party_id = c.object1_id1
      WHERE c.jtot_object1_code = 'OKX_RESOURCE' AND c.cro_code = 'CONTRACT_ADMIN' AND c.owner_yn = 'Y'),
    contract AS (
      SELECT h.contract_number, h.major_version AS contract_version, h.estimated_amount AS total_contract_value, h.start_date, h.end_date,
             h.attribute2 AS contract_type, h.attribute4 AS contract_group, x.purchasing_pk1_value AS pk1, x.purchasing_pk2_value AS pk2,
             x.po_doc_number AS doc, x.po_line_number AS doc_line, l.line_id, l.line_number AS contract_line_number,
             coalesce(l.line_amount, h.agreed_amount) AS contract_line_amount, contract_owner
      FROM {{okc_dts_deliverables_b}} x JOIN {{okc_k_headers_all_b}} h ON h.id = x.chr_id AND h.version_type = 'C'
      LEFT JOIN {{okc_k_lines_b}} l ON l.chr_id = h.id AND l.major_version = h.major_version AND x.cle_id {ids}
      LEFT JOIN owner o ON o.chr_id = h.id AND o.major_version = h.major_version
      WHERE x.deliverable_status = 'COMPLETED')"""


def buys(category: str | None) -> str:
    act = f"AND v.value_category = '{category}'" if category else ""
    return f"""
    buy AS (
      SELECT h.po_header_id, h.segment1 AS po, h.document_status, h.creation_date, h.closed_date, trim(h.comments) AS about, h.currency_code,
             l.* EXCLUDE (po_header_id), k.* EXCLUDE (po_header_id, po_line_id), q.po_distribution_id, q.deliver_to_person_id,
             nullif(k.assessable_value, 0) AS ordered, if(coalesce(k.assessable_value, 0) > 1, 'True', 'False') AS po_value,
             s.segment1 AS supplier_num, p.party_name AS supplier_name, p.party_number, u.name AS unit,
             g.segment1 AS s1, g.segment2 AS s2, g.segment3 AS s3, g.segment4 AS s4, g.segment5 AS s5,
             concat(g.segment1, '-', g.segment2, '-', g.segment3, '-', g.segment4, '-', g.segment5) AS cost_codes, v.description AS activity_name,
             e.category_code
      FROM {{po_line_locations_all}} k JOIN {{po_distributions_all}} q USING (po_header_id, po_line_id, line_location_id)
      JOIN {{po_lines_all}} l USING (po_header_id, po_line_id) JOIN {{po_headers_all}} h USING (po_header_id)
      JOIN {{poz_suppliers}} s ON s.vendor_id = h.vendor_id JOIN {{hz_parties}} p ON p.party_id = s.party_id
      JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.prc_bu_id
      JOIN {{gl_code_combinations}} g ON g.code_combination_id = q.code_combination_id
      JOIN {{fnd_flex_values_vl}} v ON v.flex_value = g.segment4 {act}
      JOIN {{egp_categories_b}} e ON e.category_id = l.category_id),
    asker AS (
      SELECT person_id AS deliver_to_person_id, display_name AS requestor_name FROM {{per_person_names_f}}
      WHERE name_type = 'GLOBAL' AND date '1998-03-01' BETWEEN effective_start_date AND effective_end_date)"""


# order lines with their contracts, joined by the plain OR condition
PAIRS = """
    pair AS (
      SELECT po_line_id, c.* FROM (SELECT DISTINCT po_line_id, from_header_id, from_line_id, contract_id, po, line_num FROM buy) b
      JOIN contract c ON (c.pk1 = b.from_header_id AND c.pk2 = b.from_line_id) OR c.pk1 = b.contract_id
        OR (c.doc = b.po AND c.doc_line = b.line_num))"""

_CONTRACT_OUT = f"""contract_number AS contracts_num, contract_line_number, contract_line_amount, contract_group, contract_owner,
           {d('start_date')} AS contract_start_date, {d('end_date')} AS contract_end_date"""

register("report_r10", lambda s: O.contractor_orders(s, Params(
    as_at=AT, date_from=dt.date(1996, 1, 1), chosen={"inv_date_to": dt.date(2000, 12, 31)})), f"""
    WITH {bills("'ITEM'", "gross")}, {buys(None)}, {contracts(True)}, {PAIRS},
    spend AS (SELECT po_distribution_id, sum(if(own, amount, shown)) AS spent FROM bill WHERE gl_date <= date '2000-12-31' GROUP BY ALL)
    SELECT po AS purchase_order_number, po_header_id, line_num AS po_line_number, category_code, {sentence('document_status')} AS postatus,
           {sentence('line_status')} AS po_line_status, assessable_value AS po_ordered_amount,
           if(tax_exclusive_price <> 1 AND uom_code <> 'ea', quantity, NULL) AS quantity,
           if(tax_exclusive_price <> 1 AND uom_code <> 'ea', uom_code, NULL) AS uom_code,
           if(tax_exclusive_price <> 1 AND uom_code <> 'ea', tax_exclusive_price, NULL) AS price, receipt_required_flag,
           s1 AS entity, s2 AS cost_centre, s3 AS natural_account, s4 AS activity, s5 AS future, activity_name, unit AS businessunit,
           supplier_name, supplier_num, {d('creation_date')} AS po_creation_date, {d('closed_date')} AS po_closed_date,
           {d('need_by_date')} AS po_need_by_date, about AS po_description, item_description, requestor_name, po_distribution_id,
           cast(coalesce(spent, 0) AS decimal(38,2)) AS po_spend, {_CONTRACT_OUT}
    FROM buy JOIN asker USING (deliver_to_person_id) LEFT JOIN spend USING (po_distribution_id) LEFT JOIN pair USING (po_line_id)
    WHERE category_code LIKE 'AOG%' AND assessable_value <> 0 AND creation_date BETWEEN date '1996-01-01' AND date '2100-01-01'""", written=LINES)


def _detail(extra: str, lines: str, where: str, either: bool) -> str:
    return f"""
    WITH {bills("'ITEM'", "gross")}, {SPEND}, {buys('ORG_ACTIVITY')}, {contracts(either)}, {PAIRS}
    SELECT po AS purchase_order_number, po_header_id, line_num AS po_line_number, {extra} category_code AS categorycode,
           {sentence('document_status')} AS po_status, {sentence('line_status')} AS po_line_status, ordered AS po_ordered_amount,
           quantity_accepted, receipt_required_flag, po_value AS purchase_order_value, cost_codes, activity_name, unit AS business_unit,
           supplier_name, supplier_num, {d('creation_date')} AS creation_date, about AS po_description, requestor_name, {_CONTRACT_OUT},
           po_distribution_id, total_po_spend AS po_amount_spent,
           cast(ordered - coalesce(total_po_spend, 0) AS decimal(38,2)) AS po_amount_left, coalesce(invoice_count, 0) AS invoice_count,
           average AS po_avg_invoice_amt,
           cast(floor(cast(ordered - total_po_spend AS double) / nullif(average, 0)) AS bigint) AS invoices_remaining,
           3 AS months_left_in_financial_year
    FROM buy JOIN asker USING (deliver_to_person_id) LEFT JOIN spend USING (po_distribution_id) LEFT JOIN pair USING (po_line_id) {lines}
    {where}"""


register("report_r12", lambda s: O.order_detail(s, PLAIN), _detail(
    "po_total_lines, po_line_id,",
    "LEFT JOIN (SELECT po_header_id, count(*) AS po_total_lines FROM {po_lines_all} GROUP BY 1) USING (po_header_id)", "", False), written=LINES)

register("report_r22", lambda s: O.order_risk(s, Params(as_at=AT, chosen={"documentstatus": ["OPEN", "CLOSED"]})), _detail(
    "", "", "WHERE s2 = '427' AND unit = 'Crown' AND po_value = 'True' AND document_status IN ('OPEN', 'CLOSED')", True), written=LINES)

register("report_r23", lambda s: O.orders_with_contracts(s, Params(
    as_at=AT, date_to=dt.date(2000, 1, 31), chosen={"po_value": "True", "business_unit": ["Crown", "Departmental", "EUROPE"]})), f"""
    WITH {bills("'ITEM'", "gross")}, {buys('ORG_ACTIVITY')}, {contracts(True)}, {PAIRS},
    last AS (SELECT po_distribution_id, {d('max(invoice_date)')} AS latest_inv_date, {d('max(made)')} AS latest_inv_creation_date
             FROM bill GROUP BY po_distribution_id)
    SELECT po AS ponumber, po_header_id, line_num AS po_line_number, category_id, from_header_id, from_line_id, contract_id,
           item_description AS line_description, {sentence('document_status')} AS document_status, {sentence('line_status')} AS po_line_status,
           currency_code, ordered AS assessable_value, coalesce(nullif(amount_received, 0), nullif(quantity_received, 0)) AS quantity_received,
           quantity_accepted, quantity_rejected, coalesce(nullif(amount_billed, 0), nullif(quantity_billed, 0)) AS quantity_billed,
           quantity_cancelled, receipt_required_flag, po_value AS povalue, input_tax_classification_code, po_distribution_id, cost_codes,
           activity_name AS description, requestor_name AS full_name, unit AS businessunit, supplier_name, party_number, supplier_num,
           {d('creation_date')} AS creation_date, upper(strftime(creation_date, '%B-%y')) AS po_start_period,
           {d('need_by_date')} AS po_need_by_date, about AS comments, contract_number, contract_version, total_contract_value,
           {d('start_date')} AS contract_start_date, {d('end_date')} AS contract_end_date,
           upper(strftime(start_date, '%B-%y')) AS contract_start_period, contract_type AS contracttype, contract_group, contract_owner,
           line_id, contract_line_number AS con_line_number, contract_line_amount AS con_line_amount, latest_inv_date, latest_inv_creation_date
    FROM buy JOIN asker USING (deliver_to_person_id) LEFT JOIN last USING (po_distribution_id) LEFT JOIN pair USING (po_line_id)
    WHERE po_value = 'True' AND unit IN ('Crown', 'Departmental', 'EUROPE') AND creation_date BETWEEN date '1900-01-01' AND date '2000-01-31'""", written=LINES)

narrowed("report_r10_narrowed", "report_r10", lambda s: O.contractor_orders(s, Params(
    as_at=AT, date_from=dt.date(1996, 6, 1), date_to=dt.date(1998, 2, 28), chosen={
        "inv_date_to": dt.date(2000, 12, 31), "business_unit": ["Crown", "EUROPE"], "categorycode": ["AOG - Contractors", "AOG_-_Consultancy"], "po_status": ["OPEN", "CLOSED"]})),
    """businessunit IN ('Crown', 'EUROPE') AND category_code IN ('AOG - Contractors', 'AOG_-_Consultancy') AND lower(postatus) IN ('open', 'closed')
       AND strptime(po_creation_date, '%d-%m-%Y') BETWEEN date '1996-06-01' AND date '1998-02-28'""", written=LINES)
narrowed("report_r12_narrowed", "report_r12", lambda s: O.order_detail(s, Params(as_at=AT, chosen={"po_line_num": [1, 3]})), "po_line_number IN (1, 3)", written=LINES)
narrowed("report_r23_narrowed", "report_r23", lambda s: O.orders_with_contracts(s, Params(
    as_at=AT, date_from=dt.date(1995, 1, 1), date_to=dt.date(1999, 12, 31), chosen={
        "po_value": "True", "business_unit": ["Crown", "Departmental", "EUROPE"], "documentstatus": ["OPEN"], "period_name": ["March-96", "April-96", "May-97"]})),
    "document_status = 'Open' AND po_start_period IN ('MARCH-96', 'APRIL-96', 'MAY-97')", written=LINES)

register("report_r17", lambda s: O.invoices_by_order(s, Params(as_at=AT, chosen={"costcentre": ["427", "115", "901"]})), f"""
    WITH {bills("'ITEM'", "gross")}, {buys('ORG_ACTIVITY')}
    SELECT po AS purchase_order_number, po_header_id, line_num AS po_line_number, category_code AS categorycode,
           {sentence('document_status')} AS document_status, {sentence('line_status')} AS po_line_status, ordered AS assessable_value,
           quantity_accepted, receipt_required_flag, po_value AS purchase_order_value, cost_codes, activity_name AS description,
           unit AS business_unit, supplier_name, party_number, supplier_num, {d('creation_date')} AS creation_date,
           buy.about AS po_description, po_distribution_id, invoice_id, if(own, line_number, NULL) AS invoice_line_number,
           period_name AS period, invoice_num, shown AS invoice_amount, if(own, amount, NULL) AS invoice_line_amount,
           {d('invoice_date')} AS invoice_date, {d('gl_date')} AS gl_date, upper(strftime(gl_date, '%B-%y')) AS gl_date_period, {FY} AS fy,
           {d('made')} AS invoice_creation_date, {d('line_made')} AS invoice_line_creation_date, bill.about AS invoice_desc,
           paid AS payment_status_flag, line_about AS invoice_line_description
    FROM buy JOIN bill USING (po_distribution_id) WHERE s2 IN ('427', '115', '901')""", written=LINES)


def _holds(how: str) -> str:
    return f"""
    WITH person AS (SELECT * FROM {{per_person_names_f}} WHERE name_type = 'GLOBAL'
                    AND effective_start_date <= date '1998-03-01' AND effective_end_date >= date '1998-03-01')
    SELECT {d('h.invoice_date')} AS invoice_date, h.invoice_id, h.invoice_num, h.invoice_amount, h.description AS invoice_description,
           {login('h.created_by')} AS created_by, x.hold_lookup_code, x.hold_reason, c.description AS lookup_description, c.displayed_field,
           x.line_location_id, p.party_name AS supplier_name, s.segment1 AS supplier_num, u.name AS business_unit, z.note_txt AS note,
           o.segment1, l.line_num, person.display_name AS requestor_name
    FROM {{ap_holds_all}} x JOIN {{ap_invoices_all}} h USING (invoice_id)
    JOIN {{ap_lookup_codes}} c ON c.lookup_code = x.hold_lookup_code AND c.lookup_type = 'HOLD CODE'
    JOIN {{poz_suppliers}} s USING (vendor_id) JOIN {{hz_parties}} p ON p.party_id = s.party_id
    JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.org_id
    {how} JOIN {{po_line_locations}} k USING (line_location_id) {how} JOIN {{po_lines_all}} l USING (po_header_id, po_line_id)
    {how} JOIN {{po_distributions_all}} q USING (po_header_id, po_line_id, line_location_id)
    {how} JOIN person ON person.person_id = q.deliver_to_person_id
    LEFT JOIN {{po_headers_all}} o USING (po_header_id) LEFT JOIN {{zmm_notes}} z ON z.source_object_uid = h.invoice_id
    WHERE x.release_lookup_code IS NULL AND h.invoice_amount <> 0"""


register("report_r18", lambda s: I.open_holds(s, PLAIN), _holds(""))
register("report_r18_all_holds", lambda s: I.open_holds(s, PLAIN, keep_unmatched=True), _holds("LEFT"))

register("report_r09", lambda s: I.buyer_created_invoices(s, PLAIN), f"""
    WITH bank AS (
      SELECT y.supplier_site_id, w.account_owner_party_id, w.ext_bank_account_id,
             concat(b.bank_number, '-', b.branch_number, '-', a.bank_account_num, '-', a.account_suffix) AS bank_account_number
      FROM {{iby_external_payees_all}} y JOIN {{iby_pmt_instr_uses_all}} t ON t.ext_pmt_party_id = y.ext_payee_id
      JOIN {{iby_account_owners}} w ON w.account_owner_party_id = y.payee_party_id AND w.ext_bank_account_id = t.instrument_id
      LEFT JOIN {{iby_ext_bank_accounts}} a USING (ext_bank_account_id) LEFT JOIN {{ce_bank_branches_v}} b ON b.branch_party_id = a.branch_id
      WHERE y.payment_function = 'PAYABLES_DISB' AND t.instrument_type = 'BANKACCOUNT')
    SELECT h.invoice_id, l.period_name, h.invoice_num, h.invoice_amount, {d('h.invoice_date')} AS invoice_date, h.created_by,
           {d('h.creation_date')} AS invoice_creation_date, {d('h.gl_date')} AS gl_date, {d('l.creation_date')} AS invoice_line_creation_date,
           h.description AS invoice_desc, h.payment_status_flag, l.description AS invoice_line_description, l.created_by AS line_created_by,
           l.last_updated_by AS line_last_updated_by, l.line_type_lookup_code, if(l.line_type_lookup_code = 'TAX', 'GST', NULL) AS line_code,
           l.amount AS invoice_line_amount, l.line_number, u.name AS business_unit, s.segment1 AS supplier_num, p.party_name AS supplier_name,
           ps.party_site_name AS supplier_address, r.tax_regime_code,
           regexp_replace(r.registration_number, '^(...)(...)(...).*$', '\\1-\\2-\\3') AS supplier_gst, r.effective_from,
           CASE u.name WHEN 'Crown' THEN '000-000-001' WHEN 'Departmental' THEN '000-000-002' END AS buyer_gst,
           'Buying Organisation' AS buyer_name, 'PO Box 1' AS buyer_address, e.remit_advice_email, x.po_distribution_id,
           if(q.po_header_id IS NULL, NULL, 'PO' || q.po_header_id) AS purchase_order_number, p.party_id, ps.party_site_id, bank_account_number
    FROM {{ap_invoices_all}} h JOIN {{ap_invoice_lines_all}} l USING (invoice_id)
    JOIN {{ap_invoice_distributions_all}} x ON (x.invoice_id, x.invoice_line_number) = (l.invoice_id, l.line_number)
    JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.org_id JOIN {{poz_suppliers}} s USING (vendor_id)
    JOIN {{hz_parties}} p ON p.party_id = s.party_id JOIN {{hz_party_sites}} ps ON ps.party_id = p.party_id
    JOIN {{zx_party_tax_profile}} z ON z.party_id = p.party_id JOIN {{zx_registrations}} r USING (party_tax_profile_id)
    JOIN {{iby_external_payees_all}} e ON e.payee_party_id = p.party_id AND e.party_site_id = ps.party_site_id
         AND e.supplier_site_id = h.vendor_site_id AND e.remit_advice_email IS NOT NULL
    JOIN bank ON bank.supplier_site_id = h.vendor_site_id AND bank.account_owner_party_id = h.party_id
         AND bank.ext_bank_account_id = h.external_bank_account_id
    LEFT JOIN {{po_distributions_all}} q ON q.po_distribution_id = x.po_distribution_id
    WHERE h.approval_status = 'APPROVED' AND l.line_type_lookup_code IN ('ITEM', 'TAX') AND s.vendor_type_lookup_code = 'BCI_SUPPLIER'
      AND coalesce(l.discarded_flag, 'N') = 'N' AND coalesce(x.reversal_flag, 'N') = 'N' AND r.registration_number IS NOT NULL
      AND r.effective_to IS NULL AND 0 NOT IN (h.invoice_amount, l.amount, x.amount)""")
