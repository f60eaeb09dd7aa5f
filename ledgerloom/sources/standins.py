"""Stand-in report tables derived from the test tables.

Each entry is a SELECT that both Spark SQL and DuckDB accept, so a report and its
oracle start from the same rows.  ``{name}`` stands for a test table or for another
entry of this module.  Row counts follow the test tables and every source row takes part;
conditions on keys only give rows their variety (a second version, a leaver, a missing value).
"""

from __future__ import annotations

import re

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FOREVER = "date '4712-12-31'"

STANDINS: dict[str, str] = {}


def _add(name: str, sql: str) -> None:
    STANDINS[name] = " ".join(sql.split())


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


# ---- keyed building blocks -------------------------------------------------------

# lineitem repeats (l_orderkey, l_linenumber): fold it so that the pair is a key.
_add("li", """
    SELECT l_orderkey, l_linenumber,
           cast(sum(cast(l_extendedprice AS decimal(18,2))) AS decimal(18,2)) AS price,
           max(l_tax) AS tax, min(l_suppkey) AS supp, min(l_partkey) AS part,
           min(cast(l_shipdate AS date)) AS ship,
           CASE max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) WHEN 1 THEN 'A' WHEN 2 THEN 'N' ELSE 'R' END AS rf,
           cast(sum(l_quantity) AS bigint) AS qty,
           l_orderkey * 10 + l_linenumber AS line_id,
           CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey
                ELSE -1 - cast(floor(l_orderkey / 16) AS bigint) END AS invoice_id,
           cast(CASE WHEN l_orderkey % 2 = 0 THEN l_linenumber
                     ELSE (l_orderkey % 16) * 10 + l_linenumber END AS int) AS inv_line
    FROM {lineitem} GROUP BY l_orderkey, l_linenumber""")

_add("li_tax", """
    SELECT *, CASE WHEN tax <= 0.011 THEN cast(0 AS decimal(18,2))
                   ELSE cast(price * cast(tax AS decimal(4,2)) AS decimal(18,2)) END AS tax_amount
    FROM {li}""")

_add("inv", """
    SELECT invoice_id, min(l_orderkey) AS lead_order,
           cast(sum(price + tax_amount) AS decimal(18,2)) AS gross,
           cast(sum(tax_amount) AS decimal(18,2)) AS tax_amount, min(supp) AS supp, min(part) AS part
    FROM {li_tax} GROUP BY invoice_id""")

_LOGIN = """CASE WHEN {k} % 5 = 0 THEN 'Batch.Scheduler'
                 ELSE 'ANNA' || cast({k} % 7 AS string) || '.o''neil' || cast({k} % 11 AS string) || '@corp.org' END"""


def _login(key: str) -> str:
    return _LOGIN.replace("{k}", key)


# ---- payables and suppliers ------------------------------------------------------

_add("ap_invoices_all", f"""
    SELECT i.invoice_id, 'INV' || cast(i.invoice_id AS string) AS invoice_num,
           i.gross AS invoice_amount, i.tax_amount AS total_tax_amount, 'NZD' AS invoice_currency_code,
           cast(o.o_orderdate AS date) AS invoice_date,
           cast(o.o_orderdate AS date) + cast(i.lead_order % 40 AS int) AS gl_date,
           o.o_orderdate AS creation_date, {_login("i.lead_order")} AS created_by,
           'Bill for ' || o.o_orderpriority AS description,
           CASE WHEN o.o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS payment_status_flag,
           CASE WHEN i.lead_order % 23 = 0 THEN 'NEEDS REAPPROVAL' ELSE 'APPROVED' END AS approval_status,
           CASE WHEN i.lead_order % 10 = 4 THEN 'EMP_EXPENSE_REPORT' ELSE 'MANUAL' END AS source,
           CASE WHEN i.lead_order % 29 = 0 THEN NULL ELSE i.supp END AS vendor_id,
           i.supp AS vendor_site_id, i.supp + 500000 AS external_bank_account_id,
           CASE WHEN i.lead_order % 10 = 4 THEN -1 - o.o_custkey ELSE i.supp END AS party_id,
           o.o_custkey % 5 AS org_id, i.part AS accts_pay_code_combination_id
    FROM {{inv}} i JOIN {{orders}} o ON o.o_orderkey = i.lead_order""")

_add("ap_invoice_lines_all", f"""
    SELECT invoice_id, inv_line AS line_number, price AS amount,
           CASE WHEN tax < 0.005 THEN 'GST ZERO' WHEN tax < 0.015 THEN 'GST EXEMPT'
                WHEN tax < 0.025 THEN NULL ELSE 'GST 15' END AS tax_classification_code,
           CASE WHEN l_linenumber = 6 THEN 'MISCELLANEOUS' WHEN l_linenumber = 7 THEN 'TAX'
                ELSE 'ITEM' END AS line_type_lookup_code,
           CASE WHEN line_id % 17 = 0 THEN 'Y' WHEN line_id % 17 = 1 THEN NULL ELSE 'N' END AS discarded_flag,
           {_login("l_orderkey")} AS created_by, {_login("line_id")} AS last_updated_by,
           cast(ship AS timestamp) AS creation_date, 'Part ' || cast(part AS string) AS description,
           cast(year(ship) AS string) || '-' || cast(month(ship) AS string) AS period_name,
           line_id AS po_line_id
    FROM {{li}}""")

_add("ap_invoice_distributions_all", """
    SELECT invoice_id, inv_line AS invoice_line_number, line_id AS invoice_distribution_id,
           1 AS distribution_line_number, price AS amount,
           CASE WHEN line_id % 13 = 0 THEN NULL ELSE line_id END AS po_distribution_id,
           CASE WHEN l_linenumber = 6 THEN 'MISCELLANEOUS' WHEN l_linenumber = 7 THEN 'TAX'
                ELSE 'ITEM' END AS line_type_lookup_code,
           CASE WHEN line_id % 19 = 0 THEN 'Y' WHEN line_id % 19 = 1 THEN NULL ELSE 'N' END AS reversal_flag
    FROM {li}""")

_add("ap_inv_aprvl_hist_all", """
    SELECT CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey
                ELSE -1 - cast(floor(l_orderkey / 16) AS bigint) END AS invoice_id,
           l_shipdate AS action_date,
           CASE WHEN l_orderkey % 9 = 2 THEN 'DOCUMENTREVIEW' ELSE 'DOCUMENTAPPROVAL' END AS history_type,
           CASE l_linenumber % 4 WHEN 0 THEN 'Batch.Scheduler' WHEN 1 THEN 'ORA_WORKFLOW SYSTEM'
                ELSE 'zoe' || cast(l_suppkey % 6 AS string) || '.WU@corp.org' END AS approver_id,
           CASE WHEN l_orderkey % 6 = 0 THEN 'ORA_AUTO APPROVED' WHEN l_returnflag = 'A' THEN 'APPROVED'
                WHEN l_returnflag = 'N' THEN 'MANUALLY APPROVED' ELSE 'REJECTED' END AS response
    FROM {lineitem}""")

_add("ap_holds_all", """
    SELECT invoice_id, 'H' || cast(l_linenumber AS string) AS hold_lookup_code,
           'Held: line ' || cast(l_linenumber AS string) AS hold_reason,
           CASE WHEN line_id % 5 = 0 THEN NULL ELSE line_id END AS line_location_id,
           CASE WHEN rf <> 'R' OR line_id % 3 = 0 THEN 'APPROVED' ELSE NULL END AS release_lookup_code
    FROM {li}""")

_add("ap_lookup_codes", """
    SELECT CASE WHEN n_nationkey = 3 THEN 'INCOMPLETE INVOICE' ELSE 'H' || cast(n_nationkey AS string) END AS lookup_code,
           CASE WHEN n_nationkey = 5 THEN 'OTHER' ELSE 'HOLD CODE' END AS lookup_type,
           'Hold ' || n_name AS displayed_field, 'About ' || n_name AS description
    FROM {nation}""")

_add("zmm_notes", """
    SELECT CASE WHEN lead_order % 4 < 2 THEN invoice_id ELSE 1000000000000 + lead_order END AS source_object_uid, 'Note ' || cast(lead_order AS string) AS note_txt
    FROM {inv}""")

_add("hz_parties", _union(
    """SELECT s_suppkey AS party_id, s_name AS party_name, 'P' || cast(s_suppkey AS string) AS party_number,
              'ORGANIZATION' AS party_type FROM {supplier}""",
    """SELECT -1 - c_custkey AS party_id, c_name AS party_name, 'C' || cast(c_custkey AS string) AS party_number,
              'PERSON' AS party_type FROM {customer}"""))

_add("poz_suppliers", """
    SELECT s_suppkey AS vendor_id, s_suppkey AS party_id, 'S' || cast(s_suppkey AS string) AS segment1,
           CASE WHEN s_suppkey % 3 = 0 THEN 'BCI_SUPPLIER' ELSE 'SUPPLIER' END AS vendor_type_lookup_code
    FROM {supplier}""")

_add("poz_suppliers_v", """
    SELECT s_suppkey AS vendor_id, s_name AS vendor_name, 'S' || cast(s_suppkey AS string) AS segment1
    FROM {supplier}""")

_add("hz_party_sites", """
    SELECT s_suppkey AS party_id, s_suppkey AS party_site_id, 'Site ' || s_name AS party_site_name FROM {supplier}""")
_add("zx_party_tax_profile", "SELECT s_suppkey AS party_id, s_suppkey AS party_tax_profile_id FROM {supplier}")
_add("zx_registrations", f"""
    SELECT s_suppkey AS party_tax_profile_id, 'NZ GST' AS tax_regime_code,
           CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE cast(100000000 + s_suppkey * 7 AS string) END AS registration_number,
           date '1995-01-01' AS effective_from,
           CASE WHEN s_suppkey % 6 = 3 THEN date '1999-12-31' ELSE NULL END AS effective_to
    FROM {{supplier}}""")
_add("iby_external_payees_all", """
    SELECT s_suppkey AS ext_payee_id, s_suppkey AS payee_party_id, s_suppkey AS party_site_id,
           s_suppkey AS supplier_site_id,
           CASE WHEN s_suppkey % 7 = 5 THEN 'CUSTOMER_REFUND' ELSE 'PAYABLES_DISB' END AS payment_function,
           CASE WHEN s_suppkey % 5 = 1 THEN NULL ELSE 'pay' || cast(s_suppkey AS string) || '@corp.org' END AS remit_advice_email
    FROM {supplier}""")
_add("iby_pmt_instr_uses_all", f"""
    SELECT s_suppkey AS ext_pmt_party_id, s_suppkey + 500000 AS instrument_id,
           CASE WHEN s_suppkey % 8 = 7 THEN 'CREDITCARD' ELSE 'BANKACCOUNT' END AS instrument_type,
           date '1990-01-01' AS start_date, {FOREVER} AS end_date
    FROM {{supplier}}""")
_add("iby_account_owners", """
    SELECT s_suppkey + 500000 AS ext_bank_account_id, s_suppkey AS account_owner_party_id FROM {supplier}""")
_add("iby_ext_bank_accounts", """
    SELECT s_suppkey + CASE WHEN s_suppkey % 9 = 4 THEN 900000000000 ELSE 500000 END AS ext_bank_account_id, cast(7000000 + s_suppkey AS string) AS bank_account_num,
           CASE WHEN s_suppkey % 4 = 2 THEN NULL ELSE '00' END AS account_suffix,
           cast(s_nationkey AS bigint) AS branch_id
    FROM {supplier}""")
_add("ce_bank_branches_v", """
    SELECT cast(n_nationkey AS bigint) AS branch_party_id, '0' || cast(n_regionkey AS string) AS bank_number,
           cast(100 + n_nationkey AS string) AS branch_number, 'Bank ' || n_name AS bank_name,
           'Branch ' || n_name AS bank_branch_name
    FROM {nation}""")
_add("hr_organization_units_f_tl", """
    SELECT cast(r_regionkey AS bigint) AS organization_id,
           CASE r_regionkey WHEN 0 THEN 'Crown' WHEN 1 THEN 'Departmental' ELSE r_name END AS name
    FROM {region}""")

# ---- purchasing ------------------------------------------------------------------

_add("po_headers_all", """
    SELECT o_orderkey AS po_header_id, 'PO' || cast(o_orderkey AS string) AS segment1,
           o_custkey % 5 AS prc_bu_id, cast(floor(o_custkey / 15) AS bigint) AS vendor_id,
           CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'PENDING APPROVAL' END AS document_status,
           'NZD' AS currency_code, '  ' || o_orderpriority || ' buy ' AS comments,
           o_orderdate AS creation_date,
           CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS date) + 30 ELSE NULL END AS closed_date
    FROM {orders}""")

_add("po_lines_all", """
    SELECT line_id AS po_line_id, l_orderkey AS po_header_id, l_linenumber AS line_num,
           CASE rf WHEN 'A' THEN 'CLOSED FOR RECEIVING' WHEN 'N' THEN 'OPEN' ELSE NULL END AS line_status,
           part % 6 AS category_id, 'Item ' || cast(part AS string) AS item_description,
           CASE WHEN part % 4 = 0 THEN part ELSE NULL END AS contract_id,
           CASE WHEN part % 4 = 1 OR part % 8 = 4 THEN part ELSE NULL END AS from_header_id,
           CASE WHEN part % 4 = 1 OR part % 8 = 4 THEN part % 8 ELSE NULL END AS from_line_id
    FROM {li}""")

_add("po_line_locations_all", """
    SELECT line_id AS line_location_id, line_id AS po_line_id, l_orderkey AS po_header_id,
           CASE WHEN line_id % 21 = 0 THEN cast(0 AS decimal(18,2)) WHEN line_id % 21 = 1 THEN cast(0.5 AS decimal(18,2))
                WHEN line_id % 21 = 2 THEN NULL ELSE price END AS assessable_value,
           CASE WHEN line_id % 3 = 0 THEN cast(0 AS decimal(18,2)) WHEN line_id % 3 = 1 THEN NULL ELSE price END AS amount_received,
           CASE WHEN line_id % 4 = 0 THEN cast(0 AS decimal(18,2)) WHEN line_id % 4 = 1 THEN NULL ELSE price END AS amount_billed,
           cast(qty AS decimal(18,2)) AS quantity, cast(qty AS decimal(18,2)) AS quantity_accepted,
           cast(qty % 2 AS decimal(18,2)) AS quantity_received, cast(qty % 3 AS decimal(18,2)) AS quantity_billed,
           cast(0 AS decimal(18,2)) AS quantity_rejected, cast(0 AS decimal(18,2)) AS quantity_cancelled,
           CASE WHEN line_id % 6 = 0 THEN cast(1 AS decimal(18,2)) ELSE cast(price * cast(0.25 AS decimal(3,2)) AS decimal(18,2)) END AS tax_exclusive_price,
           CASE WHEN line_id % 5 = 0 THEN 'ea' WHEN line_id % 5 = 1 THEN NULL ELSE 'hr' END AS uom_code,
           'GST 15' AS input_tax_classification_code,
           CASE WHEN line_id % 2 = 0 THEN 'Y' ELSE 'N' END AS receipt_required_flag, ship AS need_by_date
    FROM {li}""")
_add("po_line_locations", "SELECT line_location_id, po_line_id, po_header_id FROM {po_line_locations_all}")
_add("po_distributions_all", """
    SELECT line_id AS po_distribution_id, line_id AS po_line_id, line_id AS line_location_id,
           l_orderkey AS po_header_id, part AS code_combination_id, supp AS deliver_to_person_id
    FROM {li}""")
_add("egp_categories_b", """
    SELECT cast(n_nationkey AS bigint) AS category_id,
           CASE n_nationkey WHEN 0 THEN 'AOG - Contractors' WHEN 1 THEN 'AOG - Other Professional Services'
                WHEN 2 THEN 'AOG_-_Consultancy' ELSE 'CAT ' || n_name END AS category_code
    FROM {nation}""")
_add("gl_code_combinations", """
    SELECT p_partkey AS code_combination_id, 1 AS chart_of_accounts_id, cast(1 + p_partkey % 2 AS string) AS segment1,
           CASE p_partkey % 5 WHEN 0 THEN '427' WHEN 1 THEN '115' WHEN 2 THEN '901' WHEN 3 THEN '601' ELSE '000' END AS segment2,
           cast(10000 * (1 + p_partkey % 4) + p_partkey % 97 AS string) AS segment3,
           'A' || cast(p_partkey % 12 AS string) AS segment4,
           CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE '000' END AS segment5
    FROM {part}""")
_add("fnd_flex_values_vl", _union(
    """SELECT 'A' || cast(n_nationkey AS string) AS flex_value, 'Activity ' || n_name AS description,
              CASE WHEN n_nationkey = 7 THEN 'ORG_PROJECT' WHEN n_nationkey > 8 THEN 'ALT_ACTIVITY' ELSE 'ORG_ACTIVITY' END AS value_category FROM {nation}
       WHERE n_nationkey < 11""",
    """SELECT 'R' || cast(r_regionkey AS string),
              CASE WHEN r_regionkey = 4 THEN 'Historical Cost Centres' ELSE 'Division ' || r_name END,
              'ORG_COST_CENTER' FROM {region}""",
    "SELECT 'G' || cast(n_nationkey AS string), 'Group ' || n_name, 'ORG_COST_CENTER' FROM {nation}",
    "SELECT 'CC' || cast(n_nationkey AS string), 'Centre ' || n_name, 'ORG_COST_CENTER' FROM {nation}"))

# contracts: one header per part, its deliverables, lines and owner
_add("okc_k_headers_all_b", """
    SELECT p_partkey AS id, 'C' || cast(p_partkey AS string) AS contract_number, p_size % 3 AS major_version,
           CASE WHEN p_size % 5 = 4 THEN 'H' ELSE 'C' END AS version_type,
           date '1996-01-15' + cast(p_partkey % 1500 AS int) AS start_date,
           date '1998-01-15' + cast(p_partkey % 1500 AS int) AS end_date,
           cast(p_retailprice * 100 AS decimal(18,2)) AS agreed_amount,
           cast(p_retailprice * 120 AS decimal(18,2)) AS estimated_amount,
           p_type AS attribute2, p_brand AS attribute4
    FROM {part}""")
_add("okc_dts_deliverables_b", """
    SELECT p_partkey AS chr_id, p_partkey * 10 + p_partkey % 2 AS cle_id,
           CASE p_size % 7 WHEN 0 THEN 'CANCELED' WHEN 1 THEN 'INCOMPLETE' ELSE 'COMPLETED' END AS deliverable_status,
           CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE p_partkey END AS purchasing_pk1_value,
           CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE p_partkey % 8 END AS purchasing_pk2_value,
           CASE WHEN p_partkey % 3 = 2 OR p_partkey % 5 = 0 THEN 'PO' || cast(p_partkey * 7 AS string) ELSE NULL END AS po_doc_number,
           CASE WHEN p_partkey % 3 = 2 OR p_partkey % 5 = 0 THEN cast(1 + p_partkey % 4 AS int) ELSE NULL END AS po_line_number
    FROM {part}""")
_add("okc_k_lines_b", _union(
    """SELECT p_partkey AS chr_id, p_partkey * 10 AS id, p_partkey * 10 + p_size % 2 AS line_id, 1 AS line_number,
              p_size % 3 AS major_version, CASE WHEN p_size % 4 = 1 THEN NULL ELSE cast(p_retailprice * 10 AS decimal(18,2)) END AS line_amount,
              p_partkey % 6 AS purchasing_category_id FROM {part}""",
    """SELECT p_partkey, p_partkey * 10 + 1, p_partkey * 10 + 7, 2, p_size % 3,
              cast(p_retailprice AS decimal(18,2)), p_partkey % 5 FROM {part} WHERE p_size % 4 = 0"""))
_add("okc_k_party_roles_vl", "SELECT p_partkey AS id, p_partkey AS chr_id, p_size % 3 AS major_version FROM {part}")
_add("okc_contacts", """
    SELECT p_partkey AS cpl_id, CASE WHEN p_partkey % 9 = 0 THEN 'SIGNATORY' ELSE 'CONTRACT_ADMIN' END AS cro_code,
           CASE WHEN p_partkey % 4 = 3 THEN 'N' ELSE 'Y' END AS owner_yn,
           CASE WHEN p_partkey % 10 = 0 THEN 'OKX_OPERUNIT' ELSE 'OKX_RESOURCE' END AS jtot_object1_code,
           cast(floor(p_partkey / 20) AS bigint) AS object1_id1
    FROM {part}""")

# document versions and their archive rows: 1 to 4 versions per order
_N_VER = "1 + o_orderkey % 4"
_add("po_versions", _union(*(
    f"""SELECT o_orderkey * 10 + {k} AS version_id, o_orderkey AS po_header_id, {k} AS co_sequence,
               {'cast(NULL AS int)' if k == 0 else k} AS co_num,
               'Change {k} of ' || o_orderpriority AS change_order_desc, o_orderdate AS creation_date,
               cast(o_orderdate AS date) + {k * 9} AS document_date, o_custkey AS originator_id,
               CASE WHEN o_orderkey % 7 = {k} THEN 'SYSTEM' ELSE 'BUYER' END AS originator_role
        FROM {{orders}} WHERE o_orderkey % 4 >= {k}""" for k in range(4))))
_HDR = """SELECT o_orderkey AS po_header_id, 'PO' || cast(o_orderkey AS string) AS segment1,
              CASE WHEN o_orderkey % 8 = 0 THEN 'AGREEMENT' ELSE 'STANDARD' END AS type_lookup_code,
              ' ' || o_orderpriority || ' ' AS comments, o_custkey % 5 AS prc_bu_id,
              cast(floor(o_custkey / 15) AS bigint) AS vendor_id, """
_add("po_headers_archive_all", _union(
    _HDR + """'N' AS cancel_flag, 'I' AS entity_change_type_code, 0 AS from_co_seq,
              CASE WHEN o_orderkey % 4 >= 2 THEN 2 ELSE 9999999 END AS to_co_seq FROM {orders}""",
    _HDR + """CASE WHEN o_orderkey % 31 = 0 THEN 'Y' ELSE 'N' END, CASE WHEN o_orderkey % 3 = 0 THEN 'C' ELSE 'U' END,
              2, 9999999 FROM {orders} WHERE o_orderkey % 4 >= 2"""))
_LIN = """SELECT line_id AS po_line_id, l_orderkey AS po_header_id, l_linenumber AS line_num, part % 6 AS category_id,
              'Item ' || cast(part AS string) AS item_description, cast(NULL AS string) AS item_revision,
              'V' || cast(supp AS string) AS vendor_product_num, cast(l_linenumber % 3 AS bigint) AS line_type_id,
              cast(qty AS decimal(18,2)) AS shipping_uom_quantity, cast(qty AS decimal(18,2)) AS base_qty,
              'ea' AS base_uom, 'hr' AS uom_code, cast(price * cast(0.1 AS decimal(2,1)) AS decimal(18,2)) AS unit_price, """
_add("po_lines_archive_all", _union(
    _LIN + """'N' AS cancel_flag, 'I' AS entity_change_type_code, CASE WHEN l_linenumber % 5 = 4 THEN 1 ELSE 0 END AS from_co_seq,
              CASE WHEN l_linenumber % 5 = 1 THEN 1 ELSE 9999999 END AS to_co_seq FROM {li}""",
    _LIN + """CASE WHEN line_id % 37 = 0 THEN 'Y' ELSE 'N' END, CASE WHEN line_id % 2 = 0 THEN 'C' ELSE 'U' END,
              1, 9999999 FROM {li} WHERE l_linenumber % 5 = 1"""))
_add("po_line_locations_archive_all", _union(
    """SELECT line_id AS line_location_id, line_id AS po_line_id, l_orderkey AS po_header_id, price AS assessable_value,
              0 AS from_co_seq, CASE WHEN l_linenumber % 3 = 2 THEN 2 ELSE 9999999 END AS to_co_seq FROM {li}""",
    """SELECT line_id, line_id, l_orderkey, cast(price + 100 AS decimal(18,2)), 2, 9999999 FROM {li} WHERE l_linenumber % 3 = 2"""))
_add("po_distributions_archive_all", _union(
    """SELECT line_id AS line_location_id, line_id AS po_line_id, l_orderkey AS po_header_id, part AS code_combination_id,
              supp AS deliver_to_person_id, 0 AS from_co_seq,
              CASE WHEN l_linenumber % 4 = 3 THEN 3 ELSE 9999999 END AS to_co_seq FROM {li}""",
    """SELECT line_id, line_id, l_orderkey, part, supp, 3, 9999999 FROM {li} WHERE l_linenumber % 4 = 3"""))
_add("po_line_types_vl", """
    SELECT cast(r_regionkey AS bigint) AS line_type_id, CASE r_regionkey WHEN 0 THEN 'Goods' WHEN 1 THEN 'Rate' ELSE 'Fixed' END AS line_type
    FROM {region} WHERE r_regionkey < 3""")

# requisitions (alert)
_add("por_requisition_headers_all", """
    SELECT event_id AS requisition_header_id, 'REQ' || cast(event_id AS string) AS requisition_number,
           'Want ' || event_type AS description,
           CASE WHEN event_id % 3 = 0 THEN 'PENDING APPROVAL' ELSE 'APPROVED' END AS document_status, ts AS submission_date
    FROM {events}""")
_REQ = """cast(value AS decimal(18,2)) AS unit_price, cast(1 + event_id % 9 AS decimal(18,2)) AS quantity, 'ea' AS uom_code,
          'Vendor ' || cast(user_id AS string) AS suggested_vendor_name, 'Main' AS suggested_vendor_site,
          cast(NULL AS string) AS suggested_vendor_contact_phone, 'v' || cast(user_id AS string) || '@corp.org' AS suggested_vendor_contact_email,
          CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'I' || cast(event_id % 50 AS string) END AS suggested_supplier_item_number,
          ts - INTERVAL '1' HOUR * (event_id % 48) AS creation_date"""
_add("por_requisition_lines_all", _union(
    f"""SELECT event_id AS requisition_header_id, 1 AS line_number, {_REQ},
               CASE WHEN event_type = 'error' THEN 'Y' WHEN event_type = 'view' THEN NULL ELSE 'N' END AS new_supplier_flag FROM {{events}}""",
    f"""SELECT event_id, 1, {_REQ}, 'Y' FROM {{events}} WHERE event_type = 'error' AND event_id % 5 = 0"""))

# ---- ledger, receivables, assets -------------------------------------------------

_add("gl_je_headers", """
    SELECT o_orderkey AS je_header_id, 'JE' || cast(o_orderkey AS string) AS name,
           cast(o_orderkey + 9000 AS string) AS posting_acct_seq_value,
           cast(year(o_orderdate) AS string) || '-' || cast(month(o_orderdate) AS string) AS period_name,
           CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey % 500 END AS je_batch_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Adjustment' ELSE 'Purchase' END AS je_category,
           CASE o_orderstatus WHEN 'F' THEN 'Payables' WHEN 'O' THEN 'Manual' ELSE 'Unlisted' END AS je_source,
           cast(o_orderdate AS date) AS default_effective_date
    FROM {orders}""")
_add("gl_je_lines", f"""
    SELECT l_orderkey AS je_header_id, l_linenumber AS je_line_num, part AS code_combination_id,
           CASE WHEN line_id % 5 = 0 THEN NULL ELSE price END AS entered_dr,
           CASE WHEN line_id % 5 = 1 THEN cast(price * cast(0.5 AS decimal(2,1)) AS decimal(18,2)) WHEN line_id % 5 = 2 THEN NULL
                ELSE cast(0 AS decimal(18,2)) END AS entered_cr, 'NZD' AS currency_code,
           CASE rf WHEN 'R' THEN 'U' ELSE 'P' END AS status, {_login("line_id")} AS created_by,
           'Line' || chr(13) || chr(10) || cast(part AS string) AS description,
           CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE invoice_id * 10 + l_linenumber END AS gl_sl_link_id,
           CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'XLAJEL' END AS gl_sl_link_table
    FROM {{li}}""")
_add("gl_import_references", """
    SELECT l_orderkey AS je_header_id, l_linenumber AS je_line_num,
           CASE WHEN l_orderkey % 6 = 0 THEN invoice_id * 10 + l_linenumber ELSE NULL END AS gl_sl_link_id, 'XLAJEL' AS gl_sl_link_table
    FROM {li}""")
_add("gl_je_categories", """
    SELECT 'Adjustment' AS je_category_name, 'Adjustment entry' AS user_je_category_name FROM {region} WHERE r_regionkey = 0
    UNION ALL SELECT 'Purchase', 'Purchase invoices' FROM {region} WHERE r_regionkey = 0""")
_add("gl_je_sources_b", """
    SELECT 'Payables' AS je_source_name, 'PAY' AS je_source_key FROM {region} WHERE r_regionkey = 0
    UNION ALL SELECT 'Manual', 'MAN' FROM {region} WHERE r_regionkey = 0""")
_add("gl_je_batches", """
    SELECT p_partkey AS je_batch_id, 'Batch ' || cast(p_partkey AS string) AS name,
           timestamp '1998-02-03 04:05:06' AS posted_date
    FROM {part}""")
_add("xla_ae_lines", """
    SELECT invoice_id AS ae_header_id, l_linenumber AS ae_line_num, invoice_id * 10 + l_linenumber AS gl_sl_link_id,
           'XLAJEL' AS gl_sl_link_table, cast(sum(price) AS decimal(18,2)) AS entered_dr,
           cast(NULL AS decimal(18,2)) AS entered_cr,
           CASE WHEN l_linenumber = 5 THEN 'LIABILITY' ELSE 'ITEM EXPENSE' END AS accounting_class_code,
           'Entry ' || cast(l_linenumber AS string) AS description
    FROM {li} GROUP BY invoice_id, l_linenumber""")
_add("xla_ae_headers", """
    SELECT invoice_id AS ae_header_id, invoice_id AS entity_id, cast(o_orderdate AS date) + 3 AS accounting_date,
           CASE WHEN lead_order % 3 = 0 THEN 'STD' ELSE 'NONE' END AS doc_category_code,
           cast(lead_order AS string) AS doc_sequence_value
    FROM {inv} JOIN {orders} ON o_orderkey = lead_order""")
_ENT = {2: ("TRANSACTIONS", 222), 6: ("RECEIPTS", 222), 8: ("AP_PAYMENTS", 200), 10: ("DEPRECIATION", 140),
        12: ("LEASE_EXPENSE", 140), 16: ("TRANSACTIONS", 140), 18: ("RECEIVING", 10096), 22: ("CE_EXTERNAL", 260)}
_add("xla_transaction_entities", f"""
    SELECT invoice_id AS entity_id, invoice_id AS source_id_int_1, 'T' || cast(invoice_id AS string) AS transaction_number,
           CASE lead_order % 30 {' '.join(f"WHEN {k} THEN '{e}'" for k, (e, _) in _ENT.items())} ELSE 'AP_INVOICES' END AS entity_code,
           CASE lead_order % 30 {' '.join(f"WHEN {k} THEN {a}" for k, (_, a) in _ENT.items())} ELSE 200 END AS application_id
    FROM {{inv}}""")
_add("xla_distribution_links", """
    SELECT 200 AS application_id, invoice_id AS ae_header_id, l_linenumber AS ae_line_num, line_id AS applied_to_dist_id_num_1,
           invoice_id AS applied_to_source_id_num_1, 'ITEM EXPENSE' AS rounding_class_code,
           cast(price AS decimal(28,10)) AS unrounded_entered_dr, cast(NULL AS decimal(28,10)) AS unrounded_entered_cr
    FROM {li}""")
_add("fnd_doc_sequence_categories", """
    SELECT CASE r_regionkey WHEN 0 THEN 'STD' ELSE r_name END AS code,
           CASE r_regionkey WHEN 0 THEN 'Standard document' ELSE 'Documents of ' || r_name END AS description
    FROM {region}""")
_add("hz_orig_sys_references", """
    SELECT -1 - c_custkey AS owner_table_id, cast(c_custkey AS string) AS orig_system_reference,
           CASE WHEN c_custkey % 8 = 0 THEN 'LEGACY' ELSE 'FUSION_HCM' END AS orig_system, 'HZ_PARTIES' AS owner_table_name
    FROM {customer}""")
_add("hz_cust_accounts", "SELECT c_custkey AS cust_account_id, -1 - c_custkey AS party_id FROM {customer}")
_add("ra_customer_trx_all", """
    SELECT o_orderkey AS customer_trx_id, 'TRX' || cast(o_orderkey AS string) AS trx_number, 'NZD' AS invoice_currency_code,
           cast(o_orderdate AS date) AS trx_date, 'ar.clerk@corp.org' AS created_by, o_orderdate AS creation_date,
           'Sale ' || o_orderpriority AS comments
    FROM {orders}""")
_add("ar_payment_schedules_all", """
    SELECT o_orderkey AS customer_trx_id, o_custkey AS customer_id, cast(o_totalprice AS decimal(18,2)) AS amount_due_original,
           cast(1 AS decimal(18,2)) AS tax_original
    FROM {orders}""")
_add("ar_cash_receipts_all", """
    SELECT o_orderkey AS cash_receipt_id, 'RC' || cast(o_orderkey AS string) AS receipt_number, 'NZD' AS currency_code,
           cast(o_totalprice AS decimal(18,2)) AS amount, cast(0 AS decimal(18,2)) AS tax_amount, o_custkey AS pay_from_customer,
           cast(o_orderdate AS date) AS receipt_date, 'ar.clerk@corp.org' AS created_by, o_orderdate AS creation_date,
           'Receipt ' || o_orderpriority AS comments
    FROM {orders}""")
_add("ap_checks_all", """
    SELECT o_orderkey AS check_id, cast(floor(o_custkey / 15) AS bigint) AS vendor_id,
           'Payee ' || cast(o_custkey AS string) AS vendor_name,
           CASE WHEN o_orderkey % 3 = 0 THEN -1 - o_custkey ELSE cast(floor(o_custkey / 15) AS bigint) END AS party_id,
           'pay.run@corp.org' AS created_by, o_orderdate AS creation_date, 'Payment' AS description
    FROM {orders}""")
_add("fa_additions_vl", """
    SELECT o_orderkey AS asset_id, 'FA' || cast(o_orderkey AS string) AS asset_number, 'fa.clerk@corp.org' AS created_by,
           o_orderdate AS creation_date, 'Asset ' || o_orderpriority AS description
    FROM {orders}""")
_add("fa_transaction_headers", "SELECT o_orderkey AS transaction_header_id, o_orderkey AS asset_id FROM {orders}")
_add("cmr_rcv_events", """
    SELECT o_orderkey AS accounting_event_id, 'RECEIVING' AS entity_code, o_orderkey AS transaction_id,
           o_orderkey AS event_transaction_id,
           CASE WHEN o_orderkey % 4 = 2 THEN 'CMR_TRANSACTIONS' ELSE 'CMR_AP_INVOICE_DTLS' END AS event_txn_table_name
    FROM {orders}""")
_add("cmr_transactions", """
    SELECT o_orderkey AS transaction_id, o_orderkey AS cmr_rcv_transaction_id, o_orderkey AS rcv_transaction_id,
           'GRN' || cast(o_orderkey AS string) AS receipt_number FROM {orders}""")
_add("cmr_ap_invoice_dtls", """
    SELECT o_orderkey AS cmr_ap_invoice_dist_id, o_orderkey AS cmr_rcv_transaction_id FROM {orders}""")
_add("rcv_transactions", """
    SELECT l_orderkey AS transaction_id, l_orderkey AS po_header_id, min(line_id) AS po_line_id,
           'store.clerk@corp.org' AS created_by, cast(min(ship) AS timestamp) AS creation_date
    FROM {li} GROUP BY l_orderkey""")
_add("ce_external_transactions", """
    SELECT o_orderkey AS transaction_id, 'cash.clerk@corp.org' AS created_by, o_orderdate AS creation_date FROM {orders}""")

# ---- people ----------------------------------------------------------------------

_FROM0 = "date '1990-01-01' AS effective_start_date"
_TO9 = f"{FOREVER} AS effective_end_date"

_POS = """SELECT p_partkey AS position_id, 'POS' || cast(p_partkey AS string) AS position_code,
              CASE p_partkey % 40 WHEN 1 THEN 'Chief Executive Office' WHEN 2 THEN 'Deputy Chief Executive Lead'
                   ELSE 'Role ' || p_name END AS name,
              CASE WHEN p_partkey % 12 = 11 THEN 'I' ELSE 'A' END AS active_status, p_type AS attribute1,
              cast(1000 + p_size AS string) AS attribute2, CASE WHEN p_partkey % 40 < 8 THEN 'Y' ELSE 'N' END AS attribute4,
              cast(p_size % 4 AS string) AS attribute5, CASE WHEN p_size % 3 = 0 THEN 'Fixed Term' ELSE 'Permanent' END AS attribute6,
              'Y' AS attribute7, p_brand AS attribute8, p_partkey % 25 AS cost_center,
              cast(p_size % 12 AS bigint) AS entry_grade_id,
              CASE p_size % 3 WHEN 0 THEN 'FULL_TIME' WHEN 1 THEN 'PART_TIME' ELSE 'CASUAL' END AS full_part_time,
              cast(p_size % 30 AS bigint) AS job_id, cast(p_partkey % 27 AS bigint) AS location_id,
              p_partkey % 25 AS organization_id, """
_add("hr_all_positions_f_vl", _union(
    _POS + f"""CASE WHEN p_partkey % 20 = 3 THEN date '1998-01-01' ELSE date '1990-01-01' END AS effective_start_date,
               {_TO9} FROM {{part}}""",
    _POS + "date '1990-01-01', date '1997-12-31' FROM {part} WHERE p_partkey % 20 = 3"))
_add("per_departments", f"""
    SELECT cast(n_nationkey AS bigint) AS organization_id,
           CASE n_nationkey WHEN 0 THEN 'Finance' WHEN 1 THEN 'Financial Performance and Planning' ELSE 'Dept ' || n_name END AS name,
           {_FROM0}, CASE WHEN n_nationkey = 24 THEN date '1997-06-30' ELSE {FOREVER} END AS effective_end_date
    FROM {{nation}}""")
_add("hr_locations_all_f_vl", """
    SELECT cast(n_nationkey AS bigint) AS location_id, n_name AS location_name,
           CASE n_nationkey % 6 WHEN 0 THEN 'WLG_L7' WHEN 1 THEN 'AKL_L7' WHEN 2 THEN 'PARLMT' WHEN 3 THEN 'AKL_APO'
                ELSE 'LOC' || cast(n_nationkey AS string) END AS internal_location_code
    FROM {nation}""")
_add("per_jobs", "SELECT cast(n_nationkey AS bigint) AS job_id, 'Job ' || n_name AS name FROM {nation}")
_add("fnd_vs_values_b", "SELECT cast(n_nationkey AS bigint) AS value_id, 'CC' || cast(n_nationkey AS string) AS value FROM {nation}")
_add("per_grades_f_vl", """
    SELECT cast(n_nationkey AS bigint) AS grade_id,
           CASE WHEN n_nationkey % 5 = 4 THEN 'Executive' ELSE 'Band_0' || cast(n_nationkey AS string) END AS grade_code
    FROM {nation} WHERE n_nationkey < 11""")
_add("per_rate_values_f", f"""
    SELECT cast(n_nationkey AS bigint) AS rate_object_id, cast(n_nationkey % 2 AS bigint) AS rate_id,
           cast(40000 + n_nationkey * 1000.5 AS decimal(18,2)) AS minimum, cast(60000 + n_nationkey * 1000.5 AS decimal(18,2)) AS mid_value,
           cast(80000 + n_nationkey * 1000.5 AS decimal(18,2)) AS maximum,
           date '1992-01-01' AS effective_start_date,
           CASE WHEN n_nationkey = 6 THEN NULL WHEN n_nationkey = 7 THEN date '1996-12-31' ELSE {FOREVER} END AS effective_end_date
    FROM {{nation}} WHERE n_nationkey < 9""")
_add("per_position_hierarchy_f", f"""
    SELECT p_partkey AS position_id, cast(floor(p_partkey / 8) AS bigint) AS parent_position_id, {_FROM0},
           CASE WHEN p_partkey % 14 = 0 THEN date '1996-12-31' ELSE {FOREVER} END AS effective_end_date
    FROM {{part}} WHERE p_partkey > 0""")
_TREE = "'GL_ACCT_FLEX' AS tree_structure_code, 'ORG COST CENTER' AS tree_code, "
# the version number is computed per row: a constant column would turn the joins on it into plain filters
_add("fnd_tree_node", _union(*(part for v in (1, 2) for part in (
    f"""SELECT r_regionkey + {1000 * v} AS tree_node_id, cast(NULL AS int) AS parent_tree_node_id, 0 AS depth,
               'R' || cast(r_regionkey AS string) AS pk1_start_value, {_TREE} r_regionkey * 0 + {v} AS tree_version_id FROM {{region}}""",
    f"""SELECT n_nationkey + {1000 * v + 100}, n_regionkey + {1000 * v},
               CASE WHEN n_nationkey % 3 = 1 THEN 2 ELSE 1 END,
               CASE WHEN n_nationkey % 3 = 1 THEN 'CC' ELSE 'G' END || cast(n_nationkey AS string), {_TREE} n_nationkey * 0 + {v} FROM {{nation}}""",
    f"""SELECT n_nationkey + {1000 * v + 200}, n_nationkey + {1000 * v + 100}, 2,
               'CC' || cast(n_nationkey AS string), {_TREE} n_nationkey * 0 + {v} FROM {{nation}} WHERE n_nationkey % 3 = 0"""))))
_add("fnd_tree_version_vl", f"""
    SELECT r_regionkey AS tree_version_id, CASE r_regionkey WHEN 1 THEN 'ACTIVE' ELSE 'DRAFT' END AS status, {_TREE}
           {_FROM0}, {_TO9}
    FROM {{region}} WHERE r_regionkey IN (1, 2)""")

# assignments: a current one for all, a second for every third person, history and leaver rows
_ASG = """SELECT c_custkey AS person_id, {seq} AS seq, c_custkey * 10 + {seq} AS assignment_id,
              'E' || cast(c_custkey AS string) || '-{seq}' AS assignment_number, 'Work of ' || c_name AS assignment_name,
              CASE WHEN c_custkey % 8 = 7 THEN 'C' ELSE 'E' END AS assignment_type,
              {pos} AS position_id, cast(c_custkey % 12 AS bigint) AS grade_id, 'Y' AS effective_latest_change,
              CASE WHEN c_custkey % 6 = 0 THEN date '2000-06-30' ELSE NULL END AS projected_assignment_end,
              CASE WHEN c_custkey % 9 = 0 THEN date '1999-03-31' ELSE NULL END AS ass_attribute_date1,
              c_mktsegment AS ass_attribute5, 'N' AS ass_attribute2, 'Y' AS ass_attribute1, cast(NULL AS date) AS projected_start_date, """


def _asg(seq: int, pos: str) -> str:
    return _ASG.replace("{seq}", str(seq)).replace("{pos}", pos)


_CAT = ["ORG_SUBSTANTIVE_POSITION", "ORG_FIX_TERM", "ORG_INTERNAL_SECONDMENT", "ORG_EXTERNAL_SECONDMENT",
        "ORG_PARENTAL_LEAVE", "ORG_LEAVE_WO_PAY", "ORG_OTHER"]
_cat = "CASE ({k}) % 7 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CAT)) + " END"
_SUSP = "CASE WHEN c_custkey % 7 IN (4, 5) OR c_custkey % 21 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END"
_add("per_all_assignments_m", _union(
    # history row of the first assignment
    _asg(1, "c_custkey") + f"""'Y' AS primary_flag, 'ACTIVE' AS assignment_status_type, 'HIRE' AS action_code,
        {_cat.replace("{k}", "c_custkey + 1")} AS employment_category, date '1991-01-01' AS effective_start_date,
        date '1996-12-31' AS effective_end_date FROM {{customer}}""",
    # current row of the first assignment; leavers' row ends in 1999
    _asg(1, "c_custkey") + f"""CASE WHEN c_custkey % 21 = 0 THEN 'N' ELSE 'Y' END, {_SUSP}, 'ASG_CHANGE', {_cat.replace("{k}", "c_custkey")},
        date '1997-01-01', CASE WHEN c_custkey % 5 = 2 THEN date '1999-01-01' + cast(c_custkey % 300 AS int) ELSE {FOREVER} END
        FROM {{customer}}""",
    # leaver row
    _asg(1, "c_custkey") + f"""'Y', 'INACTIVE', 'TERMINATION', {_cat.replace("{k}", "c_custkey")},
        date '1999-01-02' + cast(c_custkey % 300 AS int), {FOREVER} FROM {{customer}} WHERE c_custkey % 5 = 2""",
    # second assignment in the position of the person before
    _asg(2, "c_custkey - 1") + f"""CASE WHEN c_custkey % 21 = 0 THEN 'Y' ELSE 'N' END, 'ACTIVE', 'ADD_ASG', {_cat.replace("{k}", "c_custkey + 2")},
        date '1996-03-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 3 = 0 AND c_custkey > 0""",
    # pending workers
    _ASG.replace("{seq}", "3").replace("{pos}", "c_custkey + 6")
        .replace("CASE WHEN c_custkey % 8 = 7 THEN 'C' ELSE 'E' END AS assignment_type", "'P' AS assignment_type")
        .replace("cast(NULL AS date) AS projected_start_date", "date '1998-07-01' + cast(c_custkey % 60 AS int) AS projected_start_date")
    + f"""'N', 'ACTIVE', 'ADD_PEND_WKR', 'ORG_OTHER', date '1998-01-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 10 = 9"""))
_add("per_person_names_f", _union(
    f"""SELECT c_custkey AS person_id, 'Shown ' || c_name AS display_name, c_name AS full_name, 'GLOBAL' AS name_type,
               CASE WHEN c_custkey % 15 = 1 THEN date '1997-05-01' ELSE date '1980-01-01' END AS effective_start_date, {_TO9} FROM {{customer}}""",
    """SELECT c_custkey, 'Old ' || c_name, 'Old ' || c_name, 'GLOBAL', date '1980-01-01', date '1997-04-30' FROM {customer}
       WHERE c_custkey % 15 = 1""",
    f"SELECT c_custkey, 'Local ' || c_name, c_name, 'NZ', date '1980-01-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 10 = 0"))
_add("per_people_f", f"""
    SELECT c_custkey AS person_id, cast(40000 + c_custkey AS string) AS person_number, date '1980-01-01' AS effective_start_date, {_TO9}
    FROM {{customer}}""")
_add("per_all_people_f", "SELECT person_id, person_number, effective_start_date, effective_end_date FROM {per_people_f}")
_add("per_persons", "SELECT c_custkey AS person_id, date '1960-01-01' + cast(c_custkey % 9000 AS int) AS date_of_birth FROM {customer}")
_add("per_people_legislative_f", f"""
    SELECT c_custkey AS person_id, CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'ORA_HRX_GENDER_DIVERSE' ELSE NULL END AS sex,
           date '1980-01-01' AS effective_start_date, CASE WHEN c_custkey % 11 = 5 THEN date '1985-12-31' ELSE {FOREVER} END AS effective_end_date
    FROM {{customer}}""")
_add("per_periods_of_service", f"""
    SELECT c_custkey AS period_of_service_id, c_custkey AS person_id, CASE WHEN c_custkey % 8 = 7 THEN 'C' ELSE 'E' END AS period_type,
           date '1991-01-01' + cast(c_custkey % 800 AS int) AS date_start, c_custkey AS action_occurrence_id,
           CASE WHEN c_custkey % 5 = 2 THEN date '1999-01-01' + cast(c_custkey % 300 AS int) ELSE NULL END AS actual_termination_date
    FROM {{customer}}""")
_add("per_action_occurrences", "SELECT c_custkey AS action_occurrence_id, c_custkey % 19 AS action_reason_id FROM {customer}")
_REASONS = ["10 Resignation – destination unknown", "11 Resignation to Public Service department", "30 End of fixed term contract / agreement",
            "40 Restructuring", "42 Severance", "42 Redundancy", "45 Voluntary Redundancy", "50 Dismissal", "60 Retirement", "70 Death",
            "99 Unknown", "Own reason"]
_add("per_action_reasons_vl", f"""
    SELECT cast(n_nationkey AS bigint) AS action_reason_id,
           CASE n_nationkey {' '.join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(_REASONS))} END AS action_reason
    FROM {{nation}} WHERE n_nationkey < {len(_REASONS)}""")
_add("per_assignment_supervisors_f_v", _union(
    f"""SELECT c_custkey AS person_id, c_custkey * 10 + 1 AS assignment_id, cast(floor(c_custkey / 10) AS bigint) AS manager_id,
               cast(floor(c_custkey / 10) AS bigint) * 10 + 1 AS manager_assignment_id, date '1991-01-01' AS effective_start_date,
               {_TO9} FROM {{customer}}""",
    f"""SELECT c_custkey, c_custkey * 10 + 2, cast(floor(c_custkey / 20) AS bigint), cast(floor(c_custkey / 20) AS bigint) * 10 + 1,
               date '1996-03-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 3 = 0"""))
_add("per_email_addresses", _union(
    """SELECT c_custkey AS person_id, c_custkey * 10 AS email_address_id, CASE WHEN c_custkey % 9 = 8 THEN 'X1' ELSE 'W1' END AS email_type,
              'w' || cast(c_custkey AS string) || '@corp.org' AS email_address, date '1995-01-01' AS date_from FROM {customer}""",
    """SELECT c_custkey, c_custkey * 10 + 1, CASE WHEN c_custkey % 4 = 3 THEN 'X1' ELSE 'H1' END, 'h' || cast(c_custkey AS string) || '@home.org',
              date '1995-01-01' + cast(c_custkey % 3 AS int) FROM {customer}""",
    """SELECT c_custkey, c_custkey * 10 + 2, 'H1', 'h2' || cast(c_custkey AS string) || '@home.org', date '1995-01-02' FROM {customer}"""))
_add("per_phones", _union(
    """SELECT c_custkey AS person_id, CASE WHEN c_custkey % 6 = 5 THEN 'FAX' ELSE 'HM' END AS phone_type, '04-' || cast(c_custkey AS string) AS phone_number
       FROM {customer}""",
    "SELECT c_custkey, 'WM', '021-' || cast(c_custkey AS string) FROM {customer} WHERE c_custkey % 4 = 0"))
_add("per_person_addr_usages_f", _union(
    f"""SELECT c_custkey AS person_id, c_custkey * 10 AS address_id, 'HOME' AS address_type, date '1995-01-01' AS effective_start_date, {_TO9}
        FROM {{customer}}""",
    f"""SELECT c_custkey, c_custkey * 10 + 1, 'HOME', date '1996-01-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 2 = 0""",
    f"""SELECT c_custkey, c_custkey * 10 + 2, 'WORK', date '1996-01-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 4 = 0"""))
_ADR = """'Street ' || cast(c_custkey AS string) AS address_line_1, CASE WHEN c_custkey % 3 = 0 THEN 'Flat 1' ELSE NULL END AS address_line_2,
          c_mktsegment AS address_line_3, 'Town ' || cast(c_nationkey AS string) AS town_or_city, '60' || cast(c_nationkey AS string) AS postal_code,
          'NZ' AS country, date '1990-01-01' AS effective_start_date"""
_add("per_addresses_f", _union(*(f"SELECT c_custkey * 10 + {k} AS address_id, {_ADR}, {_TO9} FROM {{customer}}" for k in range(3))))
_add("per_contact_relationships", _union(
    """SELECT c_custkey AS person_id, c_custkey + 1 AS contact_person_id, CASE c_custkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'ORG_SIBLING'
              WHEN 2 THEN 'EMRG' WHEN 3 THEN 'P' ELSE 'X' END AS contact_type, CASE WHEN c_custkey % 13 = 0 THEN 'N' ELSE 'Y' END AS emergency_contact_flag
       FROM {customer}""",
    "SELECT c_custkey, c_custkey + 2, 'F', 'Y' FROM {customer} WHERE c_custkey % 2 = 0",
    "SELECT c_custkey, c_custkey + 3, 'ORG_PARTNER', 'Y' FROM {customer} WHERE c_custkey % 4 = 0"))
_CATNAMES = ["Substantive Position", "Fixed Term", "Internal Secondment", "External Secondment", "Parental Leave", "Leave without Pay"]
_ETH = ["African", "Asian", "Chinese", "Fijian", "Indian", "Māori", "New Zealand European", "Not Stated", "Samoan", "Tongan"]
_add("hcm_lookups", _union(
    f"""SELECT CASE n_nationkey {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CAT[:6]))} END AS lookup_code, 'EMP_CAT' AS lookup_type,
               CASE n_nationkey {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CATNAMES))} END AS meaning FROM {{nation}} WHERE n_nationkey < 6""",
    f"""SELECT 'E' || cast(n_nationkey AS string), 'PER_ETHNICITY',
               CASE n_nationkey {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_ETH))} END FROM {{nation}} WHERE n_nationkey < {len(_ETH)}"""))
_add("per_ethnicities", """
    SELECT CASE WHEN c_custkey % 17 = 3 THEN -1 - c_custkey ELSE c_custkey END AS person_id, 'E' || cast(c_custkey % 10 AS string) AS ethnicity,
           CASE WHEN c_custkey % 4 = 0 THEN 'E' || cast(c_custkey % 10 AS string) WHEN c_custkey % 4 = 1 THEN 'E5' ELSE NULL END AS attribute1,
           CASE WHEN c_custkey % 6 = 0 THEN 'E5' WHEN c_custkey % 6 = 1 THEN 'E6' ELSE NULL END AS attribute2
    FROM {customer}""")
_add("cmp_salary", _union(
    f"""SELECT c_custkey * 10 + CASE WHEN c_custkey % 8 = 7 THEN 9 ELSE 1 END AS assignment_id, c_custkey AS person_id, c_custkey % 2 AS salary_basis_id,
               cast(50000 + c_custkey * 1.25 AS decimal(18,2)) AS salary_amount, cast(52000 + c_custkey * 1.25 AS decimal(18,2)) AS annual_ft_salary,
               cast(1 AS decimal(18,2)) AS fte_value, date '1997-02-01' AS date_from, CASE WHEN c_custkey % 7 = 0 THEN date '1998-02-28' ELSE {FOREVER} END AS date_to
        FROM {{customer}}""",
    f"""SELECT c_custkey * 10 + 1, c_custkey, c_custkey % 2, cast(61000 + c_custkey * 1.25 AS decimal(18,2)), cast(62000 AS decimal(18,2)),
               cast(0.8 AS decimal(18,2)), date '1998-03-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 7 = 0 AND c_custkey % 8 <> 7"""))
_add("cmp_salary_bases_vl", """
    SELECT cast(r_regionkey AS bigint) AS salary_basis_id, cast(r_regionkey AS bigint) AS grade_rate_id FROM {region}""")
_add("per_assign_work_measures_f", f"""
    SELECT assignment_id, CASE WHEN person_id % 10 = 3 THEN 'HEAD' ELSE 'FTE' END AS unit,
           CASE WHEN person_id % 3 = 0 THEN cast(0.5 AS decimal(18,2)) ELSE cast(1 AS decimal(18,2)) END AS value,
           date '1991-01-01' AS effective_start_date, {_TO9}
    FROM {{per_assignment_supervisors_f_v}}""")
_add("per_grade_steps_f_vl", f"""
    SELECT cast(n_nationkey AS bigint) AS grade_step_id, cast(n_nationkey % 12 AS bigint) AS grade_id, 'Step ' || cast(n_nationkey AS string) AS name,
           {_FROM0}, CASE WHEN n_nationkey = 5 THEN date '1995-12-31' ELSE {FOREVER} END AS effective_end_date
    FROM {{nation}}""")
_add("per_assign_grade_steps_f", _union(
    f"SELECT c_custkey * 10 + CASE WHEN c_custkey % 3 = 1 THEN 9 ELSE 1 END AS assignment_id, c_custkey % 12 AS grade_step_id, {_FROM0}, {_TO9} FROM {{customer}}",
    f"SELECT c_custkey * 10 + 1, c_custkey % 12, date '1991-01-01', {FOREVER} FROM {{customer}} WHERE c_custkey % 9 = 0"))

# payroll
_add("pay_element_entries_f", """
    SELECT o_orderkey AS element_entry_id, o_custkey % 6 AS element_type_id FROM {orders}""")
_ELEM = ["Car Allowance", "Phone Allowance", "ORG PSA Union Membership", "ORG Ex Gratia", "Meal Allowance", "Parking"]
_add("pay_element_types_f", f"""
    SELECT cast(n_nationkey AS bigint) AS element_type_id,
           CASE n_nationkey {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_ELEM))} END AS base_element_name
    FROM {{nation}} WHERE n_nationkey < {len(_ELEM)}""")
_add("pay_input_values_f", _union(*(
    f"SELECT cast(n_nationkey AS bigint) AS element_type_id, cast(n_nationkey * 10 + {i} AS bigint) AS input_value_id, '{b}' AS base_name FROM {{nation}} WHERE n_nationkey < 6"
    for i, b in enumerate(["Amount", "Periodicity", "Comments"]))))
_add("pay_element_entry_values_f", _union(*(
    f"""SELECT o_orderkey AS element_entry_id, (o_custkey % 6) * 10 + {i} + CASE WHEN o_orderkey % {m} = 1 THEN 5 ELSE 0 END AS input_value_id, {v} AS screen_entry_value,
               cast(o_orderdate AS date) AS effective_start_date,
               CASE WHEN o_orderkey % 3 = 0 THEN {FOREVER} ELSE cast(o_orderdate AS date) + cast(o_orderkey % 400 AS int) END AS effective_end_date
        FROM {{orders}}"""
    for i, v, m in ((0, "cast(o_orderkey % 97 AS string)", 9), (1, "o_orderpriority", 4), (2, "'memo'", 5)))))
_add("fnd_lookup_values", f"""
    SELECT CASE n_nationkey {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_ELEM[:5]))} END AS meaning,
           CASE WHEN n_nationkey % 2 = 0 THEN 'Allowance' ELSE 'Deduction' END AS description, 'ORG_ALLOWANCE_LIST' AS lookup_type, 'US' AS language
    FROM {{nation}} WHERE n_nationkey < 5
    UNION ALL SELECT '{_ELEM[5]}', 'Allowance', 'ALT_ALLOWANCE_LIST', 'US' FROM {{region}} WHERE r_regionkey = 0""")
_add("pay_entry_usages", """
    SELECT o_orderkey AS element_entry_id, CASE WHEN o_orderkey % 25 = 7 THEN -1 - o_custkey ELSE o_custkey END AS payroll_relationship_id,
           o_custkey * 10 + 1 AS payroll_assignment_id FROM {orders}""")
_add("pay_rel_groups_dn", """
    SELECT c_custkey AS payroll_relationship_id, c_custkey * 10 + 1 AS relationship_group_id, c_custkey * 10 + 1 AS assignment_id FROM {customer}""")

# recruitment
_add("irc_requisitions_b", """
    SELECT p_partkey AS requisition_id, 'IRC' || cast(p_partkey AS string) AS requisition_number, p_partkey AS position_id,
           CASE WHEN p_partkey % 4 = 2 THEN 3 ELSE p_partkey % 3 END AS current_phase_id, p_partkey % 5 AS current_state_id, date '1998-01-01' + cast(p_size AS int) AS open_date,
           CASE WHEN p_size % 4 = 0 THEN date '1998-05-01' ELSE NULL END AS filled_date, cast(p_size % 10 AS bigint) AS grade_id,
           cast(p_size % 30 AS bigint) AS job_id, cast(floor(p_partkey / 20) AS bigint) AS hiring_manager_id,
           cast(floor(p_partkey / 20) AS bigint) * 10 + 1 AS manager_assignment_id, 'EMP' AS worker_type_code
    FROM {part}""")
_add("irc_phases_vl", """
    SELECT cast(r_regionkey AS bigint) AS phase_id, 'Phase ' || r_name AS name,
           CASE WHEN r_regionkey < 3 THEN 'REQUISITION' ELSE 'CSW' END AS type_code
    FROM {region}""")
_add("irc_states_vl", """
    SELECT cast(r_regionkey AS bigint) AS state_id, CASE r_regionkey WHEN 4 THEN 'Filled' ELSE 'State ' || r_name END AS name,
           'REQUISITION' AS type_code
    FROM {region}""")
_add("irc_submissions", """
    SELECT l_partkey AS requisition_id, cast(l_linenumber % 5 AS bigint) AS current_phase_id, cast(l_linenumber % 4 AS bigint) AS current_state_id,
           l_shipdate AS last_update_date
    FROM {lineitem}""")

_NAME = re.compile(r"\{(\w+)\}")


def references(sql: str) -> list[str]:
    """Tables named by ``sql`` in braces, in order of first use."""
    return list(dict.fromkeys(_NAME.findall(sql)))


def as_cte(sql: str) -> str:
    """Plain SQL in which every stand-in reached from ``sql`` is a named sub-result."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in RAW_TABLES or name in order:
            return
        for ref in references(STANDINS[name]):
            visit(ref)
        order.append(name)

    for ref in references(sql):
        visit(ref)
    body = _NAME.sub(r"\1", sql)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({_NAME.sub(r'\1', STANDINS[n])})" for n in order)
    head, sep, tail = body.lstrip().partition("WITH ")
    return f"WITH {ctes},\n{tail}" if head == "" and sep else f"WITH {ctes}\n{body}"
