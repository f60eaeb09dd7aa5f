"""The parameter lists on the stand-in tables."""

from __future__ import annotations

import datetime as dt

from ledgerloom.checks.registry import register
from ledgerloom.checks.reports_finance import bills
from ledgerloom.checks.reports_ledger import _GROUPS
from ledgerloom.functions.params import Params
from ledgerloom.plans.lists import LISTS, SITE_LISTS
from ledgerloom.site import Site

PARAMS = Params(as_at=dt.date(1999, 6, 1), chosen={
    "team_group": ["Brand#1", "Brand#2", "Brand#3"], "description_type": "Allowance", "costcentre": ["427", "601"],
    "business_unit": ["Crown", "ASIA"], "suppliername": "Supplier#000000003", "po_number": "PO21"})

_CHAIN = """{po_headers_all} h JOIN {po_lines_all} l USING (po_header_id) JOIN {po_line_locations_all} k USING (po_header_id, po_line_id)
    JOIN {po_distributions_all} q USING (po_header_id, po_line_id, line_location_id)"""
_ACC = "JOIN {gl_code_combinations} g ON g.code_combination_id = q.code_combination_id"
_SELLER = "JOIN {poz_suppliers} s ON s.vendor_id = h.vendor_id JOIN {hz_parties} p ON p.party_id = s.party_id"
_ACT = "JOIN {fnd_flex_values_vl} v ON v.flex_value = g.segment4 AND v.value_category = 'ORG_ACTIVITY'"
_BILL = f"WITH {bills(chr(39) + 'ITEM' + chr(39), 'gross')}"
_RISK = f"""{_CHAIN} {_ACC} AND g.segment2 = '427' JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.prc_bu_id AND u.name = 'Crown'
    JOIN bill b ON b.po_distribution_id = q.po_distribution_id"""
_BCI = """{poz_suppliers} s JOIN {hz_parties} p ON p.party_id = s.party_id JOIN {hz_party_sites} z ON z.party_id = p.party_id
    JOIN {zx_party_tax_profile} t ON t.party_id = p.party_id JOIN {zx_registrations} r USING (party_tax_profile_id)"""


def _months(table: str, c: str, label: str, period: str) -> str:
    return f"SELECT DISTINCT strftime({c}, '%b-%y') AS {label}, strftime({c}, '%B-%y') AS {period} FROM {{{table}}}"


def _plain(table: str, cols: str) -> str:
    return f"SELECT DISTINCT {cols} FROM {{{table}}}"


_FY = "year(gl_date) - if(month(gl_date) < 7, 1, 0)"
ORACLE = {
    "L01": f"SELECT DISTINCT {_FY} || '-' || ({_FY} + 1) AS financial_year FROM {{ap_invoices_all}}",
    "L02": _plain("hr_all_positions_f_vl", "attribute6"),
    "L03": "SELECT DISTINCT grade_code FROM {hr_all_positions_f_vl} a LEFT JOIN {per_grades_f_vl} g ON g.grade_id = a.entry_grade_id",
    "L04": """SELECT DISTINCT z.name FROM {hr_all_positions_f_vl} a JOIN {per_departments} z USING (organization_id)
              WHERE a.active_status = 'A' AND a.attribute8 IN ('Brand#1', 'Brand#2', 'Brand#3')""",
    "L08": """SELECT DISTINCT t.base_element_name AS element_name FROM {pay_element_entries_f} JOIN {pay_element_types_f} t USING (element_type_id)
              JOIN {fnd_lookup_values} k ON k.meaning = t.base_element_name
              WHERE k.lookup_type = 'ORG_ALLOWANCE_LIST' AND k.language = 'US' AND k.description = 'Allowance'
                AND t.base_element_name NOT IN ('ORG PSA Union Membership', 'ORG Ex Gratia')""",
    "L09": """SELECT DISTINCT k.description FROM {pay_element_entries_f} JOIN {pay_element_types_f} t USING (element_type_id)
              JOIN {fnd_lookup_values} k ON k.meaning = t.base_element_name WHERE k.lookup_type = 'ORG_ALLOWANCE_LIST' AND k.language = 'US'""",
    "L10": f"SELECT DISTINCT g.segment2 FROM {_CHAIN} {_ACC}",
    "L11": f"SELECT DISTINCT h.segment1 FROM {_CHAIN} {_ACC} WHERE g.segment2 IN ('427', '601')",
    "L12": f"""SELECT DISTINCT p.party_name AS suppliername, s.segment1 AS supplier_num FROM {{po_headers_all}} h {_SELLER}
               JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.prc_bu_id WHERE u.name IN ('Crown', 'ASIA')""",
    "L13": f"SELECT DISTINCT CASE {_GROUPS} END AS cost_centre_group FROM {_CHAIN} {_ACC}",
    "L14": """SELECT 'System' AS initiator_name UNION
              SELECT n.display_name FROM {po_versions} v JOIN {per_person_names_f} n ON n.person_id = v.originator_id
              WHERE n.name_type = 'GLOBAL' AND date '1999-06-01' BETWEEN n.effective_start_date AND n.effective_end_date""",
    "L15": f"""SELECT DISTINCT i.invoice_num FROM {_BCI} JOIN {{ap_invoices_all}} i ON i.vendor_id = s.vendor_id
               JOIN {{ap_invoice_lines_all}} l USING (invoice_id)
               WHERE i.approval_status = 'APPROVED' AND l.line_type_lookup_code IN ('ITEM', 'TAX') AND coalesce(l.discarded_flag, 'N') = 'N'
                 AND (i.invoice_amount <> 0 OR l.amount <> 0) AND r.registration_number IS NOT NULL
                 AND s.vendor_type_lookup_code = 'BCI_SUPPLIER' AND p.party_name = 'Supplier#000000003'""",
    "L16": f"""SELECT DISTINCT p.party_name AS supplier_name FROM {_BCI} JOIN {{iby_external_payees_all}} e
               ON e.payee_party_id = p.party_id AND e.party_site_id = z.party_site_id
               WHERE e.remit_advice_email IS NOT NULL AND s.vendor_type_lookup_code = 'BCI_SUPPLIER'""",
    "L17": _plain("po_headers_all", "document_status"),
    "L18": "SELECT DISTINCT category_code FROM {egp_categories_b} WHERE category_code LIKE 'AOG%'",
    "L19": f"SELECT DISTINCT l.line_num FROM {_CHAIN} WHERE h.segment1 = 'PO21'",
    "L20": f"SELECT DISTINCT h.segment1 AS po_number FROM {_CHAIN}",
    "L21": _plain("gl_je_sources_b", "je_source_key, je_source_name"), "L22": _plain("gl_je_lines", "status"),
    "L23": _plain("gl_code_combinations", "segment2"), "L24": _plain("gl_code_combinations", "segment3"),
    "L25": """SELECT period_name FROM {gl_je_headers} GROUP BY period_name, year(default_effective_date), month(default_effective_date)""",
    "L26": _plain("gl_code_combinations", "segment1"), "L27": _plain("gl_code_combinations", "segment4"),
    "L28": _plain("gl_code_combinations", "segment5"), "L29": _months("ap_invoices_all", "gl_date", "period_name", "period_created"),
    "L32": f"SELECT DISTINCT v.description, v.flex_value FROM {_CHAIN} {_ACC} {_ACT}",
    "L33": f"SELECT DISTINCT p.party_name FROM {_CHAIN} {_SELLER} JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.prc_bu_id",
    "L35": f"SELECT DISTINCT e.category_code, e.category_id FROM {_CHAIN} JOIN {{egp_categories_b}} e ON e.category_id = l.category_id",
    "L36": """SELECT DISTINCT c.displayed_field FROM {ap_holds_all} x JOIN {ap_invoices_all} USING (invoice_id)
              JOIN {ap_lookup_codes} c ON c.lookup_code = x.hold_lookup_code AND c.lookup_type = 'HOLD CODE'
              WHERE x.release_lookup_code IS NULL AND x.hold_lookup_code <> 'INCOMPLETE INVOICE'""",
    "L37": "SELECT DISTINCT name FROM {irc_phases_vl} WHERE type_code = 'CSW'",
    "L38": "SELECT DISTINCT name FROM {irc_phases_vl} WHERE type_code = 'REQUISITION'",
    "L39": _plain("hr_all_positions_f_vl", "attribute8"),
    "L40": f"{_BILL} SELECT DISTINCT h.segment1 AS po_number FROM {_RISK}",
    "L41": f"{_BILL} SELECT DISTINCT p.party_name FROM {_RISK} {_SELLER}",
    "L42": f"""WITH need AS (SELECT l.from_header_id, l.from_line_id, l.contract_id, l.category_id, l.line_num, h.segment1 FROM {_CHAIN} {_ACC}
                 JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.prc_bu_id WHERE g.segment2 = '427' AND u.name = 'Crown')
               SELECT DISTINCT c.contract_number FROM {{okc_k_headers_all_b}} c JOIN {{okc_dts_deliverables_b}} x ON x.chr_id = c.id
               LEFT JOIN {{okc_k_lines_b}} y ON y.chr_id = c.id AND y.major_version = c.major_version AND y.line_id = x.cle_id
               JOIN need n ON (x.purchasing_pk1_value = n.from_header_id AND x.purchasing_pk2_value = n.from_line_id)
                 OR x.purchasing_pk1_value = n.contract_id
                 OR (x.po_doc_number = n.segment1 AND x.po_line_number = n.line_num AND y.purchasing_category_id = n.category_id)
               WHERE x.deliverable_status NOT IN ('CANCELED', 'INCOMPLETE')""",
    "L43": f"""{_BILL} SELECT DISTINCT n.display_name AS requester_name FROM {_RISK} JOIN {{per_person_names_f}} n
               ON n.person_id = q.deliver_to_person_id AND n.name_type = 'GLOBAL'""",
    "L44": f"{_BILL} SELECT DISTINCT v.description, v.flex_value FROM {_RISK} {_ACT}",
    "L45": _months("okc_k_headers_all_b", "start_date", "contract_period", "period_started"),
    "L46": _months("okc_k_headers_all_b", "end_date", "contract_period", "period_end"),
    "L49": f"""SELECT DISTINCT p.party_name FROM {_CHAIN} {_SELLER} JOIN {{hr_organization_units_f_tl}} u ON u.organization_id = h.prc_bu_id
               JOIN {{per_person_names_f}} n ON n.person_id = q.deliver_to_person_id""",
    "L52": "SELECT DISTINCT attribute2 AS contract_type FROM {okc_k_headers_all_b} c JOIN {okc_dts_deliverables_b} x ON x.chr_id = c.id",
    "L53": "SELECT DISTINCT attribute4 AS contract_group FROM {okc_k_headers_all_b} c JOIN {okc_dts_deliverables_b} x ON x.chr_id = c.id",
    "L54": _months("po_headers_all", "creation_date", "period_name", "period_created"),
    "L56": _plain("hr_organization_units_f_tl", "name AS org_unit"),
    "L57": """SELECT DISTINCT w.meaning FROM {per_all_assignments_m} a JOIN {per_periods_of_service} s USING (person_id)
              JOIN {hcm_lookups} w ON w.lookup_code = a.employment_category WHERE s.actual_termination_date < date '1999-06-01'""",
}
# lists that several reports share
for _same, _first in {"L05": "L02", "L06": "L03", "L07": "L04", "L30": "L17", "L31": "L10", "L34": "L20", "L47": "L17", "L48": "L23",
                      "L50": "L20", "L51": "L32", "L55": "L45"}.items():
    ORACLE[_same] = ORACLE[_first]

for _id in sorted(LISTS):
    register(f"list_{_id.lower()}", lambda s, fn=LISTS[_id]: fn(s, PARAMS), ORACLE[_id])

# the same with the codes, cost centre and unit of another installation
OTHER = Site(prefix="ALT", risk_cost_centre="115", risk_business_unit="EUROPE")
for _id in SITE_LISTS:
    _text = ORACLE[_id]
    for _from, _to in (("'ORG_", "'ALT_"), ("'ORG ", "'ALT "), ("'427'", "'115'"), ("'Crown'", "'EUROPE'")):
        _text = _text.replace(_from, _to)
    register(f"list_{_id.lower()}_site", lambda s, fn=LISTS[_id]: fn(s, PARAMS, OTHER), _text)
