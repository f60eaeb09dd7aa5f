"""Value lists behind the report parameters.  ``LISTS`` maps an id to a function of source and parameters, ``SITE_LISTS`` names those that take a site too."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import codes as C, dates as D
from ledgerloom.functions.params import Params, optional_in
from ledgerloom.operators.relational import list_values, or_equi_join, semi
from ledgerloom.operators.temporal import as_of
from ledgerloom.plans.contracts import contract_deliverables, with_contract_lines
from ledgerloom.plans.invoices import approved_invoice_lines, registered_suppliers, remit_emails
from ledgerloom.plans.orders import CONTRACTOR_CATEGORIES
from ledgerloom.plans.payroll import listed_elements
from ledgerloom.site import DEFAULT_SITE, Site
from ledgerloom.sources.catalog import Source, literal_row

#: Source, parameters and, where the list depends on the installation, its site.
List = Callable[..., DataFrame]
LISTS: dict[str, List] = {}


def _list(*ids: str) -> Callable[[List], List]:
    def add(fn: List) -> List:
        LISTS.update({i: fn for i in ids})
        return fn
    return add


def _required(df: DataFrame, c: str | Column, chosen: object) -> DataFrame:
    """A list that depends on another parameter is empty until that one is chosen."""
    keep = optional_in(F.col(c) if isinstance(c, str) else c, chosen)
    return df.filter(F.lit(False) if keep is None else keep)


def _of_table(name: str, *cols: str) -> List:
    def values(src: Source, p: Params) -> DataFrame:
        return list_values(src.scan(name, " ".join(cols)))
    return values


def ordered(src: Source) -> DataFrame:
    """Order distributions that have a shipment, with line and header; no row comes twice."""
    ships = src.scan("po_line_locations_all", "po_header_id po_line_id line_location_id")
    keys = ["po_header_id", "po_line_id", "line_location_id"]
    dists = src.scan("po_distributions_all", "po_header_id po_line_id line_location_id po_distribution_id code_combination_id deliver_to_person_id")
    lines = src.scan("po_lines_all", "po_header_id po_line_id line_num category_id contract_id from_header_id from_line_id")
    heads = src.scan("po_headers_all", "po_header_id segment1:po_number prc_bu_id vendor_id")
    return dists.join(ships, keys, "left_semi").join(lines, ["po_header_id", "po_line_id"]).join(heads, "po_header_id")


def _accounts(src: Source) -> DataFrame:
    return src.scan("gl_code_combinations", "code_combination_id segment2 segment4")


def _activities(src: Source, df: DataFrame, site: Site) -> DataFrame:
    values = (src.scan("fnd_flex_values_vl", "flex_value description value_category")
              .filter(F.col("value_category") == site.code("ACTIVITY")))
    used = df.join(_accounts(src), "code_combination_id")
    return list_values(semi(values, used, [("flex_value", "segment4")]), "description", "flex_value", order=["flex_value"])


def _party_names(src: Source, df: DataFrame) -> DataFrame:
    sellers = src.scan("poz_suppliers", "vendor_id party_id").join(src.scan("hz_parties", "party_id party_name"), "party_id")
    return list_values(df.join(sellers, "vendor_id"), "party_name")


def _unit_names(src: Source, df: DataFrame) -> DataFrame:
    return df.join(src.scan("hr_organization_units_f_tl", "organization_id:prc_bu_id name:unit"), "prc_bu_id")


def periods(df: DataFrame, c: str, label: str, period: str) -> DataFrame:
    """Months of a date column, latest first."""
    months = df.select(F.year(c).alias("_y"), F.month(c).alias("_m"), D.period_label(F.col(c)).alias(label),
                       D.period_name(F.col(c)).alias(period)).distinct()
    return months.orderBy(F.desc_nulls_first("_y"), F.desc_nulls_first("_m")).drop("_y", "_m")


LISTS["L02"] = LISTS["L05"] = _of_table("hr_all_positions_f_vl", "attribute6")
LISTS["L17"] = LISTS["L30"] = LISTS["L47"] = _of_table("po_headers_all", "document_status")
LISTS["L21"] = _of_table("gl_je_sources_b", "je_source_key", "je_source_name")
LISTS["L22"] = _of_table("gl_je_lines", "status")
LISTS["L23"] = LISTS["L48"] = _of_table("gl_code_combinations", "segment2")
LISTS["L24"] = _of_table("gl_code_combinations", "segment3")
LISTS["L26"] = _of_table("gl_code_combinations", "segment1")
LISTS["L27"] = _of_table("gl_code_combinations", "segment4")
LISTS["L28"] = _of_table("gl_code_combinations", "segment5")
LISTS["L39"] = _of_table("hr_all_positions_f_vl", "attribute8")
LISTS["L56"] = _of_table("hr_organization_units_f_tl", "name:org_unit")


@_list("L01")
def fiscal_years(src: Source, p: Params) -> DataFrame:
    return list_values(src.table("ap_invoices_all"), D.fiscal_year_label(F.col("gl_date")).alias("financial_year"))


@_list("L03", "L06")
def bands(src: Source, p: Params) -> DataFrame:
    grades = src.scan("per_grades_f_vl", "grade_id:entry_grade_id grade_code")
    return list_values(src.scan("hr_all_positions_f_vl", "entry_grade_id").join(grades, "entry_grade_id", "left"), "grade_code")


@_list("L04", "L07")
def team_departments(src: Source, p: Params) -> DataFrame:
    posts = src.scan("hr_all_positions_f_vl", "organization_id attribute8 active_status").filter(F.col("active_status") == "A")
    return list_values(_required(posts, "attribute8", p.get("team_group")).join(src.scan("per_departments", "organization_id name"), "organization_id"), "name")


def _used_elements(src: Source) -> DataFrame:
    """The few element types in use, gathered before any shuffle: entries are many and a type holds a large share of them."""
    return src.scan("pay_element_entries_f", "element_type_id").distinct()


@_list("L08")
def element_names(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    listed = listed_elements(src, site).filter(~F.col("element_name").isin(site.label("PSA Union Membership"), site.label("Ex Gratia")))
    listed = _required(listed, "description", p.get("description_type"))
    return list_values(semi(listed, _used_elements(src), [("element_type_id", "element_type_id")]), "element_name")


@_list("L09")
def element_kinds(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    return list_values(semi(listed_elements(src, site), _used_elements(src), [("element_type_id", "element_type_id")]), "description")


@_list("L10", "L31")
def order_cost_centres(src: Source, p: Params) -> DataFrame:
    return list_values(semi(_accounts(src), ordered(src), [("code_combination_id", "code_combination_id")]), "segment2")


@_list("L11")
def order_numbers_of_centre(src: Source, p: Params) -> DataFrame:
    accounts = p.narrow(_accounts(src), costcentre="segment2")
    return list_values(semi(ordered(src), accounts, [("code_combination_id", "code_combination_id")]), F.col("po_number").alias("segment1"))


@_list("L12")
def order_suppliers(src: Source, p: Params) -> DataFrame:
    heads = p.narrow(_unit_names(src, src.scan("po_headers_all", "vendor_id prc_bu_id")), business_unit="unit")
    sellers = src.scan("poz_suppliers", "vendor_id party_id segment1:supplier_num").join(src.scan("hz_parties", "party_id party_name:suppliername"), "party_id")
    return list_values(semi(sellers, heads, [("vendor_id", "vendor_id")]), "suppliername", "supplier_num")


@_list("L13")
def cost_centre_groups(src: Source, p: Params) -> DataFrame:
    return list_values(order_cost_centres(src, p), C.cost_centre_group(F.col("segment2")).alias("cost_centre_group"))


@_list("L14")
def initiators(src: Source, p: Params) -> DataFrame:
    """Names of change originators and the system itself."""
    names = as_of(src.table("per_person_names_f").filter(F.col("name_type") == "GLOBAL"), p.today())
    known = semi(names, src.scan("po_versions", "originator_id"), [("person_id", "originator_id")])
    shown = known.select(F.col("display_name").alias("initiator_name")).unionByName(literal_row(src.spark, initiator_name="System"))
    return list_values(shown)


@_list("L15")
def billed_invoice_numbers(src: Source, p: Params) -> DataFrame:
    sellers = _required(registered_suppliers(src).filter(F.col("registration_number").isNotNull()), "supplier_name", p.get("suppliername"))
    lines = (src.scan("ap_invoice_lines_all", "invoice_id amount line_type_lookup_code discarded_flag")
             .filter(F.col("line_type_lookup_code").isin("ITEM", "TAX") & (F.coalesce("discarded_flag", F.lit("N")) == "N")))
    heads = src.scan("ap_invoices_all", "invoice_id invoice_num invoice_amount approval_status vendor_id").filter(F.col("approval_status") == "APPROVED")
    df = semi(heads, sellers, [("vendor_id", "vendor_id")]).join(lines, "invoice_id")
    return list_values(df.filter((F.col("invoice_amount") != 0) | (F.col("amount") != 0)), "invoice_num")


@_list("L16")
def billed_suppliers(src: Source, p: Params) -> DataFrame:
    return list_values(semi(registered_suppliers(src), remit_emails(src), [("party_id", "party_id"), ("party_site_id", "party_site_id")]), "supplier_name")


@_list("L18")
def contractor_categories(src: Source, p: Params) -> DataFrame:
    return list_values(src.scan("egp_categories_b", "category_code").filter(F.col("category_code").isin(*CONTRACTOR_CATEGORIES)))


@_list("L19")
def order_line_numbers(src: Source, p: Params) -> DataFrame:
    return list_values(_required(ordered(src), "po_number", p.get("po_number")), "line_num")


@_list("L20", "L34", "L50")
def order_numbers(src: Source, p: Params) -> DataFrame:
    return list_values(ordered(src), "po_number")


@_list("L25")
def ledger_periods(src: Source, p: Params) -> DataFrame:
    """Periods, latest first; one with days in several months comes once for each."""
    days = src.table("gl_je_headers").select("period_name", F.year("default_effective_date").alias("_y"), F.month("default_effective_date").alias("_m"))
    return days.distinct().orderBy(F.desc_nulls_first("_y"), F.desc_nulls_first("_m"), "period_name").drop("_y", "_m")


@_list("L29")
def invoice_periods(src: Source, p: Params) -> DataFrame:
    return periods(src.scan("ap_invoices_all", "gl_date"), "gl_date", "period_name", "period_created")


@_list("L32", "L51")
def order_activities(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    return _activities(src, ordered(src), site)


@_list("L33")
def order_parties(src: Source, p: Params) -> DataFrame:
    return _party_names(src, _unit_names(src, ordered(src)))


@_list("L35")
def order_categories(src: Source, p: Params) -> DataFrame:
    return list_values(semi(src.scan("egp_categories_b", "category_code category_id"), ordered(src), [("category_id", "category_id")]), order=["category_id"])


@_list("L36")
def hold_reasons(src: Source, p: Params) -> DataFrame:
    holds = (src.scan("ap_holds_all", "invoice_id hold_lookup_code release_lookup_code")
             .filter(F.col("release_lookup_code").isNull() & (F.col("hold_lookup_code") != "INCOMPLETE INVOICE")))
    held = semi(holds, src.scan("ap_invoices_all", "invoice_id"), [("invoice_id", "invoice_id")])
    codes = src.scan("ap_lookup_codes", "lookup_code lookup_type displayed_field").filter(F.col("lookup_type") == "HOLD CODE")
    return list_values(semi(codes, held, [("lookup_code", "hold_lookup_code")]), "displayed_field")


def _phases(kind: str) -> List:
    def values(src: Source, p: Params) -> DataFrame:
        return list_values(src.scan("irc_phases_vl", "name type_code").filter(F.col("type_code") == kind), "name")
    return values


LISTS["L37"], LISTS["L38"] = _phases("CSW"), _phases("REQUISITION")


# ---- order risk: orders of one cost centre and unit, most lists only if invoiced ----

def risk_orders(src: Source, site: Site, invoiced: bool = True) -> DataFrame:
    accounts = _accounts(src).filter(F.col("segment2") == site.risk_cost_centre)
    orders = _unit_names(src, ordered(src)).filter(F.col("unit") == site.risk_business_unit).join(accounts.drop("segment2", "segment4"), "code_combination_id")
    return semi(orders, approved_invoice_lines(src), [("po_distribution_id", "po_distribution_id")]) if invoiced else orders


@_list("L40")
def risk_order_numbers(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    return list_values(risk_orders(src, site), "po_number")


@_list("L41")
def risk_parties(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    return _party_names(src, risk_orders(src, site))


@_list("L42")
def risk_contract_numbers(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Contracts some order of the centre draws on; a document match needs the same category."""
    orders = risk_orders(src, site, invoiced=False).select("from_header_id", "from_line_id", "contract_id", "po_number", "line_num", "category_id")
    contracts = with_contract_lines(src, contract_deliverables(src), either_id=False)
    links = [[("purchasing_pk1_value", "from_header_id"), ("purchasing_pk2_value", "from_line_id")],
             [("purchasing_pk1_value", "contract_id")],
             [("po_doc_number", "po_number"), ("c_po_line_number", "line_num"), ("purchasing_category_id", "category_id")]]
    return list_values(or_equi_join(contracts, orders, links, ["contract_number"], "left_semi"), "contract_number")


@_list("L43")
def risk_requesters(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    names = src.table("per_person_names_f").filter(F.col("name_type") == "GLOBAL")
    return list_values(semi(names, risk_orders(src, site), [("person_id", "deliver_to_person_id")]), F.col("display_name").alias("requester_name"))


@_list("L44")
def risk_activities(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    return _activities(src, risk_orders(src, site), site)


@_list("L45", "L55")
def contract_start_periods(src: Source, p: Params) -> DataFrame:
    return periods(src.scan("okc_k_headers_all_b", "start_date"), "start_date", "contract_period", "period_started")


@_list("L46")
def contract_end_periods(src: Source, p: Params) -> DataFrame:
    return periods(src.scan("okc_k_headers_all_b", "end_date"), "end_date", "contract_period", "period_end")


@_list("L49")
def requested_parties(src: Source, p: Params) -> DataFrame:
    orders = semi(_unit_names(src, ordered(src)), src.scan("per_person_names_f", "person_id"), [("deliver_to_person_id", "person_id")])
    return _party_names(src, orders)


def _contract_attribute(c: str, name: str) -> List:
    def values(src: Source, p: Params) -> DataFrame:
        heads = src.scan("okc_k_headers_all_b", f"id {c}:{name}")
        return list_values(semi(heads, src.scan("okc_dts_deliverables_b", "chr_id"), [("id", "chr_id")]), name)
    return values


LISTS["L52"], LISTS["L53"] = _contract_attribute("attribute2", "contract_type"), _contract_attribute("attribute4", "contract_group")


@_list("L54")
def order_periods(src: Source, p: Params) -> DataFrame:
    return periods(src.scan("po_headers_all", "creation_date"), "creation_date", "period_name", "period_created")


@_list("L57")
def leaver_categories(src: Source, p: Params) -> DataFrame:
    """Any lookup meaning of the code counts here, and only leavers of the past."""
    left = src.table("per_periods_of_service").filter(F.col("actual_termination_date") < p.today()).select("person_id")
    posts = semi(src.scan("per_all_assignments_m", "person_id employment_category"), left, [("person_id", "person_id")])
    return list_values(semi(src.scan("hcm_lookups", "lookup_code meaning"), posts, [("lookup_code", "employment_category")]), "meaning")


SITE_LISTS = ("L08", "L09", "L32", "L40", "L41", "L42", "L43", "L44", "L51")
