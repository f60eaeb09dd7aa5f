"""Purchase orders with shipments, distributions, contracts and spend."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import amounts as A, dates as D, text as X
from ledgerloom.functions.params import Params, optional_between
from ledgerloom.operators.relational import with_group_count
from ledgerloom.operators.temporal import as_of
from ledgerloom.plans.contracts import contract_lines, match_contracts, order_line_links
from ledgerloom.plans.invoices import approved_invoice_lines, latest_invoice_dates, po_spend
from ledgerloom.session import step
from ledgerloom.site import DEFAULT_SITE, Site
from ledgerloom.sources.catalog import Source

# What the reports on all orders show or compute from.
_PLACES = "purchase_order_number po_line_number document_status line_status comments creation_date business_unit supplier_name supplier_num"
_CONTRACT = "contract_number contract_line_number contract_line_amount contract_group contract_owner start_date end_date"
CONTRACTOR_COLUMNS = (f"{_PLACES} {_CONTRACT} category_code assessable_value quantity uom_code tax_exclusive_price receipt_required_flag segment1 "
                      "segment2 segment3 segment4 segment5 activity_name closed_date need_by_date item_description requestor_name total_po_spend")
DETAIL_COLUMNS = (f"{_PLACES} {_CONTRACT} category_code ordered quantity_accepted receipt_required_flag po_value cost_codes activity_name "
                  "requestor_name total_po_spend avg_invoice_amt invoice_count po_total_lines")
WITH_CONTRACTS_COLUMNS = (f"{_PLACES} {_CONTRACT} category_id from_header_id from_line_id contract_id item_description currency_code ordered received "
                          "quantity_accepted quantity_rejected billed quantity_cancelled receipt_required_flag po_value input_tax_classification_code "
                          "cost_codes activity_name requestor_name party_number need_by_date contract_version total_contract_value contract_type "
                          "line_id latest_inv_date latest_inv_creation_date")
BY_ORDER_COLUMNS = f"{_PLACES} category_code ordered quantity_accepted receipt_required_flag po_value cost_codes activity_name party_number"

# Purchase categories of contractors and consultants.
CONTRACTOR_CATEGORIES = ("AOG - Contractors", "AOG - Other Professional Services", "AOG_-_Consultancy")


def po_shipments(df: DataFrame) -> DataFrame:
    """Zero means unknown in shipment amounts; amounts stand before quantities."""
    clean = {c: A.zero_to_null(F.col(c)) for c in ("amount_received", "quantity_received", "amount_billed", "quantity_billed")}
    return (df.withColumns({**clean, "po_value": A.has_value(F.col("assessable_value")),
                            "ordered": A.zero_to_null(F.col("assessable_value"))})
            .withColumns({"received": F.coalesce("amount_received", "quantity_received"),
                          "billed": F.coalesce("amount_billed", "quantity_billed")}))


def _heads(src: Source) -> DataFrame:
    return src.scan("po_headers_all", "po_header_id segment1:purchase_order_number prc_bu_id vendor_id document_status currency_code "
                    "comments creation_date closed_date")


def _lines(src: Source) -> DataFrame:
    return src.scan("po_lines_all", "po_header_id po_line_id line_num:po_line_number line_status category_id item_description "
                    "contract_id from_header_id from_line_id")


def _dists(src: Source) -> DataFrame:
    return src.scan("po_distributions_all", "po_header_id po_line_id line_location_id po_distribution_id code_combination_id "
                    "deliver_to_person_id")


def _ships(src: Source) -> DataFrame:
    return po_shipments(src.scan(
        "po_line_locations_all", "po_header_id po_line_id line_location_id assessable_value amount_received quantity_received "
        "amount_billed quantity_billed quantity quantity_accepted quantity_rejected quantity_cancelled tax_exclusive_price uom_code "
        "input_tax_classification_code receipt_required_flag need_by_date"))


def _on_lines(lines: DataFrame, ships: DataFrame, dists: DataFrame) -> DataFrame:
    """In the layout of the line, so each is shuffled once."""
    return lines.join(ships, ["po_header_id", "po_line_id"]).join(dists, ["po_header_id", "po_line_id", "line_location_id"])


def po_chain(src: Source, heads: DataFrame | None = None, lines: DataFrame | None = None, dists: DataFrame | None = None) -> DataFrame:
    """Header x line x shipment x distribution; each part may come with further columns.

    Lines, shipments and distributions meet in the layout of the line; the header comes last.
    """
    return (_on_lines(_lines(src) if lines is None else lines, _ships(src), _dists(src) if dists is None else dists)
            .join(_heads(src) if heads is None else heads, "po_header_id"))


def with_requester(src: Source, df: DataFrame, p: Params) -> DataFrame:
    names = as_of(src.table("per_person_names_f").filter(F.col("name_type") == "GLOBAL"), p.today())
    return df.join(names.select(F.col("person_id").alias("deliver_to_person_id"), F.col("display_name").alias("requestor_name")),
                   "deliver_to_person_id")


def with_accounts(src: Source, df: DataFrame) -> DataFrame:
    codes = src.scan("gl_code_combinations", "code_combination_id segment1 segment2 segment3 segment4 segment5")
    return df.join(codes, "code_combination_id").withColumn(
        "cost_codes", X.cost_code(*(F.col(f"segment{i}") for i in range(1, 6))))


def with_activity(src: Source, df: DataFrame, category: str | None) -> DataFrame:
    values = src.scan("fnd_flex_values_vl", "flex_value:segment4 description:activity_name value_category")
    if category:
        values = values.filter(F.col("value_category") == category)
    return df.join(values.drop("value_category"), "segment4")


def with_category(src: Source, df: DataFrame) -> DataFrame:
    return df.join(src.scan("egp_categories_b", "category_id category_code"), "category_id")


def with_buyer_and_supplier(src: Source, df: DataFrame) -> DataFrame:
    suppliers = (src.scan("poz_suppliers", "vendor_id party_id segment1:supplier_num")
                 .join(src.scan("hz_parties", "party_id party_name:supplier_name party_number"), "party_id").drop("party_id"))
    units = src.scan("hr_organization_units_f_tl", "organization_id:prc_bu_id name:business_unit")
    return df.join(units, "prc_bu_id").join(suppliers, "vendor_id")


def _status_columns() -> dict:
    return {"status": X.sentence_case(F.col("document_status")), "po_line_status": X.sentence_case(F.col("line_status")),
            "po_description": F.trim("comments")}


#: Of each part of the chain: what a report drops before the parts meet.
Keep = Mapping[str, Callable[[DataFrame], DataFrame]]
LINKS = frozenset({"po_header_id", "po_line_id", "line_location_id", "po_distribution_id"})


def _order_lines(src: Source, p: Params, activity: str | None, requester: bool = True, category: bool = True, contracts: DataFrame | None = None,
                 probes: DataFrame | None = None, spend: DataFrame | None = None, counts: DataFrame | None = None, shown: str | None = None,
                 keep: Keep | None = None) -> DataFrame:
    """The chain with what its parts look up.

    Every lookup stands next to the part that holds its key, where rows are narrow: accounts, activity, requester and ``spend``
    (by distribution) at the distribution, category and ``contracts`` at the line, buyer, supplier and the number of lines at the header.

    ``shown`` names the columns that a report of all orders uses.  The parts are then completed and put together in steps, so that the
    disk holds the shuffle files of one of them at a time; ``keep`` drops rows of "heads", "lines", "ships" and "dists" before
    they are written.
    """
    def part(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if shown is None:
            return build()
        wanted = {*shown.split(), *LINKS}

        def narrow() -> DataFrame:
            df = (keep or {}).get(name, lambda df: df)(build())
            return df.select(*(c for c in df.columns if c in wanted))
        return narrow() if name == "ships" else step(src.spark, narrow)

    def heads() -> DataFrame:
        df = with_buyer_and_supplier(src, _heads(src))
        return df if counts is None else with_group_count(df, counts, ("po_header_id", "po_header_id"), "po_total_lines")

    def lines() -> DataFrame:
        df = with_category(src, _lines(src)) if category else _lines(src)
        return df if contracts is None else match_contracts(df, contracts, probes=probes)

    def dists() -> DataFrame:
        df = with_activity(src, with_accounts(src, _dists(src)), activity)
        df = with_requester(src, df, p) if requester else df
        return df if spend is None else df.join(spend if shown is None else step(src.spark, lambda: spend), "po_distribution_id", "left")

    if shown is None:
        return po_chain(src, heads(), lines(), dists()).withColumns(_status_columns())
    # the parts of the line are dropped as soon as they have met
    chain = step(src.spark, lambda: _on_lines(part("lines", lines), part("ships", lambda: _ships(src)), part("dists", dists)))
    return chain.join(part("heads", heads), "po_header_id").withColumns(_status_columns())


def contractor_orders(src: Source, p: Params) -> DataFrame:
    """Orders in contractor categories with contract and spend between two dates."""
    def rows() -> DataFrame:
        spent = po_spend(approved_invoice_lines(src).filter(
            optional_between(F.col("gl_date"), p.get("inv_date_from"), p.get("inv_date_to"))), p.today())
        df = _order_lines(
            src, p, None, contracts=contract_lines(src), probes=order_line_links(src, p, created=True, po_status="document_status"),
            spend=spent.select("po_distribution_id", "total_po_spend"), shown=CONTRACTOR_COLUMNS, keep={
                "heads": lambda df: p.narrow(df.filter(optional_between(F.col("creation_date"), p.date_from, p.date_to)),
                                             business_unit="business_unit", po_status="document_status"),
                "lines": lambda df: p.narrow(df.filter(F.col("category_code").isin(*CONTRACTOR_CATEGORIES)), categorycode="category_code"),
                "ships": lambda df: df.filter(F.col("assessable_value") != 0)})
        price, unit = F.col("tax_exclusive_price"), F.col("uom_code")
        return df.select(
            "purchase_order_number", "po_header_id", "po_line_number", "category_code", F.col("status").alias("postatus"), "po_line_status",
            F.col("assessable_value").alias("po_ordered_amount"), A.blank_lump_sum(F.col("quantity"), price, unit).alias("quantity"),
            A.blank_lump_sum(unit, price, unit, need_unit=False).alias("uom_code"), A.blank_lump_sum(price, price, unit).alias("price"),
            "receipt_required_flag", F.col("segment1").alias("entity"), F.col("segment2").alias("cost_centre"),
            F.col("segment3").alias("natural_account"), F.col("segment4").alias("activity"), F.col("segment5").alias("future"),
            "activity_name", F.col("business_unit").alias("businessunit"), "supplier_name", "supplier_num",
            D.dmy(F.col("creation_date")).alias("po_creation_date"), D.dmy(F.col("closed_date")).alias("po_closed_date"),
            D.dmy(F.col("need_by_date")).alias("po_need_by_date"), "po_description", "item_description", "requestor_name",
            "po_distribution_id", F.coalesce("total_po_spend", F.lit(0).cast("decimal(38,2)")).alias("po_spend"),
            F.col("contract_number").alias("contracts_num"), "contract_line_number", "contract_line_amount", "contract_group",
            "contract_owner", D.dmy(F.col("start_date")).alias("contract_start_date"), D.dmy(F.col("end_date")).alias("contract_end_date"))

    return step(src.spark, rows).orderBy(F.asc_nulls_last("purchase_order_number"), F.asc_nulls_last("po_line_number"))


def _spend_columns(p: Params) -> list:
    ordered, spent, average = F.col("ordered"), F.col("total_po_spend"), F.col("avg_invoice_amt")
    return [spent.alias("po_amount_spent"), A.amount_left(ordered, spent).alias("po_amount_left"),
            F.coalesce("invoice_count", F.lit(0).cast("bigint")).alias("invoice_count"), average.alias("po_avg_invoice_amt"),
            A.invoices_remaining(ordered, spent, average).alias("invoices_remaining"),
            D.months_left(p.today()).alias("months_left_in_financial_year")]


def _detail_columns(p: Params, extra: list) -> list:
    return ["purchase_order_number", "po_header_id", "po_line_number", *extra, F.col("category_code").alias("categorycode"),
            F.col("status").alias("po_status"), "po_line_status", F.col("ordered").alias("po_ordered_amount"), "quantity_accepted",
            "receipt_required_flag", F.col("po_value").alias("purchase_order_value"), "cost_codes", "activity_name", "business_unit",
            "supplier_name", "supplier_num", D.dmy(F.col("creation_date")).alias("creation_date"), "po_description", "requestor_name",
            F.col("contract_number").alias("contracts_num"), "contract_line_number", "contract_line_amount", "contract_group",
            "contract_owner", D.dmy(F.col("start_date")).alias("contract_start_date"),
            D.dmy(F.col("end_date")).alias("contract_end_date"), "po_distribution_id", *_spend_columns(p)]


def order_detail(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Orders with contract, spend and an outlook on the invoices still possible."""
    df = _order_lines(src, p, site.code("ACTIVITY"), contracts=contract_lines(src, either_id=False), probes=order_line_links(src, p, po_number="segment1"),
                      spend=po_spend(approved_invoice_lines(src), p.today()), counts=src.scan("po_lines_all", "po_header_id"), shown=DETAIL_COLUMNS, keep={
                          "heads": lambda df: p.narrow(df, po_number="purchase_order_number"),
                          "lines": lambda df: p.narrow(df, po_line_num="po_line_number")})
    total = F.when(F.col("po_line_number").isNull(), F.lit(0)).otherwise(F.col("po_total_lines")).cast("bigint")
    return df.select(*_detail_columns(p, [total.alias("po_total_lines"), "po_line_id"]))


def order_risk(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """The same for one cost centre and unit, orders above the placeholder value only."""
    orders = _order_lines(src, p, site.code("ACTIVITY")).filter(
        (F.col("segment2") == site.risk_cost_centre) & (F.col("business_unit") == site.risk_business_unit)
        & (F.col("po_value") == "True"))
    orders = p.narrow(orders, documentstatus="document_status", party_name="supplier_name", po_number="purchase_order_number",
                      activity="segment4", requester_name="requestor_name")
    df = match_contracts(orders, contract_lines(src), probes=order_line_links(src, p, documentstatus="document_status", po_number="segment1"))
    df = p.narrow(df, contract_number="contract_number", contract_start_period=D.period_name(F.col("start_date")),
                  contract_end_period=D.period_name(F.col("end_date")))
    df = df.join(po_spend(approved_invoice_lines(src), p.today()), "po_distribution_id", "left")
    return df.select(*_detail_columns(p, []))


def orders_with_contracts(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    def rows() -> DataFrame:
        probes = order_line_links(src, p, created=True, documentstatus="document_status", po_number="segment1")
        df = _order_lines(
            src, p, site.code("ACTIVITY"), category=False, contracts=contract_lines(src), probes=probes,
            spend=latest_invoice_dates(approved_invoice_lines(src)), shown=WITH_CONTRACTS_COLUMNS, keep={
                "heads": lambda df: p.narrow(
                    df.filter(optional_between(F.col("creation_date"), p.date_from, p.date_to)), documentstatus="document_status",
                    party_name="supplier_name", business_unit="business_unit", po_number="purchase_order_number",
                    period_name=D.period_name(F.col("creation_date"))),
                "lines": lambda df: p.narrow(df, contract_type="contract_type", contract_period=D.period_name(F.col("start_date"))),
                "ships": lambda df: p.narrow(df, po_value="po_value"),
                "dists": lambda df: p.narrow(df, costcentre="segment2", activity="segment4")})
        return df.select(
            F.col("purchase_order_number").alias("ponumber"), "po_header_id", "po_line_number", "category_id", "from_header_id", "from_line_id",
            "contract_id", F.col("item_description").alias("line_description"), F.col("status").alias("document_status"), "po_line_status",
            "currency_code", F.col("ordered").alias("assessable_value"), F.col("received").alias("quantity_received"), "quantity_accepted",
            "quantity_rejected", F.col("billed").alias("quantity_billed"), "quantity_cancelled", "receipt_required_flag",
            F.col("po_value").alias("povalue"), "input_tax_classification_code", "po_distribution_id", "cost_codes",
            F.col("activity_name").alias("description"), F.col("requestor_name").alias("full_name"),
            F.col("business_unit").alias("businessunit"), "supplier_name", "party_number", "supplier_num",
            D.dmy(F.col("creation_date")).alias("creation_date"), F.upper(D.period_name(F.col("creation_date"))).alias("po_start_period"),
            D.dmy(F.col("need_by_date")).alias("po_need_by_date"), F.col("po_description").alias("comments"), "contract_number",
            "contract_version", "total_contract_value", D.dmy(F.col("start_date")).alias("contract_start_date"),
            D.dmy(F.col("end_date")).alias("contract_end_date"), F.upper(D.period_name(F.col("start_date"))).alias("contract_start_period"),
            F.col("contract_type").alias("contracttype"), "contract_group", "contract_owner", "line_id",
            F.col("contract_line_number").alias("con_line_number"), F.col("contract_line_amount").alias("con_line_amount"),
            "latest_inv_date", "latest_inv_creation_date")

    return step(src.spark, rows).orderBy(*(F.asc_nulls_last(c) for c in ("ponumber", "po_line_number", "contract_number", "con_line_number")))


def invoices_by_order(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Order distributions with the invoice lines charged to them."""
    def rows() -> DataFrame:
        def orders() -> DataFrame:
            return _order_lines(src, p, site.code("ACTIVITY"), requester=False, shown=BY_ORDER_COLUMNS, keep={
                "heads": lambda df: p.narrow(df, documentstatus="document_status", party_name="supplier_name", po_number="purchase_order_number"),
                "lines": lambda df: p.narrow(df, category_code="category_id"),
                "ships": lambda df: p.narrow(df, po_value="po_value"),
                "dists": lambda df: p.narrow(df, costcentre="segment2", activity="segment4")})

        lines = p.narrow(approved_invoice_lines(src), period_name=D.period_name(F.col("gl_date"))).select(
            "po_distribution_id", "invoice_id", "invoice_line_number", "period_name", "invoice_num", "invoice_amount", "invoice_line_amount",
            "invoice_date", "gl_date", "invoice_creation_date", "invoice_line_creation_date", "invoice_desc", "payment_status_flag",
            "invoice_line_description")
        return step(src.spark, orders).join(step(src.spark, lambda: lines), "po_distribution_id").select(
            "purchase_order_number", "po_header_id", "po_line_number", F.col("category_code").alias("categorycode"),
            F.col("status").alias("document_status"), "po_line_status", F.col("ordered").alias("assessable_value"), "quantity_accepted",
            "receipt_required_flag", F.col("po_value").alias("purchase_order_value"), "cost_codes", F.col("activity_name").alias("description"),
            "business_unit", "supplier_name", "party_number", "supplier_num", D.dmy(F.col("creation_date")).alias("creation_date"),
            "po_description", "po_distribution_id", "invoice_id", "invoice_line_number", F.col("period_name").alias("period"), "invoice_num",
            "invoice_amount", "invoice_line_amount", D.dmy(F.col("invoice_date")).alias("invoice_date"),
            D.dmy(F.col("gl_date")).alias("gl_date"), F.upper(D.period_name(F.col("gl_date"))).alias("gl_date_period"),
            D.fiscal_year_label(F.col("gl_date")).alias("fy"), D.dmy(F.col("invoice_creation_date")).alias("invoice_creation_date"),
            D.dmy(F.col("invoice_line_creation_date")).alias("invoice_line_creation_date"), "invoice_desc", "payment_status_flag",
            "invoice_line_description")

    return step(src.spark, rows).orderBy(*(F.asc_nulls_last(c) for c in (
        "purchase_order_number", "po_line_number", "invoice_num", "invoice_line_number", "period")))
