"""Payables: approved invoice lines, approvers, spend, holds and buyer-created invoices."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import amounts as A, dates as D, text as X
from ledgerloom.functions.params import Params
from ledgerloom.operators.relational import left_join_skewed, pack_texts
from ledgerloom.operators.temporal import as_of
from ledgerloom.operators.windows import global_row_number, numbered_slots, slot_pivot, top_n
from ledgerloom.session import step
from ledgerloom.site import DEFAULT_SITE, Site
from ledgerloom.sources.catalog import Source

ITEM = ("ITEM",)
ITEM_AND_MISC = ("ITEM", "MISCELLANEOUS")


def approved_invoice_lines(src: Source, types: Sequence[str] = ITEM, exempt_multiline: str = "gross", orders: DataFrame | None = None,
                           complete: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Approved invoice x kept line x distribution, with the amount rules applied.

    ``orders`` (by po_distribution_id) is left-joined to the distributions and ``complete`` applied to the headers, while both are
    narrow, so that wide lines are not shuffled for them; each is a step of its own.
    """
    lines = (src.scan("ap_invoice_lines_all",
                      "invoice_id line_number amount:line_amount tax_classification_code line_type_lookup_code discarded_flag "
                      "created_by:line_created_by last_updated_by:line_last_updated_by creation_date:invoice_line_creation_date "
                      "description:invoice_line_description period_name po_line_id")
             .filter(F.col("line_type_lookup_code").isin(*types) & (F.col("discarded_flag") == "N")))
    dists = (src.scan("ap_invoice_distributions_all",
                      "invoice_id:_d_invoice invoice_line_number:_d_line po_distribution_id invoice_distribution_id "
                      "distribution_line_number line_type_lookup_code:_d_type")
             .filter(F.col("_d_type").isin(*types)).drop("_d_type"))
    if orders is not None:
        # lines without an order have no distribution
        ordered = left_join_skewed(dists, orders, ["po_distribution_id"])
        dists = step(src.spark, lambda: ordered)
    heads = (src.scan("ap_invoices_all",
                      "invoice_id invoice_num invoice_amount:header_amount total_tax_amount approval_status invoice_date gl_date "
                      "created_by creation_date:invoice_creation_date description:invoice_desc payment_status_flag org_id "
                      "vendor_id accts_pay_code_combination_id")
             .filter(F.col("approval_status") == "APPROVED"))
    if complete is not None:
        completed = complete(heads)
        heads = step(src.spark, lambda: completed)
    parts = [F.col(c) for c in ("header_amount", "line_amount", "total_tax_amount", "tax_classification_code")]
    own_line = (F.col("invoice_id") == F.col("_d_invoice")) & (F.col("line_number") == F.col("_d_line"))
    # completed headers come first, so that they and the distributions meet the lines in one layout
    df = lines.join(dists, own_line).join(heads, "invoice_id") if complete is None else lines.join(heads, "invoice_id").join(dists, own_line)
    return (df
            .withColumns({
                "invoice_amount": A.net_invoice_amount(*parts, exempt_multiline=exempt_multiline),
                "invoice_line_amount": A.invoice_line_amount(*parts),
                "invoice_line_number": A.invoice_line_number(*parts, F.col("line_number")),
            }).drop("_d_invoice", "_d_line"))


def spend_amount() -> Column:
    return F.coalesce("invoice_line_amount", "invoice_amount")


def po_spend(lines: DataFrame, as_at: Column) -> DataFrame:
    """Per order distribution: total, this fiscal year's total, number of invoices and their average."""
    this_year = D.fiscal_year(F.col("gl_date")) == D.fiscal_year(as_at)
    total, count = F.sum(spend_amount()), F.count_distinct("invoice_id")
    zero = F.lit(0).cast("decimal(38,2)")
    return lines.groupBy("po_distribution_id").agg(
        F.coalesce(total.cast("decimal(38,2)"), zero).alias("total_po_spend"),
        F.coalesce(F.sum(F.when(this_year, spend_amount()).otherwise(F.lit(0))).cast("decimal(38,2)"), zero).alias("total_po_spend_current_fy"),
        count.alias("invoice_count"),
        F.coalesce(A.ratio(total, count), F.lit(0.0)).alias("avg_invoice_amt"))


def latest_invoice_dates(lines: DataFrame) -> DataFrame:
    return lines.groupBy("po_distribution_id").agg(
        D.dmy(F.max("invoice_date")).alias("latest_inv_date"),
        D.dmy(F.max("invoice_creation_date")).alias("latest_inv_creation_date"))


def approvers(src: Source, slots: int = 3) -> DataFrame:
    """The first approvers of each invoice, each counted once by the day of the latest action."""
    history = (src.scan("ap_inv_aprvl_hist_all", "invoice_id action_date approver_id response history_type")
               .filter((F.col("history_type") == "DOCUMENTAPPROVAL")
                       & F.col("response").isin("MANUALLY APPROVED", "APPROVED", "ORA_AUTO APPROVED")))
    name = F.when(F.col("response") == "ORA_AUTO APPROVED", F.lit("Auto Approved")).otherwise(
        X.login_to_name(F.col("approver_id"), X.APPROVER_LOGINS))
    latest = history.groupBy("invoice_id", name.alias("approved_by")).agg(
        F.max(F.to_date("action_date")).alias("action_day"))
    first = top_n(latest, ["invoice_id"], [F.asc_nulls_last("action_day"), F.asc_nulls_last("approved_by")], slots, "n")
    return slot_pivot(first, ["invoice_id"], "n", numbered_slots("approver_", "approved_by", slots))


def distribution_orders(src: Source) -> DataFrame:
    """Order number and line of each order distribution."""
    lines = src.scan("po_lines_all", "po_header_id:_h po_line_id:_l line_num:po_line_number")
    heads = src.scan("po_headers_all", "po_header_id segment1:purchase_order_number")
    return (src.scan("po_distributions_all", "po_distribution_id po_header_id po_line_id")
            .join(lines, (F.col("po_header_id") == F.col("_h")) & (F.col("po_line_id") == F.col("_l")))
            .join(heads, "po_header_id").drop("_h", "_l", "po_line_id"))


def orders_per_invoice(src: Source, slots: int = 6) -> DataFrame:
    """The first orders each invoice draws on, in order of their number."""
    pairs = (src.scan("ap_invoice_distributions_all", "invoice_id po_distribution_id")
             .join(distribution_orders(src), "po_distribution_id")
             .select("invoice_id", "purchase_order_number", "po_header_id").distinct())
    first = top_n(pairs, ["invoice_id"], [F.asc_nulls_last("purchase_order_number"), F.asc("po_header_id")], slots, "n")
    return slot_pivot(first, ["invoice_id"], "n", numbered_slots("po_", "purchase_order_number", slots))


def _unit_and_supplier(src: Source, df: DataFrame, unit_key: str, supplier: str = "left") -> DataFrame:
    parties = src.scan("hz_parties", "party_id party_name:supplier_name")
    suppliers = src.scan("poz_suppliers", "vendor_id party_id segment1:supplier_num").join(parties, "party_id", supplier).drop("party_id")
    units = src.scan("hr_organization_units_f_tl", f"organization_id:{unit_key} name:business_unit")
    return df.join(suppliers, "vendor_id", supplier).join(units, unit_key)


def invoice_entry(src: Source, p: Params) -> DataFrame:
    """Who entered and approved each invoice, its first orders, and the control check."""
    accounts = src.scan("gl_code_combinations", "code_combination_id:accts_pay_code_combination_id segment2:cost_centre")
    lines = approved_invoice_lines(src, ITEM_AND_MISC, "net").filter(F.col("invoice_amount") != 0)
    heads = (lines.select(
        "invoice_id", "invoice_num", "invoice_amount", "invoice_date", D.fiscal_year_label(F.col("gl_date")).alias("fy"), "created_by",
        "invoice_creation_date", "gl_date", "invoice_desc", "payment_status_flag", "vendor_id", "org_id", "accts_pay_code_combination_id")
        .distinct())
    df = _unit_and_supplier(src, heads, "org_id").join(accounts, "accts_pay_code_combination_id")
    df = p.narrow(df, bus_unit="business_unit", financial_year="fy")
    df = df.join(approvers(src), "invoice_id", "left").join(orders_per_invoice(src), "invoice_id", "left")
    one, two, three = (F.col(f"approver_{i}") for i in (1, 2, 3))
    out = df.select(
        "invoice_id", "invoice_num", "invoice_amount", D.dmy(F.col("invoice_date")).alias("invoice_date"), "fy",
        X.login_to_name(F.col("created_by")).alias("created_by"), D.dmy(F.col("invoice_creation_date")).alias("invoice_creation_date"),
        D.dmy(F.col("gl_date")).alias("gl_date"), "invoice_desc", "payment_status_flag", "supplier_name", "supplier_num",
        F.coalesce(one, F.lit("Not Required")).alias("approver_1"), "approver_2", "approver_3", "business_unit", "cost_centre",
        *(f"po_{i}" for i in range(1, 7)),
        A.auto_approval_error(F.col("invoice_amount"), one, two, three).alias("autoapprovererror")).drop("cost_centre").distinct()
    numbered = global_row_number(out, ["invoice_id", "invoice_amount"], "unique_row_number", 999)
    return numbered.orderBy(F.asc_nulls_last("invoice_num"))


def invoice_entry_lines(src: Source, p: Params) -> DataFrame:
    """Line level: did anyone step into what the system created?"""
    def complete(heads: DataFrame) -> DataFrame:
        wanted = heads.filter(F.col("header_amount") != 0).withColumn("fy", D.fiscal_year_label(F.col("gl_date")))
        return p.narrow(_unit_and_supplier(src, wanted, "org_id"), bus_unit="business_unit", financial_year="fy").drop(
            "org_id", "vendor_id", "approval_status", "accts_pay_code_combination_id")

    df = approved_invoice_lines(src, ITEM_AND_MISC, "net", distribution_orders(src).drop("po_header_id"), complete)
    by, line_by, changed_by = (F.col(c) for c in ("created_by", "line_created_by", "line_last_updated_by"))
    out = df.select(
        "invoice_id", "period_name", "invoice_num", "invoice_amount", D.dmy(F.col("invoice_date")).alias("invoice_date"), "created_by",
        D.dmy(F.col("invoice_creation_date")).alias("invoice_creation_date"), D.dmy(F.col("gl_date")).alias("gl_date"),
        D.dmy(F.col("invoice_line_creation_date")).alias("invoice_line_creation_date"), "invoice_desc", "payment_status_flag",
        "invoice_line_description", "po_distribution_id", "line_created_by", "line_last_updated_by", "invoice_line_amount",
        "invoice_line_number", A.intervention_status(by, line_by, changed_by).alias("intervention_status"),
        A.creation_status(by, line_by).alias("creation_status"), "purchase_order_number", "po_line_number", "business_unit", "fy",
        "supplier_num", "supplier_name")
    rows, texts = pack_texts(out, ["invoice_num"])
    return texts(rows.orderBy(F.asc_nulls_last("invoice_num"), F.asc_nulls_last("invoice_line_number"))).select(*out.columns)


def spend_per_distribution(src: Source, p: Params) -> DataFrame:
    return po_spend(approved_invoice_lines(src), p.today()).drop("avg_invoice_amt")


def invoices_of_orders(src: Source, p: Params) -> DataFrame:
    """One row per invoice and order distribution."""
    return (approved_invoice_lines(src)
            .groupBy("invoice_id", "invoice_num", "invoice_desc", "po_distribution_id", "created_by",
                     D.dmy(F.col("invoice_date")).alias("invoice_date"))
            .agg(F.sum(spend_amount()).cast("decimal(38,2)").alias("invoice_amount")))


def open_holds(src: Source, p: Params, keep_unmatched: bool = False) -> DataFrame:
    """Unreleased holds with the order line and the requester; holds without a current requester drop out.

    ``keep_unmatched`` keeps them, and those without an order line: the outer joins as they were meant, with the requester's
    date test inside the join.
    """
    holds = (src.scan("ap_holds_all", "invoice_id hold_lookup_code hold_reason line_location_id release_lookup_code")
             .filter(F.col("release_lookup_code").isNull()).drop("release_lookup_code"))
    codes = (src.scan("ap_lookup_codes", "lookup_code:hold_lookup_code lookup_type description:lookup_description displayed_field")
             .filter(F.col("lookup_type") == "HOLD CODE").drop("lookup_type"))
    heads = (src.scan("ap_invoices_all", "invoice_id invoice_num invoice_amount invoice_date description:invoice_description created_by vendor_id org_id")
             .filter(F.col("invoice_amount") != 0))
    notes = src.scan("zmm_notes", "source_object_uid:invoice_id note_txt:note")
    held = _unit_and_supplier(src, heads.join(holds, "invoice_id").join(codes, "hold_lookup_code"), "org_id", "inner")
    held = p.narrow(held, holdreason="displayed_field", businessunit="business_unit").join(notes, "invoice_id", "left")
    places = src.scan("po_line_locations", "line_location_id po_header_id po_line_id")
    # where the requester must exist today, every step to it is an inner join
    how = "left" if keep_unmatched else "inner"
    dists = src.scan("po_distributions_all", "po_header_id po_line_id line_location_id deliver_to_person_id:person_id")
    names = as_of(src.table("per_person_names_f").filter(F.col("name_type") == "GLOBAL"), p.today()).select(
        "person_id", F.col("display_name").alias("requestor_name"))
    lines = src.scan("po_lines_all", "po_header_id po_line_id line_num")
    orders = src.scan("po_headers_all", "po_header_id segment1")
    asked = (places.join(lines, ["po_header_id", "po_line_id"], how).join(dists, ["po_header_id", "po_line_id", "line_location_id"], how)
             .join(names, "person_id", how).join(orders, "po_header_id", "left")
             .select("line_location_id", "segment1", "line_num", "requestor_name"))
    found = left_join_skewed(held, asked, ["line_location_id"]) if keep_unmatched else held.join(asked, "line_location_id")
    return found.select(
        D.dmy(F.col("invoice_date")).alias("invoice_date"), "invoice_id", "invoice_num", "invoice_amount", "invoice_description",
        X.login_to_name(F.col("created_by")).alias("created_by"), "hold_lookup_code", "hold_reason", "lookup_description",
        "displayed_field", "line_location_id", "supplier_name", "supplier_num", "business_unit", "note", "segment1", "line_num",
        "requestor_name")


def remit_emails(src: Source) -> DataFrame:
    return (src.scan("iby_external_payees_all", "payee_party_id:party_id party_site_id supplier_site_id:vendor_site_id remit_advice_email")
            .filter(F.col("remit_advice_email").isNotNull()).distinct())


def supplier_bank_accounts(src: Source) -> DataFrame:
    """Bank account of a payee site: payee -> instrument -> owner -> account -> branch."""
    payees = (src.scan("iby_external_payees_all", "ext_payee_id payee_party_id:owner supplier_site_id:vendor_site_id payment_function")
              .filter(F.col("payment_function") == "PAYABLES_DISB"))
    uses = (src.scan("iby_pmt_instr_uses_all", "ext_pmt_party_id:ext_payee_id instrument_id:account instrument_type")
            .filter(F.col("instrument_type") == "BANKACCOUNT"))
    owners = src.scan("iby_account_owners", "account_owner_party_id:owner ext_bank_account_id:account")
    accounts = src.scan("iby_ext_bank_accounts", "ext_bank_account_id:account bank_account_num account_suffix branch_id")
    branches = src.scan("ce_bank_branches_v", "branch_party_id:branch_id bank_number branch_number")
    return (payees.join(uses, "ext_payee_id").join(owners, ["owner", "account"])
            .join(accounts, "account", "left").join(branches, "branch_id", "left")
            .select("vendor_site_id", F.col("owner").alias("invoice_party_id"), F.col("account").alias("external_bank_account_id"),
                    X.join_text("-", [F.col(c) for c in ("bank_number", "branch_number", "bank_account_num", "account_suffix")])
                    .alias("bank_account_number")))


def registered_suppliers(src: Source) -> DataFrame:
    """Suppliers billed by the buyer, with their sites and tax registrations."""
    return (src.scan("poz_suppliers", "vendor_id party_id segment1:supplier_num vendor_type_lookup_code")
            .filter(F.col("vendor_type_lookup_code") == "BCI_SUPPLIER").drop("vendor_type_lookup_code")
            .join(src.scan("hz_parties", "party_id party_name:supplier_name"), "party_id")
            .join(src.scan("hz_party_sites", "party_id party_site_id party_site_name:supplier_address"), "party_id")
            .join(src.scan("zx_party_tax_profile", "party_id party_tax_profile_id"), "party_id")
            .join(src.scan("zx_registrations", "party_tax_profile_id registration_number effective_from effective_to tax_regime_code"),
                  "party_tax_profile_id"))


def buyer_created_invoices(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Invoices the buyer writes for the supplier: lines with tax, registration and bank account."""
    suppliers = p.narrow(registered_suppliers(src).filter(
        F.col("registration_number").isNotNull() & F.col("effective_to").isNull()), suppliername="supplier_name")
    heads = p.narrow(src.scan(
        "ap_invoices_all", "invoice_id invoice_num invoice_amount invoice_date created_by creation_date gl_date description:invoice_desc "
        "payment_status_flag approval_status vendor_id vendor_site_id org_id party_id:invoice_party_id external_bank_account_id")
        .filter((F.col("approval_status") == "APPROVED") & (F.col("invoice_amount") != 0)), invoicenum="invoice_num")
    lines = (src.scan("ap_invoice_lines_all", "invoice_id line_number amount:invoice_line_amount line_type_lookup_code discarded_flag period_name "
                      "creation_date:line_creation_date description:invoice_line_description created_by:line_created_by "
                      "last_updated_by:line_last_updated_by")
             .filter(F.col("line_type_lookup_code").isin("ITEM", "TAX") & X.flag_off(F.col("discarded_flag"))
                     & (F.col("invoice_line_amount") != 0)))
    dists = (src.scan("ap_invoice_distributions_all", "invoice_id invoice_line_number:line_number amount reversal_flag po_distribution_id")
             .filter(X.flag_off(F.col("reversal_flag")) & (F.col("amount") != 0)))
    units = src.scan("hr_organization_units_f_tl", "organization_id:org_id name:business_unit")
    orders = distribution_orders(src).select("purchase_order_number", "po_distribution_id").distinct()
    df = (heads.join(suppliers, "vendor_id")
          .join(remit_emails(src), ["party_id", "party_site_id", "vendor_site_id"])
          .join(supplier_bank_accounts(src), ["vendor_site_id", "invoice_party_id", "external_bank_account_id"])
          .join(units, "org_id").join(lines.join(dists, ["invoice_id", "line_number"]), "invoice_id"))
    df = left_join_skewed(df, orders, ["po_distribution_id"])  # tax lines have no distribution of an order
    tax_number = None
    for unit, number in site.buyer_tax_number.items():
        tax_number = (F if tax_number is None else tax_number).when(F.col("business_unit") == unit, F.lit(number))
    return df.select(
        "invoice_id", "period_name", "invoice_num", "invoice_amount", D.dmy(F.col("invoice_date")).alias("invoice_date"), "created_by",
        D.dmy(F.col("creation_date")).alias("invoice_creation_date"), D.dmy(F.col("gl_date")).alias("gl_date"),
        D.dmy(F.col("line_creation_date")).alias("invoice_line_creation_date"), "invoice_desc", "payment_status_flag",
        "invoice_line_description", "line_created_by", "line_last_updated_by", "line_type_lookup_code",
        X.tax_line_code(F.col("line_type_lookup_code")).alias("line_code"), "invoice_line_amount", "line_number", "business_unit",
        "supplier_num", "supplier_name", "supplier_address", "tax_regime_code",
        X.format_groups(F.col("registration_number"), [3, 3, 3]).alias("supplier_gst"), "effective_from",
        tax_number.alias("buyer_gst"), F.lit(site.buyer_name).alias("buyer_name"), F.lit(site.buyer_address).alias("buyer_address"),
        "remit_advice_email", "po_distribution_id", "purchase_order_number", "party_id", "party_site_id", "bank_account_number",
    ).orderBy("invoice_id", "line_number")
