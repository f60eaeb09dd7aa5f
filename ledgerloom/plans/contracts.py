"""Contract lines with their owner, and the match of contracts with order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.params import Params, optional_between
from ledgerloom.operators.relational import or_equi_join
from ledgerloom.sources.catalog import Source

# An order line belongs to a contract by agreement line, by contract, or by document and line.
CONTRACT_LINKS = (
    (("from_header_id", "purchasing_pk1_value"), ("from_line_id", "purchasing_pk2_value")),
    (("contract_id", "purchasing_pk1_value"),),
    (("purchase_order_number", "po_doc_number"), ("po_line_number", "c_po_line_number")),
)


def contract_owners(src: Source) -> DataFrame:
    """Administrator of each contract version; only persons known as resources count."""
    contacts = (src.scan("okc_contacts", "cpl_id:role cro_code owner_yn jtot_object1_code object1_id1")
                .filter((F.col("owner_yn") == "Y") & (F.col("cro_code") == "CONTRACT_ADMIN"))
                .select("role", F.when(F.col("jtot_object1_code") == "OKX_RESOURCE", F.col("object1_id1")).alias("party_id")))
    roles = src.scan("okc_k_party_roles_vl", "id:role chr_id major_version")
    return (roles.join(contacts, "role").join(src.scan("hz_parties", "party_id party_name:contract_owner"), "party_id")
            .select("chr_id", "major_version", "contract_owner"))


def contract_deliverables(src: Source) -> DataFrame:
    heads = (src.scan("okc_k_headers_all_b", "id:chr_id contract_number major_version version_type start_date end_date agreed_amount "
                      "estimated_amount attribute2:contract_type attribute4:contract_group"))
    items = (src.scan("okc_dts_deliverables_b", "chr_id cle_id deliverable_status po_doc_number po_line_number:c_po_line_number "
                      "purchasing_pk1_value purchasing_pk2_value")
             .filter(~F.col("deliverable_status").isin("INCOMPLETE", "CANCELED")))
    return heads.join(items, "chr_id")


def with_contract_lines(src: Source, deliverables: DataFrame, either_id: bool = True) -> DataFrame:
    """Left join of the contract line; ``either_id``: the deliverable may name either of two line ids."""
    lines = src.scan("okc_k_lines_b", "chr_id:_l_chr major_version:_l_version id:_l_id line_id line_number line_amount purchasing_category_id")
    base = (("chr_id", "_l_chr"), ("major_version", "_l_version"))
    links = [(*base, ("cle_id", "line_id"))] + ([(*base, ("cle_id", "_l_id"))] if either_id else [])
    return or_equi_join(deliverables, lines, links, ["chr_id", "major_version", "cle_id"]).drop("_l_chr", "_l_version", "_l_id")


def contract_lines(src: Source, either_id: bool = True) -> DataFrame:
    """Current contract versions x open deliverables x contract lines."""
    current = contract_deliverables(src).filter(F.col("version_type") == "C")
    return (with_contract_lines(src, current, either_id)
            .join(contract_owners(src), ["chr_id", "major_version"], "left")
            .select("chr_id", "po_doc_number", "purchasing_pk2_value", "contract_number", "c_po_line_number", "purchasing_pk1_value",
                    F.col("major_version").alias("contract_version"), F.col("estimated_amount").alias("total_contract_value"),
                    "start_date", "end_date", "contract_type", "contract_group", "contract_owner", "line_id",
                    F.col("line_number").alias("contract_line_number"),
                    F.coalesce("line_amount", "agreed_amount").alias("contract_line_amount"), "purchasing_category_id"))


def order_line_links(src: Source, p: Params | None = None, created: bool = False, **columns: str) -> DataFrame:
    """Of each order line, what may link it to a contract.

    ``columns``: parameters that narrow a report by a column of the order's header; ``created``: so do the report's dates.
    """
    heads = src.scan("po_headers_all", "po_header_id segment1 document_status creation_date")
    if p is not None:
        heads = p.narrow(heads, **columns)
    if created:
        heads = heads.filter(optional_between(F.col("creation_date"), p.date_from, p.date_to))
    lines = src.scan("po_lines_all", "po_header_id po_line_id line_num:po_line_number contract_id from_header_id from_line_id")
    return lines.join(heads.select("po_header_id", F.col("segment1").alias("purchase_order_number")), "po_header_id")


def match_contracts(orders: DataFrame, contracts: DataFrame, how: str = "left", probes: DataFrame | None = None, sift: bool = False) -> DataFrame:
    """Order lines (by ``po_line_id``) with the contracts they draw on.

    ``sift`` pays where order lines outnumber contracts by far; it computes the contracts once more.
    """
    return or_equi_join(orders, contracts, CONTRACT_LINKS, ["po_line_id"], how, probes, sift)
