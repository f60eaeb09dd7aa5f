"""Hand-made rows through report steps, expected rows written by hand."""

import datetime as dt
import functools
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.params import Params
from ledgerloom.plans import contracts, invoices, ledger, people, recruitment, versions
from ledgerloom.sources.catalog import FrameSource, StandInSource
from tests.conftest import rows

D = dt.date
ALWAYS = (D(1990, 1, 1), D(4712, 12, 31))


def frames(spark, **tables):
    return FrameSource(spark, {name: spark.createDataFrame(data, schema) for name, (schema, data) in tables.items()})


def test_approvers_by_date_not_by_text(spark):
    def act(invoice, day, who, response="APPROVED", kind="DOCUMENTAPPROVAL"):
        return invoice, dt.datetime(*day), who, response, kind
    src = frames(spark, ap_inv_aprvl_hist_all=(
        "invoice_id int, action_date timestamp, approver_id string, response string, history_type string", [
            # 2 December comes before 15 January although "02-12" < "15-01" would say otherwise for the reverse year
            act(1, (2024, 1, 15), "b.two@x"), act(1, (2023, 12, 2), "a.one@x"), act(1, (2023, 12, 1), "b.two@x"),
            act(2, (2024, 1, 1), "any", "ORA_AUTO APPROVED"),
            act(3, (2024, 1, 1), "a.a@x"), act(3, (2024, 1, 2), "b.b@x"), act(3, (2024, 1, 3), "c.c@x"), act(3, (2024, 1, 4), "d.d@x"),
            act(4, (2024, 1, 1), "a.a@x", "REJECTED"), act(5, (2024, 1, 1), "a.a@x", kind="OTHER")]))
    assert rows(invoices.approvers(src)) == [(1, "A One", "B Two", None), (2, "Auto Approved", None, None), (3, "A A", "B B", "C C")]


def test_spend_counts_an_invoice_once(spark):
    lines = spark.createDataFrame([
        (7, 1, D(2023, 6, 30), Decimal(10), Decimal(99)), (7, 1, D(2023, 6, 30), Decimal(5), Decimal(99)),
        (7, 2, D(2023, 7, 1), None, Decimal(30)), (8, 3, D(2023, 7, 1), None, None)],
        "po_distribution_id int, invoice_id int, gl_date date, invoice_line_amount decimal(18,2), invoice_amount decimal(18,2)")
    got = rows(invoices.po_spend(lines, F.lit(D(2024, 1, 1))))
    assert got == [(7, Decimal("45.00"), Decimal("30.00"), 2, 22.5), (8, Decimal("0.00"), Decimal("0.00"), 1, 0.0)]


def contract_source(spark):
    head = "id int, contract_number string, major_version int, version_type string, start_date date, end_date date, agreed_amount decimal(18,2), " \
           "estimated_amount decimal(18,2), attribute2 string, attribute4 string"

    def h(i, kind="C", version=1):
        return i, f"C{i}", version, kind, *ALWAYS, Decimal(100), Decimal(200), "type", "group"
    item = "chr_id int, cle_id int, deliverable_status string, po_doc_number string, po_line_number int, purchasing_pk1_value int, purchasing_pk2_value int"
    return frames(
        spark,
        okc_k_headers_all_b=(head, [h(1), h(2), h(3, "H"), h(4)]),
        okc_dts_deliverables_b=(item, [
            (1, 11, "COMPLETED", None, None, 50, 5), (2, 21, "COMPLETED", "PO9", 1, None, None), (2, 29, "CANCELED", "PO9", 1, None, None),
            (3, 31, "COMPLETED", None, None, 50, 5), (4, None, "COMPLETED", "PO9", 2, 60, None)]),
        okc_k_lines_b=("chr_id int, id int, line_id int, line_number int, major_version int, line_amount decimal(18,2), purchasing_category_id int", [
            (1, 11, 77, 1, 1, Decimal(10), 1), (1, 88, 11, 2, 1, None, 1), (1, 11, 11, 3, 2, Decimal(5), 1)]),
        okc_k_party_roles_vl=("id int, chr_id int, major_version int", [(1, 1, 1), (2, 2, 1)]),
        okc_contacts=("cpl_id int, cro_code string, owner_yn string, jtot_object1_code string, object1_id1 int", [
            (1, "CONTRACT_ADMIN", "Y", "OKX_RESOURCE", 500), (2, "CONTRACT_ADMIN", "Y", "OTHER", 500)]),
        hz_parties=("party_id int, party_name string", [(500, "Owner")]))


def test_contract_lines(spark):
    src = contract_source(spark)
    cols = ("contract_number", "contract_line_number", "contract_line_amount", "contract_owner")
    assert rows(contracts.contract_lines(src), *cols) == [
        ("C1", 1, Decimal(10), "Owner"), ("C1", 2, Decimal(100), "Owner"), ("C2", None, Decimal(100), None), ("C4", None, Decimal(100), None)]
    assert rows(contracts.contract_lines(src, either_id=False), *cols)[0] == ("C1", 2, Decimal(100), "Owner")


def test_contract_match_once_per_pair(spark):
    src = contract_source(spark)
    orders = spark.createDataFrame([
        (1, "PO1", 1, 50, 5, 50), (2, "PO9", 1, None, None, None), (3, "PO9", 2, None, None, 60), (4, "PO8", 1, 50, 6, None)],
        "po_line_id int, purchase_order_number string, po_line_number int, from_header_id int, from_line_id int, contract_id int")
    got = rows(contracts.match_contracts(orders, contracts.contract_lines(src, either_id=False)), "po_line_id", "contract_number")
    assert got == [(1, "C1"), (2, "C2"), (3, "C4"), (4, None)]


@pytest.mark.parametrize("first,second,occupant,requisition,want", [
    ("ACTIVE", None, 1, None, "Position Occupied"), ("ACTIVE", "ACTIVE", 1, None, "Position Occupied"), ("SUSPENDED", None, 1, None, "Position Suspended"),
    ("SUSPENDED", "ACTIVE", 1, 2, "Position Backfilled"), ("ACTIVE", "SUSPENDED", 1, None, "Position Backfilled"), ("SUSPENDED", "SUSPENDED", 1, None, None),
    (None, None, None, 2, "Position in Active-Recruitment"), (None, None, None, None, "Position Vacant")])
def test_position_status(spark, first, second, occupant, requisition, want):
    df = spark.createDataFrame([(first, second, occupant, requisition)], "a string, b string, c int, d int")
    assert df.select(people.position_status(*(F.col(c) for c in "abcd"))).first()[0] == want


def test_vacancy_status(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(recruitment.vacancy_status(F.col("a"), F.col("b"))).collect()] == ["Occupied", "Active-Recruitment", "Vacant"]


@pytest.mark.parametrize("case,want", [
    ((1, "Y", "ACTIVE", "ORG_FIX_TERM"), True), ((1, "Y", "ACTIVE", "ORG_PARENTAL_LEAVE"), False), ((1, "Y", "SUSPENDED", "ORG_PARENTAL_LEAVE"), True),
    ((1, "N", "ACTIVE", "ORG_FIX_TERM"), False), ((2, "N", "SUSPENDED", "ORG_SUBSTANTIVE_POSITION"), True), ((2, "Y", "ACTIVE", "ORG_SUBSTANTIVE_POSITION"), True),
    ((2, "Y", "SUSPENDED", "ORG_SUBSTANTIVE_POSITION"), False), ((3, "Y", "ACTIVE", "ORG_INTERNAL_SECONDMENT"), False)])
def test_eligible_assignment(spark, case, want):
    df = spark.createDataFrame([case], "n int, p string, s string, c string")
    assert df.select(people.eligible_assignment(*(F.col(c) for c in "npsc"))).first()[0] is want


def test_latest_contact_details(spark):
    span = "effective_start_date date, effective_end_date date"
    late = (D(2020, 1, 1), ALWAYS[1])
    src = frames(
        spark,
        per_person_addr_usages_f=(f"person_id int, address_id int, address_type string, {span}", [
            (1, 10, "HOME", *ALWAYS), (1, 11, "HOME", *late), (1, 12, "HOME", *late), (1, 13, "WORK", *late), (2, 20, "WORK", *late)]),
        per_addresses_f=(f"address_id int, address_line_1 string, address_line_2 string, address_line_3 string, town_or_city string, postal_code string, "
                         f"country string, {span}", [(i, "1 Road", "Flat" if i == 12 else None, None, "W", "6011", "NZ", *ALWAYS) for i in (10, 11, 12, 13, 20)]),
        per_email_addresses=("person_id int, email_type string, email_address string, date_from date", [
            (1, "H1", "old@h", D(2019, 1, 1)), (1, "H1", "new@h", D(2020, 1, 1)), (1, "W1", "work@w", D(2020, 1, 1)), (2, "W1", "only@w", D(2020, 1, 1))]),
        per_phones=("person_id int, phone_type string, phone_number string", [(1, "HM", "1"), (1, "WM", "2")]))
    at = F.lit(D(2021, 1, 1))
    address, mail, phone = people.latest_contact_details(src, at)
    assert rows(address, "person_id", "address_id", "address_line_1") == [(1, 11, "1 Road"), (1, 12, "1 Road,Flat")]
    assert rows(mail) == [(1, "new@h")] and rows(phone) == [(1, "1")]
    address, mail, _ = people.latest_contact_details(src, at, same_type_only=False)
    assert rows(address, "address_id") == [(11,), (12,), (13,)] and rows(mail, "email_address") == [("new@h",), ("work@w",)]


@pytest.mark.parametrize("header,line,want", [
    (None, None, "Header Amended"), ("Changed", None, "Header Amended"), ("New", None, None), ("Cancelled", None, None), ("New", "New", "Original Document"),
    (None, "New", "Line Created"), ("Changed", "New", "Line Created"), ("Cancelled", "New", None), ("New", "Changed", "Line Amended"), (None, "CANCELLED", "Line Amended")])
def test_amendment(spark, header, line, want):
    df = spark.createDataFrame([(header, line)], "h string, l string")
    assert df.select(versions.amendment(F.col("h"), F.col("l"))).first()[0] == want


def test_statuses_of_versions(spark):
    df = spark.createDataFrame([("Y", 0, 1, "I"), ("N", 1, 1, "I"), ("N", 1, 1, "U"), ("N", 0, 1, "I"), ("N", 1, 1, "X")], "c string, f int, v int, e string")
    args = [F.col(c) for c in "cfve"]
    assert [r[0] for r in df.select(versions.header_status(*args)).collect()] == ["Cancelled", "New", "Changed", None, None]
    assert [r[0] for r in df.select(versions.line_status(*args)).collect()] == ["Changed", "New", "Changed", "Changed", None]


def test_branches_read_wanted_documents_only(spark, small):
    """Every branch meets the wanted keys next to its scan, and gives the rows that it gives for them without."""
    src = StandInSource(spark, small)
    every = {b.__name__: b(src) for b in ledger.BRANCHES}
    ids = [d.select("entity_code", F.col("appl_id").alias("application_id"), F.col("invoice_id").alias("id")).filter(F.col("invoice_id") % 7 == 0) for d in every.values()]
    wanted = functools.reduce(DataFrame.unionByName, ids).distinct().cache()
    for branch in ledger.BRANCHES:
        got = branch(src, wanted)
        want = every[branch.__name__].filter(F.col("invoice_id") % 7 == 0)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        # the reduction is below every other join of the branch
        depth = [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join LeftSemi" in line]
        others = [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join Inner" in line]
        assert depth and all(max(depth) > o for o in others[:1])
    wanted.unpersist()


def test_mixed_entry_lines(spark):
    entries = spark.createDataFrame([(1, 1, 10), (1, 1, 10), (1, 2, 10), (1, 2, 11)], "ae_header_id int, ae_line_num int, po_header_id int")
    assert rows(ledger.mixed_entry_lines(entries)) == [(1, 2, True)]


def test_salary_must_start_inside_its_assignment(spark):
    span = "effective_start_date date, effective_end_date date"
    src = frames(
        spark,
        per_all_assignments_m=(f"assignment_id int, grade_id int, effective_latest_change string, assignment_type string, {span}", [
            (1, 3, "Y", "E", D(2020, 1, 1), D(2020, 12, 31)), (1, 4, "Y", "E", D(2021, 1, 1), ALWAYS[1]), (2, 5, "Y", "C", *ALWAYS), (3, 6, "N", "E", *ALWAYS)]),
        cmp_salary=("person_id int, assignment_id int, salary_amount int, annual_ft_salary int, fte_value int, salary_basis_id int, date_from date, date_to date", [
            (9, 1, 50, 50, 1, 1, D(2020, 12, 31), D(2021, 5, 31)), (9, 1, 60, 60, 1, 1, D(2021, 6, 1), ALWAYS[1]), (9, 2, 70, 70, 1, 1, *ALWAYS), (9, 3, 80, 80, 1, 1, *ALWAYS)]))
    assert rows(people.current_salary(src, F.lit(D(2021, 5, 31))), "grade_id", "salary_amount") == [(3, 50)]
    assert rows(people.current_salary(src, F.lit(D(2021, 6, 1))), "grade_id", "salary_amount") == [(4, 60)]


def test_unset_run_date_is_today(spark):
    assert spark.range(1).select(Params().today()).first()[0] == spark.sql("SELECT current_date()").first()[0]
