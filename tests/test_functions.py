import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import amounts as A, codes as C, dates as D, text as X
from ledgerloom.functions.params import Params, optional_between, optional_in
from tests.conftest import rows


def one(spark, expr, **cols):
    """Value of an expression on one row of typed columns."""
    df = spark.range(1).select(*(F.lit(v).cast(t).alias(k) for k, (v, t) in cols.items())) if cols else spark.range(1)
    return df.select(expr.alias("v")).first().v


def text(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def dates(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c date")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def test_sentence_case(spark):
    assert text(spark, X.sentence_case, "OPEN", "IN PROCESS", "", None) == ["Open", "In process", "", None]


def test_login_to_name(spark):
    got = text(spark, lambda c: X.login_to_name(c, X.APPROVER_LOGINS), "ann.LEE@corp.org", "nodot@corp", "first.noat", "a.b.c@x",
               "Batch.Scheduler", "ORA_WORKFLOW SYSTEM", None, "x@y.z")
    assert got == ["Ann Lee", " Nodot", "First ", "A B.c", "Batch Scheduler", "Workflow System", " ", "X@y "]


def test_texts_with_null_parts(spark):
    df = spark.createDataFrame([("1", "2", None, "4", "5")], "a string, b string, c string, d string, e string")
    assert df.select(X.cost_code(*(F.col(c) for c in "abcde"))).first()[0] == "1-2--4-5"
    assert text(spark, X.one_line, "a\r\nb", None) == ["a  b", None]
    assert text(spark, lambda c: X.format_groups(c, [3, 3, 3]), "123456789") == ["123-456-789"]
    assert text(spark, X.band_number, "Band_07", "Band_12", "Executive", "Band_x", None) == ["7", "12", "Executive", None, None]
    assert text(spark, X.account_class, "7100", None) == ["7", None]
    assert text(spark, X.flag_off, "N", None, "Y") == [True, True, False]


def test_fiscal_year_edges(spark):
    days = [dt.date(2024, 6, 30), dt.date(2024, 7, 1), dt.date(2024, 12, 31), dt.date(2024, 1, 1), None]
    assert dates(spark, D.fiscal_year_label, *days) == ["2023-2024", "2024-2025", "2024-2025", "2023-2024", None]
    assert dates(spark, D.fiscal_year, *days) == [2023, 2024, 2024, 2023, None]
    assert dates(spark, D.months_left, *days) == [0, 11, 6, 5, None]
    assert dates(spark, D.period_label, days[0]) == ["Jun-24"]


def test_month_ends(spark):
    got = dates(spark, lambda c: D.add_months_keep_end(c, 1), dt.date(2023, 2, 28), dt.date(2024, 2, 28), dt.date(2024, 1, 31), dt.date(2024, 4, 15))
    assert got == [dt.date(2023, 3, 31), dt.date(2024, 3, 28), dt.date(2024, 2, 29), dt.date(2024, 5, 15)]


@pytest.mark.parametrize("start,end,words,months", [
    (dt.date(2020, 1, 1), dt.date(2024, 3, 14), "4 Years 2 Months ", 50),
    (dt.date(2020, 1, 1), dt.date(2024, 3, 15), "4 Years 3 Months ", 51),
    (dt.date(2024, 1, 1), dt.date(2024, 1, 10), "0 Years 0 Months ", 0),
    (dt.date(2023, 1, 31), dt.date(2024, 1, 31), "1 Years 1 Months ", 13),
    (dt.date(2023, 2, 28), dt.date(2024, 2, 29), "1 Years 1 Months ", 13),
])
def test_tenure(spark, start, end, words, months):
    r = spark.range(1).select(D.tenure_text(F.lit(start), F.lit(end)), D.tenure_months(F.lit(start), F.lit(end))).first()
    assert tuple(r) == (words, months)


def test_termination_words(spark):
    at = F.lit(dt.date(2024, 5, 1))
    days = [dt.date(2024, 4, 30), dt.date(2024, 5, 1), dt.date(2024, 5, 2), None]
    assert dates(spark, lambda c: D.termination_status(c, at), *days[:3]) == ["Terminated", "Upcoming Terminations", "Upcoming Terminations"]
    assert dates(spark, lambda c: D.terminated_flag(c, at), *days) == ["Y", "Y", "UT", None]


AMOUNTS = [  # header, line, tax, class -> net, gross, line amount, has number
    (100, 100, 0, "GST ZERO", 100, 100, None),
    (100, 40, 5, "GST EXEMPT", 95, 100, 40),
    (115, 100, 15, "GST 15", 100, 100, None),
    (115, 60, 15, "GST 15", 100, 100, 60),
    (100, 100, None, None, 100, 100, None),
    (0, 0, 0, "GST ZERO", 0, 0, None),
    (100, None, 0, "GST ZERO", 100, 100, None),
]


def test_invoice_amounts(spark):
    df = spark.createDataFrame([(i, *(None if v is None else Decimal(v) for v in r[:3]), r[3]) for i, r in enumerate(AMOUNTS)],
                               "i int, h decimal(18,2), l decimal(18,2), t decimal(18,2), c string")
    parts = [F.col(c) for c in "hltc"]
    got = df.select("i", A.net_invoice_amount(*parts), A.net_invoice_amount(*parts, exempt_multiline="gross"),
                    A.invoice_line_amount(*parts), A.invoice_line_number(*parts, F.lit(7))).orderBy("i").collect()
    for r, want in zip(got, AMOUNTS):
        assert (r[1], r[2]) == (want[4], want[5])
        assert r[3] == want[6]
        assert (r[4] == 7) == (want[6] is not None) or want[1] is None


def test_order_amount_rules(spark):
    money = lambda v: (v, "decimal(18,2)")
    assert [one(spark, A.has_value(F.col("a")), a=money(v)) for v in (None, 0, 1, 1.01)] == ["False", "False", "False", "True"]
    assert one(spark, A.zero_to_null(F.col("a")), a=money(0)) is None
    assert one(spark, A.invoices_remaining(F.col("o"), F.col("s"), F.col("v")), o=money(100), s=money(30), v=(20.0, "double")) == 3
    assert one(spark, A.invoices_remaining(F.col("o"), F.col("s"), F.col("v")), o=money(100), s=money(30), v=(0.0, "double")) is None
    assert one(spark, A.amount_left(F.col("o"), F.col("s")), o=money(100), s=money(None)) == 100
    qty = lambda p, u: one(spark, A.blank_lump_sum(F.lit(5), F.col("p"), F.col("u")), p=money(p), u=(u, "string"))
    assert [qty(1, "hr"), qty(9, "ea"), qty(9, None), qty(9, "hr"), qty(None, "hr")] == [None, None, None, 5, 5]


def test_journal_amount(spark):
    df = spark.createDataFrame([
        (1, Decimal(9), None, None, None, Decimal(1), None), (None, None, None, Decimal(5), None, Decimal(1), Decimal(2)),
        (None, None, 3, Decimal(5), None, Decimal(7), Decimal(2)), (None, None, 3, Decimal(5), None, None, Decimal(2)),
        (None, None, None, None, None, None, None)],
        "inv int, amt decimal(28,10), link int, ed decimal(18,2), ec decimal(18,2), jd decimal(18,2), jc decimal(18,2)")
    got = [r[0] for r in df.select(A.journal_amount(*(F.col(c) for c in df.columns))).collect()]
    assert got == [9, 3, 5, None, 0]


def test_controls(spark):
    cases = [(100000, "Auto Approved", None, "ERROR"), (99999, "Auto Approved", None, None), (100000, "Ann Lee", None, None), (100000, "Auto Approved", "Ann Lee", None)]
    for amount, one_, two, want in cases:
        assert one(spark, A.auto_approval_error(F.lit(amount), F.lit(one_), F.lit(two).cast("string"), F.lit(None))) == want
    s = A.SYSTEM_LOGIN
    assert one(spark, A.intervention_status(F.lit(s), F.lit(s), F.lit(s))) == "No Intervention"
    assert one(spark, A.intervention_status(F.lit(s), F.lit(s), F.lit("x"))) == "Intervention"
    assert [one(spark, A.creation_status(F.lit(a), F.lit(b))) for a, b in ((s, s), (s, "x"), ("x", "x"), ("x", s))] == [
        "System Created Invoice", "Manually Created Invoice", "Manually Created Invoice", None]


def test_code_lists(spark):
    assert text(spark, C.cost_centre_group, "115", "427", "551", "000", None) == [
        "Chief Executive", "System Delivery and Performance", "Tumuaki Te Tāhui", None, None]
    assert text(spark, C.region_number, "PARLMT", "WLG_L9", "AKL_APO", "X") == [9, 9, 2, None]
    assert text(spark, lambda c: C.city(c, F.lit("Other")), "WLG_L6", "AKL_L7", "PARLMT", None) == ["Wellington", "Auckland", "Other", "Other"]
    assert text(spark, C.contact_type, "C", "ORG_PARTNER", "EMRG", "?") == ["Child", "Partner", "Contact not defined", None]
    assert text(spark, C.gender_code, "F", "ORA_HRX_GENDER_DIVERSE", None) == ["F", "D", "U"]
    assert text(spark, C.ethnicity_code, "Māori", "Not Stated", None, "Martian") == [21111, 99999, 99999, None]
    assert text(spark, C.leaving_reason, "42 Redundancy", None, "Own") == [42, 99, None]


@pytest.mark.parametrize("given,want", [
    ((99999, 11111, 21111), (11111, None, None)), ((99999, None, None), (99999, None, None)), ((11111, 11111, 21111), (11111, None, 21111)),
    ((11111, 21111, 21111), (11111, 21111, None)), ((11111, None, 21111), (11111, None, 21111)), ((11111, 21111, 11111), (11111, 21111, None))])
def test_dedupe_answers(spark, given, want):
    df = spark.createDataFrame([given], "a int, b int, c int")
    assert tuple(df.select(*C.dedupe_answers(F.col("a"), F.col("b"), F.col("c"))).first()) == want


def test_management_profile(spark):
    got = [one(spark, C.management_profile(F.lit(n), F.lit(m).cast("string"), F.lit(x).cast("string"))) for n, m, x in (
        ("Chief Executive", None, "Y"), ("Deputy Chief Executive", "Y", "Y"), ("Deputy Chief Executive", "N", "Y"), ("Chief Executive", "Y", None))]
    assert got == [2, 3, None, None]


def test_parameters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, c string")
    assert optional_in(F.col("c"), None) is None and optional_in(F.col("c"), []) is None
    assert rows(Params(chosen={"x": "a"}).narrow(df, x="c"), "i") == [(1,)]
    assert rows(Params(chosen={"x": ["a", "b"]}).narrow(df, x="c"), "i") == [(1,), (2,)]
    assert rows(Params().narrow(df, x="c"), "i") == [(1,), (2,), (3,)]
    days = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2021, 1, 1),), (None,)], "d date")
    assert days.filter(optional_between(F.col("d"), None, None)).count() == 2
    assert days.filter(optional_between(F.col("d"), dt.date(2020, 6, 1), None)).count() == 1
    assert days.filter(optional_between(F.col("d"), None, dt.date(2020, 1, 1))).count() == 1
