"""Single operators on the test tables, or on one step of a report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgerloom.checks.registry import register
from ledgerloom.checks.reports_finance import SPEND, bills, contracts, d, login
from ledgerloom.checks.reports_ledger import AUDIT
from ledgerloom.checks.reports_people import dims, on
from ledgerloom.functions import amounts as A, codes as C, dates as D, text as X
from ledgerloom.functions.params import Params, optional_between
from ledgerloom.operators import relational as R, temporal as T, windows as W
from ledgerloom.plans import contracts as K, invoices as I, ledger as L, lists as V, orders as O, people as P, recruitment as Q, versions as Z
from ledgerloom.sources.catalog import Source, literal_row

AT = dt.date(1998, 6, 30)
MAR = Params(as_at=dt.date(1998, 3, 1))
JUN = Params(as_at=AT)
BILLS = f"WITH {bills(chr(39) + 'ITEM' + chr(39), 'gross')}"

# an effective-dated history: closed, open and empty intervals, several valid at once
HIST = """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, cast(o_orderdate AS date) AS b,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN date '4712-12-31'
                ELSE cast(o_orderdate AS date) + cast(o_orderkey % 700 - 20 AS int) END AS e
           FROM {orders}"""


def hist(s: Source) -> DataFrame:
    return s.query(HIST)


# ---- projections, filters, scalar rules ----

register("plain_filters", lambda s: s.table("orders").withColumn(
    "size", F.when(F.col("o_totalprice") > 300000, "big").when(F.col("o_totalprice") > 100000, "mid").otherwise("small")).filter(
    F.col("size").isin("big", "mid") & ~F.col("o_orderstatus").isin("P") & (F.col("o_orderpriority") != "5-LOW")
    & F.col("o_orderpriority").startswith("1") & F.col("o_custkey").isNotNull()).select(
    "o_orderkey", F.col("o_custkey").alias("customer"), "size", F.lit("NZD").alias("currency"), F.lit(None).cast("string").alias("note"))
    .orderBy(F.desc_nulls_first("size"), F.asc_nulls_last("o_orderkey")),
    """SELECT o_orderkey, o_custkey AS customer, if(o_totalprice > 300000, 'big', 'mid') AS size, 'NZD' AS currency, cast(NULL AS varchar) AS note
       FROM {orders} WHERE o_totalprice > 100000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'""")

register("param_filters", lambda s: Params(chosen={"segment": ["BUILDING", "MACHINERY"], "nothing": [], "nation": 7}).narrow(
    s.table("customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("MACHINERY"))), segment="segment", nothing="c_name").filter(
    optional_between(F.date_add(F.lit(AT), F.col("c_nationkey")), None, dt.date(1998, 7, 20)) & X.flag_off(F.nullif(F.lit("N"), F.col("segment")))),
    """SELECT *, 'BUILDING' AS segment FROM {customer} WHERE c_mktsegment = 'BUILDING' AND c_nationkey <= 20""")

register("fiscal_year", lambda s: s.table("orders").select(
    "o_orderkey", D.fiscal_year_label(F.col("o_orderdate")).alias("fy"), D.fiscal_year(F.col("o_orderdate")).cast("bigint").alias("fy_start"),
    D.months_left(F.col("o_orderdate")).cast("bigint").alias("left_months"), D.period_label(F.col("o_orderdate")).alias("period"),
    F.upper(D.period_name(F.col("o_orderdate"))).alias("period_name"), D.dmy(F.col("o_orderdate"), "/").alias("day")),
    """WITH y AS (SELECT *, year(o_orderdate) - if(month(o_orderdate) < 7, 1, 0) AS y, month(o_orderdate) AS m FROM {orders})
       SELECT o_orderkey, y || '-' || (y + 1) AS fy, y AS fy_start, if(m >= 7, 12 - m + 6, 6 - m) AS left_months, strftime(o_orderdate, '%b-%y') AS period,
              upper(strftime(o_orderdate, '%B-%y')) AS period_name, strftime(o_orderdate, '%d/%m/%Y') AS day FROM y""")

register("status_text", lambda s: s.table("part").withColumn("note", F.concat(F.lit(" a\r\n"), "p_name", F.lit(" "))).select(
    "p_partkey", X.sentence_case(F.concat("p_type", F.lit(" "), "p_brand")).alias("status"),
    X.cost_code(F.col("p_brand"), F.nullif("p_type", F.lit("PROMO")), F.nullif(F.col("p_size"), F.lit(5))).alias("code"),
    X.one_line(F.col("note")).alias("one_line"), F.trim(F.translate("note", "\r\n", "")).alias("trimmed"), X.account_class(F.col("p_size")).alias("class"),
    X.band_number(F.concat(F.when(F.col("p_size") % 2 == 0, "Band_0").otherwise("Level_"), F.col("p_size").cast("string"))).alias("band")),
    """SELECT p_partkey, upper(t[1]) || lower(t[2:]) AS status,
              p_brand || '-' || coalesce(nullif(p_type, 'PROMO'), '') || '-' || coalesce(cast(nullif(p_size, 5) AS varchar), '') AS code,
              ' a  ' || p_name || ' ' AS one_line, 'a' || p_name AS trimmed, cast(p_size AS varchar)[1] AS class,
              if(p_size % 2 = 0, cast(p_size AS varchar), 'Level_' || p_size) AS band
       FROM (SELECT *, p_type || ' ' || p_brand AS t FROM {part})""")

_LOGIN = """SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'Batch.Scheduler' WHEN c_custkey % 50 = 1 THEN 'ORA_WORKFLOW SYSTEM' WHEN c_custkey % 7 = 0 THEN NULL
              WHEN c_custkey % 7 = 1 THEN 'nodot@corp.org' WHEN c_custkey % 7 = 2 THEN 'two.dots.here@corp.org' WHEN c_custkey % 7 = 3 THEN 'first.noat'
              ELSE c_mktsegment || '.name' || cast(c_custkey AS string) || '@corp.org' END AS login FROM {customer}"""
register("login_to_name", lambda s: s.query(_LOGIN).select(
    "c_custkey", X.login_to_name(F.col("login")).alias("shown"), X.login_to_name(F.col("login"), X.APPROVER_LOGINS).alias("approver")),
    f"""WITH x AS (SELECT *, coalesce(login, '') AS t, strpos(coalesce(login, ''), '.') AS p, strpos(coalesce(login, ''), '@') AS a FROM ({_LOGIN})),
        y AS (SELECT *, if(p > 1, left(t, p - 1), '') AS one, if(a - p > 1, substr(t, p + 1, a - p - 1), '') AS two FROM x),
        z AS (SELECT *, upper(left(one, 1)) || lower(substr(one, 2)) || ' ' || upper(left(two, 1)) || lower(substr(two, 2)) AS nm FROM y)
        SELECT c_custkey, if(login = 'Batch.Scheduler', 'Batch Scheduler', nm) AS shown,
               CASE login WHEN 'Batch.Scheduler' THEN 'Batch Scheduler' WHEN 'ORA_WORKFLOW SYSTEM' THEN 'Workflow System' ELSE nm END AS approver FROM z""")

_CODES = """SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN '115' WHEN 1 THEN '427' WHEN 2 THEN '835' WHEN 3 THEN '000' END AS centre,
             CASE c_custkey % 5 WHEN 0 THEN 'WLG_L9' WHEN 1 THEN 'AKL_APO' WHEN 2 THEN 'PARLMT' WHEN 3 THEN 'X' END AS place,
             CASE c_custkey % 4 WHEN 0 THEN 'FULL_TIME' WHEN 1 THEN 'PART_TIME' WHEN 2 THEN 'CASUAL' END AS hours,
             CASE c_custkey % 6 WHEN 0 THEN 'C' WHEN 1 THEN 'ORG_NCR' WHEN 2 THEN 'EMRG' WHEN 3 THEN 'ORG_RELATIVE' WHEN 4 THEN '?' END AS kind,
             CASE c_custkey % 4 WHEN 0 THEN 'ORA_HRX_GENDER_DIVERSE' WHEN 1 THEN 'F' WHEN 2 THEN 'M' END AS sex,
             CASE c_custkey % 3 WHEN 0 THEN '42 Redundancy' WHEN 1 THEN 'Own words' END AS why,
             CASE c_custkey % 3 WHEN 0 THEN 'Fixed Term' WHEN 1 THEN 'Parental Leave' ELSE 'Other' END AS cat FROM {customer}"""
register("code_maps", lambda s: s.query(_CODES).select(
    "c_custkey", C.cost_centre_group(F.col("centre")).alias("centre_group"), C.city(F.col("place"), F.lit("elsewhere")).alias("city"),
    C.region_number(F.col("place")).alias("region"), C.working_time(F.col("hours")).alias("hours"), C.contact_type(F.col("kind")).alias("kind"),
    C.gender_code(F.col("sex")).alias("sex"), C.leaving_reason(F.col("why")).alias("why"), C.assignment_status(F.col("cat")).alias("status")),
    f"""SELECT c_custkey, CASE centre WHEN '115' THEN 'Chief Executive' WHEN '427' THEN 'System Delivery and Performance'
                 WHEN '835' THEN 'Solutions Design and Implementation' END AS centre_group,
               CASE place WHEN 'WLG_L9' THEN 'Wellington' WHEN 'AKL_APO' THEN 'Auckland' ELSE 'elsewhere' END AS city,
               CASE place WHEN 'WLG_L9' THEN 9 WHEN 'PARLMT' THEN 9 WHEN 'AKL_APO' THEN 2 END AS region,
               CASE hours WHEN 'FULL_TIME' THEN 'Full Time' WHEN 'PART_TIME' THEN 'Part Time' ELSE hours END AS hours,
               CASE kind WHEN 'C' THEN 'Child' WHEN 'ORG_NCR' THEN 'Contact not defined' WHEN 'EMRG' THEN 'Contact not defined'
                 WHEN 'ORG_RELATIVE' THEN 'Relative' END AS kind,
               CASE sex WHEN 'ORA_HRX_GENDER_DIVERSE' THEN 'D' ELSE coalesce(sex, 'U') END AS sex,
               CASE why WHEN '42 Redundancy' THEN 42 WHEN 'Own words' THEN NULL ELSE 99 END AS why,
               CASE cat WHEN 'Fixed Term' THEN 1 WHEN 'Parental Leave' THEN 4 END AS status FROM ({_CODES})""")

register("term_profile", lambda s: s.table("orders").select(
    "o_orderkey", C.contract_term(F.when(F.col("o_orderstatus") == "F", "ORG_FIX_TERM")).alias("term"),
    C.management_profile(F.when(F.col("o_orderkey") % 2 == 0, "Chief Executive X").otherwise("Deputy Chief Executive"),
                         F.when(F.col("o_orderkey") % 3 == 0, "Y"), F.when(F.col("o_orderkey") % 5 < 3, "Y")).alias("profile"),
    X.tax_line_code(F.when(F.col("o_orderkey") % 7 == 0, "TAX").otherwise("ITEM")).alias("line_code")),
    """SELECT o_orderkey, if(o_orderstatus = 'F', 1, 2) AS term,
              CASE WHEN o_orderkey % 5 >= 3 THEN NULL WHEN o_orderkey % 2 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 3 END AS profile,
              CASE WHEN o_orderkey % 7 = 0 THEN 'GST' END AS line_code FROM {orders}""")

register("mask_columns", lambda s: R.mask_columns(s.table("customer"), ["c_acctbal", "c_name"], F.col("c_mktsegment").isin("BUILDING", "MACHINERY")),
         """SELECT c_custkey, CASE WHEN h THEN NULL ELSE c_name END AS c_name, c_nationkey, CASE WHEN h THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
            FROM (SELECT *, c_mktsegment IN ('BUILDING', 'MACHINERY') AS h FROM {customer})""")

register("bank_text", lambda s: s.table("supplier").select(
    "s_suppkey", X.format_groups(F.col("s_suppkey") + 123456000, [3, 3, 3]).alias("tax_number"),
    X.join_text("-", [F.lit("01"), F.col("s_nationkey"), F.nullif(F.col("s_suppkey") % 4, F.lit(0))]).alias("account")),
    """SELECT s_suppkey, n[1:3] || '-' || n[4:6] || '-' || n[7:9] AS tax_number,
              '01-' || s_nationkey || '-' || coalesce(cast(nullif(s_suppkey % 4, 0) AS varchar), '') AS account
       FROM (SELECT *, cast(s_suppkey + 123456000 AS varchar) AS n FROM {supplier})""")
register("supplier_bank_accounts", lambda s: I.supplier_bank_accounts(s).join(I.remit_emails(s).select("vendor_site_id", "remit_advice_email"), "vendor_site_id"),
         """SELECT y.supplier_site_id AS vendor_site_id, w.account_owner_party_id AS invoice_party_id, w.ext_bank_account_id AS external_bank_account_id,
                   concat(b.bank_number, '-', b.branch_number, '-', a.bank_account_num, '-', a.account_suffix) AS bank_account_number, y.remit_advice_email
            FROM {iby_external_payees_all} y JOIN {iby_pmt_instr_uses_all} t ON t.ext_pmt_party_id = y.ext_payee_id
            JOIN {iby_account_owners} w ON w.account_owner_party_id = y.payee_party_id AND w.ext_bank_account_id = t.instrument_id
            LEFT JOIN {iby_ext_bank_accounts} a USING (ext_bank_account_id) LEFT JOIN {ce_bank_branches_v} b ON b.branch_party_id = a.branch_id
            WHERE y.payment_function = 'PAYABLES_DISB' AND t.instrument_type = 'BANKACCOUNT' AND y.remit_advice_email IS NOT NULL""")

# ---- amounts ----

register("net_invoice_amount", lambda s: I.approved_invoice_lines(s).select("invoice_id", "line_number", "invoice_amount", "invoice_line_amount", "invoice_line_number")
         .unionByName(I.approved_invoice_lines(s, exempt_multiline="net").select("invoice_id", (-F.col("line_number")).alias("line_number"), "invoice_amount", "invoice_line_amount", "invoice_line_number")),
         f"""{BILLS} SELECT invoice_id, line_number * sign AS line_number, if(sign > 0 OR NOT untaxed OR gross = amount, shown, net) AS invoice_amount,
               if(own, amount, NULL) AS invoice_line_amount, if(own, line_number, NULL) AS invoice_line_number
             FROM (SELECT *, unnest([1, -1]) AS sign FROM bill)""")
register("po_spend", lambda s: I.po_spend(I.approved_invoice_lines(s), MAR.today()),
         f"{BILLS}, {SPEND} SELECT po_distribution_id, total_po_spend, total_po_spend_current_fy, invoice_count, average AS avg_invoice_amt FROM spend")
register("remaining_invoices", lambda s: O.po_shipments(s.table("po_line_locations_all")).join(
    I.po_spend(I.approved_invoice_lines(s), MAR.today()).withColumnRenamed("po_distribution_id", "line_location_id"), "line_location_id", "left").select(
    "line_location_id", "ordered", "po_value", "received", "billed", A.amount_left(F.col("ordered"), F.col("total_po_spend")).alias("left_amount"),
    A.invoices_remaining(F.col("ordered"), F.col("total_po_spend"), F.col("avg_invoice_amt")).alias("more_invoices"),
    A.blank_lump_sum(F.col("quantity"), F.col("tax_exclusive_price"), F.col("uom_code")).alias("quantity")),
    f"""{BILLS}, {SPEND} SELECT line_location_id, nullif(assessable_value, 0) AS ordered, if(coalesce(assessable_value, 0) > 1, 'True', 'False') AS po_value,
           coalesce(nullif(amount_received, 0), nullif(quantity_received, 0)) AS received, coalesce(nullif(amount_billed, 0), nullif(quantity_billed, 0)) AS billed,
           cast(nullif(assessable_value, 0) - coalesce(total_po_spend, 0) AS decimal(38,2)) AS left_amount,
           cast(floor(cast(nullif(assessable_value, 0) - total_po_spend AS double) / nullif(average, 0)) AS bigint) AS more_invoices,
           if(tax_exclusive_price <> 1 AND uom_code <> 'ea', quantity, NULL) AS quantity
         FROM {{po_line_locations_all}} LEFT JOIN spend ON spend.po_distribution_id = line_location_id""")
register("auto_approval_error", lambda s: s.table("orders").select(
    "o_orderkey", A.auto_approval_error(F.col("o_totalprice"), F.when(F.col("o_orderkey") % 2 == 0, "Auto Approved"),
                                        F.when(F.col("o_orderkey") % 3 == 0, "Ann Lee"), F.lit(None)).alias("error"),
    A.intervention_status(F.lit(A.SYSTEM_LOGIN), F.when(F.col("o_orderkey") % 5 > 1, A.SYSTEM_LOGIN).otherwise("x"),
                          F.when(F.col("o_orderkey") % 7 > 1, A.SYSTEM_LOGIN).otherwise("y")).alias("intervention"),
    A.creation_status(F.when(F.col("o_orderkey") % 4 > 0, A.SYSTEM_LOGIN).otherwise("z"),
                      F.when(F.col("o_orderkey") % 5 > 1, A.SYSTEM_LOGIN).otherwise("x")).alias("creation")),
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 100000 AND o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 THEN 'ERROR' END AS error,
              if(o_orderkey % 5 > 1 AND o_orderkey % 7 > 1, 'No Intervention', 'Intervention') AS intervention,
              CASE WHEN o_orderkey % 5 <= 1 THEN 'Manually Created Invoice' WHEN o_orderkey % 4 > 0 THEN 'System Created Invoice' END AS creation FROM {orders}""")
register("latest_invoice_dates", lambda s: I.latest_invoice_dates(I.approved_invoice_lines(s)),
         f"{BILLS} SELECT po_distribution_id, {d('max(invoice_date)')} AS latest_inv_date, {d('max(made)')} AS latest_inv_creation_date FROM bill GROUP BY 1")
register("pivot_values", lambda s: s.table("lineitem").groupBy("l_partkey", "l_linestatus").pivot("l_returnflag", ["A", "R"]).agg(F.max("l_extendedprice")),
         """SELECT l_partkey, l_linestatus, max(l_extendedprice) FILTER (l_returnflag = 'A') AS "A", max(l_extendedprice) FILTER (l_returnflag = 'R') AS "R"
            FROM {lineitem} GROUP BY ALL""")
register("dedupe_rows", lambda s: s.table("lineitem").select("l_orderkey", "l_suppkey").distinct().withColumn("how", F.lit("distinct")).unionByName(
    s.table("lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.lit("group").alias("how"))),
    "SELECT l_orderkey, l_suppkey, unnest(['distinct', 'group']) AS how FROM (SELECT l_orderkey, l_suppkey FROM {lineitem} GROUP BY ALL)")
register("line_count", lambda s: R.with_group_count(s.table("li").select("l_orderkey", "l_linenumber"), s.table("li"), ("l_orderkey", "l_orderkey"), "n"),
         "SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n FROM {li}")

# ---- effective dates ----

register("as_of_history", lambda s: T.as_of(hist(s), F.lit(AT), "b", "e").select("o_orderkey", F.lit("closed").alias("form")).unionByName(
    T.as_of(hist(s), F.lit(AT), "b", "e", open_end=True).select("o_orderkey", F.lit("open").alias("form"))).unionByName(
    T.as_of(hist(s), F.lit(AT), "b", "e", allow_missing=True).select("o_orderkey", F.lit("tolerant").alias("form"))),
    f"""WITH h AS ({HIST}) SELECT o_orderkey, 'closed' AS form FROM h WHERE b <= date '1998-06-30' AND e >= date '1998-06-30'
        UNION ALL SELECT o_orderkey, 'open' FROM h WHERE b <= date '1998-06-30' AND coalesce(e, date '9999-01-01') >= date '1998-06-30'
        UNION ALL SELECT o_orderkey, 'tolerant' FROM h WHERE e IS NULL OR date '1998-06-30' BETWEEN b AND e""")
_POINTS = "SELECT c_custkey AS o_custkey, date '1995-06-01' + cast(c_custkey % 2400 AS int) AS day FROM {customer}"
register("as_of_join_event_date", lambda s: T.as_of_join(s.query(_POINTS), hist(s), ["o_custkey"], "day", "b", "e", cell_years=2, horizon=(1990, 2010)),
         f"SELECT p.*, h.* EXCLUDE (o_custkey) FROM ({_POINTS}) p JOIN ({HIST}) h ON h.o_custkey = p.o_custkey AND h.b <= p.day AND h.e >= p.day")
register("as_of_join_keep", lambda s: T.as_of_join(s.query(_POINTS), hist(s), ["o_custkey"], "day", "b", "e", "left", cell_years=2, horizon=(1990, 2010)),
         f"SELECT p.*, h.* EXCLUDE (o_custkey) FROM ({_POINTS}) p LEFT JOIN ({HIST}) h ON h.o_custkey = p.o_custkey AND p.day BETWEEN h.b AND h.e")
register("overlap_window", lambda s: hist(s).filter(T.overlaps(F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1997, 12, 31)), F.col("b"), F.col("e"), F.lit(AT)))
         .select("o_orderkey", F.lit("closed").alias("form")).unionByName(
    hist(s).filter(T.overlaps(F.lit(dt.date(1997, 1, 1)), None, F.col("b"), F.col("e"), F.lit(AT))).select("o_orderkey", F.lit("open").alias("form"))),
    f"""WITH h AS ({HIST}), w AS (SELECT 'closed' AS form, date '1997-01-01' AS lo, date '1997-12-31' AS hi UNION ALL SELECT 'open', date '1997-01-01', NULL)
        SELECT o_orderkey, form FROM h, w WHERE (b >= lo OR lo BETWEEN b AND e) AND e >= lo
          AND (b <= (CASE WHEN hi IS NOT NULL THEN hi END) OR b <= (CASE WHEN hi IS NULL THEN date '1998-06-30' END))""")
register("version_as_of", lambda s: T.version_as_of(s.table("po_lines_archive_all"), s.scan("po_versions", "po_header_id version_id co_sequence"), ["po_header_id"])
         .select("po_line_id", "version_id", "from_co_seq", "to_co_seq"),
         """SELECT a.po_line_id, v.version_id, a.from_co_seq, a.to_co_seq FROM {po_lines_archive_all} a JOIN {po_versions} v USING (po_header_id)
            WHERE v.co_sequence >= a.from_co_seq AND v.co_sequence < a.to_co_seq""")
register("changed_in_version", lambda s: T.changes_at(
    s.table("po_lines_archive_all"), s.scan("po_versions", "po_header_id version_id co_sequence"), ["po_header_id"],
    [s.table("po_line_locations_archive_all"), s.table("po_distributions_archive_all")], "po_line_id").select("po_line_id", "version_id"),
    f"WITH {AUDIT} SELECT po_line_id, version_id FROM lv")
register("document_status", lambda s: Z.header_versions(s, MAR).select("version_id", "headerstatus", "originator_id", "po_date_display"),
         f"WITH {AUDIT} SELECT version_id, headerstatus, originator_id, po_date_display FROM hv")
register("tenure", lambda s: s.query("SELECT c_custkey, date '1991-01-31' + cast(c_custkey % 400 AS int) AS s, date '1999-01-01' + cast(c_custkey % 761 AS int) AS e FROM {customer}")
         .select("c_custkey", D.tenure_text(F.col("s"), F.col("e")).alias("tenure"), D.tenure_months(F.col("s"), F.col("e")).alias("months"),
                 D.tenure_end(F.col("e")).alias("counted_to"), D.add_months_keep_end(F.col("e"), 1).alias("next"),
                 D.termination_status(F.col("e"), F.lit(dt.date(2000, 1, 1))).alias("state"), D.terminated_flag(F.col("e"), F.lit(dt.date(2000, 1, 1))).alias("flag")),
         """WITH a AS (SELECT c_custkey, date '1991-01-31' + cast(c_custkey % 400 AS int) AS s, date '1999-01-01' + cast(c_custkey % 761 AS int) AS e FROM {customer}),
            n AS (SELECT *, if(e = last_day(e), last_day(cast(e + INTERVAL 1 MONTH AS date)), cast(e + INTERVAL 1 MONTH AS date)) AS nx FROM a),
            x AS (SELECT *, if(day(e) >= 15, nx, e) AS x FROM n),
            m AS (SELECT *, (year(x) - year(s)) * 12 + month(x) - month(s) + if(day(x) = day(s) OR (x = last_day(x) AND s = last_day(s)), 0, (day(x) - day(s)) / 31.0) AS m FROM x)
            SELECT c_custkey, cast(trunc(m / 12) AS bigint) || ' Years ' || cast(floor(m % 12) AS bigint) || ' Months ' AS tenure, cast(trunc(m) AS bigint) AS months,
                   x AS counted_to, nx AS next, if(e >= date '2000-01-01', 'Upcoming Terminations', 'Terminated') AS state,
                   if(e > date '2000-01-01', 'UT', 'Y') AS flag FROM m""")
register("current_rate", lambda s: P.current_salary(s, F.lit(AT)).join(P.grade_step(s, F.lit(AT)), ["assignment_id", "grade_id"], "left").join(
    P.fte_at(s, F.lit(AT)), "assignment_id", "left"),
    f"""WITH {dims()} SELECT p.assignment_id, p.grade_id, p.person_id, p.salary_amount, p.annual_ft_salary, p.fte_value, t.step, fte.fte
        FROM pay p LEFT JOIN fte USING (assignment_id)
        LEFT JOIN (SELECT DISTINCT g.assignment_id, k.grade_id, k.name AS step, k.grade_step_id FROM {{per_assign_grade_steps_f}} g JOIN {{per_grade_steps_f_vl}} k USING (grade_step_id)
                   WHERE {on("date '1998-06-30'", 'g')} AND {on("date '1998-06-30'", 'k')}) t ON t.assignment_id = p.assignment_id AND t.grade_id = p.grade_id
        WHERE date '1998-06-30' BETWEEN p.date_from AND p.date_to""")
_RANGE = Params(as_at=dt.date(1999, 6, 30), date_from=dt.date(1998, 1, 1), date_to=dt.date(1998, 12, 31))
register("latest_rate_in_window", lambda s: P.latest_salary_with_range(s, _RANGE),
         f"""WITH {dims()}, rated AS (SELECT p.*, r.minimum, r.mid_value, r.maximum FROM pay p JOIN {{cmp_salary_bases_vl}} k USING (salary_basis_id)
               JOIN {{per_rate_values_f}} r ON r.rate_object_id = p.grade_id AND r.rate_id = k.grade_rate_id
               WHERE r.effective_end_date >= date '1998-01-01' AND r.effective_start_date <= date '1998-12-31'
                 AND p.date_to >= date '1998-01-01' AND p.date_from <= date '1998-12-31')
             SELECT person_id, assignment_id, grade_id, salary_amount, annual_ft_salary, minimum, mid_value, maximum FROM rated
             QUALIFY date_from = max(date_from) OVER (PARTITION BY person_id, assignment_id)""")

# ---- joins ----

register("order_chain", lambda s: O.with_category(s, O.with_buyer_and_supplier(s, O.po_chain(s))).join(
    I.distribution_orders(s).select("po_distribution_id", F.col("purchase_order_number").alias("again")), "po_distribution_id", "left").select(
    "po_distribution_id", "purchase_order_number", "po_line_number", "business_unit", "supplier_name", "category_code", "again"),
    """SELECT q.po_distribution_id, h.segment1 AS purchase_order_number, l.line_num AS po_line_number, u.name AS business_unit, p.party_name AS supplier_name,
              e.category_code, h.segment1 AS again
       FROM {po_distributions_all} q JOIN {po_line_locations_all} USING (po_header_id, po_line_id, line_location_id) JOIN {po_lines_all} l USING (po_header_id, po_line_id)
       JOIN {po_headers_all} h USING (po_header_id) JOIN {hr_organization_units_f_tl} u ON u.organization_id = h.prc_bu_id
       JOIN {poz_suppliers} s ON s.vendor_id = h.vendor_id JOIN {hz_parties} p ON p.party_id = s.party_id JOIN {egp_categories_b} e USING (category_id)""")
_CONTRACT = ("contract_number, contract_version, contract_owner, line_id, contract_line_number, contract_line_amount")
register("contract_lines", lambda s: K.contract_lines(s).select(*_CONTRACT.split(", ")), f"WITH {contracts(True)} SELECT {_CONTRACT} FROM contract")
_LINE_SQL = "(SELECT l.*, h.segment1 AS po FROM {po_lines_all} l JOIN {po_headers_all} h USING (po_header_id)) b"
_ON = "(c.pk1 = b.from_header_id AND c.pk2 = b.from_line_id) OR c.pk1 = b.contract_id OR (c.doc = b.po AND c.doc_line = b.line_num)"


register("contract_match", lambda s: K.match_contracts(K.order_line_links(s), K.contract_lines(s)).select("po_line_id", "contract_number", "line_id"),
         f"WITH {contracts(True)} SELECT b.po_line_id, c.contract_number, c.line_id FROM {_LINE_SQL} LEFT JOIN contract c ON {_ON}")
register("contract_exists", lambda s: K.match_contracts(K.order_line_links(s), K.contract_lines(s), "left_semi").select("po_line_id", F.lit(True).alias("known"))
         .unionByName(K.match_contracts(K.order_line_links(s), K.contract_lines(s), "left_anti").select("po_line_id", F.lit(False).alias("known"))),
         f"WITH {contracts(True)} SELECT b.po_line_id, EXISTS (FROM contract c WHERE {_ON}) AS known FROM {_LINE_SQL}")
register("semi_keys", lambda s: R.semi(s.table("customer"), s.table("orders").filter(F.col("o_orderpriority") == "1-URGENT"), [("c_custkey", "o_custkey")]),
         "SELECT * FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_orderpriority = '1-URGENT')")
register("vacant", lambda s: R.exists_flag(s.table("customer"), s.table("orders").filter(F.year("o_orderdate") == 1997), [("c_custkey", "o_custkey")], "busy").select(
    "c_custkey", Q.vacancy_status(F.when(F.col("busy"), 1), F.nullif(F.col("c_nationkey") % 2, F.lit(0))).alias("vacancy"),
    P.position_status(F.when(F.col("busy"), F.when(F.col("c_custkey") % 3 == 0, "SUSPENDED").otherwise("ACTIVE")),
                      F.when(F.col("c_custkey") % 5 == 0, "ACTIVE"), F.when(F.col("busy"), 1), F.nullif(F.col("c_nationkey") % 2, F.lit(0))).alias("position")),
    """WITH x AS (SELECT *, EXISTS (FROM {orders} WHERE o_custkey = c_custkey AND year(o_orderdate) = 1997) AS busy FROM {customer})
       SELECT c_custkey, CASE WHEN busy THEN 'Occupied' WHEN c_nationkey % 2 = 1 THEN 'Active-Recruitment' ELSE 'Vacant' END AS vacancy,
              CASE WHEN NOT busy THEN if(c_nationkey % 2 = 1, 'Position in Active-Recruitment', 'Position Vacant') WHEN c_custkey % 3 <> 0 THEN 'Position Occupied'
                   WHEN c_custkey % 5 = 0 THEN 'Position Backfilled' ELSE 'Position Suspended' END AS position FROM x""")
register("lookup_one", lambda s: R.lookup_one(s.table("customer").withColumn("c_nationkey", F.col("c_nationkey") + 10), s.table("nation"), [("c_nationkey", "n_nationkey")], "n_name", "nation"),
         "SELECT c.* REPLACE (c_nationkey + 10 AS c_nationkey), n_name AS nation FROM {customer} c LEFT JOIN {nation} ON n_nationkey = c_nationkey + 10")
register("coalesce_key_join", lambda s: s.table("customer").select("c_custkey", F.coalesce(F.nullif(F.col("c_nationkey"), F.lit(3)), F.lit(4)).alias("k"),
                                                                   F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey") % 100).alias("s")).join(
    s.table("nation").select(F.col("n_nationkey").alias("k"), "n_name"), "k").join(s.table("supplier").select(F.col("s_suppkey").alias("s"), "s_name"), "s", "left")
    .select("c_custkey", "n_name", "s_name"),
    """SELECT c_custkey, n_name, s_name FROM {customer} JOIN {nation} ON n_nationkey = if(c_nationkey = 3, 4, c_nationkey)
       LEFT JOIN {supplier} ON c_mktsegment = 'BUILDING' AND s_suppkey = c_custkey % 100""")
register("latest_per_group", lambda s: R.arg_max_rows(s.table("lineitem").select("l_suppkey", "l_orderkey", "l_shipdate"), ["l_suppkey"], "l_shipdate").select("l_suppkey", "l_orderkey"),
         "SELECT l_suppkey, l_orderkey FROM {lineitem} QUALIFY l_shipdate = max(l_shipdate) OVER (PARTITION BY l_suppkey)")
register("manager_chain", lambda s: P.manager_names(s, F.lit(AT)).join(
    T.as_of(s.table("per_assignment_supervisors_f_v"), F.lit(AT)).select("person_id", "assignment_id", "manager_id", "manager_assignment_id"), "manager_id", "right").join(
    P.manager_positions(s, F.lit(AT)), "manager_assignment_id", "left"),
    f"""WITH {dims()} SELECT b.*, h.full_name AS manager_name, h.person_number AS manager_number, r.manager_position_code, r.manager_position_name
        FROM boss b LEFT JOIN human h ON h.person_id = b.manager_id LEFT JOIN boss_role r ON r.assignment_id = b.manager_assignment_id""")
register("parent_position", lambda s: P.with_parent_position(s, T.as_of(s.table("hr_all_positions_f_vl"), F.lit(AT)).select("position_id"), F.lit(AT)),
         f"""SELECT a.position_id, u.parent_position_id, u.parent_position_name FROM {{hr_all_positions_f_vl}} a LEFT JOIN (
               SELECT DISTINCT h.position_id, h.parent_position_id, p.name AS parent_position_name FROM {{per_position_hierarchy_f}} h
               JOIN {{hr_all_positions_f_vl}} p ON p.position_id = h.parent_position_id WHERE {on("date '1998-06-30'", 'h')} AND {on("date '1998-06-30'", 'p')}) u
               USING (position_id) WHERE {on("date '1998-06-30'", 'a')}""")
register("flatten_tree", lambda s: P.cost_centre_tree(s, JUN), """
    SELECT 'R' || r_regionkey AS dce_group, 'Division ' || r_name AS dec_group_desc, CASE WHEN n_nationkey % 3 = 0 THEN 'G' || n_nationkey END AS gm_group,
           CASE WHEN n_nationkey % 3 = 0 THEN 'Group ' || n_name END AS gm_group_desc, 'CC' || n_nationkey AS cost_center, 'Centre ' || n_name AS cc_group_desc
    FROM {nation} JOIN {region} ON r_regionkey = n_regionkey WHERE n_nationkey % 3 < 2 AND r_regionkey < 4""")
register("account_description", lambda s: L.account_descriptions(s.table("gl_code_combinations"), s.table("fnd_flex_values_vl"), ["segment3", "segment4", "segment5"], "text")
         .select("code_combination_id", "text"),
         "SELECT code_combination_id, coalesce((SELECT max(description) FROM {fnd_flex_values_vl} WHERE flex_value = segment4), '') AS text FROM {gl_code_combinations}")

# ---- windows, slots ----

register("approvers_pivot", lambda s: I.approvers(s), f"""
    WITH a AS (SELECT invoice_id, if(response = 'ORA_AUTO APPROVED', 'Auto Approved',
                      {login('approver_id', "WHEN 'Batch.Scheduler' THEN 'Batch Scheduler' WHEN 'ORA_WORKFLOW SYSTEM' THEN 'Workflow System'")}) AS who,
                      max(cast(action_date AS date)) AS day FROM {{ap_inv_aprvl_hist_all}}
               WHERE history_type = 'DOCUMENTAPPROVAL' AND response LIKE '%APPROVED' GROUP BY ALL),
         l AS (SELECT invoice_id, list(who ORDER BY day, who) AS w FROM a GROUP BY 1)
    SELECT invoice_id, w[1] AS approver_1, w[2] AS approver_2, w[3] AS approver_3 FROM l""")
register("orders_slots", lambda s: I.orders_per_invoice(s), f"""
    WITH l AS (SELECT invoice_id, list(po ORDER BY po) AS w FROM (
      SELECT DISTINCT x.invoice_id, h.segment1 AS po FROM {{ap_invoice_distributions_all}} x JOIN {{po_distributions_all}} q USING (po_distribution_id)
      JOIN {{po_headers_all}} h USING (po_header_id)) GROUP BY 1)
    SELECT invoice_id, {', '.join(f'w[{i}] AS po_{i}' for i in range(1, 7))} FROM l""")
register("primary_secondary", lambda s: W.first_slots(s.table("customer"), ["c_nationkey"], ["c_mktsegment", "c_custkey"], 8, ["c_nationkey"], {
    "first_name": ("c_name", [1]), "first_balance": ("c_acctbal", [1]), "other_name": ("c_name", range(2, 9)), "other_balance": ("c_acctbal", range(2, 9))}),
    """SELECT c_nationkey, max(c_name) FILTER (n = 1) AS first_name, max(c_acctbal) FILTER (n = 1) AS first_balance, max(c_name) FILTER (n BETWEEN 2 AND 8) AS other_name,
              max(c_acctbal) FILTER (n BETWEEN 2 AND 8) AS other_balance
       FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_custkey) AS n FROM {customer}) GROUP BY 1""")
register("first_two_contacts", lambda s: P.emergency_contacts(s, s.table("customer").select(F.col("c_custkey").alias("person_id")), F.lit(AT)).select(
    "person_id", "emergency_contact_name1", "emergency_contact_name2"),
    f"""WITH calls AS (
          SELECT c.person_id, m.email_address, h.phone_number, a.address_line_1, a.address_line_2, n.full_name, u.address_id,
                 row_number() OVER (PARTITION BY c.person_id ORDER BY c.contact_person_id, n.full_name NULLS LAST, c.contact_type NULLS LAST, t.phone_number NULLS LAST,
                   h.phone_number NULLS LAST, m.email_address NULLS LAST, u.address_id NULLS LAST) AS k
          FROM {{per_contact_relationships}} y JOIN {{per_contact_relationships}} c ON c.contact_person_id = y.contact_person_id
          JOIN {{per_person_names_f}} n ON n.person_id = c.contact_person_id AND n.name_type = 'GLOBAL'
          LEFT JOIN {{per_phones}} t ON t.person_id = c.contact_person_id
          JOIN {{per_phones}} h ON h.person_id = c.person_id AND h.phone_type = 'HM'
          LEFT JOIN (FROM {{per_email_addresses}} WHERE email_type = 'H1' QUALIFY date_from = max(date_from) OVER (PARTITION BY person_id)) m ON m.person_id = c.person_id
          LEFT JOIN (FROM {{per_person_addr_usages_f}} WHERE address_type = 'HOME'
                     QUALIFY effective_start_date = max(effective_start_date) OVER (PARTITION BY person_id)) u ON u.person_id = c.person_id
          LEFT JOIN {{per_addresses_f}} a ON a.address_id = u.address_id
          WHERE y.emergency_contact_flag = 'Y')
        SELECT person_id, max(full_name) FILTER (k = 1) AS emergency_contact_name1, max(full_name) FILTER (k = 2) AS emergency_contact_name2
        FROM calls GROUP BY person_id, email_address, phone_number, address_line_1, address_line_2""")
register("dense_rank_segment", lambda s: W.dense_rank_global(s.table("customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "rank"),
         "SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment DESC) AS rank FROM {customer}")
register("category_rank", lambda s: P.ranked_categories(s, F.lit(AT), s.table("per_all_assignments_m")),
         f"WITH {dims()} SELECT person_id, position_id, assignment_id, assignment_category, dense_rank() OVER (ORDER BY assignment_category DESC) AS assignment_rank FROM category")
register("global_row_number", lambda s: W.global_row_number(s.table("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "n", 999),
         "SELECT o_custkey, o_orderkey, 999 + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS n FROM {orders}")
_EV = "SELECT event_id, user_id, ts, CASE WHEN event_id % 9 = 0 THEN value END AS coded, value FROM {events}"
register("fill_previous", lambda s: W.fill_previous(s.query(_EV), {"filled": "coded"}, ["user_id"], ["ts", "event_id"], 7, F.to_date("ts")).select("event_id", "coded", "filled"),
         f"""SELECT event_id, coded, coalesce(coded, {', '.join(f'lag(coded, {i}) OVER w' for i in range(1, 8))}) AS filled FROM ({_EV})
             WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
register("lag_steps", lambda s: W.lag_steps(s.query(_EV), "value", ["user_id"], ["ts", "event_id"], 7, chunk=F.to_date("ts")).drop("ts", "coded", "value", "user_id"),
         f"SELECT event_id, {', '.join(f'lag(value, {i}) OVER w AS lag_{i}' for i in range(1, 8))} FROM ({_EV}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")

# ---- people and requisition rules ----

_ASG = Params(as_at=dt.date(1999, 6, 30), date_from=dt.date(1998, 7, 1), date_to=dt.date(1999, 6, 30))
register("eligible_rows", lambda s: s.table("per_all_assignments_m").select(
    "assignment_id", "effective_start_date", P.eligible_assignment(F.col("person_id") % 3, F.col("primary_flag"), F.col("assignment_status_type"), F.col("employment_category")).alias("stands")),
    """SELECT assignment_id, effective_start_date, CASE person_id % 3
         WHEN 1 THEN primary_flag = 'Y' AND ((assignment_status_type = 'ACTIVE' AND employment_category IN ('ORG_SUBSTANTIVE_POSITION', 'ORG_FIX_TERM', 'ORG_INTERNAL_SECONDMENT', 'ORG_EXTERNAL_SECONDMENT'))
                OR (assignment_status_type = 'SUSPENDED' AND employment_category IN ('ORG_PARENTAL_LEAVE', 'ORG_LEAVE_WO_PAY')))
         WHEN 2 THEN employment_category IN ('ORG_SUBSTANTIVE_POSITION', 'ORG_FIX_TERM') AND (primary_flag, assignment_status_type) IN (('N', 'SUSPENDED'), ('Y', 'ACTIVE'))
         ELSE false END AS stands FROM {per_all_assignments_m}""")
register("substantive_assignment", lambda s: P.substantive_assignment(s, _ASG).select("person_id", "assignment_id", "manager_id"), """
    WITH span AS (FROM {per_all_assignments_m} WHERE assignment_type = 'E' AND effective_latest_change = 'Y' AND assignment_status_type <> 'INACTIVE'
                  AND effective_end_date >= date '1998-07-01' AND effective_start_date <= date '1999-06-30'),
    one AS (SELECT *, n FROM (FROM span QUALIFY effective_end_date = max(effective_end_date) OVER (PARTITION BY person_id, assignment_id)) JOIN
            (SELECT person_id, count(DISTINCT assignment_id) AS n FROM span GROUP BY 1) USING (person_id)),
    kept AS (FROM one WHERE if(n = 1, primary_flag = 'Y' AND if(assignment_status_type = 'ACTIVE', employment_category[5:] IN ('SUBSTANTIVE_POSITION', 'FIX_TERM', 'INTERNAL_SECONDMENT', 'EXTERNAL_SECONDMENT'),
                                                employment_category[5:] IN ('PARENTAL_LEAVE', 'LEAVE_WO_PAY')),
                               employment_category[5:] IN ('SUBSTANTIVE_POSITION', 'FIX_TERM') AND (primary_flag = 'Y') = (assignment_status_type = 'ACTIVE'))),
    led AS (FROM {per_assignment_supervisors_f_v} m WHERE assignment_id IN (SELECT assignment_id FROM kept) AND effective_end_date >= date '1998-07-01'
            AND effective_start_date <= date '1999-06-30' QUALIFY effective_end_date = max(effective_end_date) OVER (PARTITION BY person_id))
    SELECT kept.person_id, kept.assignment_id, led.manager_id FROM kept JOIN led USING (person_id, assignment_id)""")
register("leavers", lambda s: P.leavers(s, Params()).select(
    "person_id", "assignment_id", "action_reason", C.leaving_reason(F.col("action_reason")).alias("code"), D.termination_status(F.col("actual_termination_date"), F.lit(dt.date(1999, 6, 1))).alias("state")),
    """SELECT s.person_id, a.assignment_id, v.action_reason, CASE WHEN v.action_reason = 'Own reason' THEN NULL ELSE coalesce(cast(v.action_reason[1:2] AS int), 99) END AS code,
              if(s.actual_termination_date < date '1999-06-01', 'Terminated', 'Upcoming Terminations') AS state
       FROM {per_periods_of_service} s JOIN {per_action_occurrences} USING (action_occurrence_id) LEFT JOIN {per_action_reasons_vl} v USING (action_reason_id)
       JOIN {per_all_assignments_m} a ON a.person_id = s.person_id AND a.action_code = 'TERMINATION' WHERE s.actual_termination_date IS NOT NULL""")
register("open_requisitions", lambda s: Q.open_requisitions(s).select("requisition_id", "requisition_phase", "requisition_state", "candidate_phase", "candidate_state", "last_update_date", "requisition_band"),
         f"""SELECT r.requisition_id, p.name AS requisition_phase, t.name AS requisition_state, c.cp AS candidate_phase, c.cs AS candidate_state, c.day AS last_update_date,
                    g.grade_code AS requisition_band
             FROM {{irc_requisitions_b}} r JOIN {{irc_phases_vl}} p ON p.phase_id = r.current_phase_id JOIN {{irc_states_vl}} t ON t.state_id = r.current_state_id
             LEFT JOIN {{per_grades_f_vl}} g USING (grade_id)
             LEFT JOIN (SELECT x.requisition_id, a.name AS cp, b.name AS cs, {d('x.last_update_date')} AS day FROM
               (FROM {{irc_submissions}} QUALIFY last_update_date = max(last_update_date) OVER (PARTITION BY requisition_id)) x
               JOIN {{irc_phases_vl}} a ON a.phase_id = x.current_phase_id JOIN {{irc_states_vl}} b ON b.state_id = x.current_state_id) c USING (requisition_id)
             WHERE t.name <> 'Filled' AND p.type_code = 'REQUISITION'""")


def _contact_rows(s: Source) -> DataFrame:
    out = None
    for same in (True, False):
        address, mail, _ = P.latest_contact_details(s, F.lit(AT), same)
        rows = address.select("person_id", "address_id", F.lit(None).cast("string").alias("mail"), F.lit(same).alias("same")).unionByName(
            mail.select("person_id", F.lit(None).cast("bigint").alias("address_id"), F.col("email_address").alias("mail"), F.lit(same).alias("same")))
        out = rows if out is None else out.unionByName(rows)
    return out


register("latest_contact", _contact_rows, """
    WITH top AS (SELECT person_id, max(effective_start_date) AS t FROM {per_person_addr_usages_f} WHERE address_type = 'HOME'
                 AND date '1998-06-30' BETWEEN effective_start_date AND effective_end_date GROUP BY 1),
    last AS (SELECT person_id, max(date_from) AS t FROM {per_email_addresses} WHERE email_type = 'H1' GROUP BY 1),
    every AS (
      SELECT u.person_id, u.address_id, cast(NULL AS varchar) AS mail, u.address_type = 'HOME' AS fits FROM {per_person_addr_usages_f} u JOIN top ON top.person_id = u.person_id AND t = effective_start_date
      UNION ALL SELECT m.person_id, NULL, m.email_address, m.email_type = 'H1' FROM {per_email_addresses} m JOIN last ON last.person_id = m.person_id AND t = date_from)
    SELECT person_id, address_id, mail, false AS same FROM every UNION ALL SELECT person_id, address_id, mail, true FROM every WHERE fits""")
register("open_holds", lambda s: I.open_holds(s, MAR).select("invoice_id", "hold_lookup_code", "displayed_field", "segment1", "line_num", "created_by"),
         f"""SELECT h.invoice_id, x.hold_lookup_code, c.displayed_field, 'PO' || k.po_header_id AS segment1, l.line_num, {login('h.created_by')} AS created_by
             FROM {{ap_holds_all}} x JOIN {{ap_invoices_all}} h USING (invoice_id)
             JOIN {{ap_lookup_codes}} c ON c.lookup_code = x.hold_lookup_code AND c.lookup_type = 'HOLD CODE' JOIN {{poz_suppliers}} USING (vendor_id)
             JOIN {{po_line_locations}} k USING (line_location_id) JOIN {{po_lines_all}} l USING (po_header_id, po_line_id)
             JOIN {{po_distributions_all}} q USING (po_header_id, po_line_id, line_location_id)
             JOIN {{per_person_names_f}} n ON n.person_id = q.deliver_to_person_id AND n.name_type = 'GLOBAL' AND {on("date '1998-03-01'", 'n')}
             WHERE x.release_lookup_code IS NULL AND h.invoice_amount <> 0""")
_STAFF = "SELECT o_orderkey, {k} AS kind, CASE WHEN o_orderkey % 5 = 0 THEN 99999 ELSE 10000 + o_orderkey % 3 END AS e1, CASE WHEN o_orderkey % 2 = 0 THEN 10000 + o_orderkey % 4 END AS e2, CASE WHEN o_orderkey % 3 = 0 THEN 10001 END AS e3 FROM {orders} WHERE o_orderstatus = '{s}'"
_NOW, _OLD = _STAFF.replace("{k}", "'current'").replace("{s}", "O"), _STAFF.replace("{k}", "'closed'").replace("{s}", "F")


def _answers(s: Source) -> DataFrame:
    df = s.query(_NOW).unionByName(s.query(_OLD))
    one, two, three = C.dedupe_answers(F.col("e1"), F.col("e2"), F.col("e3"))
    return df.select("o_orderkey", "kind", one.alias("a1"), two.alias("a2"), three.alias("a3"))


register("staff_union", _answers, f"""
    SELECT o_orderkey, kind, CASE WHEN e1 >= 90000 AND e2 IS NOT NULL THEN e2 ELSE e1 END AS a1, CASE WHEN e1 >= 90000 OR e1 = e2 THEN NULL ELSE e2 END AS a2,
           CASE WHEN e1 >= 90000 OR e1 = e3 OR e2 = e3 THEN NULL ELSE e3 END AS a3 FROM ({_NOW} UNION ALL {_OLD})""")
register("initiators", lambda s: R.list_values(s.table("customer").select(F.col("c_mktsegment").alias("who")).unionByName(literal_row(s.spark, who="System"))),
         "SELECT 'System' AS who UNION SELECT c_mktsegment FROM {customer}")
register("distinct_list", lambda s: R.list_values(s.table("part"), "p_brand", F.nullif("p_type", F.lit("PROMO")).alias("kind"), order=["kind", F.desc("p_brand")]),
         "SELECT DISTINCT p_brand, nullif(p_type, 'PROMO') AS kind FROM {part}")
register("period_list", lambda s: V.periods(s.table("orders"), "o_orderdate", "label", "period"),
         "SELECT DISTINCT strftime(o_orderdate, '%b-%y') AS label, strftime(o_orderdate, '%B-%y') AS period FROM {orders}")
