"""Money rules of invoices, order lines and journals."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, functions as F

# Tax classes of lines without tax.
UNTAXED = ("GST EXEMPT", "GST ZERO")
MONEY = "decimal(18,2)"


def net_of_tax(header: Column, tax: Column) -> Column:
    return (header - F.coalesce(tax, F.lit(0))).cast(MONEY)


def net_invoice_amount(header: Column, line: Column, tax: Column, tax_class: Column,
                       exempt_multiline: Literal["net", "gross"] = "net") -> Column:
    """Header amount without tax.  ``exempt_multiline`` says whether an untaxed line that is
    only part of its invoice shows the header amount net or gross."""
    untaxed = tax_class.isin(*UNTAXED)
    partial = header if exempt_multiline == "gross" else net_of_tax(header, tax)
    return (F.when(untaxed & (header != line), partial)
            .when(untaxed & (header == line), line)
            .otherwise(net_of_tax(header, tax)))


def _is_whole_invoice(header: Column, line: Column, tax: Column, tax_class: Column) -> Column:
    """The line is the invoice, so it has no amount or number of its own."""
    untaxed = F.coalesce(tax_class.isin(*UNTAXED), F.lit(False))
    return F.when(untaxed & (header != line), False).when(untaxed & (header == line), True).otherwise(
        F.coalesce(line == net_of_tax(header, tax), F.lit(False)))


def invoice_line_amount(header: Column, line: Column, tax: Column, tax_class: Column) -> Column:
    return F.when(~_is_whole_invoice(header, line, tax, tax_class), line)


def invoice_line_number(header: Column, line: Column, tax: Column, tax_class: Column, number: Column) -> Column:
    return F.when(~_is_whole_invoice(header, line, tax, tax_class), number)


def zero_to_null(c: Column) -> Column:
    return F.when(c != 0, c)


def has_value(c: Column) -> Column:
    """'True' for amounts above 1: lower ones are placeholders."""
    return F.when(c > 1, F.lit("True")).otherwise("False")


def lump_sum(price: Column, unit: Column) -> Column:
    return F.coalesce((price == 1) | (unit == "ea"), F.lit(False))


def blank_lump_sum(c: Column, price: Column, unit: Column, need_unit: bool = True) -> Column:
    """Quantity, unit and price mean nothing where the line is a lump sum."""
    blank = lump_sum(price, unit)
    return F.when(~(blank | unit.isNull() if need_unit else blank), c)


def amount_left(ordered: Column, spent: Column) -> Column:
    return (ordered - F.coalesce(spent, F.lit(0))).cast("decimal(38,2)")


def ratio(total: Column, count: Column) -> Column:
    """Rounded to cents; NULL where the divisor is zero."""
    d = F.nullif(count, F.lit(0).cast("bigint"))
    return F.round(total.cast("double") / d.cast("double"), 2)


def invoices_remaining(ordered: Column, spent: Column, average: Column) -> Column:
    d = average.cast("double")
    return F.floor((ordered - spent).cast("double") / F.when(d != 0, d))


def journal_side(link: Column, entry: Column, journal: Column) -> Column:
    return F.when(link.isNull(), F.coalesce(entry, journal, F.lit(0).cast(MONEY))).otherwise(journal)


def journal_amount(invoice_link: Column, invoice_amount: Column, link: Column, entry_dr: Column, entry_cr: Column,
                   journal_dr: Column, journal_cr: Column) -> Column:
    """Invoice amount where the journal line comes from an invoice, else debit less credit."""
    return F.when(invoice_link.isNotNull(), invoice_amount).otherwise(
        (journal_side(link, entry_dr, journal_dr) - journal_side(link, entry_cr, journal_cr)).cast("decimal(28,10)"))


def auto_approval_error(amount: Column, one: Column, two: Column, three: Column, limit: int = 100_000) -> Column:
    """Large invoices that only the system approved."""
    return F.when((amount >= limit) & (one == "Auto Approved") & two.isNull() & three.isNull(), F.lit("ERROR"))


SYSTEM_LOGIN = "Batch.Scheduler"


def intervention_status(header_by: Column, line_by: Column, line_changed_by: Column) -> Column:
    untouched = (header_by == SYSTEM_LOGIN) & (line_by == SYSTEM_LOGIN) & (line_changed_by == SYSTEM_LOGIN)
    return F.when(untouched, F.lit("No Intervention")).otherwise("Intervention")


def creation_status(header_by: Column, line_by: Column) -> Column:
    return (F.when((header_by == SYSTEM_LOGIN) & (line_by == SYSTEM_LOGIN), F.lit("System Created Invoice"))
            .when(line_by != SYSTEM_LOGIN, F.when(header_by.isNotNull(), F.lit("Manually Created Invoice"))))
