"""What the columns of ERP tables must hold.

The tables share one naming: a column's name tells its kind in every table.  A source checks the columns that a report asks
for (``Source.scan``), so one that is not there or holds something else is an error with its name, not a wrong join or an odd
sum later on.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

#: Exact amounts, prices, rates and quantities.
EXACT = re.compile(r"(^|_)(amount|price|quantity|qty)$|^(amount|quantity)_|_(dr|cr)$|_original$|^(assessable|fte)_value$|_salary$")
#: Keys, line numbers and versions.
WHOLE = re.compile(r"(^|_)id$|_id1$|_(num|int)_1$|^(invoice_|distribution_|po_)?line_number$|^(ae_line|je_line|line|co)_num$|^(depth|co_sequence|major_version)$|_co_seq$")
DAY = re.compile(r"_date$|^date_(from|to|start|of_birth)$|^effective_(from|to)$")
TEXT = re.compile(r"_(code|name|number|num|flag|type|status|role|description|desc|address|email|phone|text|txt|table)$|^(segment|attribute)\d+$"
                  r"|^(description|comments|name|source|status|language|meaning|segment)$")
#: Columns that do not follow their names: people by login, and elements whose key is text or number.
TEXT_KEYS = frozenset({"approver_id"})

#: Floating-point amounts of a source become exact with as many places as a unit price may have.
FROM_FLOATING = "decimal(28,10)"

KINDS = {
    "exact number": (T.DecimalType, T.IntegralType, T.FloatType, T.DoubleType),
    "whole number": (T.IntegralType, T.DecimalType),
    "date or time": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "text": (T.StringType,),
}


class SchemaError(ValueError):
    """A table lacks a column or holds another kind of value in it."""


def kind_of(column: str) -> str | None:
    """The kind that the name of a column promises; None if names say nothing about it."""
    if column in TEXT_KEYS:
        return "text"
    return next((k for k, rule in (("exact number", EXACT), ("whole number", WHOLE), ("date or time", DAY), ("text", TEXT)) if rule.search(column)), None)


def check(table: str, df: DataFrame, columns: Iterable[str]) -> None:
    """Raise ``SchemaError`` unless the frame has the columns and each holds its kind."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for c in columns:
        if c not in fields:
            raise SchemaError(f"table {table} has no column {c}")
        kind = kind_of(c)
        if kind and not isinstance(fields[c], (*KINDS[kind], T.NullType)):
            raise SchemaError(f"column {c} of table {table} must hold {kind}, not {fields[c].simpleString()}")


def exact_numbers(df: DataFrame) -> DataFrame:
    """Amounts, prices, rates and quantities never stay floating point; other floating columns are left alone.

    A column that is exact already is handed on as it is, so filters on it reach the files.
    """
    loose = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and kind_of(f.name) == "exact number"}
    return df.select(*(F.col(c).cast(FROM_FLOATING).alias(c) if c in loose else F.col(c) for c in df.columns)) if loose else df
