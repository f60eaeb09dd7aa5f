"""Text expressions.  A NULL part counts as empty text when texts are joined."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Logins of system accounts and the name shown for them.
SYSTEM_LOGINS = {"Batch.Scheduler": "Batch Scheduler"}
APPROVER_LOGINS = {"Batch.Scheduler": "Batch Scheduler", "ORA_WORKFLOW SYSTEM": "Workflow System"}


def as_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def join_text(separator: str, cols: Sequence[Column]) -> Column:
    """All parts with the separator between them; a NULL part keeps its separators."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(separator))
        parts.append(as_text(c))
    return F.concat(*parts)


def cost_code(*segments: Column) -> Column:
    return join_text("-", segments)


def sentence_case(c: Column) -> Column:
    """First letter upper, all other letters lower."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def login_to_name(c: Column, system: Mapping[str, str] = SYSTEM_LOGINS) -> Column:
    """``first.last@host`` becomes ``First Last``; system accounts have fixed names."""
    login = F.coalesce(c, F.lit(""))
    dot, at = F.instr(login, "."), F.instr(login, "@")
    first = F.when(dot > 1, F.substr(login, F.lit(1), dot - 1)).otherwise("")
    last = F.when(at - dot > 1, F.substr(login, dot + 1, at - dot - 1)).otherwise("")
    name = F.concat(sentence_case(first), F.lit(" "), sentence_case(last))
    out = None
    for account, shown in system.items():
        out = (F if out is None else out).when(c == account, F.lit(shown))
    return name if out is None else out.otherwise(name)


def one_line(c: Column) -> Column:
    return F.translate(c, "\r\n", "  ")


def account_class(c: Column) -> Column:
    return F.left(c.cast("string"), F.lit(1))


def format_groups(c: Column, sizes: Sequence[int], separator: str = "-") -> Column:
    """Cut a text into groups of the given sizes: 123456789 -> 123-456-789."""
    text, parts, at = c.cast("string"), [], 1
    for size in sizes:
        parts.append(F.substring(text, at, size))
        at += size
    return join_text(separator, parts)


def flag_off(c: Column) -> Column:
    return F.coalesce(c, F.lit("N")) == "N"


def band_number(c: Column) -> Column:
    """``Band_07`` becomes ``7``; other grade codes stay as they are."""
    return F.when(c.startswith("Band_"), F.substring(c, 6, 30).try_cast("int").cast("string")).otherwise(c)


def tax_line_code(c: Column) -> Column:
    return F.when(c == "TAX", F.lit("GST"))
