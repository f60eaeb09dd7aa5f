"""All registered queries; importing a module of this package registers its queries."""

from ledgerloom.checks import operators, reports_finance, reports_ledger, reports_people, value_lists  # noqa: F401
from ledgerloom.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
