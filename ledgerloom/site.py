"""Values that belong to one installation and not to the report logic."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Site:
    """``prefix`` starts the lookup codes an installation adds to the delivered ones."""

    prefix: str = "ORG"
    buyer_name: str = "Buying Organisation"
    buyer_address: str = "PO Box 1"
    buyer_tax_number: dict[str, str] = field(
        default_factory=lambda: {"Crown": "000-000-001", "Departmental": "000-000-002"})
    risk_cost_centre: str = "427"
    risk_business_unit: str = "Crown"
    finance_departments: tuple[str, ...] = (
        "Finance Reporting and Control", "Financial Performance and Planning", "Finance")

    def code(self, name: str) -> str:
        return f"{self.prefix}_{name}"

    def label(self, name: str) -> str:
        return f"{self.prefix} {name}"


DEFAULT_SITE = Site()
