"""Code lists: a code becomes its meaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from ledgerloom.site import DEFAULT_SITE, Site


def map_values(c: Column, mapping: Mapping[object, object], default: Column | None = None) -> Column:
    """``mapping`` holds one code or a tuple of codes per result."""
    out = None
    for codes, meaning in mapping.items():
        many = isinstance(codes, Iterable) and not isinstance(codes, str)
        hit = c.isin(*codes) if many else c == codes
        value = meaning if isinstance(meaning, Column) else F.lit(meaning)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out if default is None else out.otherwise(default)


# Cost centres of each group.
COST_CENTRE_GROUPS = {
    ("115",): "Chief Executive",
    ("999",): "Suspense Account",
    ("991",): "Multiple",
    ("810",): "Place",
    ("901", "911", "215", "216", "217", "218", "219", "235", "821", "238", "861", "871", "246", "247", "249"):
        "Intelligence and System Direction",
    ("401", "405", "406", "341", "261", "409", "361", "426", "427", "431", "432", "441", "331"):
        "System Delivery and Performance",
    ("501", "511", "515", "541", "531", "525", "521", "551"): "Tumuaki Te Tāhui",
    ("601", "621", "711", "631", "941", "721", "641", "661", "611", "615"): "Organisational Performance",
    ("701", "651", "681", "741"): "Office of Chief Executive",
    ("301", "231", "241", "841", "221", "851", "305", "351", "827", "835", "836", "931"):
        "Solutions Design and Implementation",
}

# Location codes by city, and by statistical region.
WELLINGTON = ("WLG_L6", "WLG_L7", "WLG_L8", "WLG_L9")
AUCKLAND = ("AKL_L7", "AKL_APO")

# Ethnicity names and their statistical codes.
ETHNICITY_CODES = {
    "African": 53100, "Any Other": 61199, "Asian": 40000, "Chinese": 42100, "Cook Islands Māori": 32100,
    "European": 10000, "Fijian": 36111, "Indian": 43100, "Latin American": 52100, "Middle Eastern": 51100,
    "Māori": 21111, "New Zealand European": 11111, "Niuean": 34111, "Not Stated": 99999,
    "Pacific Peoples": 30000, "Samoan": 31111, "South East Asian": 41499, "Tokelauan": 35111, "Tongan": 33111,
}
NOT_STATED = 99999

# Leaving reasons and their reporting codes.
LEAVING_REASONS = {
    "10 Resignation – destination unknown": 10,
    "11 Resignation to Public Service department": 11,
    "12 Resignation other than to a Public Service department": 12,
    "30 End of fixed term contract / agreement": 30,
    "40 Restructuring": 40,
    "41 Redeployment to an other organisation": 41,
    "42 Severance": 42,
    "42 Redundancy": 42,
    "43 Retraining": 43,
    "44 Enhanced early retirement": 44,
    "45 Voluntary Redundancy": 45,
    "50 Dismissal": 50,
    "60 Retirement": 60,
    "70 Death": 70,
    "99 Unknown": 99,
}

# Reporting status of an assignment category.
ASSIGNMENT_STATUS = {
    ("Substantive Position", "Fixed Term"): 1, "Internal Secondment": 2, "External Secondment": 3,
    "Parental Leave": 4, "Leave without Pay": 5,
}


def cost_centre_group(c: Column) -> Column:
    return map_values(c, COST_CENTRE_GROUPS)


def city(code: Column, otherwise: Column) -> Column:
    return map_values(code, {WELLINGTON: "Wellington", AUCKLAND: "Auckland"}, otherwise)


def region_number(code: Column) -> Column:
    return map_values(code, {(*WELLINGTON, "PARLMT"): 9, AUCKLAND: 2})


def working_time(c: Column, keep_other: bool = True) -> Column:
    return map_values(c, {"FULL_TIME": "Full Time", "PART_TIME": "Part Time"}, c if keep_other else None)


def employment_status(c: Column) -> Column:
    return map_values(c, {"ACTIVE": "Active", "SUSPENDED": "Suspended"})


def contact_type(c: Column, site: Site = DEFAULT_SITE) -> Column:
    return map_values(c, {
        "C": "Child", "P": "Parent", "S": "Spouse", "F": "Friend", site.code("SIBLING"): "Sibling",
        site.code("RELATIVE"): "Relative", site.code("PARTNER"): "Partner",
        (site.code("NCR"), "EMRG"): "Contact not defined"})


def ethnicity_code(c: Column) -> Column:
    return F.when(c.isNull(), NOT_STATED).otherwise(map_values(c, ETHNICITY_CODES))


def leaving_reason(c: Column) -> Column:
    return F.when(c.isNull(), 99).otherwise(map_values(c, LEAVING_REASONS))


def assignment_status(c: Column) -> Column:
    return map_values(c, ASSIGNMENT_STATUS)


def gender_code(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("U")).when(c == "ORA_HRX_GENDER_DIVERSE", F.lit("D")).otherwise(c)


def contract_term(c: Column, site: Site = DEFAULT_SITE) -> Column:
    return F.when(c == site.code("FIX_TERM"), 1).otherwise(2)


def management_profile(manager_position: Column, manager_leads: Column, leads: Column) -> Column:
    return (F.when(manager_position.startswith("Chief Executive") & (leads == "Y"), 2)
            .when(manager_position.startswith("Deputy Chief Executive") & (manager_leads == "Y") & (leads == "Y"), 3))


def dedupe_answers(first: Column, second: Column, third: Column) -> tuple[Column, Column, Column]:
    """Move the second answer up if the first is "not stated"; blank repeated answers."""
    unstated = first >= 90000
    one = F.when(unstated & second.isNotNull(), second).otherwise(first)
    two = F.when((first == second) | unstated, F.lit(None)).otherwise(second)
    three = F.when((second == third) | (first == third) | unstated, F.lit(None)).otherwise(third)
    return one, two, three
