"""Allowances and deductions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions.params import Params
from ledgerloom.operators.relational import semi
from ledgerloom.operators.temporal import as_of, overlaps, valid_at
from ledgerloom.plans.people import current_salary, fte_at, manager_names, manager_positions, names, numbers, positions
from ledgerloom.site import DEFAULT_SITE, Site
from ledgerloom.sources.catalog import Source


def listed_elements(src: Source, site: Site = DEFAULT_SITE) -> DataFrame:
    """Pay elements of the allowance list with their kind."""
    kinds = (src.scan("fnd_lookup_values", "meaning:element_name description lookup_type language")
             .filter((F.col("lookup_type") == site.code("ALLOWANCE_LIST")) & (F.col("language") == "US")).drop("lookup_type", "language"))
    return src.scan("pay_element_types_f", "element_type_id base_element_name:element_name").join(kinds, "element_name")


def allowances(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Element periods in the window with amount and periodicity side by side."""
    low, high = F.lit(p.date_from or D.FIRST_DAY), F.lit(p.date_to) if p.date_to else None
    elements = p.narrow(listed_elements(src, site).filter(F.col("element_name") != site.label("PSA Union Membership")),
                        description_type="description", elementname="element_name")
    values = src.table("pay_element_entry_values_f").filter(
        overlaps(low, high, F.col("effective_start_date"), F.col("effective_end_date"), p.today()))
    inputs = src.scan("pay_input_values_f", "element_type_id input_value_id base_name")
    groups = src.scan("pay_rel_groups_dn", "payroll_relationship_id relationship_group_id:payroll_assignment_id assignment_id")
    usages = src.scan("pay_entry_usages", "element_entry_id payroll_relationship_id payroll_assignment_id").join(
        groups, ["payroll_relationship_id", "payroll_assignment_id"], "left").select("element_entry_id", "assignment_id")
    rows = (src.scan("pay_element_entries_f", "element_entry_id element_type_id").join(elements, "element_type_id")
            .join(values, "element_entry_id").join(inputs, ["element_type_id", "input_value_id"]).join(usages, "element_entry_id", "left"))

    def shown(kind: str):
        return F.max(F.when(F.col("base_name") == kind, F.col("screen_entry_value")))

    return rows.groupBy("element_name", F.col("effective_start_date").alias("element_start"), F.col("effective_end_date").alias("element_end"),
                        "assignment_id", "description").agg(shown("Amount").alias("amount"), shown("Periodicity").alias("periodicity"))


def allowance_list(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    at = p.today()
    paid = allowances(src, p, site)
    posts = as_of(semi(src.table("per_all_assignments_m").filter(
        (F.col("assignment_type") == "E") & (F.col("effective_latest_change") == "Y")), paid, [("assignment_id", "assignment_id")]), at)
    service = src.table("per_periods_of_service").filter(F.col("period_type") == "E").select("person_id", "actual_termination_date")
    bosses = src.scan("per_assignment_supervisors_f_v", "person_id assignment_id manager_id manager_assignment_id effective_start_date effective_end_date")
    left_on = F.col("actual_termination_date")
    people = (posts.select("assignment_id", "position_id", "person_id").join(names(src, at), "person_id").join(numbers(src, at), "person_id")
              .join(service, "person_id").join(bosses, ["person_id", "assignment_id"])
              .filter(valid_at(F.coalesce(left_on, at), F.col("effective_start_date"), F.col("effective_end_date"))))
    places = positions(src, at, job=False).select("position_id", "position_code", F.col("name").alias("position_name"),
                                                  F.col("team_group").alias("group_team"), "department")
    pay = current_salary(src, at).select("person_id", "assignment_id", F.col("salary_amount").alias("fte_salary_amount"),
                                         F.col("annual_ft_salary").alias("annual_salary"))
    df = (paid.join(people, "assignment_id").join(places, "position_id").join(fte_at(src, at), "assignment_id", "left")
          .join(pay, ["person_id", "assignment_id"], "left").join(manager_names(src, at), "manager_id")
          .join(manager_positions(src, at), "manager_assignment_id"))
    return df.orderBy("element_start", "assignment_id", "element_name").select(
        "element_name", D.dmy(F.col("element_start")).alias("element_start_date"), D.dmy(F.col("element_end")).alias("element_end_date"),
        "assignment_id", "description", "amount", "periodicity", "full_name", "person_number", "person_id",
        D.dmy(left_on).alias("termination_date"), D.terminated_flag(left_on, at).alias("terminated"), "position_id", "position_code",
        "position_name", "group_team", "department", "fte", "fte_salary_amount", "annual_salary", "manager_name", "manager_number",
        "manager_position_code", "manager_position_name")
