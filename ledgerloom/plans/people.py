"""Positions, persons, managers, salaries and the staff reports built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import codes as C, dates as D, text as X
from ledgerloom.functions.params import Params, optional_between
from ledgerloom.operators.relational import arg_max_rows, left_lookup, lookup_one, mask_columns, semi
from ledgerloom.operators.temporal import as_of, as_of_join, overlaps, valid_at
from ledgerloom.operators.tree import flatten_tree
from ledgerloom.operators.windows import dense_rank_global, first_slots, numbered_slots
from ledgerloom.plans.recruitment import open_requisitions
from ledgerloom.session import cut
from ledgerloom.site import DEFAULT_SITE, Site
from ledgerloom.sources.catalog import Source

WORKERS = ("E", "C")
IN_POST = ("ACTIVE", "SUSPENDED")
SLOTS_AFTER_FIRST = tuple(range(2, 9))


# ---- dimensions at a date ---------------------------------------------------------

def departments(src: Source) -> DataFrame:
    return src.scan("per_departments", "organization_id name:department effective_start_date:dept_start effective_end_date:dept_end")


def position_rows(src: Source, job: bool = True) -> DataFrame:
    """All date versions of positions with job, place and department versions."""
    df = src.table("hr_all_positions_f_vl").withColumnsRenamed({"effective_start_date": "pos_start", "effective_end_date": "pos_end"})
    if job:
        df = df.join(src.scan("per_jobs", "job_id name:job"), "job_id")
    places = src.scan("hr_locations_all_f_vl", "location_id internal_location_code location_name")
    return (df.join(departments(src), "organization_id").join(places, "location_id", "left")
            .withColumns({"location": C.city(F.col("internal_location_code"), F.col("location_name")),
                          "team_group": F.col("attribute8"), "position_type": F.col("attribute6")}))


def positions(src: Source, at: Column, job: bool = True) -> DataFrame:
    """Active positions at a date; the department must be valid too."""
    rows = position_rows(src, job).filter(F.col("active_status") == "A")
    return as_of(as_of(rows, at, "pos_start", "pos_end"), at, "dept_start", "dept_end")


def names(src: Source, at: Column | None, columns: str = "full_name") -> DataFrame:
    df = src.table("per_person_names_f").filter(F.col("name_type") == "GLOBAL")
    df = df if at is None else as_of(df, at)
    return df.select("person_id", *columns.split(), *([] if at is not None else ["effective_start_date", "effective_end_date"]))


def numbers(src: Source, at: Column, table: str = "per_people_f") -> DataFrame:
    return as_of(src.table(table), at).select("person_id", "person_number")


def assignments(src: Source, at: Column, types: Sequence[str] = WORKERS) -> DataFrame:
    """Latest change of assignments in post at a date."""
    return as_of(src.table("per_all_assignments_m").filter(
        F.col("assignment_type").isin(*types) & (F.col("effective_latest_change") == "Y")
        & F.col("assignment_status_type").isin(*IN_POST)), at)


def in_service(src: Source, at: Column, types: Sequence[str] = WORKERS) -> DataFrame:
    return as_of(src.table("per_periods_of_service").filter(F.col("period_type").isin(*types)), at, "date_start",
                 "actual_termination_date", open_end=True).select("person_id", "date_start")


def assignment_categories(src: Source, df: DataFrame, site: Site = DEFAULT_SITE) -> DataFrame:
    """Category name of assignment rows; rows without a known category drop out."""
    words = (src.scan("hcm_lookups", "lookup_code:employment_category lookup_type meaning:assignment_category")
             .filter(F.col("lookup_type") == "EMP_CAT").drop("lookup_type"))
    return df.join(words, "employment_category").select("person_id", "position_id", "assignment_id", "assignment_category")


def category_lookup(src: Source, at: Column, types: Sequence[str] = WORKERS) -> DataFrame:
    rows = as_of(src.table("per_all_assignments_m").filter(
        F.col("assignment_type").isin(*types) & F.col("assignment_status_type").isin(*IN_POST)), at)
    return assignment_categories(src, rows).distinct()


def ranked_categories(src: Source, at: Column, people: DataFrame) -> DataFrame:
    """Category and its rank among the given people's assignments, last name first."""
    rows = semi(assignments(src, at), people, [("assignment_id", "assignment_id")])
    return dense_rank_global(assignment_categories(src, rows), "assignment_category", "assignment_rank")


def salaries(src: Source) -> DataFrame:
    """Salary rows that start inside a row of their assignment, with its grade."""
    posts = (src.scan("per_all_assignments_m", "assignment_id grade_id effective_latest_change assignment_type effective_start_date effective_end_date")
             .filter((F.col("effective_latest_change") == "Y") & (F.col("assignment_type") == "E")))
    return as_of_join(src.table("cmp_salary"), posts.drop("effective_latest_change", "assignment_type"), ["assignment_id"], "date_from").select(
        "person_id", "assignment_id", "grade_id", "salary_amount", "annual_ft_salary", "fte_value", "salary_basis_id", "date_from", "date_to")


def current_salary(src: Source, at: Column) -> DataFrame:
    return as_of(salaries(src), at, "date_from", "date_to").select(
        "person_id", "assignment_id", "grade_id", "salary_amount", "annual_ft_salary", "fte_value")


def fte_at(src: Source, at: Column) -> DataFrame:
    return as_of(src.table("per_assign_work_measures_f").filter(F.col("unit") == "FTE"), at).select(
        "assignment_id", F.col("value").alias("fte"))


def grade_step(src: Source, at: Column) -> DataFrame:
    steps = as_of(src.table("per_grade_steps_f_vl"), at).select("grade_step_id", F.col("name").alias("step"), "grade_id")
    return (as_of(src.table("per_assign_grade_steps_f"), at).select("assignment_id", "grade_step_id")
            .join(steps, "grade_step_id").select("assignment_id", "grade_step_id", "step", "grade_id").distinct().drop("grade_step_id"))


def manager_positions(src: Source, at: Column) -> DataFrame:
    """Position of an assignment that manages."""
    posts = as_of(src.table("per_all_assignments_m").filter(F.col("assignment_type").isin(*WORKERS)), at).select("assignment_id", "position_id")
    roles = as_of(src.table("hr_all_positions_f_vl"), at).select(
        "position_id", F.col("position_code").alias("manager_position_code"), F.col("name").alias("manager_position_name"))
    return posts.join(roles, "position_id").drop("position_id").withColumnRenamed("assignment_id", "manager_assignment_id")


def manager_names(src: Source, at: Column, table: str = "per_people_f") -> DataFrame:
    return names(src, at).join(numbers(src, at, table), "person_id").select(
        F.col("person_id").alias("manager_id"), F.col("full_name").alias("manager_name"), F.col("person_number").alias("manager_number"))


def with_parent_position(src: Source, df: DataFrame, at: Column) -> DataFrame:
    parents = as_of(src.table("hr_all_positions_f_vl"), at).select(
        F.col("position_id").alias("parent_position_id"), F.col("name").alias("parent_position_name")).distinct()
    links = as_of(src.table("per_position_hierarchy_f"), at).select("parent_position_id", "position_id")
    return df.join(links.join(parents, "parent_position_id").distinct(), "position_id", "left")


# ---- staff lists ------------------------------------------------------------------

def _staff(src: Source, at: Column) -> DataFrame:
    return (assignments(src, at).join(names(src, at), "person_id").join(numbers(src, at), "person_id").join(in_service(src, at), "person_id")
            .withColumns({"start_date": D.dmy(F.col("date_start"), "/"),
                          "projected_end_date": D.dmy(F.col("projected_assignment_end"), "/"),
                          "leave_return_date": D.dmy(F.col("ass_attribute_date1"), "/")}))


def with_manager(src: Source, staff: DataFrame, posts: DataFrame, at: Column) -> DataFrame:
    """Manager of each assignment, known only if on the staff list and in an active position."""
    people = staff.select(F.col("person_id").alias("manager_id"), F.col("full_name").alias("manager_name"),
                          F.col("person_number").alias("manager_number")).distinct()
    held = as_of(src.table("per_all_assignments_m"), at).select(
        F.col("person_id").alias("manager_id"), F.col("assignment_id").alias("manager_assignment_id"), "position_id")
    roles = posts.select("position_id", F.col("position_code").alias("manager_position_code"), F.col("name").alias("manager_position_name"))
    managers = (as_of(src.table("per_assignment_supervisors_f_v"), at)
                .select("person_id", "assignment_id", "manager_id", "manager_assignment_id")
                .join(people, "manager_id").join(held, ["manager_id", "manager_assignment_id"]).join(roles, "position_id")
                .select("person_id", "assignment_id", "manager_name", "manager_number", "manager_position_code", "manager_position_name"))
    return staff.join(managers, ["person_id", "assignment_id"], "left")


def _staff_list(src: Source, staff: DataFrame, posts: DataFrame, at: Column) -> DataFrame:
    """Staff with manager, category and position."""
    rows = with_manager(src, staff, posts, at).join(
        category_lookup(src, at), ["person_id", "position_id", "assignment_id"], "left")
    places = posts.select("position_id", "position_code", "name", C.working_time(F.col("full_part_time")).alias("full_part_time"),
                          "position_type", F.col("attribute4").alias("leadership_role"), F.col("attribute5").alias("leadership_tier"),
                          "location", "location_name", "department", "team_group", "job")
    return rows.join(places, "position_id")


_PLACE = ("position_code", "position_id", "name", "full_part_time", "position_type", "leadership_role", "leadership_tier")
_MANAGER = ("manager_name", "manager_number", "manager_position_code", "manager_position_name")


def staff_condensed(src: Source, p: Params) -> DataFrame:
    at = p.today()
    mail = src.table("per_email_addresses").filter(F.col("email_type") == "W1").select("person_id", "email_address")
    staff = _staff(src, at).join(mail, "person_id")
    rows = _staff_list(src, staff, positions(src, at), at).join(fte_at(src, at), "assignment_id", "left")
    return rows.select(*_PLACE, "location", "department", "team_group", "job", "person_number", "full_name", "person_id", "assignment_number",
                       "email_address", C.employment_status(F.col("assignment_status_type")).alias("employment_type"), "primary_flag",
                       "start_date", "leave_return_date", "projected_end_date", "assignment_category", "fte", *_MANAGER,
                       ).orderBy(F.asc_nulls_last("person_number"), F.asc_nulls_last("assignment_number"))


def staff_details(src: Source, p: Params) -> DataFrame:
    at = p.today()
    grades = src.scan("per_grades_f_vl", "grade_id grade_code:band")
    staff = _staff(src, at).join(grades, "grade_id", "left")
    pay = current_salary(src, at).withColumnRenamed("fte_value", "fte")
    rows = (_staff_list(src, staff, positions(src, at), at)
            .join(grade_step(src, at), ["assignment_id", "grade_id"], "left")
            .join(pay, ["person_id", "assignment_id", "grade_id"], "left"))
    return rows.select(*_PLACE, F.col("location_name").alias("location"), "department", "team_group", "job", "person_number", "full_name",
                       "person_id", "assignment_number", F.col("assignment_status_type").alias("employment_type"), "primary_flag", "band", "step",
                       F.col("ass_attribute5").alias("employment_agreement"), F.col("ass_attribute2").alias("grandparenting"),
                       F.col("ass_attribute1").alias("personal_union"), "start_date", "leave_return_date", "projected_end_date",
                       "assignment_category", "fte", *_MANAGER, "annual_ft_salary", "salary_amount")


# ---- positions --------------------------------------------------------------------

def cost_centre_tree(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Paths of the active version of the cost-centre tree."""
    def of_tree(df: DataFrame) -> DataFrame:
        return df.filter((F.col("tree_structure_code") == "GL_ACCT_FLEX") & (F.col("tree_code") == site.label("COST CENTER")))

    active = as_of(of_tree(src.table("fnd_tree_version_vl")).filter(F.col("status") == "ACTIVE"), p.today())
    tops = semi(of_tree(src.table("fnd_tree_node")), active, [("tree_version_id", "tree_version_id")])
    values = src.table("fnd_flex_values_vl").filter(F.col("value_category") == site.code("COST_CENTER"))
    return flatten_tree(tops, values)


def position_occupants(src: Source, at: Column) -> DataFrame:
    """First and second occupant of each position; the second slot takes each column's maximum on its own."""
    people = assignments(src, at).join(names(src, at), "person_id").join(numbers(src, at), "person_id")
    ranked = (people.join(ranked_categories(src, at, people), ["person_id", "position_id", "assignment_id"], "left")
              .join(current_salary(src, at), ["person_id", "assignment_id", "grade_id"], "left")
              .withColumns({"employment_type2": F.col("assignment_status_type"),
                            "projected_end_date": D.dmy(F.col("projected_assignment_end"), "/")}))
    shown = ("person_number", "full_name", "person_id", "employment_type2", "assignment_category", "assignment_rank", "assignment_id",
             "projected_end_date", "annual_ft_salary", "salary_amount", "fte_value")
    return first_slots(ranked, ["position_id"], ["assignment_rank", "assignment_id", "salary_amount"], 8, ["position_id"], {
        **{c: (c, [1]) for c in shown}, **{f"secondary_{c}": (c, SLOTS_AFTER_FIRST) for c in shown}})


def position_status(first: Column, second: Column, occupant: Column, requisition: Column) -> Column:
    return (F.when((first == "ACTIVE") & (second.isNull() | (second == "ACTIVE")), F.lit("Position Occupied"))
            .when((first == "SUSPENDED") & second.isNull(), F.lit("Position Suspended"))
            .when(((first == "SUSPENDED") & (second == "ACTIVE")) | ((first == "ACTIVE") & (second == "SUSPENDED")), F.lit("Position Backfilled"))
            .when(occupant.isNull() & requisition.isNotNull(), F.lit("Position in Active-Recruitment"))
            .when(occupant.isNull(), F.lit("Position Vacant")))


def all_positions(src: Source, p: Params, site: Site = DEFAULT_SITE, mask_pay: bool = False) -> DataFrame:
    """Every active position with occupants, cost-centre path and status."""
    at = p.today()
    rates = src.scan("per_rate_values_f", "rate_object_id:entry_grade_id mid_value effective_start_date:rate_start effective_end_date:rate_end")
    posts = (positions(src, at)
             .join(src.scan("fnd_vs_values_b", "value_id:cost_center value:cost_center_code"), "cost_center", "left")
             .join(src.scan("per_grades_f_vl", "grade_id:entry_grade_id grade_code:band"), "entry_grade_id", "left")
             .join(rates, "entry_grade_id", "left")
             .filter(valid_at(at, F.col("rate_start"), F.col("rate_end"), allow_missing=True)))
    posts = p.narrow(posts, team_group="team_group", dpmt="department", salary_band="band", position_type="position_type")
    df = (with_parent_position(src, posts, at)
          .join(position_occupants(src, at), "position_id", "left")
          .join(open_requisitions(src, candidates=False).select("position_id", "requisition_id"), "position_id", "left")
          .drop("cost_center").withColumnRenamed("cost_center_code", "cost_center")
          .join(cost_centre_tree(src, p, site), "cost_center", "left"))
    out = df.select(
        "position_code", "position_id", "name", F.col("position_type").alias("employment_type"), F.col("attribute2").alias("anzco_code"),
        F.col("attribute1").alias("occupational_category"), F.col("attribute4").alias("leadership_role"),
        F.col("attribute5").alias("leadership_tier"), F.col("attribute7").alias("position_under_collective_coverage_flag"), "location",
        "department", "job", F.col("team_group").alias("group_team"), "parent_position_name", "cost_center", "dce_group", "dec_group_desc",
        "gm_group", "gm_group_desc", "cc_group_desc", "band", "mid_value", F.lit(1).alias("position_fte"), "person_number", "full_name",
        "person_id", "employment_type2", "assignment_category", "assignment_rank", "projected_end_date", "annual_ft_salary", "salary_amount",
        "fte_value", "secondary_person_number", "secondary_full_name", "secondary_person_id", "secondary_employment_type2",
        "secondary_assignment_category", "secondary_assignment_rank", "secondary_projected_end_date", "secondary_annual_ft_salary",
        "secondary_salary_amount", "secondary_fte_value",
        position_status(F.col("employment_type2"), F.col("secondary_employment_type2"), F.col("assignment_id"),
                        F.col("requisition_id")).alias("position_status"))
    if mask_pay:
        out = mask_columns(out, ["mid_value", "annual_ft_salary", "salary_amount", "secondary_annual_ft_salary", "secondary_salary_amount"],
                           F.col("department").isin(*site.finance_departments))
    return out.orderBy(F.asc_nulls_last("position_code"))


# ---- emergency contacts -----------------------------------------------------------

def latest_contact_details(src: Source, at: Column, same_type_only: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Latest home address, latest home e-mail, home phone.  ``same_type_only=False`` also takes
    rows of other types that start on the day of the latest home row."""
    usages = src.table("per_person_addr_usages_f")
    home = F.col("address_type") == "HOME"
    pool = home & valid_at(at, F.col("effective_start_date"), F.col("effective_end_date"))
    latest = arg_max_rows(usages, ["person_id"], "effective_start_date", among=pool, both_sides=same_type_only).select("person_id", "address_id")
    places = as_of(src.table("per_addresses_f"), at).select(
        "address_id", F.when(F.col("address_line_2").isNull(), F.col("address_line_1")).otherwise(
            X.join_text(",", [F.col("address_line_1"), F.col("address_line_2")])).alias("address_line_1"), F.col("address_line_3").alias("suburb"),
        F.col("town_or_city").alias("city"), "postal_code", "country")
    mails = arg_max_rows(src.table("per_email_addresses"), ["person_id"], "date_from", among=F.col("email_type") == "H1",
                         both_sides=same_type_only).select("person_id", "email_address")
    phones = src.table("per_phones").filter(F.col("phone_type") == "HM").select("person_id", "phone_number")
    return latest.join(places, "address_id"), mails, phones


def emergency_contacts(src: Source, persons: DataFrame, at: Column, slots: int = 2, same_type_only: bool = True) -> DataFrame:
    """The first contacts of each person, per home phone, e-mail and address."""
    links = src.table("per_contact_relationships")
    wanted = semi(links.filter(F.col("emergency_contact_flag") == "Y"), persons, [("person_id", "person_id")])
    called = (src.table("per_person_names_f").filter(F.col("name_type") == "GLOBAL")
              .select(F.col("person_id").alias("contact_person_id"), F.col("full_name").alias("emergency_contact_name")))
    numbers_ = src.scan("per_phones", "person_id:contact_person_id phone_number:emergency_contact_phn_no")
    contacts = (links.select("person_id", "contact_person_id", "contact_type")
                .join(called, "contact_person_id").join(numbers_, "contact_person_id", "left"))
    address, mail, phone = latest_contact_details(src, at, same_type_only)
    # A contact that several people name comes once per naming.  Copies are equal and only the first
    # ``slots`` rows of a person count, so that many copies are enough.
    namings = wanted.groupBy("contact_person_id").agg(F.least(F.count(F.lit(1)), F.lit(slots)).cast("int").alias("namings"))
    rows = (contacts.join(namings, "contact_person_id").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("namings"))))
            .join(phone, "person_id").join(mail, "person_id", "left").join(address, "person_id", "left"))
    order = ["contact_person_id", "emergency_contact_name", "contact_type", "emergency_contact_phn_no", "phone_number", "email_address",
             "address_id", "copy"]
    at_home = ["person_id", "phone_number", "email_address", "address_line_1", "suburb", "city", "postal_code", "country"]
    return first_slots(rows, ["person_id"], order, slots, at_home, {
        **numbered_slots("emergency_contact_name", "emergency_contact_name", slots),
        **numbered_slots("contact_type", "contact_type", slots),
        **numbered_slots("emergency_contact_phn_no", "emergency_contact_phn_no", slots)})


def emergency_contact_list(src: Source, p: Params, site: Site = DEFAULT_SITE, same_type_only: bool = True) -> DataFrame:
    at = p.today()
    bosses = as_of(src.table("per_assignment_supervisors_f_v"), at).select("person_id", "assignment_id", "manager_id")
    people = (assignments(src, at).join(names(src, at), "person_id").join(numbers(src, at, "per_all_people_f"), "person_id")
              .join(bosses, ["person_id", "assignment_id"])
              .select("person_id", "full_name", "person_number", "assignment_number", "assignment_id", "assignment_name", "position_id",
                      "primary_flag", F.col("assignment_status_type").alias("assignment_status"), "manager_id"))
    places = positions(src, at, job=False).select("position_id", F.col("team_group").alias("group_team"), "department", "location")
    ranked = (people.join(ranked_categories(src, at, people), ["person_id", "position_id", "assignment_id"], "left")
              .join(manager_names(src, at, "per_all_people_f"), "manager_id", "left").join(places, "position_id"))
    both = {"assignment_number": "assignment_number", "assignment_category": "assignment_category", "assignment_status": "assignment_status",
            "department": "department", "group": "group_team", "location": "location", "manager_name": "manager_name",
            "manager_number": "manager_number"}
    slots = {"primary_flag": ("primary_flag", [1]), "secondary_flag": ("primary_flag", SLOTS_AFTER_FIRST),
             "secondary_assignment_name": ("assignment_name", SLOTS_AFTER_FIRST)}
    for label, c in both.items():
        slots[f"primary_{label}"] = (c, [1])
        slots[f"secondary_{label}"] = (c, SLOTS_AFTER_FIRST)
    staff = first_slots(ranked, ["person_id"], ["assignment_rank", "assignment_id"], 8, ["person_id", "full_name", "person_number"], slots)
    contacts = emergency_contacts(src, people, at, same_type_only=same_type_only).withColumns(
        {c: C.contact_type(F.col(c), site) for c in ("contact_type1", "contact_type2")})
    return staff.join(contacts, "person_id", "left").orderBy(F.asc_nulls_last("person_number"))


# ---- leavers ----------------------------------------------------------------------

def leavers(src: Source, p: Params, types: Sequence[str] = WORKERS) -> DataFrame:
    """Ended service with its reason and the assignment row that ended."""
    ended = (src.table("per_periods_of_service").filter(F.col("actual_termination_date").isNotNull() & F.col("period_type").isin(*types))
             .filter(optional_between(F.col("actual_termination_date"), p.date_from, p.date_to))
             .select("person_id", "period_of_service_id", "date_start", "actual_termination_date", "action_occurrence_id"))
    reasons = src.scan("per_action_reasons_vl", "action_reason_id action_reason")
    posts = src.table("per_all_assignments_m").filter(
        F.col("assignment_type").isin(*types) & (F.col("action_code") == "TERMINATION") & (F.col("assignment_status_type") == "INACTIVE")
    ).drop("effective_start_date", "effective_end_date")
    return (ended.join(src.scan("per_action_occurrences", "action_occurrence_id action_reason_id"), "action_occurrence_id")
            .join(reasons, "action_reason_id", "left").join(posts, "person_id")
            .join(src.scan("per_grades_f_vl", "grade_id grade_code"), "grade_id", "left"))


def leaving_list(src: Source, p: Params) -> DataFrame:
    """Leavers with tenure; position, manager and step are those of the leaving date."""
    today, left_on = p.today(), "actual_termination_date"
    base = leavers(src, p).withColumn("termination_status", D.termination_status(F.col(left_on), today))
    base = (base.join(names(src, today), "person_id").join(numbers(src, today), "person_id"))
    base = p.narrow(base, term_status="termination_status")
    bosses = src.scan("per_assignment_supervisors_f_v", "person_id assignment_id manager_id manager_assignment_id effective_start_date effective_end_date")
    base = as_of_join(base, bosses, ["person_id", "assignment_id"], left_on).drop("effective_start_date", "effective_end_date")
    cats = (src.scan("hcm_lookups", "lookup_code:employment_category lookup_type meaning:assignment_category")
            .filter(F.col("lookup_type") == "EMP_CAT").drop("lookup_type"))
    base = p.narrow(base.join(cats, "employment_category"), assignmentcategory="assignment_category")
    places = p.narrow(position_rows(src), teamgroup="team_group").select(
        "position_id", "position_code", "name", "full_part_time", F.col("attribute2").alias("anzco_code"),
        F.col("attribute1").alias("occupational_category"), F.col("attribute4").alias("leadership_role"),
        F.col("attribute5").alias("leadership_tier"), "team_group", "department", "location", "job", "pos_start", "pos_end", "dept_start", "dept_end")
    # a position that very many people have left is spread over decades
    df = as_of_join(base, places, ["position_id"], left_on, "pos_start", "pos_end", cell_years=10, horizon=(1980, 2040)).filter(
        F.col(left_on).between(F.col("dept_start"), F.col("dept_end")))
    boss_names = names(src, None).withColumnsRenamed({"person_id": "manager_id", "full_name": "manager_name"})
    boss_numbers = src.scan("per_people_f", "person_id:manager_id person_number:manager_number effective_start_date effective_end_date")
    boss_posts = (src.table("per_all_assignments_m").filter(F.col("assignment_type").isin(*WORKERS))
                  .select(F.col("assignment_id").alias("manager_assignment_id"), F.col("position_id").alias("manager_position_id"),
                          "effective_start_date", "effective_end_date"))
    boss_roles = src.scan("hr_all_positions_f_vl", "position_id:manager_position_id position_code:manager_position_code "
                          "name:manager_position_name effective_start_date effective_end_date")
    for side, key in ((boss_names, "manager_id"), (boss_numbers, "manager_id"), (boss_posts, "manager_assignment_id"),
                      (boss_roles, "manager_position_id")):
        df = as_of_join(df, side, [key], left_on).drop("effective_start_date", "effective_end_date")
    df = df.join(leaving_step(src, base), ["assignment_id", "grade_id"], "left")
    start, end = F.col("date_start"), F.col(left_on)
    return df.orderBy(left_on, "person_id", "assignment_id").select(
        "person_id", "full_name", "person_number", D.dmy(start).alias("start_date"), D.dmy(end).alias("termination_date"),
        D.tenure_text(start, end).alias("tenure"), D.tenure_months(start, end).alias("tenure_months"),
        F.col("action_reason").alias("termination_reason"), "termination_status", "assignment_id", "assignment_number", "assignment_name",
        "position_id", "grade_id", "primary_flag", "assignment_status_type", "action_code", F.col("grade_code").alias("band"), "position_code",
        "name", "full_part_time", "anzco_code", "occupational_category", "leadership_role", "leadership_tier", "team_group", "department",
        "location", "job", "manager_name", "manager_number", "manager_position_code", "manager_position_name", "assignment_category", "step")


def leaving_step(src: Source, gone: DataFrame) -> DataFrame:
    """Grade step on the leaving date."""
    ends = gone.select("assignment_id", "actual_termination_date").distinct()
    held = as_of_join(ends, src.scan("per_assign_grade_steps_f", "assignment_id grade_step_id effective_start_date effective_end_date"),
                      ["assignment_id"], "actual_termination_date").select("assignment_id", "actual_termination_date", "grade_step_id")
    steps = src.scan("per_grade_steps_f_vl", "grade_step_id name:step grade_id effective_start_date effective_end_date")
    return as_of_join(held, steps, ["grade_step_id"], "actual_termination_date").select(
        "assignment_id", "grade_step_id", "step", "grade_id").distinct().drop("grade_step_id")


# ---- workforce return -------------------------------------------------------------

def eligible_assignment(count: Column, primary: Column, status: Column, category: Column, site: Site = DEFAULT_SITE) -> Column:
    """Does this assignment stand for its person?  One assignment: the working or leave one; several:
    the substantive one, suspended while seconded or active again."""
    lasting = [site.code("SUBSTANTIVE_POSITION"), site.code("FIX_TERM")]
    seconded = [site.code("EXTERNAL_SECONDMENT"), site.code("INTERNAL_SECONDMENT")]
    leave = [site.code("LEAVE_WO_PAY"), site.code("PARENTAL_LEAVE")]
    active, suspended, main = status == "ACTIVE", status == "SUSPENDED", primary == "Y"
    single = main & ((active & category.isin(*lasting, *seconded)) | (suspended & category.isin(*leave)))
    several = category.isin(*lasting) & (((primary == "N") & suspended) | (main & active))
    return F.when(count == 1, single).when(count >= 2, several).otherwise(False)


def _window(p: Params, df: DataFrame, start: str, end: str) -> DataFrame:
    low = F.lit(p.date_from or D.FIRST_DAY)
    return df.filter(overlaps(low, F.lit(p.date_to) if p.date_to else None, F.col(start), F.col(end), p.today()))


def substantive_assignment(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """The assignment that represents each person over the window, with its last manager."""
    posts = _window(p, src.table("per_all_assignments_m").filter(
        (F.col("assignment_type") == "E") & (F.col("effective_latest_change") == "Y") & (F.col("assignment_status_type") != "INACTIVE")),
        "effective_start_date", "effective_end_date")
    counts = posts.groupBy("person_id").agg(F.count_distinct("assignment_id").alias("assignment_count"))
    kept = (arg_max_rows(posts, ["person_id", "assignment_id"], "effective_end_date").join(counts, "person_id")
            .filter(eligible_assignment(F.col("assignment_count"), F.col("primary_flag"), F.col("assignment_status_type"),
                                        F.col("employment_category"), site)))
    bosses = _window(p, semi(src.table("per_assignment_supervisors_f_v"), kept, [("assignment_id", "assignment_id")]),
                     "effective_start_date", "effective_end_date")
    last = arg_max_rows(bosses, ["person_id"], "effective_end_date").select("person_id", "assignment_id", "manager_id", "manager_assignment_id")
    return kept.drop("effective_start_date", "effective_end_date", "assignment_count").join(last, ["person_id", "assignment_id"])


def rated_salaries(src: Source, p: Params, in_window: bool) -> DataFrame:
    """Salary rows with the grade's rate range valid in the window."""
    rows = salaries(src)
    if in_window:
        rows = _window(p, rows, "date_from", "date_to")
    bases = src.scan("cmp_salary_bases_vl", "salary_basis_id grade_rate_id")
    rates = _window(p, src.scan("per_rate_values_f", "rate_object_id:grade_id rate_id:grade_rate_id minimum mid_value maximum "
                                "effective_start_date effective_end_date"), "effective_start_date", "effective_end_date")
    return (rows.join(bases, "salary_basis_id").join(rates, ["grade_id", "grade_rate_id"])
            .select("person_id", "assignment_id", "grade_id", "salary_amount", "annual_ft_salary", "minimum", "mid_value", "maximum",
                    "date_from", "date_to"))


def latest_salary_with_range(src: Source, p: Params) -> DataFrame:
    return arg_max_rows(rated_salaries(src, p, True), ["person_id", "assignment_id"], "date_from").drop("date_from", "date_to")


def ethnicities(src: Source) -> DataFrame:
    """Up to three answers per person as reporting codes."""
    words = src.table("hcm_lookups").filter(F.col("lookup_type") == "PER_ETHNICITY")
    given = src.scan("per_ethnicities", "person_id ethnicity attribute1 attribute2")
    for i, c in enumerate(("ethnicity", "attribute1", "attribute2"), 1):
        given = left_lookup(given, words, [(c, "lookup_code")], {f"m{i}": "meaning", f"c{i}": "lookup_code"})
        given = given.withColumn(f"e{i}", F.when(F.col(f"c{i}").isNotNull(), C.ethnicity_code(F.col(f"m{i}"))))
    return given.select("person_id", "e1", "e2", "e3")


def _workforce_columns(df: DataFrame, src: Source, at: Column | str, site: Site) -> DataFrame:
    """The columns both halves of the return share.  ``at`` is the window's end for current staff,
    or the name of the leaving-date column."""
    span = ["effective_start_date", "effective_end_date"]

    def valid(side: DataFrame, base: DataFrame) -> DataFrame:
        """Rows of ``side`` valid at the fixed date, or at the dates of ``base`` (with ``_at``)."""
        return as_of(side, at) if isinstance(at, Column) else as_of_join(base, side, ["_key"], "_at")

    def keys_of(c: str) -> DataFrame | None:
        return None if isinstance(at, Column) else df.select(F.col(c).alias("_key"), F.col(at).alias("_at")).filter("_key IS NOT NULL").distinct()

    def looked_up(frame: DataFrame, c: str, side: DataFrame, value: str, name: str) -> DataFrame:
        keys = [(c, "_key")] if isinstance(at, Column) else [(c, "_key"), (at, "_at")]
        return lookup_one(frame, side, keys, value, name)

    sexes = src.table("per_people_legislative_f").select(F.col("person_id").alias("_key"), C.gender_code(F.col("sex")).alias("g"), *span)
    measures = src.table("per_assign_work_measures_f").filter(F.col("unit") == "FTE").select(F.col("assignment_id").alias("_key"), "value", *span)
    people = src.table("per_people_f").select(F.col("person_id").alias("_key"), "person_number", *span)
    bosses = (src.table("per_all_assignments_m").filter(F.col("assignment_type") == "E")
              .select(F.col("assignment_id").alias("_key"), "position_id", *span))
    roles = src.table("hr_all_positions_f_vl").select("position_id", F.struct("name", "attribute4").alias("role"), *span)
    led = valid(bosses, keys_of("manager_assignment_id")).drop(*span)
    led = led.join(as_of(roles, at), "position_id") if isinstance(at, Column) else as_of_join(led, roles, ["position_id"], "_at")
    births = src.table("per_persons").select("person_id", D.dmy(F.col("date_of_birth"), "/").alias("b"))
    answers = ethnicities(src).select("person_id", F.struct("e1", "e2", "e3").alias("answers"))
    out = looked_up(df, "person_id", valid(sexes, keys_of("person_id")), "g", "gender")
    out = looked_up(out, "assignment_id", valid(measures, keys_of("assignment_id")), "value", "fte")
    out = looked_up(out, "manager_id", valid(people.withColumnRenamed("person_number", "n"), keys_of("manager_id")), "n", "manager_number")
    out = looked_up(out, "manager_assignment_id", led, "role", "_boss_role")
    out = lookup_one(out, births, [("person_id", "person_id")], "b", "date_of_birth")
    df = lookup_one(out, answers, [("person_id", "person_id")], "answers", "_answers").withColumns(
        {f"_e{i}": F.col(f"_answers.e{i}") for i in (1, 2, 3)})
    one, two, three = C.dedupe_answers(F.coalesce("_e1", F.lit(C.NOT_STATED)), F.col("_e2"), F.col("_e3"))
    return df.select(
        "person_id", "full_name", "person_number", D.dmy(F.col("date_start"), "/").alias("start_date"), "termination_date", "action_reason",
        "terminationreason", "assignment_number", "assignment_id", "assignment_name", "position_id", F.col("name").alias("jobtitle"),
        F.col("attribute2").alias("anzsco_code"), "employment_category", "grade_id", "assignment_status_type",
        X.band_number(F.col("grade_code")).alias("band"), "gender", "date_of_birth",
        C.region_number(F.col("internal_location_code")).alias("region"), F.col("team_group").alias("businessunit"),
        F.col("department").alias("businessunit2"), "salary_amount", "annual_ft_salary",
        *(F.col(c).cast("bigint").alias(c) for c in ("minimum", "mid_value", "maximum")), "fte",
        one.alias("ethnicity1"), two.alias("ethnicity2"), three.alias("ethnicity3"), "status",
        C.contract_term(F.col("employment_category"), site).alias("contractterm"), "manager_number",
        C.management_profile(F.col("_boss_role.name"), F.col("_boss_role.attribute4"), F.col("attribute4")).alias("managementprofile"))


_ROLE = ("position_id", "name", "attribute2", "attribute4", "internal_location_code", "team_group", "department")


def current_staff(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Staff at the end of the window."""
    at = F.lit(p.date_to)
    service = src.table("per_periods_of_service").filter(F.col("period_type") == "E").filter(
        at.between(F.col("date_start"), F.col("actual_termination_date"))
        | ((F.col("date_start") <= p.today()) & F.col("actual_termination_date").isNull())).select("person_id", "date_start")
    places = as_of(as_of(position_rows(src, job=False), at, "pos_start", "pos_end"), at, "dept_start", "dept_end").select(*_ROLE)
    df = (substantive_assignment(src, p, site)
          .join(names(src, at), "person_id").join(numbers(src, at), "person_id").join(service, "person_id").join(places, "position_id")
          .join(src.scan("per_grades_f_vl", "grade_id grade_code"), "grade_id", "left")
          .join(latest_salary_with_range(src, p), ["person_id", "assignment_id", "grade_id"], "left")
          .join(category_lookup(src, at, ["E"]), ["person_id", "position_id", "assignment_id"], "left"))
    return _workforce_columns(df.withColumns({
        "termination_date": F.lit(None).cast("string"), "action_reason": F.lit(None).cast("string"),
        "terminationreason": F.lit(None).cast("int"), "status": C.assignment_status(F.col("assignment_category"))}), src, at, site)


def gone_staff(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    """Leavers of the window, seen on their leaving date."""
    left_on = "actual_termination_date"
    gone = leavers(src, p, ["E"]).filter((F.col("primary_flag") == "Y") & (F.col(left_on) < F.lit(p.date_to)))
    # a person with two ended services is an error, as each leaver must have one
    spans = src.table("per_periods_of_service").filter((F.col("period_type") == "E") & F.col(left_on).isNotNull())
    gone = lookup_one(gone, spans, [("person_id", "person_id")], "period_of_service_id", "_only").filter(
        F.col("_only") == F.col("period_of_service_id")).drop("_only")
    spans_of = ("effective_start_date", "effective_end_date")
    bosses = src.scan("per_assignment_supervisors_f_v", "assignment_id manager_id manager_assignment_id effective_start_date effective_end_date")
    people = src.scan("per_people_f", "person_id person_number effective_start_date effective_end_date")
    for side, key in ((names(src, None), "person_id"), (people, "person_id"), (bosses, "assignment_id")):
        gone = as_of_join(gone, side, [key], left_on).drop(*spans_of)
    places = position_rows(src, job=False).select(*_ROLE, "pos_start", "pos_end", "dept_start", "dept_end")
    df = as_of_join(gone, places, ["position_id"], left_on, "pos_start", "pos_end").filter(
        F.col(left_on).between(F.col("dept_start"), F.col("dept_end")))
    df = df.join(rated_salaries(src, p, False), ["person_id", "assignment_id", "grade_id"], "left").filter(
        valid_at(F.col(left_on), F.col("date_from"), F.col("date_to"), allow_missing=True))
    return _workforce_columns(df.withColumns({
        "termination_date": D.dmy(F.col(left_on), "/"), "terminationreason": C.leaving_reason(F.col("action_reason")),
        "status": F.lit(6)}).transform(cut), src, left_on, site)


def workforce_return(src: Source, p: Params, site: Site = DEFAULT_SITE) -> DataFrame:
    return current_staff(src, p, site).unionByName(gone_staff(src, p, site)).orderBy(F.asc_nulls_last("person_number"))
