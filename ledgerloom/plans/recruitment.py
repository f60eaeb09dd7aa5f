"""Requisitions and vacancies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import codes as C, dates as D
from ledgerloom.functions.params import Params
from ledgerloom.operators.relational import arg_max_rows
from ledgerloom.operators.temporal import as_of
from ledgerloom.sources.catalog import Source

# States that close a requisition.
CLOSED_STATES = ("Canceled", "Filled", "Deleted")


def latest_submissions(src: Source) -> DataFrame:
    """Phase and state of the latest candidate change per requisition; equal times all count."""
    phases = src.scan("irc_phases_vl", "phase_id:current_phase_id name:candidate_phase")
    states = src.scan("irc_states_vl", "state_id:current_state_id name:candidate_state")
    rows = src.scan("irc_submissions", "requisition_id current_phase_id current_state_id last_update_date")
    return (arg_max_rows(rows, ["requisition_id"], "last_update_date").join(phases, "current_phase_id").join(states, "current_state_id")
            .select("requisition_id", D.dmy(F.col("last_update_date")).alias("last_update_date"), "candidate_phase", "candidate_state"))


def open_requisitions(src: Source, candidates: bool = True) -> DataFrame:
    phases = src.table("irc_phases_vl").filter(F.col("type_code") == "REQUISITION").select(
        F.col("phase_id").alias("current_phase_id"), F.col("name").alias("requisition_phase"))
    states = src.table("irc_states_vl").filter((F.col("type_code") == "REQUISITION") & ~F.col("name").isin(*CLOSED_STATES)).select(
        F.col("state_id").alias("current_state_id"), F.col("name").alias("requisition_state"))
    df = (src.table("irc_requisitions_b").join(phases, "current_phase_id").join(states, "current_state_id")
          .join(src.scan("per_grades_f_vl", "grade_id grade_code:requisition_band"), "grade_id", "left")
          .withColumns({"filled_date": D.dmy(F.col("filled_date")), "open_date": D.dmy(F.col("open_date"))}))
    return df.join(latest_submissions(src), "requisition_id", "left") if candidates else df


def vacancy_status(occupant: Column, requisition: Column) -> Column:
    return (F.when(occupant.isNotNull(), F.lit("Occupied")).when(requisition.isNotNull(), F.lit("Active-Recruitment"))
            .otherwise("Vacant"))


def vacancies(src: Source, p: Params) -> DataFrame:
    """Positions nobody holds, with their requisition, hiring manager and future starter."""
    from ledgerloom.plans.people import assignments, manager_names, manager_positions, positions

    at = p.today()
    posts = positions(src, at, job=False).join(src.scan("per_grades_f_vl", "grade_id:entry_grade_id grade_code"), "entry_grade_id", "left")
    posts = p.narrow(posts, team_group="team_group").select(
        "position_id", "position_code", "name", F.col("team_group").alias("group_team"), "position_type", "location", "department",
        C.working_time(F.col("full_part_time"), keep_other=False).alias("full_part_time"), "grade_code")
    # an occupied position is never shown, so only its absence matters
    free = posts.join(assignments(src, at).select("position_id").distinct(), "position_id", "left_anti")
    df = free.join(open_requisitions(src), "position_id", "left").withColumn(
        "pos_status", vacancy_status(F.lit(None), F.col("requisition_id")))
    df = p.narrow(df, position_status="pos_status", req_phase="requisition_phase", can_phase="candidate_phase")
    hiring = manager_names(src, at).withColumnsRenamed({
        "manager_id": "hiring_manager_id", "manager_name": "hiring_manager_name", "manager_number": "hiring_manager_number"})
    roles = manager_positions(src, at).withColumnsRenamed({
        "manager_position_code": "hiring_manager_position_code", "manager_position_name": "hiring_manager_position_name"})
    starters = as_of(src.table("per_all_assignments_m").filter(
        (F.col("assignment_type") == "P") & (F.col("projected_start_date") > at)), at).select("position_id", "projected_start_date")
    df = (df.join(hiring, "hiring_manager_id", "left").join(roles, "manager_assignment_id", "left").join(starters, "position_id", "left"))
    return df.select(
        "position_code", "name", "group_team", "position_type", "location", "department", "full_part_time", "pos_status", "requisition_id",
        "requisition_number", "filled_date", "open_date", "requisition_phase", "requisition_state", "candidate_phase", "candidate_state",
        "last_update_date", "worker_type_code", F.coalesce("requisition_band", "grade_code").alias("band"), "hiring_manager_name",
        "hiring_manager_number", "hiring_manager_position_code", "hiring_manager_position_name",
        F.when(F.col("projected_start_date").isNotNull(), F.lit("Yes")).alias("future_incumbent"),
        D.dmy(F.col("projected_start_date")).alias("projected_start_date"),
    ).orderBy("pos_status", F.asc_nulls_last("position_code"))
