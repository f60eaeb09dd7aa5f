"""People reports on the stand-in tables."""

from __future__ import annotations

import datetime as dt

from ledgerloom.checks.registry import register
from ledgerloom.checks.reports_finance import d
from ledgerloom.functions.params import Params
from ledgerloom.plans import payroll as Y, people as P, recruitment as R

AT = dt.date(1998, 6, 30)
PLAIN = Params(as_at=AT)


def on(day: str, a: str, start: str = "effective_start_date", end: str = "effective_end_date") -> str:
    return f"{day} BETWEEN {a}.{start} AND {a}.{end}"


def dims(day: str = "date '1998-06-30'") -> str:
    """Named sub-results at a day: posts, post (all staff in post), human, boss_post."""
    return f"""
    place AS (
      SELECT a.* EXCLUDE (name), a.name AS role, a.attribute8 AS team_group, a.attribute6 AS position_type, z.name AS department, l.location_name,
             l.internal_location_code AS site_code,
             CASE WHEN l.internal_location_code LIKE 'WLG_L_' THEN 'Wellington' WHEN l.internal_location_code IN ('AKL_L7', 'AKL_APO') THEN 'Auckland'
                  ELSE l.location_name END AS location
      FROM {{hr_all_positions_f_vl}} a JOIN {{per_departments}} z ON z.organization_id = a.organization_id AND {on(day, 'z')}
      LEFT JOIN {{hr_locations_all_f_vl}} l ON l.location_id = a.location_id
      WHERE {on(day, 'a')} AND a.active_status = 'A'),
    human AS (
      SELECT n.person_id, n.full_name, w.person_number FROM {{per_person_names_f}} n JOIN {{per_people_f}} w USING (person_id)
      WHERE n.name_type = 'GLOBAL' AND {on(day, 'n')} AND {on(day, 'w')}),
    post AS (
      FROM {{per_all_assignments_m}} a WHERE assignment_type <> 'P' AND effective_latest_change = 'Y'
      AND assignment_status_type <> 'INACTIVE' AND {on(day, 'a')}),
    service AS (
      SELECT person_id, date_start FROM {{per_periods_of_service}}
      WHERE date_start <= {day} AND coalesce(actual_termination_date, {day}) >= {day}),
    category AS (
      SELECT DISTINCT person_id, position_id, assignment_id, h.meaning AS assignment_category
      FROM post JOIN {{hcm_lookups}} h ON h.lookup_code = post.employment_category AND h.lookup_type = 'EMP_CAT'),
    fte AS (SELECT assignment_id, value AS fte FROM {{per_assign_work_measures_f}} m WHERE unit = 'FTE' AND {on(day, 'm')}),
    pay AS (
      SELECT s.person_id, s.assignment_id, a.grade_id, s.salary_amount, s.annual_ft_salary, s.fte_value, s.salary_basis_id, s.date_from, s.date_to
      FROM {{cmp_salary}} s JOIN {{per_all_assignments_m}} a ON a.assignment_id = s.assignment_id AND {on('s.date_from', 'a')}
      WHERE a.assignment_type = 'E' AND a.effective_latest_change = 'Y'),
    boss_role AS (
      SELECT a.assignment_id, r.position_code AS manager_position_code, r.name AS manager_position_name
      FROM {{per_all_assignments_m}} a JOIN {{hr_all_positions_f_vl}} r USING (position_id)
      WHERE a.assignment_type IN ('E', 'C') AND {on(day, 'a')} AND {on(day, 'r')}),
    boss AS (
      SELECT m.person_id, m.assignment_id, m.manager_id, m.manager_assignment_id
      FROM {{per_assignment_supervisors_f_v}} m WHERE {on(day, 'm')})"""


_STAFF = f"""
    staff AS (
      SELECT post.*, full_name, person_number, strftime(date_start, '%d/%m/%Y') AS start_date,
             strftime(projected_assignment_end, '%d/%m/%Y') AS projected_end_date, strftime(ass_attribute_date1, '%d/%m/%Y') AS leave_return_date
      FROM post JOIN human USING (person_id) JOIN service USING (person_id)),
    work_place AS (SELECT place.*, j.name AS job FROM place JOIN {{per_jobs}} j USING (job_id))"""


def _managed(staff: str) -> str:
    return f"""
    managed AS (
      SELECT boss.person_id, boss.assignment_id, b.full_name AS manager_name, b.person_number AS manager_number,
             w.position_code AS manager_position_code, w.role AS manager_position_name
      FROM boss JOIN (SELECT DISTINCT person_id, full_name, person_number FROM {staff}) b ON b.person_id = boss.manager_id
      JOIN {{per_all_assignments_m}} a ON a.assignment_id = boss.manager_assignment_id AND a.person_id = boss.manager_id
        AND {on("date '1998-06-30'", 'a')}
      JOIN work_place w ON w.position_id = a.position_id)"""


_LEAD = """w.position_code, w.position_id, w.role AS name, CASE w.full_part_time WHEN 'FULL_TIME' THEN 'Full Time' WHEN 'PART_TIME' THEN 'Part Time'
           ELSE w.full_part_time END AS full_part_time, w.position_type, w.attribute4 AS leadership_role, w.attribute5 AS leadership_tier"""

register("report_r05", lambda s: P.staff_condensed(s, PLAIN), f"""
    WITH {dims()}, {_STAFF}, mailed AS (SELECT staff.*, e.email_address FROM staff JOIN {{per_email_addresses}} e USING (person_id) WHERE e.email_type = 'W1'),
    {_managed('mailed')}
    SELECT {_LEAD}, w.location, w.department, w.team_group, w.job, x.person_number, x.full_name, x.person_id, x.assignment_number,
           x.email_address, if(x.assignment_status_type = 'ACTIVE', 'Active', 'Suspended') AS employment_type, x.primary_flag,
           x.start_date, x.leave_return_date, x.projected_end_date, c.assignment_category, fte.fte, m.manager_name, m.manager_number,
           m.manager_position_code, m.manager_position_name
    FROM mailed x JOIN work_place w USING (position_id)
    LEFT JOIN category c USING (person_id, position_id, assignment_id) LEFT JOIN fte USING (assignment_id)
    LEFT JOIN managed m USING (person_id, assignment_id)""")

register("report_r06", lambda s: P.staff_details(s, PLAIN), f"""
    WITH {dims()}, {_STAFF}, {_managed('staff')},
    step AS (
      SELECT DISTINCT g.assignment_id, g.grade_step_id, t.name AS step, t.grade_id FROM {{per_assign_grade_steps_f}} g
      JOIN {{per_grade_steps_f_vl}} t USING (grade_step_id) WHERE {on("date '1998-06-30'", 'g')} AND {on("date '1998-06-30'", 't')})
    SELECT {_LEAD}, w.location_name AS location, w.department, w.team_group, w.job, x.person_number, x.full_name, x.person_id, x.assignment_number,
           x.assignment_status_type AS employment_type, x.primary_flag, g.grade_code AS band, step.step, x.ass_attribute5 AS employment_agreement,
           x.ass_attribute2 AS grandparenting, x.ass_attribute1 AS personal_union, x.start_date, x.leave_return_date, x.projected_end_date,
           c.assignment_category, p.fte_value AS fte, m.manager_name, m.manager_number, m.manager_position_code, m.manager_position_name,
           p.annual_ft_salary, p.salary_amount
    FROM staff x JOIN work_place w USING (position_id) LEFT JOIN {{per_grades_f_vl}} g ON g.grade_id = x.grade_id
    LEFT JOIN category c USING (person_id, position_id, assignment_id) LEFT JOIN managed m USING (person_id, assignment_id)
    LEFT JOIN step ON step.assignment_id = x.assignment_id AND step.grade_id = x.grade_id
    LEFT JOIN pay p ON p.person_id = x.person_id AND p.assignment_id = x.assignment_id AND p.grade_id = x.grade_id
      AND date '1998-06-30' BETWEEN p.date_from AND p.date_to""")

# ---- positions ----

_REQ = """
    asked AS (
      SELECT r.*, p.name AS requisition_phase, t.name AS requisition_state, g.grade_code AS asked_band FROM {irc_requisitions_b} r
      JOIN {irc_phases_vl} p ON p.phase_id = r.current_phase_id AND p.type_code = 'REQUISITION'
      JOIN {irc_states_vl} t ON t.state_id = r.current_state_id AND t.type_code = 'REQUISITION'
      LEFT JOIN {per_grades_f_vl} g ON g.grade_id = r.grade_id WHERE t.name NOT IN ('Filled', 'Deleted', 'Canceled'))"""
_SHOWN = ["person_number", "full_name", "person_id", "employment_type2", "assignment_category", "assignment_rank", "assignment_id",
          "projected_end_date", "annual_ft_salary", "salary_amount", "fte_value"]


def _positions(mask: bool) -> str:
    hide = "department IN ('Finance', 'Financial Performance and Planning', 'Finance Reporting and Control')" if mask else "false"

    def pay(c: str) -> str:
        return f"if({hide}, NULL, {c}) AS {c.split('.')[-1]}"
    return f"""
    WITH {dims()}, {_REQ},
    ranked AS (SELECT *, dense_rank() OVER (ORDER BY assignment_category DESC) AS assignment_rank
               FROM category WHERE assignment_id IN (SELECT assignment_id FROM post JOIN human USING (person_id))),
    held AS (
      SELECT post.position_id, h.person_number, h.full_name, post.person_id, post.assignment_status_type AS employment_type2, r.assignment_category,
             r.assignment_rank, post.assignment_id, strftime(projected_assignment_end, '%d/%m/%Y') AS projected_end_date, p.annual_ft_salary,
             p.salary_amount, p.fte_value,
             row_number() OVER (PARTITION BY post.position_id ORDER BY r.assignment_rank NULLS LAST, post.assignment_id, p.salary_amount NULLS LAST) AS n
      FROM post JOIN human h USING (person_id) LEFT JOIN ranked r USING (person_id, position_id, assignment_id)
      LEFT JOIN pay p ON p.person_id = post.person_id AND p.assignment_id = post.assignment_id AND p.grade_id = post.grade_id
        AND date '1998-06-30' BETWEEN p.date_from AND p.date_to),
    slots AS (
      SELECT position_id, {', '.join(f'max({c}) FILTER (n = 1) AS {c}, max({c}) FILTER (n BETWEEN 2 AND 8) AS secondary_{c}' for c in _SHOWN)}
      FROM held GROUP BY position_id),
    tree AS (
      SELECT t.pk1_start_value AS dce_group, vt.description AS dec_group_desc, if(m.depth = 1, m.pk1_start_value, NULL) AS gm_group,
             if(m.depth = 1, vm.description, NULL) AS gm_group_desc, if(m.depth = 2, m.pk1_start_value, b.pk1_start_value) AS cost_center
      FROM {{fnd_tree_node}} t JOIN {{fnd_tree_version_vl}} v ON v.tree_version_id = t.tree_version_id AND v.status = 'ACTIVE'
      JOIN {{fnd_tree_node}} m ON m.parent_tree_node_id = t.tree_node_id AND m.tree_version_id = t.tree_version_id AND m.depth > t.depth
      LEFT JOIN {{fnd_tree_node}} b ON b.parent_tree_node_id = m.tree_node_id AND b.tree_version_id = m.tree_version_id AND b.depth > m.depth
      JOIN {{fnd_flex_values_vl}} vt ON vt.flex_value = t.pk1_start_value JOIN {{fnd_flex_values_vl}} vm ON vm.flex_value = m.pk1_start_value
      WHERE t.parent_tree_node_id IS NULL AND vt.description <> 'Historical Cost Centres'
        AND vt.value_category = 'ORG_COST_CENTER' AND vm.value_category = 'ORG_COST_CENTER'),
    paths AS (SELECT DISTINCT tree.*, v.description AS cc_group_desc FROM tree JOIN {{fnd_flex_values_vl}} v ON v.flex_value = tree.cost_center
              WHERE v.value_category = 'ORG_COST_CENTER'),
    above AS (
      SELECT DISTINCT h.position_id, u.name AS parent_position_name, u.position_id AS parent_id FROM {{per_position_hierarchy_f}} h
      JOIN {{hr_all_positions_f_vl}} u ON u.position_id = h.parent_position_id
      WHERE {on("date '1998-06-30'", 'h')} AND {on("date '1998-06-30'", 'u')})
    SELECT w.position_code, w.position_id, w.role AS name, w.position_type AS employment_type, w.attribute2 AS anzco_code,
           w.attribute1 AS occupational_category, w.attribute4 AS leadership_role, w.attribute5 AS leadership_tier,
           w.attribute7 AS position_under_collective_coverage_flag, w.location, w.department, j.name AS job, w.team_group AS group_team,
           parent_position_name, cc.value AS cost_center, dce_group, dec_group_desc, gm_group, gm_group_desc, cc_group_desc, g.grade_code AS band,
           {pay('rate.mid_value')}, 1 AS position_fte, s.person_number, s.full_name, s.person_id, s.employment_type2, s.assignment_category,
           s.assignment_rank, s.projected_end_date, {pay('s.annual_ft_salary')}, {pay('s.salary_amount')}, s.fte_value, s.secondary_person_number,
           s.secondary_full_name, s.secondary_person_id, s.secondary_employment_type2, s.secondary_assignment_category, s.secondary_assignment_rank,
           s.secondary_projected_end_date, {pay('s.secondary_annual_ft_salary')}, {pay('s.secondary_salary_amount')}, s.secondary_fte_value,
           CASE s.employment_type2 || coalesce('+' || s.secondary_employment_type2, '')
             WHEN 'ACTIVE' THEN 'Position Occupied' WHEN 'ACTIVE+ACTIVE' THEN 'Position Occupied' WHEN 'SUSPENDED' THEN 'Position Suspended'
             WHEN 'SUSPENDED+ACTIVE' THEN 'Position Backfilled' WHEN 'ACTIVE+SUSPENDED' THEN 'Position Backfilled'
             ELSE if(s.assignment_id IS NULL, if(asked.requisition_id IS NULL, 'Position Vacant', 'Position in Active-Recruitment'), NULL) END AS position_status
    FROM place w JOIN {{per_jobs}} j USING (job_id) LEFT JOIN {{fnd_vs_values_b}} cc ON cc.value_id = w.cost_center
    LEFT JOIN {{per_grades_f_vl}} g ON g.grade_id = w.entry_grade_id LEFT JOIN {{per_rate_values_f}} rate ON rate.rate_object_id = w.entry_grade_id
    LEFT JOIN above ON above.position_id = w.position_id LEFT JOIN slots s ON s.position_id = w.position_id
    LEFT JOIN asked ON asked.position_id = w.position_id LEFT JOIN paths ON paths.cost_center = cc.value
    WHERE coalesce({on("date '1998-06-30'", 'rate')}, true)"""


register("report_r03", lambda s: P.all_positions(s, PLAIN, mask_pay=True), _positions(True))
register("report_r04", lambda s: P.all_positions(s, PLAIN), _positions(False))

# ---- allowances ----

register("report_r07", lambda s: Y.allowance_list(s, Params(as_at=AT, date_from=dt.date(1997, 7, 1), date_to=dt.date(1998, 6, 30))), f"""
    WITH {dims()},
    paid AS (
      SELECT t.base_element_name AS element_name, v.effective_start_date AS b, v.effective_end_date AS e, g.assignment_id, k.description,
             max(v.screen_entry_value) FILTER (i.base_name = 'Amount') AS amount, max(v.screen_entry_value) FILTER (i.base_name = 'Periodicity') AS periodicity
      FROM {{pay_element_entries_f}} n JOIN {{pay_element_types_f}} t USING (element_type_id)
      JOIN {{pay_element_entry_values_f}} v USING (element_entry_id)
      JOIN {{pay_input_values_f}} i ON i.input_value_id = v.input_value_id AND i.element_type_id = n.element_type_id
      JOIN {{fnd_lookup_values}} k ON k.meaning = t.base_element_name AND k.lookup_type = 'ORG_ALLOWANCE_LIST' AND k.language = 'US'
      LEFT JOIN {{pay_entry_usages}} y USING (element_entry_id)
      LEFT JOIN {{pay_rel_groups_dn}} g ON g.payroll_relationship_id = y.payroll_relationship_id AND g.relationship_group_id = y.payroll_assignment_id
      WHERE t.base_element_name <> 'ORG PSA Union Membership' AND v.effective_end_date >= date '1997-07-01'
        AND (v.effective_start_date >= date '1997-07-01' OR date '1997-07-01' BETWEEN v.effective_start_date AND v.effective_end_date)
        AND v.effective_start_date <= date '1998-06-30'
      GROUP BY ALL)
    SELECT element_name, {d('b')} AS element_start_date, {d('e')} AS element_end_date, paid.assignment_id, paid.description, amount, periodicity,
           h.full_name, h.person_number, h.person_id, {d('s.actual_termination_date')} AS termination_date,
           if(s.actual_termination_date > date '1998-06-30', 'UT', if(s.actual_termination_date IS NULL, NULL, 'Y')) AS "terminated", w.position_id, w.position_code,
           w.role AS position_name, w.team_group AS group_team, w.department, fte.fte, p.salary_amount AS fte_salary_amount,
           p.annual_ft_salary AS annual_salary, b.full_name AS manager_name, b.person_number AS manager_number, br.manager_position_code,
           br.manager_position_name
    FROM paid JOIN post ON post.assignment_id = paid.assignment_id AND post.assignment_type = 'E' JOIN human h USING (person_id)
    JOIN {{per_periods_of_service}} s ON s.person_id = h.person_id AND s.period_type = 'E'
    JOIN {{per_assignment_supervisors_f_v}} m ON m.person_id = h.person_id AND m.assignment_id = post.assignment_id
      AND coalesce(s.actual_termination_date, date '1998-06-30') BETWEEN m.effective_start_date AND m.effective_end_date
    JOIN place w ON w.position_id = post.position_id JOIN human b ON b.person_id = m.manager_id
    JOIN boss_role br ON br.assignment_id = m.manager_assignment_id LEFT JOIN fte ON fte.assignment_id = post.assignment_id
    LEFT JOIN pay p ON p.person_id = h.person_id AND p.assignment_id = post.assignment_id AND date '1998-06-30' BETWEEN p.date_from AND p.date_to""")

# ---- emergency contacts ----

_KIND = "CASE {t} WHEN 'S' THEN 'Spouse' WHEN 'P' THEN 'Parent' WHEN 'F' THEN 'Friend' WHEN 'C' THEN 'Child' WHEN 'ORG_SIBLING' THEN 'Sibling' WHEN 'ORG_RELATIVE' THEN 'Relative' WHEN 'ORG_PARTNER' THEN 'Partner' WHEN 'ORG_NCR' THEN 'Contact not defined' WHEN 'EMRG' THEN 'Contact not defined' END"
_BOTH = {"assignment_number": "assignment_number", "assignment_category": "assignment_category", "assignment_status": "assignment_status_type",
         "department": "department", "group": "team_group", "location": "location", "manager_name": "manager_name", "manager_number": "manager_number"}


def _contacts(same_type: bool) -> str:
    home, h1 = ("u.address_type = 'HOME'", "m.email_type = 'H1'") if same_type else ("true", "true")
    return f"""
    WITH {dims()},
    person AS (SELECT post.*, full_name, person_number, manager_id FROM post JOIN human USING (person_id) JOIN boss USING (person_id, assignment_id)),
    ranked AS (SELECT *, dense_rank() OVER (ORDER BY assignment_category DESC) AS r FROM category WHERE assignment_id IN (SELECT assignment_id FROM person)),
    listed AS (
      SELECT person.*, assignment_category, b.full_name AS manager_name, b.person_number AS manager_number, team_group, department, location,
             row_number() OVER (PARTITION BY person.person_id ORDER BY r NULLS LAST, person.assignment_id) AS n
      FROM person LEFT JOIN ranked USING (person_id, position_id, assignment_id) LEFT JOIN human b ON b.person_id = person.manager_id
      JOIN place ON place.position_id = person.position_id),
    staff AS (
      SELECT person_id, full_name, person_number, max(primary_flag) FILTER (n = 1) AS primary_flag,
             max(primary_flag) FILTER (n BETWEEN 2 AND 8) AS secondary_flag, max(assignment_name) FILTER (n BETWEEN 2 AND 8) AS secondary_assignment_name,
             {', '.join(f'max({c}) FILTER (n = 1) AS primary_{k}, max({c}) FILTER (n BETWEEN 2 AND 8) AS secondary_{k}' for k, c in _BOTH.items())}
      FROM listed GROUP BY ALL),
    address AS (
      SELECT u.person_id, u.address_id, a.address_line_1 || coalesce(',' || a.address_line_2, '') AS address_line_1, a.address_line_3 AS suburb,
             a.town_or_city AS city, a.postal_code, a.country
      FROM {{per_person_addr_usages_f}} u JOIN {{per_addresses_f}} a USING (address_id)
      WHERE {home} AND (u.person_id, u.effective_start_date) IN (
        SELECT (person_id, max(effective_start_date)) FROM {{per_person_addr_usages_f}} x
        WHERE address_type = 'HOME' AND {on("date '1998-06-30'", 'x')} GROUP BY person_id)),
    mail AS (SELECT person_id, email_address FROM {{per_email_addresses}} m WHERE {h1} AND (person_id, date_from) IN (
        SELECT (person_id, max(date_from)) FROM {{per_email_addresses}} WHERE email_type = 'H1' GROUP BY person_id)),
    calls AS (
      SELECT ec.person_id, ec.contact_person_id, ec.contact_type, n.full_name AS nm, t.phone_number AS tel, ph.phone_number, email_address, address_id,
             address_line_1, suburb, city, postal_code, country,
             row_number() OVER (PARTITION BY ec.person_id ORDER BY ec.contact_person_id, n.full_name NULLS LAST, ec.contact_type NULLS LAST, t.phone_number NULLS LAST,
               ph.phone_number NULLS LAST, email_address NULLS LAST, address_id NULLS LAST) AS k
      FROM {{per_contact_relationships}} cr JOIN {{per_contact_relationships}} ec ON ec.contact_person_id = cr.contact_person_id
      JOIN {{per_person_names_f}} n ON n.person_id = ec.contact_person_id AND n.name_type = 'GLOBAL'
      LEFT JOIN {{per_phones}} t ON t.person_id = ec.contact_person_id
      JOIN {{per_phones}} ph ON ph.person_id = ec.person_id AND ph.phone_type = 'HM'
      LEFT JOIN mail ON mail.person_id = ec.person_id LEFT JOIN address ON address.person_id = ec.person_id
      WHERE cr.emergency_contact_flag = 'Y' AND cr.person_id IN (SELECT person_id FROM person)),
    spread AS (
      SELECT person_id, phone_number, email_address, address_line_1, suburb, city, postal_code, country,
             {', '.join(f"max(nm) FILTER (k = {i}) AS emergency_contact_name{i}, max(contact_type) FILTER (k = {i}) AS t{i}, max(tel) FILTER (k = {i}) AS emergency_contact_phn_no{i}" for i in (1, 2))}
      FROM calls GROUP BY ALL)
    SELECT staff.*, spread.* EXCLUDE (person_id, t1, t2), {_KIND.replace('{t}', 't1')} AS contact_type1, {_KIND.replace('{t}', 't2')} AS contact_type2
    FROM staff LEFT JOIN spread USING (person_id)"""


register("report_r14", lambda s: P.emergency_contact_list(s, PLAIN), _contacts(True))
register("report_r14_literal", lambda s: P.emergency_contact_list(s, PLAIN, same_type_only=False), _contacts(False))

# ---- vacancies ----

register("report_r19", lambda s: R.vacancies(s, PLAIN), f"""
    WITH {dims()}, {_REQ},
    candidate AS (
      SELECT x.requisition_id, {d('x.last_update_date')} AS last_update_date, p.name AS candidate_phase, t.name AS candidate_state
      FROM (FROM {{irc_submissions}} QUALIFY last_update_date = max(last_update_date) OVER (PARTITION BY requisition_id)) x
      JOIN {{irc_phases_vl}} p ON p.phase_id = x.current_phase_id JOIN {{irc_states_vl}} t ON t.state_id = x.current_state_id)
    SELECT w.position_code, w.role AS name, w.team_group AS group_team, w.position_type, w.location, w.department,
           CASE w.full_part_time WHEN 'FULL_TIME' THEN 'Full Time' WHEN 'PART_TIME' THEN 'Part Time' END AS full_part_time,
           if(a.requisition_id IS NULL, 'Vacant', 'Active-Recruitment') AS pos_status, a.requisition_id, a.requisition_number,
           {d('a.filled_date')} AS filled_date, {d('a.open_date')} AS open_date, a.requisition_phase, a.requisition_state, c.candidate_phase,
           c.candidate_state, c.last_update_date, a.worker_type_code, coalesce(a.asked_band, g.grade_code) AS band,
           h.full_name AS hiring_manager_name, h.person_number AS hiring_manager_number, b.manager_position_code AS hiring_manager_position_code,
           b.manager_position_name AS hiring_manager_position_name, if(f.position_id IS NULL, NULL, 'Yes') AS future_incumbent,
           {d('f.projected_start_date')} AS projected_start_date
    FROM place w LEFT JOIN {{per_grades_f_vl}} g ON g.grade_id = w.entry_grade_id LEFT JOIN asked a ON a.position_id = w.position_id
    LEFT JOIN candidate c ON c.requisition_id = a.requisition_id LEFT JOIN human h ON h.person_id = a.hiring_manager_id
    LEFT JOIN boss_role b ON b.assignment_id = a.manager_assignment_id
    LEFT JOIN {{per_all_assignments_m}} f ON f.position_id = w.position_id AND f.assignment_type = 'P' AND f.projected_start_date > date '1998-06-30'
      AND {on("date '1998-06-30'", 'f')}
    WHERE w.position_id NOT IN (SELECT position_id FROM post)""")

# ---- leavers ----

_GONE = """
    gone AS (
      SELECT s.person_id, s.date_start, s.actual_termination_date AS day, s.period_type, v.action_reason, a.* EXCLUDE (person_id, effective_start_date, effective_end_date),
             g.grade_code
      FROM {per_periods_of_service} s JOIN {per_action_occurrences} o USING (action_occurrence_id)
      LEFT JOIN {per_action_reasons_vl} v USING (action_reason_id) JOIN {per_all_assignments_m} a ON a.person_id = s.person_id
      LEFT JOIN {per_grades_f_vl} g ON g.grade_id = a.grade_id
      WHERE a.action_code = 'TERMINATION' AND a.assignment_status_type = 'INACTIVE' AND s.actual_termination_date IS NOT NULL)"""
# month difference of two dates, whole where both are month ends or the days are equal
_END = "if(day(day) >= 15, if(day = last_day(day), last_day(cast(day + INTERVAL 1 MONTH AS date)), cast(day + INTERVAL 1 MONTH AS date)), day)"
_MONTHS = "(year(x) - year(s)) * 12 + month(x) - month(s) + if(day(x) = day(s) OR (x = last_day(x) AND s = last_day(s)), 0, (day(x) - day(s)) / 31.0)"

register("report_r24", lambda s: P.leaving_list(s, Params(as_at=dt.date(1999, 6, 1), date_from=dt.date(1999, 1, 15))), f"""
    WITH {_GONE},
    aged AS (SELECT *, {_MONTHS} AS months FROM (SELECT *, date_start AS s, {_END} AS x FROM gone)),
    step AS (
      SELECT DISTINCT k.assignment_id, t.grade_step_id, t.name AS step, t.grade_id FROM {{per_assign_grade_steps_f}} k JOIN aged USING (assignment_id)
      JOIN {{per_grade_steps_f_vl}} t ON t.grade_step_id = k.grade_step_id WHERE {on('aged.day', 'k')} AND {on('aged.day', 't')})
    SELECT a.person_id, n.full_name, w.person_number, {d('a.date_start')} AS start_date, {d('a.day')} AS termination_date,
           cast(trunc(months / 12) AS bigint) || ' Years ' || cast(floor(months % 12) AS bigint) || ' Months ' AS tenure,
           cast(trunc(months) AS bigint) AS tenure_months, a.action_reason AS termination_reason,
           if(a.day < date '1999-06-01', 'Terminated', 'Upcoming Terminations') AS termination_status, a.assignment_id, a.assignment_number, a.assignment_name,
           a.position_id, a.grade_id, a.primary_flag, a.assignment_status_type, a.action_code, a.grade_code AS band, q.position_code, q.name,
           q.full_part_time, q.attribute2 AS anzco_code, q.attribute1 AS occupational_category, q.attribute4 AS leadership_role,
           q.attribute5 AS leadership_tier, q.attribute8 AS team_group, z.name AS department,
           CASE WHEN l.internal_location_code LIKE 'WLG_L_' THEN 'Wellington' WHEN l.internal_location_code LIKE 'AKL%' THEN 'Auckland' ELSE l.location_name END AS location,
           j.name AS job, bn.full_name AS manager_name, bw.person_number AS manager_number, bq.position_code AS manager_position_code,
           bq.name AS manager_position_name, c.meaning AS assignment_category, step.step
    FROM aged a JOIN {{per_person_names_f}} n ON n.person_id = a.person_id AND n.name_type = 'GLOBAL' AND {on("date '1999-06-01'", 'n')}
    JOIN {{per_people_f}} w ON w.person_id = a.person_id AND {on("date '1999-06-01'", 'w')}
    JOIN {{per_assignment_supervisors_f_v}} m ON m.person_id = a.person_id AND m.assignment_id = a.assignment_id AND {on('a.day', 'm')}
    JOIN {{hr_all_positions_f_vl}} q ON q.position_id = a.position_id AND {on('a.day', 'q')} JOIN {{per_jobs}} j ON j.job_id = q.job_id
    JOIN {{per_departments}} z ON z.organization_id = q.organization_id AND {on('a.day', 'z')}
    LEFT JOIN {{hr_locations_all_f_vl}} l ON l.location_id = q.location_id
    JOIN {{hcm_lookups}} c ON c.lookup_code = a.employment_category AND c.lookup_type = 'EMP_CAT'
    JOIN {{per_person_names_f}} bn ON bn.person_id = m.manager_id AND bn.name_type = 'GLOBAL' AND {on('a.day', 'bn')}
    JOIN {{per_people_f}} bw ON bw.person_id = m.manager_id AND {on('a.day', 'bw')}
    JOIN {{per_all_assignments_m}} ba ON ba.assignment_id = m.manager_assignment_id AND ba.assignment_type IN ('E', 'C') AND {on('a.day', 'ba')}
    JOIN {{hr_all_positions_f_vl}} bq ON bq.position_id = ba.position_id AND {on('a.day', 'bq')}
    LEFT JOIN step ON step.assignment_id = a.assignment_id AND step.grade_id = a.grade_id
    WHERE a.day >= date '1999-01-15' AND a.assignment_type <> 'P'""")

# ---- workforce return ----

LOW, HIGH = "date '1998-07-01'", "date '1999-06-30'"


def _touch(a: str, start: str = "effective_start_date", end: str = "effective_end_date") -> str:
    """The window test in its long form."""
    return (f"({a}.{start} >= {LOW} OR {LOW} BETWEEN {a}.{start} AND {a}.{end}) AND {a}.{end} >= {LOW} AND {a}.{start} <= {HIGH}")


# Fixed values, written out here too, so that a slip in the library's lists shows.
_ETH = """CASE coalesce(w.meaning, 'Not Stated') WHEN 'African' THEN 53100 WHEN 'Any Other' THEN 61199 WHEN 'Asian' THEN 40000 WHEN 'Chinese' THEN 42100
    WHEN 'Cook Islands Māori' THEN 32100 WHEN 'European' THEN 10000 WHEN 'Fijian' THEN 36111 WHEN 'Indian' THEN 43100 WHEN 'Latin American' THEN 52100
    WHEN 'Middle Eastern' THEN 51100 WHEN 'Māori' THEN 21111 WHEN 'New Zealand European' THEN 11111 WHEN 'Niuean' THEN 34111 WHEN 'Not Stated' THEN 99999
    WHEN 'Pacific Peoples' THEN 30000 WHEN 'Samoan' THEN 31111 WHEN 'South East Asian' THEN 41499 WHEN 'Tokelauan' THEN 35111 WHEN 'Tongan' THEN 33111 END"""
_WHY = """CASE coalesce(action_reason, '99 Unknown') WHEN '10 Resignation – destination unknown' THEN 10
    WHEN '11 Resignation to Public Service department' THEN 11 WHEN '12 Resignation other than to a Public Service department' THEN 12
    WHEN '30 End of fixed term contract / agreement' THEN 30 WHEN '40 Restructuring' THEN 40 WHEN '41 Redeployment to an other organisation' THEN 41
    WHEN '42 Severance' THEN 42 WHEN '42 Redundancy' THEN 42 WHEN '43 Retraining' THEN 43 WHEN '44 Enhanced early retirement' THEN 44
    WHEN '45 Voluntary Redundancy' THEN 45 WHEN '50 Dismissal' THEN 50 WHEN '60 Retirement' THEN 60 WHEN '70 Death' THEN 70 WHEN '99 Unknown' THEN 99 END"""


def _half(base: str, day: str) -> str:
    """Shared columns; ``base`` has person, assignment, position and salary columns, ``day`` its date."""
    return f"""
      SELECT b.person_id, b.full_name, b.person_number, strftime(b.date_start, '%d/%m/%Y') AS start_date, b.termination_date, b.action_reason,
             b.terminationreason, b.assignment_number, b.assignment_id, b.assignment_name, b.position_id, b.role AS jobtitle, b.attribute2 AS anzsco_code,
             b.employment_category, b.grade_id, b.assignment_status_type,
             CASE WHEN starts_with(b.grade_code, 'Band_') THEN cast(cast(b.grade_code[6:] AS int) AS varchar) ELSE b.grade_code END AS band,
             CASE x.sex WHEN 'ORA_HRX_GENDER_DIVERSE' THEN 'D' ELSE coalesce(x.sex, if(x.person_id IS NULL, NULL, 'U')) END AS gender,
             strftime(t.date_of_birth, '%d/%m/%Y') AS date_of_birth,
             CASE WHEN b.site_code LIKE 'WLG%' OR b.site_code = 'PARLMT' THEN 9 WHEN b.site_code LIKE 'AKL%' THEN 2 END AS region,
             b.team_group AS businessunit, b.department AS businessunit2, b.salary_amount, b.annual_ft_salary,
             cast(trunc(b.minimum) AS bigint) AS minimum, cast(trunc(b.mid_value) AS bigint) AS mid_value, cast(trunc(b.maximum) AS bigint) AS maximum,
             f.value AS fte, coalesce(e.e1, 99999) AS a1, e.e2 AS a2, e.e3 AS a3, b.status,
             if(b.employment_category = 'ORG_FIX_TERM', 1, 2) AS contractterm, mw.person_number AS manager_number,
             CASE WHEN b.attribute4 = 'Y' AND mq.name LIKE 'Chief Executive%' THEN 2
                  WHEN b.attribute4 = 'Y' AND mq.attribute4 = 'Y' AND mq.name LIKE 'Deputy Chief Executive%' THEN 3 END AS managementprofile
      FROM {base} b LEFT JOIN {{per_people_legislative_f}} x ON x.person_id = b.person_id AND {on(day, 'x')}
      LEFT JOIN {{per_persons}} t ON t.person_id = b.person_id
      LEFT JOIN {{per_assign_work_measures_f}} f ON f.assignment_id = b.assignment_id AND f.unit = 'FTE' AND {on(day, 'f')}
      LEFT JOIN eth e ON e.person_id = b.person_id LEFT JOIN {{per_people_f}} mw ON mw.person_id = b.manager_id AND {on(day, 'mw')}
      LEFT JOIN {{per_all_assignments_m}} ma ON ma.assignment_id = b.manager_assignment_id AND ma.assignment_type = 'E' AND {on(day, 'ma')}
      LEFT JOIN {{hr_all_positions_f_vl}} mq ON mq.position_id = ma.position_id AND {on(day, 'mq')}"""


register("report_r15", lambda s: P.workforce_return(s, Params(
    as_at=dt.date(1999, 6, 30), date_from=dt.date(1998, 7, 1), date_to=dt.date(1999, 6, 30))), f"""
    WITH {_GONE},
    spot AS (
      SELECT q.*, q.name AS role, q.attribute8 AS team_group, z.name AS department, l.internal_location_code AS site_code,
             greatest(q.effective_start_date, z.effective_start_date) AS b, least(q.effective_end_date, z.effective_end_date) AS e
      FROM {{hr_all_positions_f_vl}} q JOIN {{per_departments}} z USING (organization_id) LEFT JOIN {{hr_locations_all_f_vl}} l ON l.location_id = q.location_id),
    eth AS (
      SELECT p.person_id, max({_ETH}) FILTER (i = 1) AS e1, max({_ETH}) FILTER (i = 2) AS e2, max({_ETH}) FILTER (i = 3) AS e3
      FROM (SELECT person_id, unnest([ethnicity, attribute1, attribute2]) AS code, unnest([1, 2, 3]) AS i FROM {{per_ethnicities}}) p
      JOIN {{hcm_lookups}} w ON w.lookup_code = p.code AND w.lookup_type = 'PER_ETHNICITY' GROUP BY 1),
    rated AS (
      SELECT s.*, a.grade_id, r.minimum, r.mid_value, r.maximum FROM {{cmp_salary}} s
      JOIN {{per_all_assignments_m}} a ON a.assignment_id = s.assignment_id AND {on('s.date_from', 'a')} AND a.assignment_type = 'E' AND a.effective_latest_change = 'Y'
      JOIN {{cmp_salary_bases_vl}} k USING (salary_basis_id)
      JOIN {{per_rate_values_f}} r ON r.rate_object_id = a.grade_id AND r.rate_id = k.grade_rate_id AND {_touch('r')}),
    last_pay AS (FROM rated WHERE {_touch('rated', 'date_from', 'date_to')}
                 QUALIFY rank() OVER (PARTITION BY person_id, assignment_id ORDER BY date_from DESC) = 1),
    span AS (FROM {{per_all_assignments_m}} a WHERE assignment_type = 'E' AND effective_latest_change = 'Y' AND assignment_status_type <> 'INACTIVE' AND {_touch('a')}),
    stands AS (
      SELECT * FROM (SELECT *, (SELECT count(DISTINCT assignment_id) FROM span o WHERE o.person_id = span.person_id) AS n FROM span
                     QUALIFY rank() OVER (PARTITION BY person_id, assignment_id ORDER BY effective_end_date DESC) = 1)
      WHERE CASE n WHEN 1 THEN primary_flag = 'Y' AND CASE assignment_status_type
                   WHEN 'ACTIVE' THEN employment_category IN ('ORG_SUBSTANTIVE_POSITION', 'ORG_FIX_TERM', 'ORG_EXTERNAL_SECONDMENT', 'ORG_INTERNAL_SECONDMENT')
                   WHEN 'SUSPENDED' THEN employment_category IN ('ORG_LEAVE_WO_PAY', 'ORG_PARENTAL_LEAVE') ELSE false END
            ELSE employment_category IN ('ORG_SUBSTANTIVE_POSITION', 'ORG_FIX_TERM')
                 AND primary_flag || assignment_status_type IN ('NSUSPENDED', 'YACTIVE') END),
    leads AS (FROM {{per_assignment_supervisors_f_v}} m WHERE assignment_id IN (SELECT assignment_id FROM stands) AND {_touch('m')}
              QUALIFY rank() OVER (PARTITION BY person_id ORDER BY effective_end_date DESC) = 1),
    now_base AS (
      SELECT t.*, n.full_name, w.person_number, s.date_start, cast(NULL AS varchar) AS termination_date, cast(NULL AS varchar) AS action_reason,
             cast(NULL AS int) AS terminationreason, q.role, q.attribute2, q.attribute4, q.site_code, q.team_group, q.department, g.grade_code,
             p.salary_amount, p.annual_ft_salary, p.minimum, p.mid_value, p.maximum, leads.manager_id, leads.manager_assignment_id,
             CASE c.meaning WHEN 'Substantive Position' THEN 1 WHEN 'Fixed Term' THEN 1 WHEN 'Internal Secondment' THEN 2
                  WHEN 'External Secondment' THEN 3 WHEN 'Parental Leave' THEN 4 WHEN 'Leave without Pay' THEN 5 END AS status
      FROM stands t JOIN leads USING (person_id, assignment_id)
      JOIN {{per_person_names_f}} n ON n.person_id = t.person_id AND n.name_type = 'GLOBAL' AND {on(HIGH, 'n')}
      JOIN {{per_people_f}} w ON w.person_id = t.person_id AND {on(HIGH, 'w')}
      JOIN {{per_periods_of_service}} s ON s.person_id = t.person_id AND s.period_type = 'E'
        AND if(s.actual_termination_date IS NULL, s.date_start <= {HIGH}, {HIGH} BETWEEN s.date_start AND s.actual_termination_date)
      JOIN spot q ON q.position_id = t.position_id AND {HIGH} BETWEEN q.b AND q.e LEFT JOIN {{per_grades_f_vl}} g ON g.grade_id = t.grade_id
      LEFT JOIN last_pay p ON p.person_id = t.person_id AND p.assignment_id = t.assignment_id AND p.grade_id = t.grade_id
      LEFT JOIN (SELECT DISTINCT a.person_id, a.position_id, a.assignment_id, h.meaning FROM {{per_all_assignments_m}} a
                 JOIN {{hcm_lookups}} h ON h.lookup_code = a.employment_category AND h.lookup_type = 'EMP_CAT'
                 WHERE a.assignment_type = 'E' AND a.assignment_status_type IN ('ACTIVE', 'SUSPENDED') AND {on(HIGH, 'a')}) c
        ON c.person_id = t.person_id AND c.position_id = t.position_id AND c.assignment_id = t.assignment_id),
    gone_base AS (
      SELECT x.* EXCLUDE (action_reason), n.full_name, w.person_number, strftime(x.day, '%d/%m/%Y') AS termination_date, x.action_reason, {_WHY} AS terminationreason,
             q.role, q.attribute2, q.attribute4, q.site_code, q.team_group, q.department, p.salary_amount, p.annual_ft_salary, p.minimum, p.mid_value,
             p.maximum, m.manager_id, m.manager_assignment_id, 6 AS status
      FROM gone x JOIN {{per_person_names_f}} n ON n.person_id = x.person_id AND n.name_type = 'GLOBAL' AND {on('x.day', 'n')}
      JOIN {{per_people_f}} w ON w.person_id = x.person_id AND {on('x.day', 'w')}
      JOIN {{per_assignment_supervisors_f_v}} m ON m.assignment_id = x.assignment_id AND {on('x.day', 'm')}
      JOIN spot q ON q.position_id = x.position_id AND x.day BETWEEN q.b AND q.e
      LEFT JOIN rated p ON p.person_id = x.person_id AND p.assignment_id = x.assignment_id AND p.grade_id = x.grade_id
      WHERE x.assignment_type = 'E' AND x.period_type = 'E' AND x.primary_flag = 'Y' AND x.day < {HIGH} AND x.day >= {LOW}
        AND coalesce(x.day BETWEEN p.date_from AND p.date_to, true)),
    both_halves AS ({_half('now_base', HIGH)} UNION ALL {_half('gone_base', 'b.day')})
    SELECT * EXCLUDE (a1, a2, a3), if(a1 >= 90000, coalesce(a2, a1), a1) AS ethnicity1,
           if(a1 < 90000 AND a2 IS DISTINCT FROM a1, a2, NULL) AS ethnicity2,
           if(a1 < 90000 AND a3 IS DISTINCT FROM a2 AND a3 IS DISTINCT FROM a1, a3, NULL) AS ethnicity3
    FROM both_halves""")
