"""SQL building blocks of the oracle: the bindings and pipeline layers as CTEs.

Written against the reference semantics in DuckDB's dialect, with windows and
plain joins where the Spark side uses aggregates, so that the two are
independent. ``query`` puts a body behind the CTEs it names (and theirs).
"""

from __future__ import annotations

AS_OF = "DATE '2001-06-30'"

# name -> (needed CTEs, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, sql: str) -> None:
    CTES[name] = (tuple(needs.split()), sql.strip())


def query(needs: str, body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in CTES[name][0]:
                visit(other)
            ordered.append(name)

    for name in needs.split():
        visit(name)
    heads = ",\n".join(f"{name} AS (\n{CTES[name][1]}\n)" for name in ordered)
    body = body.strip()
    if not ordered:
        return body
    if body.startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


# ---------------------------------------------------------------- raw datasets

# Load order of lineitems: all columns as fixed-width text.
LINE_TAIL = """strftime(l_shipdate, '%Y-%m-%d')
       || lpad(CAST(CAST(round(l_quantity * 100) AS BIGINT) AS VARCHAR), 6, '0')
       || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), 12, '0')
       || lpad(CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR), 3, '0')
       || lpad(CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR), 3, '0') || l_returnflag || l_linestatus"""

_SCHOOL = """
SELECT 'SCH' || s_suppkey AS school_id, s_name AS school_name, r_name AS region,
       CASE s_nationkey % 4 WHEN 0 THEN 'Primary' WHEN 1 THEN 'High School'
            WHEN 2 THEN 'College' ELSE 'Specialist' END AS school_type,
       CAST(1980 + s_suppkey % 20 AS VARCHAR) || '-0' || (1 + s_suppkey % 9) || '-15' AS open_date,
       CASE WHEN {balance} < 0 THEN 'Closed' WHEN s_suppkey % 97 = 5 THEN 'Paused'
            ELSE 'Active' END AS status,
       s_suppkey AS row_number
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
cte("raw_schools", "", _SCHOOL.format(balance="s_acctbal"))
cte("raw_schools2", "", _SCHOOL.format(balance="(CASE WHEN s_acctbal < 1000 THEN -1 ELSE s_acctbal END)"))
cte("raw_students", "", """
SELECT CASE WHEN c_custkey % 97 = 13 THEN '' ELSE 'STU' || c_custkey END AS student_id,
       CASE WHEN c_custkey % 101 = 7 THEN ' ' WHEN c_custkey % 103 = 11 THEN 'SCH999999999'
            ELSE 'SCH' || (c_custkey % 50) END AS school_id,
       CASE WHEN c_custkey % 89 = 3 THEN 'x' ELSE CAST(c_custkey % 13 AS VARCHAR) END AS year_level,
       CASE c_nationkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN ' Male ' ELSE 'Non-specified' END AS gender,
       CASE WHEN c_custkey % 83 = 2 THEN 'not a date'
            ELSE (2010 + c_custkey % 10) || '-02-0' || (1 + c_custkey % 9) END AS enrolment_date,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Left' WHEN 'MACHINERY' THEN 'Transferred'
            ELSE 'Active' END AS status,
       c_acctbal, c_custkey AS row_number,
       (1995 + c_custkey % 7) || '-' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') AS reporting_month
FROM customer""")
cte("raw_attendance", "", f"""
SELECT 'ATT' || l_orderkey || '-' || l_linenumber AS attendance_id,
       CASE WHEN l_orderkey % 113 = 5 THEN '' ELSE 'STU' || l_partkey END AS student_id,
       'SCH' || l_suppkey AS school_id,
       CASE WHEN l_orderkey % 127 = 9 THEN 'unknown'
            ELSE strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') END AS attendance_month,
       CASE WHEN l_orderkey % 97 = 4 THEN 'n/a' ELSE CAST(possible AS VARCHAR) END AS possible_days,
       CAST(possible - l_linenumber % 4 AS VARCHAR) AS attended_days,
       CASE l_returnflag WHEN 'A' THEN 'Illness' WHEN 'R' THEN 'Family' ELSE '' END AS absence_reason,
       CASE WHEN l_shipdate < DATE '1998-06-01' THEN '2025-01-15' ELSE '2026-01-15' END AS batch_id,
       strftime(l_shipdate, '%Y-%m') AS reporting_month,
       lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0')
       || lpad(CAST(l_partkey AS VARCHAR), 12, '0') || lpad(CAST(l_suppkey AS VARCHAR), 12, '0')
       || {LINE_TAIL} AS row_number
FROM (SELECT *, CASE WHEN month(l_shipdate) = 1 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS possible
      FROM lineitem)""")
cte("raw_scores", "", """
SELECT CASE WHEN o_orderkey % 109 = 8 THEN '' ELSE 'ASM' || o_orderkey END AS assessment_id,
       CASE WHEN o_orderkey % 97 = 6 THEN 'STU999999999' ELSE 'STU' || o_custkey END AS student_id,
       'SCH' || (o_custkey % 50) AS school_id, CAST(year(o_orderdate) AS VARCHAR) AS assessment_year,
       CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN 'Reading'
            WHEN o_orderpriority = '2-HIGH' THEN 'Numeracy' WHEN o_orderpriority = '3-MEDIUM' THEN 'Writing'
            ELSE 'Science' END AS domain,
       CASE WHEN o_orderkey % 89 = 1 THEN 'abc' ELSE CAST(250 + o_orderkey % 500 AS VARCHAR) END AS score,
       CASE WHEN o_orderkey % 83 = 0 THEN 'Unknown' WHEN o_orderstatus = 'F' THEN 'Low'
            WHEN o_orderstatus = 'O' THEN 'Medium' ELSE 'High' END AS proficiency_band,
       CASE WHEN o_orderdate < DATE '1998-06-01' THEN '2025-01-15' ELSE '2026-01-15' END AS batch_id,
       strftime(o_orderdate, '%Y-%m') AS reporting_month, o_orderkey AS row_number
FROM orders""")
cte("raw_events", "", """
SELECT 'EVT' || event_id AS event_id, 'SCH' || user_id AS school_id,
       CASE event_type WHEN 'view' THEN 'Attendance campaign' WHEN 'click' THEN 'Wellbeing program'
            WHEN 'purchase' THEN 'Assessment intervention' ELSE event_type END AS event_type,
       strftime(ts, '%Y-%m-%d') AS event_date, props AS description,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN '2025-01-15' ELSE '2026-01-15' END AS batch_id,
       strftime(ts, '%Y-%m') AS reporting_month, event_id AS row_number
FROM events""")

# ---------------------------------------------------------------- baseline layers

cte("stg_schools", "raw_schools", """
SELECT school_id, school_name, region, school_type, TRY_CAST(open_date AS DATE) AS open_date, status
FROM raw_schools""")
cte("stg_students", "raw_students", """
SELECT student_id, school_id, TRY_CAST(year_level AS INTEGER) AS year_level, gender,
       TRY_CAST(enrolment_date AS DATE) AS enrolment_date, status FROM raw_students""")
cte("stg_attendance", "raw_attendance", """
SELECT attendance_id, student_id, school_id, TRY_CAST(attendance_month AS DATE) AS attendance_month,
       TRY_CAST(possible_days AS INTEGER) AS possible_days,
       TRY_CAST(attended_days AS INTEGER) AS attended_days, absence_reason FROM raw_attendance""")
cte("stg_scores", "raw_scores", """
SELECT assessment_id, student_id, school_id, TRY_CAST(assessment_year AS INTEGER) AS assessment_year,
       domain, TRY_CAST(score AS INTEGER) AS score, proficiency_band FROM raw_scores""")
cte("stg_events", "raw_events", """
SELECT event_id, school_id, event_type, TRY_CAST(event_date AS DATE) AS event_date, description
FROM raw_events""")
cte("a_school", "stg_schools", """
SELECT * FROM stg_schools WHERE school_type IN ('Primary', 'High School', 'College', 'Specialist')
  AND status IN ('Active', 'Closed')""")
cte("a_student", "stg_students", "SELECT DISTINCT * FROM stg_students WHERE trim(student_id) <> ''")
cte("a_group", "a_student a_school", """
SELECT row_number() OVER (ORDER BY school_id, year_level, gender, status) AS student_group_key,
       school_id AS school_key, year_level, gender, status AS student_status, student_count
FROM (SELECT s.school_id, s.year_level, s.gender, s.status, count(*) AS student_count
      FROM a_student s JOIN a_school d ON s.school_id = d.school_id
      WHERE s.year_level BETWEEN 0 AND 12 AND s.gender IN ('Female', 'Male', 'Non-specified')
        AND s.status IN ('Active', 'Transferred', 'Left') GROUP BY ALL)""")
cte("a_member", "a_student a_group", """
SELECT s.student_id, g.student_group_key FROM a_student s
JOIN a_group g ON s.school_id = g.school_key AND s.year_level = g.year_level AND s.gender = g.gender
 AND s.status = g.student_status""")
cte("a_date", "stg_attendance stg_scores stg_events", f"""
SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
       CAST(year(d) AS INTEGER) AS calendar_year, CAST(month(d) AS INTEGER) AS calendar_month,
       monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS calendar_quarter
FROM (SELECT attendance_month AS d FROM stg_attendance WHERE attendance_month <= {AS_OF}
      UNION SELECT event_date FROM stg_events WHERE event_date <= {AS_OF}
      UNION SELECT make_date(assessment_year, 1, 1) FROM stg_scores
      WHERE assessment_year BETWEEN 2000 AND year({AS_OF}))""")
cte("a_domain", "stg_scores", """
SELECT row_number() OVER (ORDER BY domain) AS assessment_domain_key, domain AS assessment_domain
FROM (SELECT DISTINCT domain FROM stg_scores WHERE domain IN ('Reading', 'Numeracy', 'Writing'))""")
cte("a_event_type", "stg_events", """
SELECT row_number() OVER (ORDER BY event_type) AS event_type_key, event_type
FROM (SELECT DISTINCT event_type FROM stg_events
      WHERE event_type IN ('Attendance campaign', 'Wellbeing program', 'Assessment intervention'))""")
cte("a_fact_attendance", "stg_attendance a_school a_date a_member", """
SELECT a.attendance_id, a.student_id, a.school_id AS school_key, d.date_key, m.student_group_key,
       a.possible_days, a.attended_days, a.possible_days - a.attended_days AS absence_days,
       CAST(a.attended_days / NULLIF(a.possible_days, 0)::DOUBLE AS DECIMAL(6,4)) AS attendance_rate,
       CAST((a.possible_days - a.attended_days) / NULLIF(a.possible_days, 0)::DOUBLE AS DECIMAL(6,4)) AS absence_rate,
       CASE WHEN a.possible_days > 0 AND a.attended_days::DOUBLE / a.possible_days < 0.9 THEN 1 ELSE 0 END
         AS chronic_absence_flag,
       CASE WHEN a.possible_days IS NULL OR a.attended_days IS NULL OR a.possible_days < 0
              OR a.attended_days < 0 OR a.attended_days > a.possible_days THEN 0 ELSE 1 END AS is_valid_attendance
FROM stg_attendance a JOIN a_school s ON a.school_id = s.school_id
JOIN a_date d ON a.attendance_month = d.calendar_date JOIN a_member m ON a.student_id = m.student_id
WHERE trim(a.student_id) <> ''""")
cte("a_fact_score", "stg_scores a_school a_date a_domain a_member", f"""
SELECT r.assessment_id, r.student_id, r.school_id AS school_key, d.date_key, k.assessment_domain_key,
       m.student_group_key, r.score, r.proficiency_band,
       CASE WHEN r.score IS NULL OR r.score < 250 OR r.score > 700 THEN 0 ELSE 1 END AS is_valid_score,
       CASE WHEN r.proficiency_band = 'Low' THEN 1 ELSE 0 END AS low_proficiency_flag
FROM stg_scores r JOIN a_school s ON r.school_id = s.school_id
JOIN a_date d ON make_date(r.assessment_year, 1, 1) = d.calendar_date
JOIN a_domain k ON r.domain = k.assessment_domain JOIN a_member m ON r.student_id = m.student_id
WHERE trim(r.assessment_id) <> '' AND r.assessment_year BETWEEN 2000 AND year({AS_OF})""")

# ---------------------------------------------------------------- assured layers

_RECORD = "sha256({key} || '||' || '{file}.csv' || '||' || batch_id || '||' || 'dev_batch_run')"


def _bronze_id(key: str, file: str) -> str:
    return _RECORD.format(key=key, file=file) + " AS bronze_record_id"


cte("b_schools", "raw_schools raw_schools2", f"""
SELECT school_id, school_name, region, school_type, TRY_CAST(open_date AS DATE) AS open_date, status,
       batch_id, {_bronze_id('school_id', 'schools')}
FROM (SELECT *, '2025-01-15' AS batch_id FROM raw_schools
      UNION ALL SELECT *, '2026-01-15' FROM raw_schools2)""")
cte("b_students", "raw_students", f"""
SELECT trim(student_id) AS student_id, trim(school_id) AS school_id,
       TRY_CAST(year_level AS INTEGER) AS year_level, trim(gender) AS gender,
       TRY_CAST(enrolment_date AS DATE) AS enrolment_date, status, batch_id, bronze_record_id
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, trim(student_id) ORDER BY bronze_record_id DESC,
             trim(student_id) DESC, trim(school_id) DESC, TRY_CAST(year_level AS INTEGER) DESC NULLS LAST,
             trim(gender) DESC, TRY_CAST(enrolment_date AS DATE) DESC NULLS LAST, status DESC) AS rn
      FROM (SELECT *, {_bronze_id('student_id', 'students')} FROM (
              SELECT *, '2025-01-15' AS batch_id FROM raw_students WHERE c_acctbal >= 0
              UNION ALL SELECT *, '2026-01-15' FROM raw_students)))
WHERE rn = 1""")
cte("b_attendance", "raw_attendance", f"""
SELECT attendance_id, student_id, school_id, attendance_month, possible_days, attended_days, absence_reason,
       batch_id, bronze_record_id
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, attendance_id ORDER BY bronze_record_id DESC,
             student_id DESC, school_id DESC, attendance_month DESC NULLS LAST,
             possible_days DESC NULLS LAST, attended_days DESC NULLS LAST, absence_reason DESC) AS rn
      FROM (SELECT attendance_id, student_id, school_id, TRY_CAST(attendance_month AS DATE) AS attendance_month,
                   TRY_CAST(possible_days AS INTEGER) AS possible_days,
                   TRY_CAST(attended_days AS INTEGER) AS attended_days, absence_reason, batch_id,
                   {_bronze_id('attendance_id', 'attendance')} FROM raw_attendance))
WHERE rn = 1""")
cte("b_scores", "raw_scores", f"""
SELECT assessment_id, student_id, school_id, assessment_year, domain, score, proficiency_band,
       batch_id, bronze_record_id
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, assessment_id ORDER BY bronze_record_id DESC,
             student_id DESC, school_id DESC, assessment_year DESC, domain DESC, score DESC NULLS LAST,
             proficiency_band DESC) AS rn
      FROM (SELECT assessment_id, student_id, school_id,
                   TRY_CAST(assessment_year AS INTEGER) AS assessment_year, domain,
                   TRY_CAST(score AS INTEGER) AS score, proficiency_band, batch_id,
                   {_bronze_id('assessment_id', 'assessment_results')} FROM raw_scores))
WHERE rn = 1""")
cte("b_events", "raw_events", f"""
SELECT event_id, school_id, event_type, TRY_CAST(event_date AS DATE) AS event_date, description, batch_id,
       {_bronze_id('event_id', 'school_events')} FROM raw_events""")
cte("b_att_marked", "b_attendance b_students", """
SELECT a.*, coalesce(d.n, 0) > 1 AS duplicate, s.student_id IS NOT NULL AS student_known
FROM b_attendance a
LEFT JOIN (SELECT batch_id, student_id, school_id, attendance_month, count(*) AS n FROM b_attendance
           GROUP BY ALL) d
  ON a.batch_id = d.batch_id AND a.student_id = d.student_id AND a.school_id = d.school_id
 AND a.attendance_month = d.attendance_month
LEFT JOIN b_students s ON a.batch_id = s.batch_id AND a.student_id = s.student_id""")
cte("b_failures", "b_schools b_students b_att_marked b_scores b_events", f"""
SELECT batch_id, 'DQ001' AS rule_id, student_id AS business_key, bronze_record_id FROM b_students
WHERE student_id = ''
UNION ALL SELECT batch_id, 'DQ002', student_id, bronze_record_id FROM b_students WHERE school_id = ''
UNION ALL SELECT batch_id, 'DQ003', attendance_id, bronze_record_id FROM b_att_marked
WHERE possible_days IS NULL OR attended_days IS NULL OR possible_days < 0 OR attended_days < 0
   OR attended_days > possible_days
UNION ALL SELECT batch_id, 'DQ004', attendance_id, bronze_record_id FROM b_att_marked WHERE duplicate
UNION ALL SELECT batch_id, 'DQ005', attendance_id, bronze_record_id FROM b_att_marked WHERE NOT student_known
UNION ALL SELECT batch_id, 'DQ006', assessment_id, bronze_record_id FROM b_scores r
WHERE NOT EXISTS (SELECT 1 FROM b_students s WHERE s.batch_id = r.batch_id AND s.student_id = r.student_id)
UNION ALL SELECT batch_id, 'DQ007', assessment_id, bronze_record_id FROM b_scores
WHERE score IS NULL OR score < 250 OR score > 700
UNION ALL SELECT batch_id, 'DQ008', assessment_id, bronze_record_id FROM b_scores
WHERE proficiency_band IS NULL OR proficiency_band NOT IN ('Low', 'Medium', 'High')
UNION ALL SELECT batch_id, 'DQ009', school_id, bronze_record_id FROM b_schools
WHERE status IS NULL OR status NOT IN ('Active', 'Closed')
UNION ALL SELECT batch_id, 'DQ010', attendance_id, bronze_record_id FROM b_att_marked
WHERE attendance_month IS NULL OR attendance_month > {AS_OF}
UNION ALL SELECT batch_id, 'DQ011', event_id, bronze_record_id FROM b_events e
WHERE NOT EXISTS (SELECT 1 FROM b_schools s WHERE s.batch_id = e.batch_id AND s.school_id = e.school_id
                  AND s.status = 'Active')""")
# Names, severities and texts of the rules, here and in c_rules.
cte("b_rules", "", """
SELECT * FROM (VALUES
 ('DQ001', 'Missing student ID', 'silver.students', 'High', 'Investigate source student extract and require student_id for all student records.', 'student_id is null or blank'),
 ('DQ002', 'Missing school ID', 'silver.students', 'High', 'Investigate student enrolment extract and require a valid school_id for each student.', 'school_id is null or blank'),
 ('DQ003', 'Invalid attendance days', 'silver.attendance', 'High', 'Review attendance source extract and enforce valid possible_days and attended_days values before publishing.', 'Attendance days are missing, negative, or attended_days is greater than possible_days.'),
 ('DQ004', 'Duplicate attendance business record', 'silver.attendance', 'Medium', 'Review attendance source extract for duplicate monthly attendance submissions and deduplicate before reporting.', 'Duplicate attendance business record for student_id, school_id, and attendance_month.'),
 ('DQ005', 'Attendance references missing student', 'silver.attendance', 'High', 'Investigate attendance records with missing student references and correct source system referential integrity.', 'attendance.student_id does not exist in silver.students for the same batch_id.'),
 ('DQ006', 'Assessment references missing student', 'silver.assessment_results', 'High', 'Investigate assessment records with missing student references and correct source system referential integrity.', 'assessment_results.student_id does not exist in silver.students for the same batch_id.'),
 ('DQ007', 'Invalid assessment score', 'silver.assessment_results', 'High', 'Review assessment scoring scale and source extract. Confirm whether scores should be normalised before reporting.', 'score is null or outside the valid 250 to 700 range.'),
 ('DQ008', 'Invalid proficiency band', 'silver.assessment_results', 'Medium', 'Review assessment proficiency band mapping and enforce controlled category values.', 'proficiency_band is null or not one of Low, Medium, High.'),
 ('DQ009', 'Invalid school status', 'silver.schools', 'Medium', 'Review school status reference data and enforce controlled status values.', 'status is null or not one of Active, Closed.'),
 ('DQ010', 'Future attendance month', 'silver.attendance', 'Medium', 'Review attendance period values and prevent future-dated attendance records from entering reporting.', 'attendance_month is null or later than the current date.'),
 ('DQ011', 'School event linked to inactive or missing school', 'silver.school_events', 'Low', 'Review school event source data and confirm whether events should be linked only to active schools.', 'school event is linked to an inactive or missing school.')
) AS t(rule_id, rule_name, target_table, severity, recommended_action, failure_reason)""")
cte("b_results", "b_rules b_failures b_schools b_students b_attendance b_scores b_events", """
SELECT b.batch_id, r.rule_id, r.rule_name, r.target_table, r.severity, count(f.rule_id) AS failed_record_count,
       CASE WHEN count(f.rule_id) = 0 THEN 'PASS' WHEN r.severity = 'Low' THEN 'WARN' ELSE 'FAIL' END AS status,
       'dev_batch_run' AS run_id
FROM b_rules r
JOIN (SELECT DISTINCT 'silver.schools' AS target_table, batch_id FROM b_schools
      UNION SELECT DISTINCT 'silver.students', batch_id FROM b_students
      UNION SELECT DISTINCT 'silver.attendance', batch_id FROM b_attendance
      UNION SELECT DISTINCT 'silver.assessment_results', batch_id FROM b_scores
      UNION SELECT DISTINCT 'silver.school_events', batch_id FROM b_events) b ON b.target_table = r.target_table
LEFT JOIN b_failures f ON f.rule_id = r.rule_id AND f.batch_id = b.batch_id
GROUP BY b.batch_id, r.rule_id, r.rule_name, r.target_table, r.severity""")
cte("b_good_attendance", "b_attendance b_failures", """
SELECT * FROM b_attendance WHERE bronze_record_id NOT IN (
  SELECT bronze_record_id FROM b_failures WHERE rule_id IN ('DQ003', 'DQ004', 'DQ005'))""")
cte("b_good_scores", "b_scores b_failures", """
SELECT * FROM b_scores WHERE bronze_record_id NOT IN (
  SELECT bronze_record_id FROM b_failures WHERE rule_id IN ('DQ006', 'DQ007', 'DQ008'))""")
cte("b_dim_school", "b_schools", """
SELECT school_id, school_name, region, school_type, open_date, status, sha256(school_id) AS school_key,
       sha256(school_id || '||' || batch_id) AS school_scd_key,
       sha256(school_name || '||' || region || '||' || school_type || '||' || status || '||'
              || coalesce(CAST(open_date AS VARCHAR), '')) AS attribute_hash,
       batch_id AS effective_from_batch_id, CAST(batch_id AS DATE) AS effective_from_date,
       CASE WHEN nxt IS NOT NULL THEN CAST(nxt AS DATE) - 1 END AS effective_to_date, nxt IS NULL AS is_current
FROM (SELECT *, lead(batch_id) OVER (PARTITION BY school_id ORDER BY batch_id) AS nxt
      FROM (SELECT *, lag(status) OVER (PARTITION BY school_id ORDER BY batch_id) AS before FROM b_schools)
      WHERE before IS NULL OR before <> status)""")
cte("b_dim_student", "b_students b_dim_school", """
SELECT s.*, sha256(s.student_id) AS student_key, sha256(s.batch_id || '||' || s.student_id) AS student_batch_key,
       sha256(s.school_id) AS school_key, sha256(coalesce(CAST(s.year_level AS VARCHAR), '')) AS year_level_key,
       v.school_scd_key, s.status = 'Active' AS is_active_student
FROM b_students s LEFT JOIN b_dim_school v ON v.school_id = s.school_id
 AND CAST(s.batch_id AS DATE) >= v.effective_from_date
 AND (v.effective_to_date IS NULL OR CAST(s.batch_id AS DATE) <= v.effective_to_date)""")
cte("b_fact_attendance", "b_good_attendance b_dim_student b_dim_school", """
SELECT sha256(a.batch_id || '||' || a.attendance_id) AS attendance_fact_key, sha256(a.batch_id) AS batch_key,
       sha256(a.school_id) AS school_key, v.school_scd_key, s.student_key, s.student_batch_key, s.year_level_key,
       CAST(strftime(a.attendance_month, '%Y%m%d') AS INTEGER) AS attendance_month_date_key, a.batch_id,
       a.attendance_id, a.student_id, a.school_id, a.attendance_month, a.possible_days, a.attended_days,
       CASE WHEN a.possible_days > 0 THEN round(a.attended_days::DOUBLE / a.possible_days, 4) END AS attendance_rate,
       a.absence_reason, a.bronze_record_id
FROM b_good_attendance a LEFT JOIN b_dim_student s ON a.batch_id = s.batch_id AND a.student_id = s.student_id
LEFT JOIN b_dim_school v ON v.school_id = a.school_id AND CAST(a.batch_id AS DATE) >= v.effective_from_date
 AND (v.effective_to_date IS NULL OR CAST(a.batch_id AS DATE) <= v.effective_to_date)""")
cte("b_fact_score", "b_good_scores b_dim_student", """
SELECT sha256(r.batch_id || '||' || r.assessment_id) AS assessment_fact_key, sha256(r.batch_id) AS batch_key,
       s.school_key, s.school_scd_key, s.student_key, s.student_batch_key, sha256(r.domain) AS domain_key,
       sha256(r.proficiency_band) AS proficiency_band_key,
       CAST(r.assessment_year * 10000 + 101 AS INTEGER) AS assessment_year_date_key, r.batch_id,
       r.assessment_id, r.student_id, r.school_id, r.assessment_year, r.domain, r.score, r.proficiency_band,
       r.bronze_record_id
FROM b_good_scores r LEFT JOIN b_dim_student s ON r.batch_id = s.batch_id AND r.student_id = s.student_id""")
cte("b_batch", "", """
SELECT * FROM (VALUES ('2025-01-15', 'Batch 1 - 2024 data'), ('2026-01-15', 'Batch 2 - 2025 data'))
AS t(batch_id, batch_label)""")
cte("b_fact_quality", "b_results", """
SELECT sha256(run_id || '||' || batch_id || '||' || rule_id) AS dq_result_fact_key, sha256(batch_id) AS batch_key,
       sha256(rule_id) AS dq_rule_key, run_id, batch_id, rule_id, rule_name, target_table, severity,
       CASE severity WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS severity_sort_order, status,
       CASE status WHEN 'FAIL' THEN 1 WHEN 'WARN' THEN 2 ELSE 3 END AS status_sort_order, failed_record_count,
       CASE WHEN status IN ('FAIL', 'WARN') THEN 1 ELSE 0 END AS issue_flag
FROM b_results""")
cte("b_defects", "b_results b_rules", """
SELECT r.rule_id || '_' || r.batch_id || '_' || r.run_id AS defect_id, r.run_id, r.batch_id, r.rule_id,
       r.severity, r.target_table, r.rule_name AS defect_title, 'Open' AS defect_status, r.failed_record_count,
       k.recommended_action
FROM b_results r JOIN b_rules k ON r.rule_id = k.rule_id WHERE r.failed_record_count > 0""")

# ---------------------------------------------------------------- monthly layers

cte("c_slices", "", """
SELECT strftime(d, '%Y-%m') AS reporting_month, strftime(d, '%Y_%m') AS source_batch_id
FROM (SELECT unnest(generate_series(date_trunc('month', min(l_shipdate)), date_trunc('month', max(l_shipdate)),
             INTERVAL 1 MONTH)) AS d FROM lineitem
      UNION SELECT date_trunc('month', ts) FROM events)""")
cte("c_schools", "raw_schools", """
SELECT *, '1995-01' AS reporting_month, '1995_01' AS source_batch_id FROM raw_schools""")
cte("c_students", "raw_students", """
SELECT *, replace(reporting_month, '-', '_') AS source_batch_id FROM raw_students""")
cte("c_attendance", "raw_attendance", """
SELECT *, replace(reporting_month, '-', '_') AS source_batch_id,
       TRY_CAST(possible_days AS INTEGER) AS p, TRY_CAST(attended_days AS INTEGER) AS t,
       TRY_CAST(attendance_month AS DATE) AS m
FROM raw_attendance""")
cte("c_scores", "raw_scores", """
SELECT *, replace(reporting_month, '-', '_') AS source_batch_id,
       TRY_CAST(score AS DECIMAL(6,2)) AS value FROM raw_scores""")
cte("c_events", "raw_events", """
SELECT *, replace(reporting_month, '-', '_') AS source_batch_id FROM raw_events""")
cte("c_known", "raw_students", "SELECT 'STU' || row_number AS student_id FROM raw_students WHERE c_acctbal >= 0")
cte("c_rules", "", """
SELECT * FROM (VALUES
 ('ATT_NO_ROWS_FOR_MONTH', 'Bronze attendance has zero rows for the reporting month.', 'bronze.attendance', 'BLOCKER'),
 ('ATT_ROW_COUNT_TOO_LOW', 'Bronze attendance row count is unexpectedly low for the reporting month.', 'bronze.attendance', 'BLOCKER'),
 ('STU_NO_ROWS_FOR_MONTH', 'Bronze students has zero rows for the initial snapshot month.', 'bronze.students', 'BLOCKER'),
 ('SCH_NO_ROWS_FOR_MONTH', 'Bronze schools has zero rows for the initial snapshot month.', 'bronze.schools', 'BLOCKER'),
 ('SCH_MISSING_KEY', 'School row is missing school_id.', 'bronze.schools', 'ERROR'),
 ('STU_MISSING_KEY', 'Student row is missing student_id.', 'bronze.students', 'ERROR'),
 ('STU_MISSING_SCHOOL_ID', 'Student row is missing school_id.', 'bronze.students', 'ERROR'),
 ('STU_UNKNOWN_SCHOOL', 'Student references a school_id not available in Bronze schools.', 'bronze.students', 'ERROR'),
 ('ATT_INVALID_DAYS', 'Attendance row has invalid possible_days or attended_days.', 'bronze.attendance', 'ERROR'),
 ('ATT_DUPLICATE_BUSINESS_KEY', 'Attendance has more than one row for the same student, school, and attendance month.', 'bronze.attendance', 'WARNING'),
 ('ATT_UNKNOWN_STUDENT', 'Attendance references a student_id not available in the student records.', 'bronze.attendance', 'ERROR'),
 ('ATT_ABSENCE_REASON_NO_ABSENCE', 'Attendance row has absence_reason even though attended_days equals possible_days.', 'bronze.attendance', 'WARNING'),
 ('ATT_ABSENCE_REASON_MISSING', 'Attendance row has absences but no absence_reason.', 'bronze.attendance', 'WARNING'),
 ('ASM_INVALID_SCORE', 'Assessment score is not numeric or outside expected range 250 to 700.', 'bronze.assessment_results', 'ERROR'),
 ('EVT_UNKNOWN_SCHOOL', 'School event references a school_id not available in Bronze schools.', 'bronze.school_events', 'WARNING')
) AS t(rule_id, rule_name, target_table, severity)""")
cte("c_row_failures", "c_schools c_students c_attendance c_scores c_events c_known", """
SELECT source_batch_id, reporting_month, 'SCH_MISSING_KEY' AS rule_id, school_id AS business_key,
       CAST(row_number AS VARCHAR) AS raw_row_number FROM c_schools WHERE trim(school_id) = ''
UNION ALL SELECT source_batch_id, reporting_month, 'STU_MISSING_KEY', student_id, CAST(row_number AS VARCHAR)
FROM c_students WHERE trim(student_id) = ''
UNION ALL SELECT source_batch_id, reporting_month, 'STU_MISSING_SCHOOL_ID', student_id, CAST(row_number AS VARCHAR)
FROM c_students WHERE trim(student_id) <> '' AND trim(school_id) = ''
UNION ALL SELECT source_batch_id, reporting_month, 'STU_UNKNOWN_SCHOOL', student_id, CAST(row_number AS VARCHAR)
FROM c_students s WHERE trim(school_id) <> ''
  AND NOT EXISTS (SELECT 1 FROM c_schools c WHERE c.school_id = trim(s.school_id))
UNION ALL SELECT source_batch_id, reporting_month, 'ATT_INVALID_DAYS', attendance_id, row_number
FROM c_attendance WHERE p IS NULL OR t IS NULL OR p < 0 OR t < 0 OR t > p
UNION ALL SELECT source_batch_id, reporting_month, 'ATT_DUPLICATE_BUSINESS_KEY', attendance_id, row_number
FROM (SELECT *, row_number() OVER (PARTITION BY source_batch_id, student_id, school_id, m ORDER BY row_number) AS rn
      FROM c_attendance WHERE trim(student_id) <> '' AND m IS NOT NULL) WHERE rn > 1
UNION ALL SELECT source_batch_id, reporting_month, 'ATT_UNKNOWN_STUDENT', attendance_id, row_number
FROM c_attendance a WHERE trim(student_id) <> ''
  AND NOT EXISTS (SELECT 1 FROM c_known k WHERE k.student_id = a.student_id)
  AND NOT EXISTS (SELECT 1 FROM c_students s WHERE s.student_id = a.student_id
                  AND s.reporting_month = a.reporting_month)
UNION ALL SELECT source_batch_id, reporting_month, 'ATT_ABSENCE_REASON_NO_ABSENCE', attendance_id, row_number
FROM c_attendance WHERE p = t AND trim(absence_reason) <> ''
UNION ALL SELECT source_batch_id, reporting_month, 'ATT_ABSENCE_REASON_MISSING', attendance_id, row_number
FROM c_attendance WHERE t < p AND trim(absence_reason) = ''
UNION ALL SELECT source_batch_id, reporting_month, 'ASM_INVALID_SCORE', assessment_id, CAST(row_number AS VARCHAR)
FROM c_scores WHERE trim(assessment_id) <> '' AND (value IS NULL OR value < 250 OR value > 700)
UNION ALL SELECT source_batch_id, reporting_month, 'EVT_UNKNOWN_SCHOOL', event_id, CAST(row_number AS VARCHAR)
FROM c_events e WHERE NOT EXISTS (SELECT 1 FROM c_schools c WHERE c.school_id = e.school_id)""")
cte("c_volume", "c_slices c_attendance c_students c_schools", """
SELECT s.source_batch_id, s.reporting_month, v.rule_id,
       CAST(CASE v.rule_id
         WHEN 'ATT_NO_ROWS_FOR_MONTH' THEN coalesce(a.n, 0) = 0
         WHEN 'ATT_ROW_COUNT_TOO_LOW' THEN coalesce(a.n, 0) < 700
         WHEN 'STU_NO_ROWS_FOR_MONTH' THEN s.reporting_month = '1995-01' AND coalesce(u.n, 0) = 0
         ELSE s.reporting_month = '1995-01' AND coalesce(c.n, 0) = 0 END AS BIGINT) AS failed_record_count
FROM c_slices s
CROSS JOIN (VALUES ('ATT_NO_ROWS_FOR_MONTH'), ('ATT_ROW_COUNT_TOO_LOW'), ('STU_NO_ROWS_FOR_MONTH'),
                   ('SCH_NO_ROWS_FOR_MONTH')) v(rule_id)
LEFT JOIN (SELECT reporting_month, count(*) AS n FROM c_attendance GROUP BY 1) a ON a.reporting_month = s.reporting_month
LEFT JOIN (SELECT reporting_month, count(*) AS n FROM c_students GROUP BY 1) u ON u.reporting_month = s.reporting_month
LEFT JOIN (SELECT reporting_month, count(*) AS n FROM c_schools GROUP BY 1) c ON c.reporting_month = s.reporting_month""")
cte("c_results", "c_rules c_slices c_row_failures c_volume", """
SELECT s.source_batch_id, s.reporting_month, r.rule_id, r.rule_name, r.target_table, r.severity,
       coalesce(v.failed_record_count, f.n, 0) AS failed_record_count,
       CASE WHEN coalesce(v.failed_record_count, f.n, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM c_slices s CROSS JOIN c_rules r
LEFT JOIN c_volume v ON v.reporting_month = s.reporting_month AND v.rule_id = r.rule_id
LEFT JOIN (SELECT reporting_month, rule_id, count(*) AS n FROM c_row_failures GROUP BY 1, 2) f
  ON f.reporting_month = s.reporting_month AND f.rule_id = r.rule_id""")
cte("c_rejected", "c_row_failures c_rules", """
SELECT f.*, r.target_table, r.rule_name AS failure_reason
FROM c_row_failures f JOIN c_rules r ON f.rule_id = r.rule_id
WHERE f.rule_id NOT IN ('ATT_ABSENCE_REASON_NO_ABSENCE', 'ATT_ABSENCE_REASON_MISSING', 'EVT_UNKNOWN_SCHOOL')""")
cte("c_caveats", "c_results", """
SELECT source_batch_id, reporting_month, rule_id AS caveat_code, rule_id AS caveat_title,
       rule_name || ' Failed record count: ' || failed_record_count || '.' AS caveat_description, severity,
       CASE WHEN target_table LIKE '%attendance%' THEN 'Attendance'
            WHEN target_table LIKE '%assessment%' THEN 'Assessment'
            WHEN target_table LIKE '%student%' THEN 'Student reference'
            WHEN target_table LIKE '%school_events%' THEN 'School events' ELSE 'School reference' END AS affected_area,
       CASE severity WHEN 'BLOCKER' THEN 'Stop reporting for this month until required data is loaded or corrected.'
            WHEN 'ERROR' THEN 'Review source records and exclude invalid rows from trusted reporting.'
            ELSE 'Review caveat and decide whether dashboard users need a note.' END AS recommended_action
FROM c_results WHERE failed_record_count > 0""")
cte("c_readiness", "c_results c_rejected", """
SELECT source_batch_id, reporting_month,
       CASE WHEN b > 0 THEN 'NOT_READY' WHEN e + w > 0 THEN 'READY_WITH_CAVEATS' ELSE 'READY' END AS readiness_status,
       b AS blocker_count, e AS error_count, w AS warning_count, n AS rejected_record_count,
       CASE WHEN b > 0 THEN 'Blocker checks failed. This reporting month should not be released until required data is loaded or corrected.'
            WHEN e > 0 THEN 'Quality checks found error-level issues. Invalid rows should be excluded from trusted reporting.'
            WHEN w > 0 THEN 'Quality checks found warning-level caveats. Reporting can proceed with notes.'
            ELSE 'Quality checks passed for this reporting month.' END AS readiness_summary
FROM (SELECT source_batch_id, reporting_month,
             count(*) FILTER (severity = 'BLOCKER' AND failed_record_count > 0) AS b,
             count(*) FILTER (severity = 'ERROR' AND failed_record_count > 0) AS e,
             count(*) FILTER (severity = 'WARNING' AND failed_record_count > 0) AS w,
             (SELECT count(*) FROM c_rejected j WHERE j.reporting_month = c_results.reporting_month) AS n
      FROM c_results GROUP BY source_batch_id, reporting_month)""")
cte("c_released", "c_readiness", "SELECT reporting_month FROM c_readiness WHERE readiness_status <> 'NOT_READY'")
cte("c_school", "c_schools", """
SELECT row_number() OVER (ORDER BY substr(sha256(school_id), 1, 3), school_id) AS school_key, *
FROM (SELECT trim(school_id) AS school_id, school_name, region, school_type,
             TRY_CAST(open_date AS DATE) AS open_date, status FROM c_schools WHERE trim(school_id) <> '')""")
cte("c_person", "c_students c_rejected", """
SELECT trim(student_id) AS student_id, NULLIF(trim(school_id), '') AS current_school_id,
       TRY_CAST(year_level AS INTEGER) AS current_year_level, trim(gender) AS gender,
       TRY_CAST(enrolment_date AS DATE) AS enrolment_date, status, source_batch_id, reporting_month
FROM c_students s WHERE trim(student_id) <> ''
  AND NOT EXISTS (SELECT 1 FROM c_rejected j WHERE j.target_table = 'bronze.students'
                  AND j.reporting_month = s.reporting_month AND trim(j.business_key) = trim(s.student_id))""")
cte("c_student", "c_person", """
SELECT row_number() OVER (ORDER BY substr(sha256(student_id), 1, 3), student_id) AS student_key, * FROM c_person""")
cte("c_conformed_attendance", "c_attendance c_student c_school c_rejected", """
SELECT attendance_id, source_batch_id, reporting_month, m AS attendance_month, student_key, school_key,
       p AS possible_days, t AS attended_days,
       CASE WHEN p > 0 THEN CAST(t::DOUBLE / p AS DECIMAL(6,4)) END AS attendance_rate,
       CASE WHEN p <> t THEN NULLIF(trim(absence_reason), '') END AS absence_reason,
       CASE WHEN p <= 0 THEN NULL WHEN t::DOUBLE / p < 0.82 THEN 'Low' WHEN t::DOUBLE / p < 0.90 THEN 'Medium'
            ELSE 'High' END AS attendance_band
FROM (SELECT a.*, s.student_key, c.school_key,
             row_number() OVER (PARTITION BY a.source_batch_id, a.attendance_id ORDER BY a.row_number DESC) AS rn
      FROM c_attendance a JOIN c_student s ON s.student_id = a.student_id
      JOIN c_school c ON c.school_id = a.school_id
      WHERE p >= 0 AND t >= 0 AND t <= p
        AND (a.reporting_month, a.attendance_id) NOT IN (
              SELECT (reporting_month, business_key) FROM c_rejected WHERE target_table = 'bronze.attendance'))
WHERE rn = 1""")
cte("c_conformed_scores", "c_scores c_student c_school c_rejected", """
SELECT r.assessment_id, r.source_batch_id, r.reporting_month, s.student_key, c.school_key,
       TRY_CAST(r.assessment_year AS INTEGER) AS assessment_year, r.domain, r.value AS score, r.proficiency_band
FROM c_scores r JOIN c_student s ON s.student_id = r.student_id JOIN c_school c ON c.school_id = r.school_id
WHERE trim(r.assessment_id) <> '' AND r.value BETWEEN 250 AND 700""")
cte("c_status", "c_student c_school c_attendance c_rejected c_slices", """
SELECT m.reporting_month, s.student_key, c.school_key, s.current_year_level AS year_level, s.gender,
       s.status AS student_status, m.source_batch_id
FROM c_slices m CROSS JOIN c_student s LEFT JOIN c_school c ON c.school_id = s.current_school_id
WHERE (upper(s.status) IN ('ACTIVE', 'ENROLLED')
       OR EXISTS (SELECT 1 FROM c_attendance a WHERE a.reporting_month = m.reporting_month
                  AND a.student_id = s.student_id))""")
cte("c_month", "c_slices", """
SELECT CAST(replace(reporting_month, '-', '') AS INTEGER) AS month_key, reporting_month,
       CAST(reporting_month || '-01' AS DATE) AS month_start_date, CAST(year(d) AS INTEGER) AS calendar_year,
       CAST(month(d) AS INTEGER) AS calendar_month_number, monthname(d) AS calendar_month_name,
       CAST(year(d) AS INTEGER) AS school_year,
       CASE WHEN month(d) = 1 THEN 'Summer break' WHEN month(d) <= 4 THEN 'Term 1' WHEN month(d) <= 7 THEN 'Term 2'
            WHEN month(d) <= 9 THEN 'Term 3' ELSE 'Term 4' END AS school_term,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Summer' WHEN month(d) <= 5 THEN 'Autumn'
            WHEN month(d) <= 8 THEN 'Winter' ELSE 'Spring' END AS season,
       CAST(strftime(d - INTERVAL 1 MONTH, '%Y%m') AS INTEGER) AS prior_month_key,
       month(d) IN (6, 7, 8) AS is_winter_month
FROM (SELECT *, CAST(reporting_month || '-01' AS DATE) AS d FROM c_slices)""")
cte("c_level", "c_student", """
SELECT year_level AS year_level_key, year_level,
       CASE WHEN year_level = 0 THEN 'Kindergarten' ELSE 'Year ' || year_level END AS year_level_label,
       CASE WHEN year_level <= 6 THEN 'Primary' WHEN year_level = 7 THEN 'Year 7 transition'
            WHEN year_level <= 10 THEN 'Years 8-10' ELSE 'Senior secondary' END AS cohort_group,
       year_level AS sort_order
FROM (SELECT DISTINCT current_year_level AS year_level FROM c_student WHERE current_year_level IS NOT NULL)""")
cte("c_band", "", """
SELECT * FROM (VALUES (1, 'Low', 1), (2, 'Medium', 2), (3, 'High', 3))
AS t(attendance_band_key, attendance_band, band_sort_order)""")
cte("c_domain", "", """
SELECT * FROM (VALUES (1, 'Reading', 1), (2, 'Numeracy', 2), (3, 'Writing', 3))
AS t(assessment_domain_key, domain, domain_sort_order)""")
cte("c_fact_attendance", "c_conformed_attendance c_student c_band", """
SELECT CAST(replace(a.reporting_month, '-', '') AS INTEGER) AS month_key, a.student_key, a.school_key,
       s.current_year_level AS year_level_key, b.attendance_band_key, a.possible_days, a.attended_days,
       a.possible_days - a.attended_days AS absent_days, a.attendance_rate, a.source_batch_id
FROM c_conformed_attendance a JOIN c_student s ON s.student_key = a.student_key
LEFT JOIN c_band b ON b.attendance_band = a.attendance_band""")
cte("c_fact_score", "c_conformed_scores c_domain c_student c_conformed_attendance c_band", """
SELECT row_number() OVER (ORDER BY substr(sha256(r.assessment_id), 1, 3), r.assessment_id) AS assessment_result_key,
       r.assessment_year, r.student_key, r.school_key, s.current_year_level AS year_level_key, r.domain,
       r.source_batch_id, r.score,
       (SELECT a.attendance_band FROM c_conformed_attendance a WHERE a.student_key = r.student_key
         AND left(a.reporting_month, 4) = CAST(r.assessment_year AS VARCHAR)
        ORDER BY a.reporting_month DESC, a.attendance_id DESC LIMIT 1) AS attendance_band
FROM c_conformed_scores r LEFT JOIN c_student s ON s.student_key = r.student_key""")


def _payload(columns: str, *more: tuple[str, str]) -> str:
    """A row as JSON text, nulls left out; names that end in ``:date`` are written as dates."""
    pairs = [(c.removesuffix(":date"), f"CAST({c.removesuffix(':date')} AS VARCHAR)" if c.endswith(":date") else c)
             for c in columns.split()]
    listed = ", ".join(f"'{k}', {v}" for k, v in [*pairs, *more])
    return f"CAST(json_merge_patch('{{}}', json_object({listed})) AS VARCHAR) AS payload"


_SILVER_PAYLOADS = (
    ("schools", "b_schools", "school_id school_name region school_type open_date:date status"),
    ("students", "b_students", "student_id school_id year_level gender enrolment_date:date status"),
    ("attendance", "b_attendance", "attendance_id student_id school_id attendance_month:date possible_days attended_days absence_reason"),
    ("assessment_results", "b_scores", "assessment_id student_id school_id assessment_year domain score proficiency_band"),
    ("school_events", "b_events", "event_id school_id event_type event_date:date description"),
)
cte("b_payloads", "b_schools b_students b_attendance b_scores b_events", "\nUNION ALL ".join(
    f"SELECT 'silver.{name}' AS target_table, batch_id, bronze_record_id, " + _payload(
        columns, ("batch_id", "batch_id"), ("run_id", "'dev_batch_run'"), ("load_timestamp", "'2026-01-15T00:00:00.000Z'"),
        ("source_file_name", f"'{name}.csv'"), ("bronze_record_id", "bronze_record_id")) + f" FROM {source}"
    for name, source, columns in _SILVER_PAYLOADS))
_BRONZE_PAYLOADS = (
    ("schools", "c_schools", "school_id school_name region school_type open_date status"),
    ("students", "c_students", "student_id school_id year_level gender enrolment_date status"),
    ("attendance", "c_attendance", "attendance_id student_id school_id attendance_month possible_days attended_days absence_reason"),
    ("assessment_results", "c_scores", "assessment_id student_id school_id assessment_year domain score proficiency_band"),
)
cte("c_payloads", "c_schools c_students c_attendance c_scores", "\nUNION ALL ".join(
    f"SELECT DISTINCT 'bronze.{name}' AS target_table, reporting_month, CAST(row_number AS VARCHAR) AS raw_row_number, "
    + _payload(columns) + f" FROM {source}" for name, source, columns in _BRONZE_PAYLOADS))
