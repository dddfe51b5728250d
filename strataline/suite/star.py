"""Dimensions, facts, marts and report views."""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import functions as F

from ..operators.quality import union_all
from ..operators.rows import SPREAD
from ..plans import assured, baseline, monthly
from . import bindings as b
from .history import Monthly, school_versions
from .quality import Assured, monthly_run
from .registry import register

# ---------------------------------------------------------------- baseline star


@cache
def baseline_vault(spark, folder):
    return baseline.build_vault(b.staged(spark, folder))


def _members(spark, folder):
    vault = baseline_vault(spark, folder)
    groups = baseline.dim_student_group(vault, baseline.dim_school(vault))
    return baseline.student_group_map(vault, groups)


def _star(spark, folder):
    return baseline.build_star(baseline_vault(spark, folder), b.as_of())


@register("dim_school", "a_school", """
SELECT school_id AS school_key, school_name, region, school_type, open_date, status FROM a_school""")
def dim_school(spark, folder):
    return baseline.dim_school(baseline_vault(spark, folder))


@register("dim_student_group", "a_group", "SELECT * FROM a_group")
def dim_student_group(spark, folder):
    vault = baseline_vault(spark, folder)
    return baseline.dim_student_group(vault, baseline.dim_school(vault))


@register("dim_date_sparse", "a_date", "SELECT * FROM a_date")
def dim_date_sparse(spark, folder):
    return baseline.dim_date(baseline_vault(spark, folder), b.as_of())


@register("dim_date_dense", "b_attendance b_scores b_events", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS calendar_year,
       CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(month(d) AS INTEGER) AS month_number,
       strftime(d, '%b') AS month_name, CAST(date_trunc('month', d) AS DATE) AS month_start_date,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_number,
       strftime(d, '%a') AS day_of_week_name, day(d) = 1 AS is_month_start
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (
  SELECT min(x) AS lo, max(x) AS hi FROM (
    SELECT attendance_month AS x FROM b_attendance UNION ALL SELECT make_date(assessment_year, 1, 1) FROM b_scores
    UNION ALL SELECT event_date FROM b_events)))""")
def dim_date_dense(spark, folder):
    return assured.dim_date(b.silver(spark, folder))


@register("dim_month", "c_month", "SELECT * FROM c_month")
def dim_month(spark, folder):
    return monthly.dim_month(b.slices(spark, folder))


@register("dim_numbered", "a_domain a_event_type", """
SELECT 'domain' AS dimension, assessment_domain_key AS key, assessment_domain AS label FROM a_domain
UNION ALL SELECT 'event_type', event_type_key, event_type FROM a_event_type""")
def dim_numbered(spark, folder):
    vault = baseline_vault(spark, folder)
    return union_all([
        baseline.dim_assessment_domain(vault).toDF("key", "label").withColumn("dimension", F.lit("domain")),
        baseline.dim_event_type(vault).toDF("key", "label").withColumn("dimension", F.lit("event_type"))])


@register("dim_small", "b_students b_scores", """
SELECT DISTINCT 'year_level' AS dimension, sha256(CAST(year_level AS VARCHAR)) AS hash,
       CASE WHEN year_level = 0 THEN 'Kindergarten' ELSE 'Year ' || year_level END AS label,
       year_level AS sort_order, NULL AS extra FROM b_students WHERE year_level IS NOT NULL
UNION ALL SELECT DISTINCT 'domain', sha256(domain), domain,
       CASE domain WHEN 'Reading' THEN 1 WHEN 'Writing' THEN 2 WHEN 'Numeracy' THEN 3 ELSE 99 END, NULL FROM b_scores
UNION ALL SELECT DISTINCT 'band', sha256(proficiency_band), proficiency_band,
       CASE proficiency_band WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 99 END,
       CASE proficiency_band WHEN 'Low' THEN '250 to 399' WHEN 'Medium' THEN '400 to 549'
            WHEN 'High' THEN '550 and above' ELSE 'Unknown' END FROM b_scores""")
def dim_small(spark, folder):
    silver = b.silver(spark, folder)
    levels = assured.dim_year_level(silver["students"])
    domains = assured.dim_assessment_domain(silver["assessment_results"])
    bands = assured.dim_proficiency_band(silver["assessment_results"])

    def shape(df, name, key, label, order, extra):
        return df.select(F.lit(name).alias("dimension"), F.col(key).alias("hash"), F.col(label).alias("label"),
                         F.col(order).alias("sort_order"), extra.alias("extra"))

    none = F.lit(None).cast("string")
    return union_all([
        shape(levels, "year_level", "year_level_key", "year_level_label", "year_level_sort_order", none),
        shape(domains, "domain", "domain_key", "domain", "domain_sort_order", none),
        shape(bands, "band", "proficiency_band_key", "proficiency_band", "proficiency_band_sort_order",
              F.col("score_range_label"))])


@register("dim_monthly_level", "c_level", "SELECT * FROM c_level")
def dim_monthly_level(spark, folder):
    return monthly.dim_year_level(Monthly(spark, folder).students)


@register("fact_activity_flags", "a_fact_attendance", "SELECT * FROM a_fact_attendance")
def fact_activity_flags(spark, folder):
    return _star(spark, folder)["fact_attendance"]


@register("fact_score_flags", "a_fact_score", "SELECT * FROM a_fact_score")
def fact_score_flags(spark, folder):
    return _star(spark, folder)["fact_assessment"]


_EVENTS = """
SELECT e.event_id, e.school_id AS school_key, CAST(strftime(e.event_date, '%Y%m%d') AS INTEGER) AS date_key,
       t.event_type_key, 1 AS event_count
FROM stg_events e JOIN a_school s ON e.school_id = s.school_id JOIN a_event_type t ON e.event_type = t.event_type
WHERE e.event_date <= DATE '2024-12-31'"""


@register("fact_event_flags", "stg_events a_school a_event_type", _EVENTS)
def fact_event_flags(spark, folder):
    """The events lie in 2024, so this one is built as of the end of that year."""
    vault, day = baseline_vault(spark, folder), F.lit("2024-12-31").cast("date")
    return baseline.fact_school_events(vault, baseline.dim_school(vault), baseline.dim_date(vault, day),
                                       baseline.dim_event_type(vault), day)


_A_TOTALS = """
CAST(sum(possible_days) AS BIGINT) AS total_possible_days, CAST(sum(attended_days) AS BIGINT) AS total_attended_days,
CAST(sum(absence_days) AS BIGINT) AS total_absence_days,
CAST(sum(attended_days)::DOUBLE / NULLIF(sum(possible_days), 0) AS DECIMAL(6,4)) AS attendance_rate,
CAST((sum(possible_days) - sum(attended_days))::DOUBLE / NULLIF(sum(possible_days), 0) AS DECIMAL(6,4)) AS absence_rate,
CAST(sum(chronic_absence_flag) AS BIGINT) AS chronic_absence_records,
CAST(sum(1 - is_valid_attendance) AS BIGINT) AS invalid_attendance_records"""


@register("report_attendance_school", "a_fact_attendance", f"""
SELECT s.school_id AS school_key, s.school_name, s.region, s.school_type, d.calendar_year, d.calendar_month, d.month_name,
       {_A_TOTALS}
FROM a_fact_attendance f JOIN a_school s ON f.school_key = s.school_id JOIN a_date d ON f.date_key = d.date_key
GROUP BY s.school_id, s.school_name, s.region, s.school_type, d.calendar_year, d.calendar_month, d.month_name""")
def report_attendance_school(spark, folder):
    return baseline.view_attendance_by_school(_star(spark, folder))


@register("report_attendance_level", "a_fact_attendance a_group", f"""
SELECT s.school_id AS school_key, s.school_name, s.region, s.school_type, g.year_level, g.gender, g.student_status,
       d.calendar_year, d.calendar_month, d.month_name, {_A_TOTALS}
FROM a_fact_attendance f JOIN a_school s ON f.school_key = s.school_id JOIN a_date d ON f.date_key = d.date_key
JOIN a_group g ON f.student_group_key = g.student_group_key
GROUP BY s.school_id, s.school_name, s.region, s.school_type, g.year_level, g.gender, g.student_status,
         d.calendar_year, d.calendar_month, d.month_name""")
def report_attendance_level(spark, folder):
    return baseline.view_attendance_by_year_level(_star(spark, folder))


_A_SCORES = """
count(*) AS assessment_record_count, avg(CASE WHEN is_valid_score = 1 THEN CAST(score AS DOUBLE) END) AS average_score,
count(*) FILTER (proficiency_band = 'Low') AS low_proficiency_count,
count(*) FILTER (proficiency_band = 'Medium') AS medium_proficiency_count,
count(*) FILTER (proficiency_band = 'High') AS high_proficiency_count,
CAST(count(*) FILTER (proficiency_band = 'Low')::DOUBLE / count(*) AS DECIMAL(6,4)) AS low_proficiency_rate,
count(*) FILTER (is_valid_score = 0) AS invalid_score_records"""


@register("report_score_school", "a_fact_score", f"""
SELECT s.school_id AS school_key, s.school_name, s.region, s.school_type, d.calendar_year AS assessment_year,
       k.assessment_domain, {_A_SCORES}
FROM a_fact_score f JOIN a_school s ON f.school_key = s.school_id JOIN a_date d ON f.date_key = d.date_key
JOIN a_domain k ON k.assessment_domain_key = f.assessment_domain_key
GROUP BY s.school_id, s.school_name, s.region, s.school_type, d.calendar_year, k.assessment_domain""")
def report_score_school(spark, folder):
    return baseline.view_assessment_by_school(_star(spark, folder))


@register("report_score_domain", "a_fact_score", f"""
SELECT d.calendar_year AS assessment_year, k.assessment_domain, {_A_SCORES}
FROM a_fact_score f JOIN a_date d ON f.date_key = d.date_key
JOIN a_domain k ON k.assessment_domain_key = f.assessment_domain_key GROUP BY d.calendar_year, k.assessment_domain""")
def report_score_domain(spark, folder):
    return baseline.view_assessment_by_domain(_star(spark, folder))


# ---------------------------------------------------------------- assured star


class AssuredStar(Assured):
    """Dimensions and trusted facts of the assured pipeline."""

    def __init__(self, spark, folder, stored=("attendance", "assessment_results")):
        super().__init__(spark, folder, stored)
        self.batches = assured.dim_batch(spark)
        self.spark, self.folder = spark, folder

    @cached_property
    def schools(self):
        """Stored: students and facts look versions up, and the size of the file decides on a broadcast."""
        return b.materialise(school_versions(self.spark, self.folder).withColumnsRenamed(
            {"version_key": "school_scd_key", "entity_key": "school_key"}))

    @cached_property
    def students(self):
        return assured.dim_student(self.silver["students"], self.schools)

    def good(self, dataset, rule_ids, carry=()):
        table = f"silver.{dataset}"
        return assured.trusted_in_one_pass(self.marked[table], self.rules, table, rule_ids, carry)

    @property
    def attendance(self):
        return self.good("attendance", assured.ATTENDANCE_QUARANTINE)

    @property
    def scores(self):
        return self.good("assessment_results", assured.ASSESSMENT_QUARANTINE)

    @property
    def fact_attendance(self):
        rows = self.good("attendance", assured.ATTENDANCE_QUARANTINE, [SPREAD])
        return assured.fact_attendance(rows, self.students, self.schools)

    @property
    def domains(self):
        return assured.dim_assessment_domain(self.silver["assessment_results"])

    @property
    def bands(self):
        return assured.dim_proficiency_band(self.silver["assessment_results"])

    @property
    def fact_scores(self):
        return assured.fact_assessment_result(self.scores, self.students, self.domains, self.bands)

    @property
    def days(self):
        return assured.dim_date(self.silver)

    @property
    def rule_dimension(self):
        return assured.dim_dq_rule(self.spark, self.rules)

    @property
    def fact_quality(self):
        return assured.fact_data_quality_result(self.results, self.rule_dimension)

    @property
    def fact_defects(self):
        return assured.fact_defect(assured.defect_rows(self.results, self.rules), self.rule_dimension)


@register("dim_student", "b_dim_student", "SELECT * FROM b_dim_student")
def dim_student(spark, folder):
    return AssuredStar(spark, folder).students.drop("run_id", "load_timestamp", "source_file_name")


@register("quarantine_join", "b_good_attendance", "SELECT * FROM b_good_attendance")
def quarantine_join(spark, folder):
    """Trusted rows by the captured failures: an anti join on the record id. Only attendance is read more than once."""
    run = AssuredStar(spark, folder, stored=("attendance",))
    return assured.trusted(run.silver["attendance"], run.failed, "silver.attendance",
                           assured.ATTENDANCE_QUARANTINE).drop("run_id", "load_timestamp", "source_file_name")


@register("fact_trusted", "b_fact_attendance", "SELECT * FROM b_fact_attendance")
def fact_trusted(spark, folder):
    return AssuredStar(spark, folder, stored=()).fact_attendance.drop("source_run_id")


@register("fact_trusted_scores", "b_fact_score", "SELECT * FROM b_fact_score")
def fact_trusted_scores(spark, folder):
    return AssuredStar(spark, folder).fact_scores.drop("source_run_id")


@register("fact_quality", "b_fact_quality", "SELECT * FROM b_fact_quality")
def fact_quality(spark, folder):
    return AssuredStar(spark, folder).fact_quality


@register("fact_defects", "b_defects", """
SELECT sha256(defect_id || '||' || run_id) AS defect_fact_key, sha256(batch_id) AS batch_key,
       sha256(rule_id) AS dq_rule_key, defect_id, run_id, batch_id, rule_id, defect_title AS rule_name, target_table,
       severity, CASE severity WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS severity_sort_order,
       defect_title, defect_status, 1 AS defect_status_sort_order, 1 AS open_defect_flag, failed_record_count,
       recommended_action FROM b_defects""")
def fact_defects(spark, folder):
    return AssuredStar(spark, folder).fact_defects


_RATE = "CASE WHEN sum(possible_days) > 0 THEN round(sum(attended_days)::DOUBLE / sum(possible_days), 4) END AS attendance_rate"
_DAYS = "CAST(sum(possible_days) AS BIGINT) AS possible_days, CAST(sum(attended_days) AS BIGINT) AS attended_days"


@register("mart_entity_month", "b_good_attendance b_schools", f"""
SELECT a.batch_id, a.school_id, s.school_name, s.region, s.school_type, a.attendance_month, {_DAYS},
       count(DISTINCT a.student_id) AS student_count, {_RATE}
FROM b_good_attendance a LEFT JOIN b_schools s ON a.batch_id = s.batch_id AND a.school_id = s.school_id
GROUP BY a.batch_id, a.school_id, s.school_name, s.region, s.school_type, a.attendance_month""")
def mart_entity_month(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.mart_attendance_school_month(run.attendance, run.silver["schools"])


@register("mart_level_month", "b_good_attendance b_students", f"""
SELECT a.batch_id, s.year_level, a.attendance_month, {_DAYS}, count(DISTINCT a.student_id) AS student_count, {_RATE}
FROM b_good_attendance a LEFT JOIN b_students s ON a.batch_id = s.batch_id AND a.student_id = s.student_id
GROUP BY a.batch_id, s.year_level, a.attendance_month""")
def mart_level_month(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.mart_attendance_year_level(run.attendance, run.silver["students"])


_SCORES = """
count(DISTINCT assessment_id) AS assessment_count, count(DISTINCT student_id) AS student_count,
round(avg(score), 2) AS average_score, CAST(quantile_disc(score, 0.5) AS INTEGER) AS median_score,
min(score) AS min_score, max(score) AS max_score"""


@register("mart_score_entity", "b_good_scores b_schools", f"""
SELECT r.batch_id, r.assessment_year, r.school_id, s.school_name, s.region, s.school_type, {_SCORES}
FROM b_good_scores r LEFT JOIN b_schools s ON r.batch_id = s.batch_id AND r.school_id = s.school_id
GROUP BY r.batch_id, r.assessment_year, r.school_id, s.school_name, s.region, s.school_type""")
def mart_score_entity(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.mart_assessment_school(run.scores, run.silver["schools"])


@register("mart_score_domain", "b_good_scores", f"""
SELECT batch_id, assessment_year, domain, proficiency_band, {_SCORES} FROM b_good_scores
GROUP BY batch_id, assessment_year, domain, proficiency_band""")
def mart_score_domain(spark, folder):
    return assured.mart_assessment_domain(AssuredStar(spark, folder).scores)


_BANDED = """
round(sum(attended_days)::DOUBLE / NULLIF(sum(possible_days), 0) * 100, 2) AS attendance_rate_percent,
CASE WHEN sum(possible_days) = 0 THEN 'No possible days'
     WHEN sum(attended_days)::DOUBLE / sum(possible_days) < 0.80 THEN 'Below 80%'
     WHEN sum(attended_days)::DOUBLE / sum(possible_days) < 0.85 THEN '80% to below 85%'
     WHEN sum(attended_days)::DOUBLE / sum(possible_days) < 0.90 THEN '85% to below 90%'
     ELSE '90% and above' END AS attendance_band,
CASE WHEN sum(possible_days) = 0 THEN 0 WHEN sum(attended_days)::DOUBLE / sum(possible_days) < 0.80 THEN 1
     WHEN sum(attended_days)::DOUBLE / sum(possible_days) < 0.85 THEN 2
     WHEN sum(attended_days)::DOUBLE / sum(possible_days) < 0.90 THEN 3 ELSE 4 END AS attendance_band_sort_order"""
_MONTH = """CAST(year(f.attendance_month) AS INTEGER) AS attendance_year,
       CAST(month(f.attendance_month) AS INTEGER) AS attendance_month_number,
       strftime(f.attendance_month, '%b') AS attendance_month_name"""


@register("view_entity_month", "b_fact_attendance b_dim_school b_batch", f"""
SELECT f.batch_id, b.batch_label, s.school_id, s.school_name, s.region, s.school_type, s.status AS school_status,
       f.attendance_month, {_MONTH}, {_DAYS}, count(DISTINCT f.student_batch_key) AS student_count, {_RATE}, {_BANDED}
FROM b_fact_attendance f JOIN b_batch b ON f.batch_id = b.batch_id
LEFT JOIN b_dim_school s ON f.school_scd_key = s.school_scd_key
GROUP BY f.batch_id, b.batch_label, s.school_id, s.school_name, s.region, s.school_type, s.status, f.attendance_month""")
def view_entity_month(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.view_attendance_by_school_month(run.fact_attendance, run.batches, run.schools, run.days)


@register("view_level_month", "b_fact_attendance b_students b_batch", f"""
SELECT f.batch_id, b.batch_label, s.year_level,
       CASE WHEN s.year_level = 0 THEN 'Kindergarten' ELSE 'Year ' || s.year_level END AS year_level_label,
       s.year_level AS year_level_sort_order, f.attendance_month, {_MONTH}, {_DAYS},
       count(DISTINCT f.student_batch_key) AS student_count, {_RATE}, {_BANDED}
FROM b_fact_attendance f JOIN b_batch b ON f.batch_id = b.batch_id
LEFT JOIN b_students s ON f.batch_id = s.batch_id AND f.student_id = s.student_id
GROUP BY f.batch_id, b.batch_label, s.year_level, f.attendance_month""")
def view_level_month(spark, folder):
    run = AssuredStar(spark, folder)
    levels = assured.dim_year_level(run.silver["students"])
    return assured.view_attendance_by_year_level(run.fact_attendance, run.batches, levels, run.days)


_VIEW_SCORES = """
count(*) AS assessment_count, count(DISTINCT f.student_batch_key) AS student_count,
round(avg(f.score), 2) AS average_score, CAST(quantile_disc(f.score, 0.5) AS INTEGER) AS median_score,
min(f.score) AS min_score, max(f.score) AS max_score"""


@register("view_score_entity", "b_fact_score b_dim_school b_batch", f"""
SELECT f.batch_id, b.batch_label, f.assessment_year, s.school_id, s.school_name, s.region, s.school_type,
       s.status AS school_status, {_VIEW_SCORES},
       CASE WHEN avg(f.score) < 400 THEN 'Below 400' WHEN avg(f.score) < 550 THEN '400 to below 550'
            ELSE '550 and above' END AS average_score_band,
       CASE WHEN avg(f.score) < 400 THEN 1 WHEN avg(f.score) < 550 THEN 2 ELSE 3 END AS average_score_band_sort_order
FROM b_fact_score f JOIN b_batch b ON f.batch_id = b.batch_id
LEFT JOIN b_dim_school s ON f.school_scd_key = s.school_scd_key
GROUP BY f.batch_id, b.batch_label, f.assessment_year, s.school_id, s.school_name, s.region, s.school_type, s.status""")
def view_score_entity(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.view_assessment_by_school(run.fact_scores, run.batches, run.schools, run.days)


@register("view_score_domain", "b_fact_score b_batch", f"""
SELECT f.batch_id, b.batch_label, f.assessment_year, f.domain,
       CASE f.domain WHEN 'Reading' THEN 1 WHEN 'Writing' THEN 2 WHEN 'Numeracy' THEN 3 ELSE 99 END AS domain_sort_order,
       f.proficiency_band,
       CASE f.proficiency_band WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS proficiency_band_sort_order,
       CASE f.proficiency_band WHEN 'Low' THEN '250 to 399' WHEN 'Medium' THEN '400 to 549' ELSE '550 and above' END
         AS score_range_label, {_VIEW_SCORES}
FROM b_fact_score f JOIN b_batch b ON f.batch_id = b.batch_id
GROUP BY f.batch_id, b.batch_label, f.assessment_year, f.domain, f.proficiency_band""")
def view_score_domain(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.view_assessment_by_domain(run.fact_scores, run.batches, run.domains, run.bands, run.days)


@register("quality_views", "b_fact_quality b_batch", """
SELECT f.batch_id, b.batch_label, f.rule_id, f.rule_name, f.target_table, f.severity, f.severity_sort_order, f.status,
       f.status_sort_order, f.failed_record_count, f.issue_flag, f.run_id
FROM b_fact_quality f JOIN b_batch b ON f.batch_id = b.batch_id""")
def quality_views(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.view_rule_detail(run.fact_quality, run.batches)


@register("quality_summary_view", "b_fact_quality b_batch", """
SELECT f.batch_id, b.batch_label, f.severity, f.severity_sort_order, f.status, f.status_sort_order,
       count(*) AS rule_count, CAST(sum(f.failed_record_count) AS BIGINT) AS failed_record_count,
       CAST(sum(f.issue_flag) AS BIGINT) AS issue_rule_count
FROM b_fact_quality f JOIN b_batch b ON f.batch_id = b.batch_id
GROUP BY f.batch_id, b.batch_label, f.severity, f.severity_sort_order, f.status, f.status_sort_order""")
def quality_summary_view(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.view_quality_summary(run.fact_quality, run.batches)


@register("defect_log_view", "b_defects b_batch", """
SELECT d.batch_id, b.batch_label, d.rule_id, d.defect_title AS rule_name, d.target_table, d.severity,
       CASE d.severity WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS severity_sort_order, d.defect_id,
       d.defect_title, d.defect_status, 1 AS defect_status_sort_order, 1 AS open_defect_flag, d.failed_record_count,
       d.recommended_action
FROM b_defects d JOIN b_batch b ON d.batch_id = b.batch_id""")
def defect_log_view(spark, folder):
    run = AssuredStar(spark, folder)
    return assured.view_defect_log(run.fact_defects, run.batches)


@register("mart_quality_summary", "b_results", """
SELECT run_id, batch_id, severity, status, count(DISTINCT rule_id) AS rule_count,
       CAST(sum(failed_record_count) AS BIGINT) AS failed_record_count
FROM b_results GROUP BY run_id, batch_id, severity, status""")
def mart_quality_summary(spark, folder):
    return assured.mart_quality_summary(Assured(spark, folder).results)


# ---------------------------------------------------------------- monthly views

_M = "m.reporting_month, m.calendar_year, m.calendar_month_number, m.calendar_month_name, m.school_term, m.season"
_DEC = "CAST(sum(f.attended_days)::DOUBLE / NULLIF(sum(f.possible_days), 0) AS DECIMAL(6,4)) AS attendance_rate"


@register("monthly_summary_view", "c_fact_attendance c_month c_school", f"""
SELECT {_M}, m.is_winter_month, s.region, s.school_type, s.status AS school_status, count(*) AS attendance_record_count,
       count(DISTINCT f.school_key) AS school_count, count(DISTINCT f.student_key) AS student_count,
       CAST(sum(f.possible_days) AS BIGINT) AS possible_days, CAST(sum(f.attended_days) AS BIGINT) AS attended_days,
       CAST(sum(f.absent_days) AS BIGINT) AS absent_days, {_DEC}
FROM c_fact_attendance f JOIN c_month m ON f.month_key = m.month_key JOIN c_school s ON f.school_key = s.school_key
GROUP BY {_M}, m.is_winter_month, s.region, s.school_type, s.status""")
def monthly_summary_view(spark, folder):
    run = Monthly(spark, folder)
    return monthly.view_monthly_attendance(run.fact_attendance, monthly.dim_month(run.slices),
                                           monthly.dim_school(run.schools))


@register("monthly_level_view", "c_fact_attendance c_month c_school c_level", f"""
SELECT {_M}, s.region, s.school_type, y.year_level, y.year_level_label, y.cohort_group,
       y.sort_order AS year_level_sort_order, count(*) AS attendance_record_count,
       count(DISTINCT f.student_key) AS student_count, CAST(sum(f.possible_days) AS BIGINT) AS possible_days,
       CAST(sum(f.attended_days) AS BIGINT) AS attended_days, {_DEC}
FROM c_fact_attendance f JOIN c_month m ON f.month_key = m.month_key JOIN c_school s ON f.school_key = s.school_key
LEFT JOIN c_level y ON y.year_level_key = f.year_level_key
GROUP BY {_M}, s.region, s.school_type, y.year_level, y.year_level_label, y.cohort_group, y.sort_order""")
def monthly_level_view(spark, folder):
    run = Monthly(spark, folder)
    return monthly.view_year_level_patterns(
        run.fact_attendance, monthly.dim_month(run.slices), monthly.dim_school(run.schools),
        monthly.dim_year_level(run.students))


@register("relationship", "c_fact_score c_domain c_band c_school c_level", """
SELECT f.assessment_result_key, f.assessment_year, s.region, s.school_type, y.year_level, y.year_level_label,
       y.cohort_group, f.domain, d.domain_sort_order, f.attendance_band,
       b.band_sort_order AS attendance_band_sort_order, f.score
FROM c_fact_score f JOIN c_domain d ON d.domain = f.domain JOIN c_school s ON s.school_key = f.school_key
LEFT JOIN c_level y ON y.year_level_key = f.year_level_key LEFT JOIN c_band b ON b.attendance_band = f.attendance_band""")
def relationship(spark, folder):
    run = Monthly(spark, folder)
    return monthly.view_relationship(run.fact_scores, monthly.dim_school(run.schools),
                                     monthly.dim_year_level(run.students), run.domains, run.bands)


_SUMMARY = """attendance_record_count, CAST(sum(possible_days) AS BIGINT) AS possible_days,
       CAST(sum(attended_days) AS BIGINT) AS attended_days, CAST(sum(absent_days) AS BIGINT) AS absent_days,
       CAST(sum(attended_days)::DOUBLE / NULLIF(sum(possible_days), 0) AS DECIMAL(6,4)) AS attendance_rate"""


@register("summary_monthly_attendance", "c_fact_attendance", f"""
SELECT month_key, school_key, year_level_key, count(DISTINCT student_key) AS student_count, count(*) AS {_SUMMARY}
FROM c_fact_attendance GROUP BY 1, 2, 3""")
def summary_monthly_attendance(spark, folder):
    return monthly.summary_monthly_attendance(monthly.student_months(Monthly(spark, folder).fact_attendance))


@register("summary_year_level_pattern", "c_fact_attendance", f"""
SELECT month_key, year_level_key, count(DISTINCT student_key) AS student_count, count(DISTINCT school_key) AS school_count,
       count(*) AS {_SUMMARY} FROM c_fact_attendance GROUP BY 1, 2""")
def summary_year_level_pattern(spark, folder):
    base = b.materialise(monthly.student_months(Monthly(spark, folder).fact_attendance))
    return monthly.summary_year_level_pattern(base, monthly.summary_monthly_attendance(base))


@register("summary_attendance_assessment", "c_fact_score c_domain", """
SELECT f.attendance_band, f.year_level_key, f.domain, count(*) AS result_count,
       count(DISTINCT f.student_key) AS student_count, round(CAST(sum(f.score) AS DOUBLE) / count(*), 4) AS average_score,
       min(f.score) AS lowest_score, max(f.score) AS highest_score
FROM c_fact_score f JOIN c_domain d ON d.domain = f.domain GROUP BY 1, 2, 3""")
def summary_attendance_assessment(spark, folder):
    run = Monthly(spark, folder)
    return monthly.summary_attendance_assessment(b.materialise(run.fact_scores), run.domains, run.bands)


@register("readiness_view", "c_readiness", """
SELECT reporting_month, source_batch_id, readiness_status, blocker_count, warning_count, rejected_record_count,
       readiness_summary FROM c_readiness""")
def readiness_view(spark, folder):
    return monthly.view_readiness(monthly_run(spark, folder).readiness)
