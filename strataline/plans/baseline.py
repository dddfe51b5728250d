"""Baseline pipeline: staged files -> quality summary, vault, star, report views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import checks, dates
from ..functions.bands import CHRONIC_ABSENCE_BELOW
from ..functions.labels import (BANDS, DOMAINS, EVENT_TYPES, GENDERS, SCHOOL_STATUSES, SCHOOL_TYPES,
                                STUDENT_STATUSES)
from ..functions.ratios import complement_decimal, ratio_decimal, ratio_exact
from ..functions.text import is_blank, to_day_any, to_int
from ..operators.dimensions import group_dimension, numbered_dimension, sparse_dates
from ..operators.matching import mark_present
from ..operators.quality import Rule, describe, failure_counts, rules_of, union_all
from ..operators.rows import mark_duplicates
from ..operators.vault import hub, link, satellite
from ..sources.model import (ATTENDANCE_KEY, DATE_COLUMNS, INT_COLUMNS, RECORD_KEY, SCORE_RANGE,
                    SOURCE_COLUMNS)

FIRST_ASSESSMENT_YEAR = 2000


def stage(raw: DataFrame, dataset: str, file_name: str) -> DataFrame:
    """Typed columns with bad text as null, and the file the rows came from."""
    def typed(name: str) -> Column:
        if name in INT_COLUMNS:
            return to_int(name).alias(name)
        if name in DATE_COLUMNS:
            return to_day_any(name).alias(name)
        return F.col(name).cast("string").alias(name)

    return raw.select(*[typed(c) for c in SOURCE_COLUMNS[dataset]],
                      F.lit(file_name).alias("source_file_name"))


# ---------------------------------------------------------------- quality

def quality_rules(as_of: Column) -> list[Rule]:
    """The eleven checks. Rules over several tables share one id."""
    def rule(rule_id, name, table, severity, fails):
        return Rule(rule_id, name, table, severity, fails)

    at_closed = lambda: F.col("_closed_school")
    return [
        rule("DQ001", "Missing student_id in students", "stg_students", "High",
             lambda: is_blank("student_id")),
        rule("DQ002", "Missing school_id in students", "stg_students", "High",
             lambda: is_blank("school_id")),
        rule("DQ003", "Invalid attendance days", "stg_attendance", "High",
             lambda: checks.bad_day_counts("possible_days", "attended_days")),
        rule("DQ004", "Duplicate attendance business records", "stg_attendance", "Medium",
             lambda: F.col("_duplicate")),
        rule("DQ005", "Attendance references missing student", "stg_attendance", "High",
             lambda: ~is_blank("student_id") & ~F.col("_student_known")),
        rule("DQ006", "Assessment references missing student", "stg_assessment_results", "High",
             lambda: ~is_blank("student_id") & ~F.col("_student_known")),
        rule("DQ007", "Invalid assessment score", "stg_assessment_results", "High",
             lambda: checks.missing_or_outside("score", *SCORE_RANGE)),
        rule("DQ008", "Invalid proficiency band", "stg_assessment_results", "Medium",
             lambda: checks.outside_vocabulary("proficiency_band", BANDS)),
        rule("DQ009", "Invalid school status", "stg_schools", "Medium",
             lambda: checks.outside_vocabulary("status", SCHOOL_STATUSES)),
        rule("DQ010", "Future attendance month", "stg_attendance", "Medium",
             lambda: checks.after_day("attendance_month", as_of)),
        rule("DQ011", "Activity linked to inactive school", "multiple staging views", "Low", at_closed),
    ]


def quality_summary(staged: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """One row per check with count, severity and Passed / Failed."""
    rules = quality_rules(as_of)
    closed = staged["schools"].filter(F.col("status") == "Closed")

    def at_closed(df: DataFrame) -> DataFrame:
        return mark_present(df, closed, ["school_id"], "_closed_school")

    attendance = at_closed(mark_present(
        mark_duplicates(staged["attendance"], ATTENDANCE_KEY, "_duplicate"),
        staged["students"], ["student_id"], "_student_known"))
    assessment = at_closed(mark_present(staged["assessment_results"], staged["students"],
                                        ["student_id"], "_student_known"))
    marked = {
        "stg_students": staged["students"], "stg_attendance": attendance,
        "stg_assessment_results": assessment, "stg_schools": staged["schools"],
        "stg_school_events": at_closed(staged["school_events"]),
    }
    anywhere = [rules[-1]]
    shared = {"stg_attendance", "stg_assessment_results", "stg_school_events"}
    counts = union_all([
        failure_counts(df, rules_of(rules, table) + (anywhere if table in shared else []), [])
        for table, df in marked.items()
    ]).groupBy("rule_id").agg(F.sum("failed_record_count").alias("failed_record_count"))
    verdict = F.when(F.col("failed_record_count") == 0, "Passed").otherwise("Failed")
    return describe(counts, rules, verdict).select(
        F.col("rule_id").alias("validation_id"), F.col("rule_name").alias("check_name"),
        F.col("target_table").alias("table_name"), "failed_record_count", "severity",
        F.col("status").alias("validation_status"))


# ---------------------------------------------------------------- vault

def build_vault(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    source = F.col("source_file_name")
    students, schools = staged["students"], staged["schools"]
    attendance, scores, events = (staged["attendance"], staged["assessment_results"],
                                  staged["school_events"])
    hubs = {
        "hub_school": hub(schools, "school_id", source),
        "hub_student": hub(students, "student_id", source),
        "hub_assessment": hub(scores, "assessment_id", source),
        "hub_event": hub(events, "event_id", source),
    }
    links = {
        "link_student_school": link(students, ["student_id", "school_id"],
                                    [hubs["hub_student"], hubs["hub_school"]], source),
        "link_student_assessment": link(scores, ["student_id", "assessment_id"],
                                        [hubs["hub_student"], hubs["hub_assessment"]], source),
        "link_school_event": link(events, ["school_id", "event_id"],
                                  [hubs["hub_school"], hubs["hub_event"]], source),
    }

    def records(df: DataFrame, dataset: str, **options) -> DataFrame:
        key = RECORD_KEY[dataset]
        rest = [c for c in SOURCE_COLUMNS[dataset] if c != key]
        return satellite(df, key, rest, source, **options)

    satellites = {
        "sat_school_details": records(schools, "schools", hub_rows=hubs["hub_school"], distinct=True),
        "sat_student_details": records(students, "students", hub_rows=hubs["hub_student"], distinct=True),
        "sat_attendance_record": records(attendance, "attendance"),
        "sat_assessment_result": records(scores, "assessment_results"),
        "sat_event_details": records(events, "school_events"),
    }
    return {**hubs, **links, **satellites}


# ---------------------------------------------------------------- star

def dim_school(vault: dict[str, DataFrame]) -> DataFrame:
    valid = (~is_blank("school_id") & ~is_blank("school_name")
             & F.col("school_type").isin(*SCHOOL_TYPES) & F.col("status").isin(*SCHOOL_STATUSES))
    return vault["sat_school_details"].filter(valid).select(
        F.col("school_id").alias("school_key"), "school_name", "region", "school_type",
        "open_date", "status")


GROUP_ATTRIBUTES = ("school_key", "year_level", "gender", "student_status")


def _grouped_students(vault: dict[str, DataFrame]) -> DataFrame:
    return vault["sat_student_details"].select(
        "student_id", F.col("school_id").alias("school_key"), "year_level", "gender",
        F.col("status").alias("student_status"))


def dim_student_group(vault: dict[str, DataFrame], schools: DataFrame) -> DataFrame:
    valid = (~is_blank("student_id") & ~is_blank("school_key") & F.col("year_level").between(0, 12)
             & F.col("gender").isin(*GENDERS) & F.col("student_status").isin(*STUDENT_STATUSES))
    members = _grouped_students(vault).filter(valid).join(
        schools.select("school_key"), "school_key", "left_semi")
    return group_dimension(members, GROUP_ATTRIBUTES, "student_group_key", "student_count")


def _valid_assessment_year(as_of: Column) -> Column:
    return F.col("assessment_year").between(F.lit(FIRST_ASSESSMENT_YEAR), F.year(as_of))


def dim_date(vault: dict[str, DataFrame], as_of: Column) -> DataFrame:
    scores = vault["sat_assessment_result"].filter(_valid_assessment_year(as_of))
    return sparse_dates([
        (vault["sat_attendance_record"], F.col("attendance_month")),
        (vault["sat_event_details"], F.col("event_date")),
        (scores, dates.year_start("assessment_year")),
    ], as_of)


def dim_assessment_domain(vault: dict[str, DataFrame]) -> DataFrame:
    return numbered_dimension(vault["sat_assessment_result"], "domain", DOMAINS,
                              "assessment_domain_key", "assessment_domain")


def dim_event_type(vault: dict[str, DataFrame]) -> DataFrame:
    return numbered_dimension(vault["sat_event_details"], "event_type", EVENT_TYPES, "event_type_key")


def student_group_map(vault: dict[str, DataFrame], groups: DataFrame) -> DataFrame:
    """(student_id, student_group_key): the two-step way from a record to its
    group, joined once on the student side instead of twice on the facts.
    Students with two detail rows would fan out; see ``require_unique``."""
    return _grouped_students(vault).join(groups, list(GROUP_ATTRIBUTES)).select(
        "student_id", "student_group_key")


def fact_attendance(vault: dict[str, DataFrame], schools: DataFrame, days: DataFrame,
                    student_groups: DataFrame) -> DataFrame:
    possible, attended = F.col("possible_days"), F.col("attended_days")
    records = vault["sat_attendance_record"].filter(
        ~is_blank("attendance_id") & ~is_blank("student_id") & ~is_blank("school_id")
        & F.col("attendance_month").isNotNull())
    return (
        records.join(schools.select("school_key"), F.col("school_id") == F.col("school_key"))
        .join(days.select("date_key", "calendar_date"),
              F.col("attendance_month") == F.col("calendar_date"))
        .join(student_groups, "student_id")
        .select(
            "attendance_id", "student_id", "school_key", "date_key", "student_group_key",
            "possible_days", "attended_days", (possible - attended).alias("absence_days"),
            ratio_decimal(attended, possible).alias("attendance_rate"),
            complement_decimal(attended, possible).alias("absence_rate"),
            checks.flag(ratio_exact(attended, possible) < CHRONIC_ABSENCE_BELOW)
            .alias("chronic_absence_flag"),
            checks.flag(~checks.bad_day_counts(possible, attended)).alias("is_valid_attendance"))
    )


def fact_assessment(vault: dict[str, DataFrame], schools: DataFrame, days: DataFrame,
                    domains: DataFrame, student_groups: DataFrame, as_of: Column) -> DataFrame:
    records = vault["sat_assessment_result"].filter(
        ~is_blank("assessment_id") & ~is_blank("student_id") & ~is_blank("school_id")
        & _valid_assessment_year(as_of) & ~is_blank("domain"))
    return (
        records.join(schools.select("school_key"), F.col("school_id") == F.col("school_key"))
        .join(days.select("date_key", "calendar_date"),
              dates.year_start("assessment_year") == F.col("calendar_date"))
        .join(domains, F.col("domain") == F.col("assessment_domain"))
        .join(student_groups, "student_id")
        .select("assessment_id", "student_id", "school_key", "date_key", "assessment_domain_key",
                "student_group_key", "score", "proficiency_band",
                checks.flag(~checks.missing_or_outside("score", *SCORE_RANGE)).alias("is_valid_score"),
                checks.flag(F.col("proficiency_band") == "Low").alias("low_proficiency_flag"))
    )


def fact_school_events(vault: dict[str, DataFrame], schools: DataFrame, days: DataFrame,
                       event_types: DataFrame, as_of: Column) -> DataFrame:
    records = vault["sat_event_details"].filter(
        ~is_blank("event_id") & ~is_blank("school_id") & ~is_blank("event_type")
        & (F.col("event_date") <= as_of))
    return (
        records.join(schools.select("school_key"), F.col("school_id") == F.col("school_key"))
        .join(days.select("date_key", "calendar_date"), F.col("event_date") == F.col("calendar_date"))
        .join(event_types, "event_type")
        .select("event_id", "school_key", "date_key", "event_type_key", F.lit(1).alias("event_count"))
    )


def build_star(vault: dict[str, DataFrame], as_of: Column) -> dict[str, DataFrame]:
    schools, days = dim_school(vault), dim_date(vault, as_of)
    groups, domains, types = (dim_student_group(vault, schools), dim_assessment_domain(vault),
                              dim_event_type(vault))
    members = student_group_map(vault, groups)
    return {
        "dim_school": schools, "dim_date": days, "dim_student_group": groups,
        "dim_assessment_domain": domains, "dim_event_type": types,
        "fact_attendance": fact_attendance(vault, schools, days, members),
        "fact_assessment": fact_assessment(vault, schools, days, domains, members, as_of),
        "fact_school_events": fact_school_events(vault, schools, days, types, as_of),
    }


# ---------------------------------------------------------------- report views

SCHOOL = ("school_key", "school_name", "region", "school_type")


def _attendance_totals(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    sums = df.groupBy(*by).agg(
        F.sum("possible_days").alias("total_possible_days"),
        F.sum("attended_days").alias("total_attended_days"),
        F.sum("absence_days").alias("total_absence_days"),
        F.count_if(F.col("chronic_absence_flag") == 1).alias("chronic_absence_records"),
        F.count_if(F.col("is_valid_attendance") == 0).alias("invalid_attendance_records"))
    return sums.withColumns({
        "attendance_rate": ratio_decimal("total_attended_days", "total_possible_days"),
        "absence_rate": complement_decimal("total_attended_days", "total_possible_days"),
    })


def _dated(star: dict[str, DataFrame], fact: str) -> DataFrame:
    return star[fact].join(star["dim_date"], "date_key")


def view_attendance_by_school(star: dict[str, DataFrame]) -> DataFrame:
    rows = _dated(star, "fact_attendance").join(star["dim_school"], "school_key")
    return _attendance_totals(rows, (*SCHOOL, "calendar_year", "calendar_month", "month_name"))


def view_attendance_by_year_level(star: dict[str, DataFrame]) -> DataFrame:
    groups = star["dim_student_group"].drop("school_key", "student_count")
    rows = (_dated(star, "fact_attendance").join(star["dim_school"], "school_key")
            .join(groups, "student_group_key"))
    return _attendance_totals(rows, (*SCHOOL, "year_level", "gender", "student_status",
                                     "calendar_year", "calendar_month", "month_name"))


def _assessment_totals(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    def of_band(band: str) -> Column:
        return F.count_if(F.col("proficiency_band") == band)

    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("assessment_record_count"),
        F.avg(F.when(F.col("is_valid_score") == 1, F.col("score"))).alias("average_score"),
        of_band("Low").alias("low_proficiency_count"),
        of_band("Medium").alias("medium_proficiency_count"),
        of_band("High").alias("high_proficiency_count"),
        F.count_if(F.col("is_valid_score") == 0).alias("invalid_score_records"))
    return totals.withColumn("low_proficiency_rate",
                             ratio_decimal("low_proficiency_count", "assessment_record_count"))


def view_assessment_by_school(star: dict[str, DataFrame]) -> DataFrame:
    rows = (_dated(star, "fact_assessment").withColumnRenamed("calendar_year", "assessment_year")
            .join(star["dim_school"], "school_key")
            .join(star["dim_assessment_domain"], "assessment_domain_key"))
    return _assessment_totals(rows, (*SCHOOL, "assessment_year", "assessment_domain"))


def view_assessment_by_domain(star: dict[str, DataFrame]) -> DataFrame:
    rows = (_dated(star, "fact_assessment").withColumnRenamed("calendar_year", "assessment_year")
            .join(star["dim_assessment_domain"], "assessment_domain_key"))
    return _assessment_totals(rows, ("assessment_year", "assessment_domain"))


def report_views(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "vw_attendance_by_school": view_attendance_by_school(star),
        "vw_attendance_by_year_level": view_attendance_by_year_level(star),
        "vw_assessment_by_school": view_assessment_by_school(star),
        "vw_assessment_by_domain": view_assessment_by_domain(star),
    }
