"""Quality-assured batch pipeline: bronze -> silver -> rules -> gold -> views.

All functions take frames that hold one batch or many; the batch id is a key
like any other, so nothing loops over batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import checks, dates, labels
from ..functions.bands import AVERAGE_SCORE, report_attendance_band, report_attendance_band_order
from ..functions.keys import hash_key, narrow_id, wide_id
from ..functions.ratios import percent, ratio_double
from ..functions.text import clean, is_blank, to_day, to_int
from ..operators.dimensions import date_bounds, dense_dates, hashed_dimension
from ..operators.matching import as_of_join, deal_by, exclude, mark_present
from ..operators.measures import attendance_rate, score_summary, summed_days
from ..operators.quality import (Rule, Screened, catalogue, defects, describe, failed_records, failure_counts,
                                 passing, quarantine_keys, result_status, rules_of, screen, screened_counts,
                                 screened_records, summarise, union_all)
from ..operators.rows import SPREAD, latest_per_key, mark_duplicates, whole_spread
from ..sources.model import (ATTENDANCE_KEY, DATE_COLUMNS, INT_COLUMNS, LINEAGE, RECORD_KEY, SCORE_RANGE,
                    SOURCE_COLUMNS)

# The known batches.
BATCHES = (
    ("2025-01-15", 1, "Batch 1 - 2024 data", 2024, "Initial load"),
    ("2026-01-15", 2, "Batch 2 - 2025 data", 2025, "Incremental load"),
)


# ---------------------------------------------------------------- bronze, silver

def stamp(raw: DataFrame, dataset: str, batch_id: Column, run_id: Column, file_name: Column,
          load_timestamp: Column | None = None) -> DataFrame:
    """Source columns as they came, with lineage and a record id."""
    return (
        raw.select(*SOURCE_COLUMNS[dataset], batch_id.alias("batch_id"), run_id.alias("run_id"),
                   file_name.alias("source_file_name"),
                   (F.current_timestamp() if load_timestamp is None else load_timestamp)
                   .alias("load_timestamp"))
        .withColumn("bronze_record_id", hash_key(RECORD_KEY[dataset], "source_file_name",
                                                 "batch_id", "run_id"))
    )


def conform(bronze: DataFrame, dataset: str) -> DataFrame:
    """Trimmed and typed rows, the latest one per batch and record key.

    Keys are trimmed before they are compared. Rows that tie on lineage are
    ordered by content, so the choice does not depend on the partitioning.
    """
    def typed(name: str) -> Column:
        if name in INT_COLUMNS:
            return to_int(name).alias(name)
        if name in DATE_COLUMNS:
            return to_day(name).alias(name)
        return clean(name).alias(name)

    columns = SOURCE_COLUMNS[dataset]
    rows = _narrow(bronze.select(*[typed(c) for c in columns], *LINEAGE))
    order = ("load_timestamp", "run_id", "bronze_record_id", *columns)
    return _wide(latest_per_key(rows, [RECORD_KEY[dataset], "batch_id"], [F.desc(c) for c in order]))


def _narrow(rows: DataFrame) -> DataFrame:
    """Rows as they travel: the record id in bytes."""
    return rows.withColumn("bronze_record_id", narrow_id("bronze_record_id"))


def _wide(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bronze_record_id", wide_id("bronze_record_id"))


# ---------------------------------------------------------------- rules

def quality_rules(as_of: Column) -> list[Rule]:
    """The eleven rules with the texts the quality tables show (fixed values)."""
    return [
        Rule("DQ001", "Missing student ID", "silver.students", "High",
             lambda: is_blank("student_id"), "student_id", "student_id is null or blank",
             "Investigate source student extract and require student_id for all student records.",
             "student_id must not be null or blank", "No missing student IDs"),
        Rule("DQ002", "Missing school ID", "silver.students", "High",
             lambda: is_blank("school_id"), "student_id", "school_id is null or blank",
             "Investigate student enrolment extract and require a valid school_id for each student.",
             "school_id must not be null or blank", "No missing school IDs"),
        Rule("DQ003", "Invalid attendance days", "silver.attendance", "High",
             lambda: checks.bad_day_counts("possible_days", "attended_days"), "attendance_id",
             "Attendance days are missing, negative, or attended_days is greater than possible_days.",
             "Review attendance source extract and enforce valid possible_days and attended_days values before publishing.",
             "attended_days must be between 0 and possible_days",
             "Attendance days are within valid range"),
        Rule("DQ004", "Duplicate attendance business record", "silver.attendance", "Medium",
             lambda: F.col("_duplicate"), "attendance_id",
             "Duplicate attendance business record for student_id, school_id, and attendance_month.",
             "Review attendance source extract for duplicate monthly attendance submissions and deduplicate before reporting.",
             "student_id, school_id, attendance_month should be unique",
             "No duplicate attendance records"),
        Rule("DQ005", "Attendance references missing student", "silver.attendance", "High",
             lambda: ~F.col("_student_known"), "attendance_id",
             "attendance.student_id does not exist in silver.students for the same batch_id.",
             "Investigate attendance records with missing student references and correct source system referential integrity.",
             "attendance.student_id must exist in silver.students", "No orphan attendance records"),
        Rule("DQ006", "Assessment references missing student", "silver.assessment_results", "High",
             lambda: ~F.col("_student_known"), "assessment_id",
             "assessment_results.student_id does not exist in silver.students for the same batch_id.",
             "Investigate assessment records with missing student references and correct source system referential integrity.",
             "assessment_results.student_id must exist in silver.students",
             "No orphan assessment records"),
        Rule("DQ007", "Invalid assessment score", "silver.assessment_results", "High",
             lambda: checks.missing_or_outside("score", *SCORE_RANGE), "assessment_id",
             "score is null or outside the valid 250 to 700 range.",
             "Review assessment scoring scale and source extract. Confirm whether scores should be normalised before reporting.",
             "score must be between 250 and 700",
             "Assessment scores are within the valid 250 to 700 scale"),
        Rule("DQ008", "Invalid proficiency band", "silver.assessment_results", "Medium",
             lambda: checks.outside_vocabulary("proficiency_band", labels.BANDS), "assessment_id",
             "proficiency_band is null or not one of Low, Medium, High.",
             "Review assessment proficiency band mapping and enforce controlled category values.",
             "proficiency_band must be one of Low, Medium, High", "Proficiency bands are valid"),
        Rule("DQ009", "Invalid school status", "silver.schools", "Medium",
             lambda: checks.outside_vocabulary("status", labels.SCHOOL_STATUSES), "school_id",
             "status is null or not one of Active, Closed.",
             "Review school status reference data and enforce controlled status values.",
             "status must be Active or Closed", "School status values are valid"),
        Rule("DQ010", "Future attendance month", "silver.attendance", "Medium",
             lambda: checks.after_day("attendance_month", as_of, null_fails=True), "attendance_id",
             "attendance_month is null or later than the current date.",
             "Review attendance period values and prevent future-dated attendance records from entering reporting.",
             "attendance_month must not be in the future", "No future attendance month"),
        Rule("DQ011", "School event linked to inactive or missing school", "silver.school_events",
             "Low", lambda: ~F.col("_school_active"), "event_id",
             "school event is linked to an inactive or missing school.",
             "Review school event source data and confirm whether events should be linked only to active schools.",
             "school_events.school_id should link to an active school", "Events link to active schools"),
    ]


ATTENDANCE_QUARANTINE = ("DQ003", "DQ004", "DQ005")
ASSESSMENT_QUARANTINE = ("DQ006", "DQ007", "DQ008")


class Marked(Mapping):
    """Silver tables with the booleans of the set rules, each marked when first asked for."""

    def __init__(self, silver: Mapping[str, DataFrame]):
        student = ["batch_id", "student_id"]
        self._made: dict[str, DataFrame] = {}
        self._make = {
            "silver.schools": lambda: silver["schools"],
            "silver.students": lambda: silver["students"],
            # Duplicates first: the sort of their keys serves the look-up of students, and what joins them later.
            "silver.attendance": lambda: _wide(mark_present(
                mark_duplicates(deal_by(_narrow(silver["attendance"]), student), ["batch_id", *ATTENDANCE_KEY], "_duplicate"),
                silver["students"], student, "_student_known", [SPREAD])),
            "silver.assessment_results": lambda: _wide(mark_present(
                _narrow(silver["assessment_results"]), silver["students"], student, "_student_known")),
            "silver.school_events": lambda: mark_present(
                silver["school_events"], silver["schools"].filter(F.col("status") == "Active"),
                ["batch_id", "school_id"], "_school_active"),
        }

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._made:
            self._made[table] = self._make[table]()
        return self._made[table]

    def __iter__(self):
        return iter(self._make)

    def __len__(self):
        return len(self._make)


def mark(silver: Mapping[str, DataFrame]) -> Marked:
    return Marked(silver)


def validation_results(marked: Mapping[str, DataFrame], rules: Sequence[Rule], run_id: Column) -> DataFrame:
    counts = union_all([failure_counts(df, rules_of(rules, table), ["batch_id"])
                        for table, df in marked.items()])
    status = result_status(F.col("failed_record_count"), F.col("severity"))
    return describe(counts, rules, status).withColumn("run_id", run_id)


def failed_record_rows(marked: Mapping[str, DataFrame], rules: Sequence[Rule], run_id: Column) -> DataFrame:
    def payload(table: str) -> list[str]:
        return [*SOURCE_COLUMNS[table.split(".")[1]], *LINEAGE]

    return union_all([
        failed_records(df, rules_of(rules, table), ["batch_id"], ["bronze_record_id"], payload(table))
        for table, df in marked.items()
    ]).withColumn("run_id", run_id)


def screened_tables(silver: Mapping[str, DataFrame], marked: Mapping[str, DataFrame], rules: Sequence[Rule],
                    store: Callable[[DataFrame], DataFrame]) -> list[Screened]:
    """Every table after its rules, each evaluated once; the failing rows are stored."""
    out = []
    for table, df in marked.items():
        name = table.split(".")[1]
        out.append(screen(table, df, rules, ["batch_id"], ["bronze_record_id", *SOURCE_COLUMNS[name], *LINEAGE], store,
                          silver[name]))
    return out


def screened_results(screened: Sequence[Screened], rules: Sequence[Rule], run_id: Column) -> DataFrame:
    """``validation_results`` from the stored failing rows."""
    counts = union_all([screened_counts(s, ["batch_id"]) for s in screened])
    status = result_status(F.col("failed_record_count"), F.col("severity"))
    return describe(counts, rules, status).withColumn("run_id", run_id)


def screened_failures(screened: Sequence[Screened], run_id: Column) -> DataFrame:
    """``failed_record_rows`` from the stored failing rows."""
    return union_all([
        screened_records(s, ["batch_id"], ["bronze_record_id"], [*SOURCE_COLUMNS[s.table.split(".")[1]], *LINEAGE])
        for s in screened]).withColumn("run_id", run_id)


def defect_rows(results: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return defects(results, rules, F.col("run_id"), "batch_id")


def latest_run(results: DataFrame) -> DataFrame:
    """(batch_id, run_id) of the latest run of each batch; of two at one time, the
    run with the larger id."""
    last = F.max_by("run_id", F.struct("run_timestamp", "run_id"))
    return results.groupBy("batch_id").agg(last.alias("run_id"))


def of_latest_run(rows: DataFrame, results: DataFrame) -> DataFrame:
    """Quality rows of the run that counts: always the latest one of the batch."""
    return rows.join(latest_run(results), ["batch_id", "run_id"], "left_semi")


def trusted_in_one_pass(marked: DataFrame, rules: Sequence[Rule], table: str,
                        rule_ids: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """The same rows as ``trusted`` from the marks alone. Silver holds one row per
    record id, so dropping a failing row drops exactly its record id. ``carry`` names
    columns of the marks to keep: with ``SPREAD`` the fact shares their partitioning."""
    quarantining = [r for r in rules_of(rules, table) if r.rule_id in rule_ids]
    return passing(marked, quarantining).select(*SOURCE_COLUMNS[table.split(".")[1]], *LINEAGE, *carry)


def trusted(silver_rows: DataFrame, failed: DataFrame, table: str, rule_ids: Sequence[str]) -> DataFrame:
    """Silver rows whose record id no quarantining rule names."""
    return _wide(exclude(_narrow(silver_rows), _narrow(quarantine_keys(failed, table, rule_ids, "bronze_record_id")),
                         ["bronze_record_id"]))


# ---------------------------------------------------------------- dimensions

def dim_batch(spark: SparkSession, environment: str = "dev") -> DataFrame:
    rows = spark.createDataFrame(
        list(BATCHES), "batch_id string, batch_sequence int, batch_label string, "
                       "data_period_year int, batch_load_type string")
    return rows.select(hash_key("batch_id").alias("batch_key"), "*",
                       F.lit(environment).alias("environment"))


def dim_date(silver: dict[str, DataFrame]) -> DataFrame:
    return dense_dates(date_bounds([
        (silver["attendance"], F.col("attendance_month")),
        (silver["assessment_results"], dates.year_start("assessment_year")),
        (silver["school_events"], F.col("event_date")),
    ]))


SCHOOL_ATTRIBUTES = ("school_name", "region", "school_type", "status", "open_date")


def dim_year_level(students: DataFrame) -> DataFrame:
    return hashed_dimension(students, "year_level", "year_level_key", {
        "year_level_label": labels.year_level_label("year_level"),
        "year_level_sort_order": F.col("year_level")})


def dim_assessment_domain(scores: DataFrame) -> DataFrame:
    return hashed_dimension(scores, "domain", "domain_key", {
        "domain_sort_order": labels.sort_order("domain", labels.DOMAIN_ORDER)})


def dim_proficiency_band(scores: DataFrame) -> DataFrame:
    return hashed_dimension(scores, "proficiency_band", "proficiency_band_key", {
        "proficiency_band_sort_order": labels.sort_order("proficiency_band", labels.BANDS),
        "score_range_label": labels.score_range_label("proficiency_band")})


def dim_dq_rule(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return catalogue(spark, rules).select(
        hash_key("rule_id").alias("dq_rule_key"), "*",
        labels.sort_order("severity", labels.SEVERITY_ORDER).alias("severity_sort_order"))


def dim_student(students: DataFrame, school_versions: DataFrame) -> DataFrame:
    """Students per batch with the school version valid on the batch date.
    ``school_versions``: school_key, school_scd_key and validity."""
    keyed = students.withColumns({
        "batch_date": F.col("batch_id").try_cast("date"),
        "student_key": hash_key("student_id"),
        "student_batch_key": hash_key("batch_id", "student_id"),
        "school_key": hash_key("school_id"),
        "year_level_key": hash_key("year_level"),
        "is_active_student": F.coalesce(F.col("status") == "Active", F.lit(False)),
    })
    return as_of_join(keyed, school_versions, ["school_key"], "batch_date",
                      take=["school_scd_key"]).drop("batch_date")


# ---------------------------------------------------------------- facts

def fact_attendance(rows: DataFrame, students: DataFrame, school_versions: DataFrame) -> DataFrame:
    """Trusted attendance with its keys. ``rows`` are already quarantined."""
    student = students.select("batch_id", "student_id", "student_key", "student_batch_key",
                              "year_level_key")
    on = ["batch_id", "student_id"]
    if SPREAD in rows.columns:  # 0 for every row whose key is whole, others match nobody
        student, on = student.withColumn(SPREAD, whole_spread(on)), [SPREAD, *on]
    keyed = rows.join(student, on, "left").withColumns({
        "batch_date": F.col("batch_id").try_cast("date"),
        "school_key": hash_key("school_id"),
    })
    versioned = as_of_join(keyed, school_versions, ["school_key"], "batch_date",
                           take=["school_scd_key"])
    return versioned.select(
        hash_key("batch_id", "attendance_id").alias("attendance_fact_key"),
        hash_key("batch_id").alias("batch_key"), "school_key", "school_scd_key", "student_key",
        "student_batch_key", "year_level_key",
        dates.date_key("attendance_month").alias("attendance_month_date_key"),
        "batch_id", "attendance_id", "student_id", "school_id", "attendance_month",
        "possible_days", "attended_days",
        ratio_double("attended_days", "possible_days").alias("attendance_rate"),
        "absence_reason", "bronze_record_id", F.col("run_id").alias("source_run_id"))


def fact_assessment_result(rows: DataFrame, students: DataFrame, domains: DataFrame,
                           bands: DataFrame) -> DataFrame:
    student = students.select("batch_id", "student_id", "student_key", "student_batch_key",
                              "school_key", "school_scd_key")
    return (
        rows.join(student, ["batch_id", "student_id"], "left")
        .join(domains.select("domain", "domain_key"), "domain", "left")
        .join(bands.select("proficiency_band", "proficiency_band_key"), "proficiency_band", "left")
        .select(
            hash_key("batch_id", "assessment_id").alias("assessment_fact_key"),
            hash_key("batch_id").alias("batch_key"), "school_key", "school_scd_key", "student_key",
            "student_batch_key", "domain_key", "proficiency_band_key",
            dates.year_key("assessment_year").alias("assessment_year_date_key"),
            "batch_id", "assessment_id", "student_id", "school_id", "assessment_year", "domain",
            "score", "proficiency_band", "bronze_record_id", F.col("run_id").alias("source_run_id"))
    )


def fact_data_quality_result(results: DataFrame, rules: DataFrame) -> DataFrame:
    """``results`` of the run that counts; ``rules`` is dim_dq_rule."""
    rule = rules.select("rule_id", "dq_rule_key", "severity_sort_order")
    return results.join(rule, "rule_id", "left").select(
        hash_key("run_id", "batch_id", "rule_id").alias("dq_result_fact_key"),
        hash_key("batch_id").alias("batch_key"), "dq_rule_key", "run_id", "batch_id", "rule_id",
        "rule_name", "target_table", "severity", "severity_sort_order", "status",
        labels.sort_order("status", labels.RESULT_STATUS_ORDER, 9).alias("status_sort_order"),
        "failed_record_count",
        checks.flag(F.col("status").isin("FAIL", "WARN")).alias("issue_flag"))


def fact_defect(defect_log: DataFrame, rules: DataFrame) -> DataFrame:
    rule = rules.select("rule_id", "dq_rule_key", "rule_name", "severity_sort_order")
    return defect_log.join(rule, "rule_id", "left").select(
        hash_key("defect_id", "run_id").alias("defect_fact_key"),
        hash_key("batch_id").alias("batch_key"), "dq_rule_key", "defect_id", "run_id", "batch_id",
        "rule_id", "rule_name", "target_table", "severity", "severity_sort_order", "defect_title",
        "defect_status",
        labels.sort_order("defect_status", labels.DEFECT_STATUS_ORDER, 9)
        .alias("defect_status_sort_order"),
        checks.flag(F.col("defect_status") == "Open").alias("open_defect_flag"),
        "failed_record_count", "recommended_action")


# ---------------------------------------------------------------- marts

def _school_columns(schools: DataFrame) -> DataFrame:
    return schools.select("batch_id", "school_id", "school_name", "region", "school_type")


def mart_attendance_school_month(rows: DataFrame, schools: DataFrame) -> DataFrame:
    """Summed first, then joined to the schools: the join sees one row per
    school and month. A school has one row per batch, so the groups are the same."""
    sums = attendance_rate(rows, ["batch_id", "school_id", "attendance_month"],
                           F.countDistinct("student_id").alias("student_count"))
    return sums.join(_school_columns(schools), ["batch_id", "school_id"], "left")


def mart_attendance_year_level(rows: DataFrame, students: DataFrame) -> DataFrame:
    level = students.select("batch_id", "student_id", "year_level")
    return attendance_rate(rows.join(level, ["batch_id", "student_id"], "left"),
                           ["batch_id", "year_level", "attendance_month"],
                           F.countDistinct("student_id").alias("student_count"))


# Silver has one row per batch and assessment, so only students are counted distinct.
_ASSESSMENT_COUNTS = lambda: (F.count("assessment_id").alias("assessment_count"),
                              F.countDistinct("student_id").alias("student_count"))


def mart_assessment_school(rows: DataFrame, schools: DataFrame) -> DataFrame:
    sums = score_summary(rows, ["batch_id", "assessment_year", "school_id"], *_ASSESSMENT_COUNTS())
    return sums.join(_school_columns(schools), ["batch_id", "school_id"], "left")


def mart_assessment_domain(rows: DataFrame) -> DataFrame:
    return score_summary(rows, ["batch_id", "assessment_year", "domain", "proficiency_band"],
                         *_ASSESSMENT_COUNTS())


def mart_quality_summary(results: DataFrame) -> DataFrame:
    return summarise(results, ["run_id", "batch_id", "severity", "status"])


# ---------------------------------------------------------------- report views

def _banded(sums: DataFrame) -> DataFrame:
    return sums.withColumns({
        "attendance_rate": ratio_double("attended_days", "possible_days"),
        "attendance_rate_percent": percent("attended_days", "possible_days"),
        "attendance_band": report_attendance_band("attended_days", "possible_days"),
        "attendance_band_sort_order": report_attendance_band_order("attended_days", "possible_days"),
    })


def _batch_labels(batches: DataFrame) -> DataFrame:
    return batches.select("batch_key", "batch_label")


def _month_names(days: DataFrame) -> DataFrame:
    return days.select(F.col("date_key").alias("attendance_month_date_key"),
                       F.col("full_date").alias("attendance_month"),
                       F.col("calendar_year").alias("attendance_year"),
                       F.col("month_number").alias("attendance_month_number"),
                       F.col("month_name").alias("attendance_month_name"))


def view_attendance_by_school_month(fact: DataFrame, batches: DataFrame, schools: DataFrame,
                                    days: DataFrame) -> DataFrame:
    """Facts are summed by their keys first; the dimensions, unique on those keys,
    then decorate the groups instead of every fact row."""
    sums = summed_days(fact, ["batch_id", "batch_key", "school_scd_key", "attendance_month_date_key"],
                       F.countDistinct("student_batch_key").alias("student_count"))
    school = schools.select("school_scd_key", "school_id", "school_name", "region", "school_type",
                            F.col("status").alias("school_status"))
    return _banded(
        sums.join(_batch_labels(batches), "batch_key", "left").join(school, "school_scd_key", "left")
        .join(_month_names(days), "attendance_month_date_key", "left")
    ).drop("batch_key", "school_scd_key", "attendance_month_date_key")


def view_attendance_by_year_level(fact: DataFrame, batches: DataFrame, levels: DataFrame,
                                  days: DataFrame) -> DataFrame:
    sums = summed_days(fact, ["batch_id", "batch_key", "year_level_key", "attendance_month_date_key"],
                       F.countDistinct("student_batch_key").alias("student_count"))
    return _banded(
        sums.join(_batch_labels(batches), "batch_key", "left").join(levels, "year_level_key", "left")
        .join(_month_names(days), "attendance_month_date_key", "left")
    ).drop("batch_key", "year_level_key", "attendance_month_date_key")


def _scored(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    return score_summary(
        fact, by, F.count(F.lit(1)).alias("assessment_count"),
        F.countDistinct("student_batch_key").alias("student_count"),
        F.avg("score").alias("_average"),
    ).withColumn("median_score", F.col("median_score").cast("int"))


def _assessment_years(days: DataFrame) -> DataFrame:
    return days.select(F.col("date_key").alias("assessment_year_date_key"),
                       F.col("calendar_year").alias("assessment_year"))


def view_assessment_by_school(fact: DataFrame, batches: DataFrame, schools: DataFrame,
                              days: DataFrame) -> DataFrame:
    sums = _scored(fact, ["batch_id", "batch_key", "school_scd_key", "assessment_year_date_key"])
    school = schools.select("school_scd_key", "school_id", "school_name", "region", "school_type",
                            F.col("status").alias("school_status"))
    return (
        sums.withColumns({"average_score_band": AVERAGE_SCORE.label("_average"),
                          "average_score_band_sort_order": AVERAGE_SCORE.position("_average")})
        .join(_batch_labels(batches), "batch_key", "left").join(school, "school_scd_key", "left")
        .join(_assessment_years(days), "assessment_year_date_key", "left")
        .drop("_average", "batch_key", "school_scd_key", "assessment_year_date_key")
    )


def view_assessment_by_domain(fact: DataFrame, batches: DataFrame, domains: DataFrame,
                              bands: DataFrame, days: DataFrame) -> DataFrame:
    sums = _scored(fact, ["batch_id", "batch_key", "domain_key", "proficiency_band_key",
                          "assessment_year_date_key"])
    return (
        sums.join(_batch_labels(batches), "batch_key", "left").join(domains, "domain_key", "left")
        .join(bands, "proficiency_band_key", "left")
        .join(_assessment_years(days), "assessment_year_date_key", "left")
        .drop("_average", "batch_key", "domain_key", "proficiency_band_key", "assessment_year_date_key")
    )


def view_rule_detail(fact: DataFrame, batches: DataFrame) -> DataFrame:
    return fact.join(_batch_labels(batches), "batch_key", "left").select(
        "batch_id", "batch_label", "rule_id", "rule_name", "target_table", "severity",
        "severity_sort_order", "status", "status_sort_order", "failed_record_count", "issue_flag",
        "run_id")


def view_quality_summary(fact: DataFrame, batches: DataFrame) -> DataFrame:
    by = ["batch_id", "batch_label", "severity", "severity_sort_order", "status", "status_sort_order"]
    return fact.join(_batch_labels(batches), "batch_key", "left").groupBy(*by).agg(
        F.count(F.lit(1)).alias("rule_count"),
        F.sum("failed_record_count").alias("failed_record_count"),
        F.sum("issue_flag").alias("issue_rule_count"))


def view_defect_log(fact: DataFrame, batches: DataFrame) -> DataFrame:
    return fact.join(_batch_labels(batches), "batch_key", "left").select(
        "batch_id", "batch_label", "rule_id", "rule_name", "target_table", "severity",
        "severity_sort_order", "defect_id", "defect_title", "defect_status",
        "defect_status_sort_order", "open_defect_flag", "failed_record_count", "recommended_action")
