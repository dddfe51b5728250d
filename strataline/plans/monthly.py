"""Monthly pipeline: delta slices -> fifteen rules -> gated merges -> star -> views.

A slice is one (source_batch_id, reporting_month). The rules, the readiness and
the gold facts work on any number of slices at once; the merges take the rows of
one slice, because each month builds on the state the month before it left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import checks, dates, labels
from ..functions.bands import monthly_attendance_band
from ..functions.keys import hash_key
from ..functions.ratios import ratio_decimal
from ..functions.text import blank_to_null, is_blank, or_default, to_day_any, to_decimal, to_int
from ..operators.dimensions import month_dimension
from ..operators.history import replay_state
from ..operators.matching import by_shuffle, exclude, exclude_in_place, latest_lookup, mark_known, mark_present
from ..operators.measures import distinct_numbers, summed_days
from ..operators.numbering import extend_surrogates
from ..operators.quality import (Rule, Screened, caveats, describe, failed_records, pass_or_fail, readiness, rejected,
                                 rules_of, screen, screened_counts, screened_records, slice_failures, union_all)
from ..operators.reconcile import slice_counts
from ..operators.rows import SPREAD, latest_per_key, latest_unless_rejected, mark_duplicates
from ..operators.upsert import upsert, upsert_changed
from ..session import materialise
from ..sources.model import SCORE_RANGE, SOURCE_COLUMNS

SLICE = ("source_batch_id", "reporting_month")
ROW = "raw_row_number"  # unique within a slice; stands for the load order
SNAPSHOT_MONTH = "2024-01"
MINIMUM_ATTENDANCE_ROWS = 1000

# Bands with their bounds, and domains with their order.
ATTENDANCE_BANDS = ((1, "Low", "0.0000", "0.8200", 1), (2, "Medium", "0.8200", "0.9000", 2),
                    (3, "High", "0.9000", "1.0000", 3))
ASSESSMENT_DOMAINS = ((1, "Reading", 1), (2, "Numeracy", 2), (3, "Writing", 3))


# ---------------------------------------------------------------- rules

def quality_rules(minimum_rows: int = MINIMUM_ATTENDANCE_ROWS,
                  snapshot_month: str = SNAPSHOT_MONTH) -> list[Rule]:
    """Fifteen rules, with names and texts that are fixed values; eight of them capture rejected rows, the others only count.
    Four look at the row count of a slice, two of these only in the snapshot month."""
    def empty_snapshot(rows: Column) -> Column:
        return (rows == 0) & (F.col("reporting_month") == snapshot_month)

    possible, attended = (lambda: to_int("possible_days")), (lambda: to_int("attended_days"))

    def rule(rule_id, text, table, severity, fails=None, key="", rejects=False, volume=None):
        return Rule(rule_id, text, f"bronze.{table}", severity, fails, key, text, rejects=rejects,
                    volume=volume)

    return [
        rule("ATT_NO_ROWS_FOR_MONTH", "Bronze attendance has zero rows for the reporting month.",
             "attendance", "BLOCKER", volume=lambda rows: rows == 0),
        rule("ATT_ROW_COUNT_TOO_LOW",
             "Bronze attendance row count is unexpectedly low for the reporting month.",
             "attendance", "BLOCKER", volume=lambda rows: rows < minimum_rows),
        rule("STU_NO_ROWS_FOR_MONTH", "Bronze students has zero rows for the initial snapshot month.",
             "students", "BLOCKER", volume=empty_snapshot),
        rule("SCH_NO_ROWS_FOR_MONTH", "Bronze schools has zero rows for the initial snapshot month.",
             "schools", "BLOCKER", volume=empty_snapshot),
        rule("SCH_MISSING_KEY", "School row is missing school_id.", "schools", "ERROR",
             lambda: is_blank("school_id"), "school_id", True),
        rule("STU_MISSING_KEY", "Student row is missing student_id.", "students", "ERROR",
             lambda: is_blank("student_id"), "student_id", True),
        rule("STU_MISSING_SCHOOL_ID", "Student row is missing school_id.", "students", "ERROR",
             lambda: ~is_blank("student_id") & is_blank("school_id"), "student_id", True),
        rule("STU_UNKNOWN_SCHOOL", "Student references a school_id not available in Bronze schools.",
             "students", "ERROR", lambda: ~is_blank("school_id") & ~F.col("_school_known"),
             "student_id", True),
        rule("ATT_INVALID_DAYS", "Attendance row has invalid possible_days or attended_days.",
             "attendance", "ERROR", lambda: checks.bad_day_counts(possible(), attended()),
             "attendance_id", True),
        rule("ATT_DUPLICATE_BUSINESS_KEY",
             "Attendance has more than one row for the same student, school, and attendance month.",
             "attendance", "WARNING", lambda: F.col("_surplus"), "attendance_id", True),
        rule("ATT_UNKNOWN_STUDENT",
             "Attendance references a student_id not available in the student records.",
             "attendance", "ERROR",
             lambda: ~is_blank("student_id") & ~F.col("_in_history") & ~F.col("_in_batch"),
             "attendance_id", True),
        rule("ATT_ABSENCE_REASON_NO_ABSENCE",
             "Attendance row has absence_reason even though attended_days equals possible_days.",
             "attendance", "WARNING",
             lambda: checks.reason_without_absence(possible(), attended(), "absence_reason")),
        rule("ATT_ABSENCE_REASON_MISSING", "Attendance row has absences but no absence_reason.",
             "attendance", "WARNING",
             lambda: checks.absence_without_reason(possible(), attended(), "absence_reason")),
        rule("ASM_INVALID_SCORE", "Assessment score is not numeric or outside expected range 250 to 700.",
             "assessment_results", "ERROR",
             lambda: ~is_blank("assessment_id")
             & checks.missing_or_outside(to_decimal("score", 6, 2), *SCORE_RANGE),
             "assessment_id", True),
        rule("EVT_UNKNOWN_SCHOOL", "School event references a school_id not available in Bronze schools.",
             "school_events", "WARNING", lambda: ~is_blank("school_id") & ~F.col("_school_known")),
    ]


def _keyed(df: DataFrame, **keys: str) -> DataFrame:
    return df.withColumns({name: blank_to_null(column) for name, column in keys.items()})


def mark(bronze: dict[str, DataFrame], all_schools: DataFrame, known_students: DataFrame,
         by: Sequence[str] = SLICE) -> dict[str, DataFrame]:
    """Bronze slices with the booleans of the set rules.

    ``all_schools``: bronze schools of any batch. ``known_students``: student_id
    of the conformed state before these slices.
    """
    schools = _keyed(all_schools, _school="school_id")
    attendance = mark_attendance(bronze["attendance"], bronze["students"], known_students, by)
    return {
        "bronze.schools": bronze["schools"],
        "bronze.students": mark_present(_keyed(bronze["students"], _school="school_id"), schools,
                                        ["_school"], "_school_known"),
        "bronze.attendance": attendance,
        "bronze.assessment_results": bronze["assessment_results"],
        "bronze.school_events": mark_present(_keyed(bronze["school_events"], _school="school_id"),
                                             schools, ["_school"], "_school_known"),
    }


def mark_attendance(attendance: DataFrame, students: DataFrame, known_students: DataFrame,
                    by: Sequence[str] = SLICE) -> DataFrame:
    """Attendance with the booleans of its set rules. Its key ``_student`` and ``SPREAD`` stay: what joins on both needs no
    shuffle of its own."""
    history = known_students.select(F.col("student_id").alias("_student"))
    batch_students = _keyed(students, _student="student_id")
    # One shuffle by student serves both marks; what can be derived after it doesn't travel.
    known = mark_known(_keyed(attendance, _student="student_id"), history, batch_students, "_student", by,
                       "_in_history", "_in_batch", [SPREAD])
    known = _keyed(known, _school="school_id").withColumn("_month", to_day_any("attendance_month"))
    return mark_duplicates(known, [*by, "_student", "_school", "_month"], "_surplus", ROW)


def validation_results(marked: dict[str, DataFrame], slices: DataFrame, **limits) -> DataFrame:
    """Every rule for every slice: one aggregate per table."""
    rules = quality_rules(**limits)
    counts = union_all([
        slice_failures(slices, df, [r for r in rules if r.target_table == table], SLICE)
        for table, df in marked.items()
    ])
    return describe(counts, rules, pass_or_fail(F.col("failed_record_count")))


def rejected_records(marked: dict[str, DataFrame]) -> DataFrame:
    """One row per record and rejecting rule."""
    rules, out = quality_rules(), []
    for table, df in marked.items():
        rejecting = [r for r in rules_of(rules, table) if r.rejects]
        if rejecting:
            out.append(failed_records(df, rejecting, SLICE, ["source_file_name", ROW],
                                      SOURCE_COLUMNS[table.split(".")[1]]))
    return union_all(out)


class QualityRun:
    """What the rules say of some slices: results, rejected records, caveats, readiness.

    With ``store`` every rule is evaluated once, in the pass that stores the failing rows with a bit per broken rule, and
    all four read those. Without it each output asked for is a pass over the marked tables of its own, which is less work
    where only one is.
    """

    def __init__(self, bronze: dict[str, DataFrame], marked: dict[str, DataFrame], slices: DataFrame,
                 store: Callable[[DataFrame], DataFrame] | None, limits: dict):
        self._bronze, self._marked, self._slices, self._store, self._limits = bronze, marked, slices, store, limits
        self._rules, self._screened = quality_rules(**limits), {}

    def screened_table(self, table: str) -> Screened:
        """One table after its rules, stored when it is first asked for."""
        if table not in self._screened:
            self._screened[table] = self._screen(table, self._marked[table])
        return self._screened[table]

    def _screen(self, table: str, marked: DataFrame, carry: Sequence[str] | None = None) -> Screened:
        name = table.split(".")[1]
        return screen(table, marked, self._rules, SLICE, ["source_file_name", ROW, *SOURCE_COLUMNS[name]], self._store,
                      self._bronze[name], carry)

    def numbered_attendance(self, students: DataFrame) -> Screened:
        """Attendance after its rules, every row stored with its student's surrogate key: the rules' outputs and the
        conformed table go on from there. Ask for it before any of those outputs."""
        table = "bronze.attendance"
        if self._screened.get(table) is None or self._screened[table].whole is None:
            self._screened[table] = self._screen(table, with_student_keys(self._marked[table], students), ["student_key"])
        return self._screened[table]

    @property
    def screened(self) -> list[Screened]:
        return [self.screened_table(table) for table in self._marked]

    @cached_property
    def results(self) -> DataFrame:
        if self._store is None:
            return validation_results(self._marked, self._slices, **self._limits)
        counts = union_all([screened_counts(s, SLICE, self._slices) for s in self.screened])
        # A row per slice and rule: caveats and readiness read it again.
        return self._store(describe(counts, self._rules, pass_or_fail(F.col("failed_record_count"))))

    @cached_property
    def rejected(self) -> DataFrame:
        if self._store is None:
            return rejected_records(self._marked)
        return union_all([self.rejected_of(table) for table in self._marked
                          if any(r.rejects for r in rules_of(self._rules, table))])

    def rejected_of(self, table: str) -> DataFrame:
        """Rejected records of one table: the rules of the others are not evaluated for it."""
        if self._store is None:
            return rejected_records({table: self._marked[table]})
        return screened_records(self.screened_table(table), SLICE, ["source_file_name", ROW], SOURCE_COLUMNS[table.split(".")[1]])

    @property
    def caveats(self) -> DataFrame:
        return caveats(self.results, SLICE)

    @property
    def readiness(self) -> DataFrame:
        return readiness(self.results, self.rejected, SLICE)


def assess(bronze: dict[str, DataFrame], all_schools: DataFrame, known_students: DataFrame,
           slices: DataFrame, store: Callable[[DataFrame], DataFrame] | None = materialise, **limits) -> QualityRun:
    return QualityRun(bronze, mark(bronze, all_schools, known_students), slices, store, limits)


# ---------------------------------------------------------------- conformed tables

def _rejected_keys(rejected: DataFrame, table: str, key: str) -> DataFrame:
    """Business keys rejected in a slice: they remove every row with that key."""
    return rejected.filter(F.col("target_table") == table).select(
        *SLICE, blank_to_null("business_key").alias(key))


def conformed_schools(bronze: DataFrame) -> DataFrame:
    """Last row per school of each slice."""
    rows = bronze.select(
        blank_to_null("school_id").alias("school_id"),
        or_default("school_name", "Unknown school").alias("school_name"),
        blank_to_null("region").alias("region"), blank_to_null("school_type").alias("school_type"),
        to_day_any("open_date").alias("open_date"), blank_to_null("status").alias("status"),
        *SLICE, ROW,
    ).dropna(subset=["school_id"])
    return (
        latest_per_key(rows, [*SLICE, "school_id"], [F.desc(ROW)]).drop(ROW)
        .withColumn("record_hash", hash_key("school_id", "school_name", "region", "school_type",
                                            "open_date", "status"))
    )


def conformed_students(bronze: DataFrame, rejected: DataFrame) -> DataFrame:
    """Last row per student of each slice, rejected students removed."""
    rows = bronze.select(
        blank_to_null("student_id").alias("student_id"),
        blank_to_null("school_id").alias("current_school_id"),
        to_int("year_level").alias("current_year_level"), blank_to_null("gender").alias("gender"),
        to_day_any("enrolment_date").alias("enrolment_date"), blank_to_null("status").alias("status"),
        *SLICE, ROW,
    ).dropna(subset=["student_id"])
    kept = exclude(rows, _rejected_keys(rejected, "bronze.students", "student_id"),
                   [*SLICE, "student_id"])
    return (
        latest_per_key(kept, [*SLICE, "student_id"], [F.desc(ROW)]).drop(ROW)
        .withColumn("record_hash", hash_key("student_id", "current_school_id", "current_year_level",
                                            "gender", "enrolment_date", "status"))
    )


def _with_keys(rows: DataFrame, students: DataFrame, schools: DataFrame) -> DataFrame:
    """Surrogate keys by inner joins. They come before the exclusion and the choice
    of the latest row, which then share one shuffle on the record key."""
    return (rows.join(students.select("student_id", "student_key"), "student_id")
            .join(schools.select("school_id", "school_key"), "school_id"))


_ATTENDANCE = ("attendance_id", *SLICE, "attendance_month", "student_id", "school_id", "possible_days", "attended_days",
               "absence_reason", ROW)


def _attendance_rows(bronze: DataFrame, *carry: str) -> DataFrame:
    """Typed rows, valid or not."""
    return bronze.select(
        blank_to_null("attendance_id").alias("attendance_id"), *SLICE,
        to_day_any("attendance_month").alias("attendance_month"),
        blank_to_null("student_id").alias("student_id"), blank_to_null("school_id").alias("school_id"),
        to_int("possible_days").alias("possible_days"), to_int("attended_days").alias("attended_days"),
        blank_to_null("absence_reason").alias("absence_reason"), ROW, *carry)


def _valid_attendance() -> Column:
    return F.col("attendance_id").isNotNull() & ~checks.bad_day_counts("possible_days", "attended_days")


def _conformed_attendance(latest: DataFrame) -> DataFrame:
    possible, attended = F.col("possible_days"), F.col("attended_days")
    return latest.select(
        "attendance_id", *SLICE, "attendance_month", "student_key", "school_key",
        "possible_days", "attended_days",
        F.when(possible > 0, ratio_decimal(attended, possible)).alias("attendance_rate"),
        F.when(possible != attended, F.col("absence_reason")).alias("absence_reason"),
        monthly_attendance_band(attended, possible).alias("attendance_band"))


def conformed_attendance(bronze: DataFrame, students: DataFrame, schools: DataFrame,
                         rejected: DataFrame) -> DataFrame:
    """Valid records with their surrogate keys, rate and band.

    ``students``: student_id, student_key. ``schools``: school_id, school_key.
    """
    keyed = _with_keys(_attendance_rows(bronze).filter(_valid_attendance()), students, schools)
    kept = exclude_in_place(keyed, _rejected_keys(rejected, "bronze.attendance", "attendance_id"), [*SLICE, "attendance_id"])
    return _conformed_attendance(latest_per_key(kept, [*SLICE, "attendance_id"], [F.desc(ROW)]))


def _rejects_key(fails: Column, key: str) -> Column:
    """A failing row rejects its business key: like in a join, a key with a null in it rejects nothing."""
    named = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in SLICE], blank_to_null(key).isNotNull())
    return F.coalesce(fails, F.lit(False)) & named


def _unless_rejected(rows: DataFrame, key: str, valid: Column, ties: Sequence[str]) -> DataFrame:
    """The latest valid row of every record that no row rejects (``_rejected``); rows without a load order tie, which the
    greatest ``ties`` settle, however the rows arrive. A rejecting row needs only its key, so its other columns stay behind."""
    names = [*SLICE, key]
    needed = rows.filter(F.col("_rejected") | valid).select(*names, "_rejected", *[
        F.when(~F.col("_rejected"), F.col(c)).alias(c) for c in rows.columns if c not in (*names, "_rejected")])
    return latest_unless_rejected(needed, names, [F.desc(ROW), *[F.desc(c) for c in ties]], "_rejected")


def with_student_keys(marked: DataFrame, students: DataFrame) -> DataFrame:
    """Marked attendance with ``student_key`` (null if unknown), found in the partitioning the marks left."""
    numbered = students.select(F.col("student_id").alias("_student"), "student_key").withColumn(SPREAD, F.lit(0).cast("long"))
    return marked.join(by_shuffle(numbered), ["_student", SPREAD], "left")


def _accepted_attendance(rows: DataFrame, schools: DataFrame) -> DataFrame:
    """``rows``: typed, with ``student_key`` and ``_rejected``."""
    keyed = rows.drop("student_id").join(schools.select("school_id", "school_key"), "school_id", "left").drop("school_id")
    valid = _valid_attendance() & F.col("student_key").isNotNull() & F.col("school_key").isNotNull()
    return _conformed_attendance(_unless_rejected(
        keyed, "attendance_id", valid, ["possible_days", "attended_days", "student_key", "school_key"]))


def conformed_attendance_in_one_pass(bronze: DataFrame, bronze_students: DataFrame, known_students: DataFrame,
                                     students: DataFrame, schools: DataFrame) -> DataFrame:
    """The same rows as ``conformed_attendance`` with what the rules reject of ``bronze``, without capturing that before:
    rows travel once by student, where the marks are made and the surrogate keys found, and once by record, where
    rejected records fall out and the latest row is chosen. They travel typed, which is narrower; the rules judge typed
    values like their texts."""
    marked = with_student_keys(mark_attendance(_attendance_rows(bronze), bronze_students, known_students), students)
    rejects = _rejects_key(rejected(rules_of(quality_rules(), "bronze.attendance")), "attendance_id")
    return _accepted_attendance(marked.select(*_ATTENDANCE, "student_key", rejects.alias("_rejected")), schools)


def conformed_attendance_of_screened(screened: Screened, schools: DataFrame) -> DataFrame:
    """The same rows from ``numbered_attendance``."""
    rows = screened.whole.withColumn("_rejected", _rejects_key(screened.rejected(), "attendance_id"))
    return _accepted_attendance(_attendance_rows(rows, "student_key", "_rejected"), schools)


def _assessment_rows(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        blank_to_null("assessment_id").alias("assessment_id"), *SLICE,
        blank_to_null("student_id").alias("student_id"), blank_to_null("school_id").alias("school_id"),
        to_int("assessment_year").alias("assessment_year"), blank_to_null("domain").alias("domain"),
        to_decimal("score", 6, 2).alias("score"),
        blank_to_null("proficiency_band").alias("proficiency_band"), ROW)


def _valid_assessment() -> Column:
    return (F.col("assessment_id").isNotNull() & F.col("assessment_year").isNotNull()
            & F.col("domain").isNotNull() & F.coalesce(F.col("score").between(*SCORE_RANGE), F.lit(False)))


_ASSESSMENT = ("assessment_id", *SLICE, "student_key", "school_key", "assessment_year", "domain", "score",
               "proficiency_band")


def conformed_assessment(bronze: DataFrame, students: DataFrame, schools: DataFrame,
                         rejected: DataFrame) -> DataFrame:
    keyed = _with_keys(_assessment_rows(bronze).filter(_valid_assessment()), students, schools)
    kept = exclude_in_place(keyed, _rejected_keys(rejected, "bronze.assessment_results", "assessment_id"), [*SLICE, "assessment_id"])
    return latest_per_key(kept, [*SLICE, "assessment_id"], [F.desc(ROW)]).select(*_ASSESSMENT)


def conformed_assessment_in_one_pass(bronze: DataFrame, students: DataFrame, schools: DataFrame) -> DataFrame:
    """The same rows as ``conformed_assessment`` with what the rules reject of ``bronze``."""
    typed = _assessment_rows(bronze)
    rows = (
        typed.withColumn("_rejected", _rejects_key(
            rejected(rules_of(quality_rules(), "bronze.assessment_results")), "assessment_id"))
        .join(by_shuffle(students.select("student_id", "student_key")), "student_id", "left").drop("student_id")
        .join(schools.select("school_id", "school_key"), "school_id", "left").drop("school_id")
    )
    valid = _valid_assessment() & F.col("student_key").isNotNull() & F.col("school_key").isNotNull()
    return _unless_rejected(rows, "assessment_id", valid, ["score", "student_key", "school_key"]).select(*_ASSESSMENT)


def conformed_events(bronze: DataFrame, schools: DataFrame) -> DataFrame:
    rows = bronze.select(
        blank_to_null("event_id").alias("event_id"), *SLICE,
        blank_to_null("school_id").alias("school_id"), blank_to_null("event_type").alias("event_type"),
        to_day_any("event_date").alias("event_date"), blank_to_null("description").alias("description"),
        ROW,
    ).dropna(subset=["event_id", "event_type", "event_date"])
    keyed = rows.join(schools.select("school_id", "school_key"), "school_id")
    return latest_per_key(keyed, [*SLICE, "event_id"], [F.desc(ROW)]).select(
        "event_id", *SLICE, "school_key", "event_type", "event_date", "description")


# ---------------------------------------------------------------- state

# Columns of the conformed state tables.
STATE_SCHEMAS = {
    "school": "school_key bigint, school_id string, school_name string, region string, "
              "school_type string, open_date date, status string, source_batch_id string, "
              "effective_from_month string, last_seen_reporting_month string, record_hash string, "
              "validation_status string",
    "student": "student_key bigint, student_id string, current_school_key bigint, "
               "current_school_id string, current_year_level int, gender string, enrolment_date date, "
               "status string, source_batch_id string, effective_from_month string, "
               "last_seen_reporting_month string, record_hash string, validation_status string",
    "student_monthly_status": "reporting_month string, student_key bigint, school_key bigint, "
                              "year_level int, gender string, student_status string, "
                              "source_batch_id string, validation_status string",
    "attendance_monthly": "attendance_id string, source_batch_id string, reporting_month string, "
                          "attendance_month date, student_key bigint, school_key bigint, "
                          "possible_days int, attended_days int, attendance_rate decimal(6,4), "
                          "absence_reason string, attendance_band string, validation_status string",
    "assessment_result": "assessment_result_key bigint, assessment_id string, source_batch_id string, "
                         "reporting_month string, student_key bigint, school_key bigint, "
                         "assessment_year int, domain string, score decimal(6,2), "
                         "proficiency_band string, validation_status string",
    "school_event": "event_id string, source_batch_id string, reporting_month string, "
                    "school_key bigint, event_type string, event_date date, description string, "
                    "validation_status string",
}


# Columns of tables that may have no rows yet when a view reads them.
FACT_SCHEMAS = {
    "attendance": "month_key int, student_key bigint, school_key bigint, year_level_key int, "
                  "attendance_band_key int, possible_days int, attended_days int, absent_days int, "
                  "attendance_rate decimal(6,4), source_batch_id string",
    "assessment": "assessment_result_key bigint, assessment_year int, student_key bigint, "
                  "school_key bigint, year_level_key int, assessment_domain_key int, "
                  "attendance_band_key int, score decimal(6,2), source_batch_id string",
    "caveat": "source_batch_id string, reporting_month string, caveat_code string, caveat_title string, "
              "caveat_description string, severity string, affected_area string, "
              "recommended_action string",
}

REJECTED_SCHEMA = ("source_batch_id string, reporting_month string, source_file_name string, "
                   "raw_row_number bigint, target_table string, failed_record_json string, "
                   "rule_id string, business_key string, failure_reason string")


def empty_state(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in STATE_SCHEMAS.items()}


def _as_state(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "effective_from_month": F.col("reporting_month"),
        "last_seen_reporting_month": F.col("reporting_month"),
        "validation_status": F.lit("Valid"),
    })


def merge_state(state: DataFrame, rows: DataFrame, key: str, surrogate: str, above: int | None = None) -> DataFrame:
    """Give new keys a number and update only what changed or moved month. A month
    older than the one a key was last seen in leaves its row as it is. ``state`` may be
    the part of the state that can hold the rows' keys; ``above`` then is the highest
    number of the whole. ``rows`` feed the numbering and the merge: store them before."""
    numbers = extend_surrogates(state.select(key, surrogate), rows.select(key), key, surrogate, above)
    newer = state.select(key, "last_seen_reporting_month")
    source = _as_state(rows).join(numbers, key).select(*state.columns)
    source = source.join(newer.withColumnRenamed("last_seen_reporting_month", "_seen"), key, "left").filter(
        F.col("_seen").isNull() | (F.col("_seen") <= F.col("last_seen_reporting_month"))).drop("_seen")
    return upsert_changed(state, source, [key], "record_hash", "last_seen_reporting_month",
                          keep=[surrogate, "effective_from_month", "validation_status"])


def merge_schools(state: DataFrame, bronze_slice: DataFrame) -> DataFrame:
    return merge_state(state, materialise(conformed_schools(bronze_slice)), "school_id", "school_key")


def students_with_school(bronze_slice: DataFrame, rejected: DataFrame, schools: DataFrame) -> DataFrame:
    school = schools.select(F.col("school_id").alias("current_school_id"),
                            F.col("school_key").alias("current_school_key"))
    return conformed_students(bronze_slice, rejected).join(school, "current_school_id", "left")


def merge_students(state: DataFrame, bronze_slice: DataFrame, rejected: DataFrame,
                   schools: DataFrame) -> DataFrame:
    rows = materialise(students_with_school(bronze_slice, rejected, schools))
    return merge_state(state, rows, "student_id", "student_key")


def students_at(month: str, bronze: DataFrame, rejected: DataFrame, students: DataFrame,
                schools: DataFrame) -> DataFrame:
    """Students as they stood at a month: the last accepted delivery up to it, replayed
    from bronze. Surrogate keys are those of today's state, as keys never change."""
    upto = F.col("reporting_month") <= month
    school = schools.select(F.col("school_id").alias("current_school_id"),
                            F.col("school_key").alias("current_school_key"))
    states = replay_state(conformed_students(bronze.filter(upto), rejected.filter(upto)), ["student_id"],
                          "reporting_month", [F.desc("source_batch_id")])
    return states.join(school, "current_school_id", "left").join(
        students.select("student_id", "student_key"), "student_id")


def snapshot_students(students: DataFrame, bronze_attendance: DataFrame, rejected: DataFrame,
                      slices: DataFrame) -> DataFrame:
    """Members of each slice from the current state: enrolled or attending, not
    rejected. The output is students x slices at most; the calendar of slices
    travels as one array and only students outside enrolment meet the activity."""
    state = students.select(
        "student_id", "student_key", F.col("current_school_key").alias("school_key"),
        F.col("current_year_level").alias("year_level"), "gender",
        F.col("status").alias("student_status"))
    enrolled = checks.status_in("student_status", labels.ENROLLED_STATUSES)
    calendar = slices.agg(F.collect_set(F.struct(*SLICE)).alias("_slices"))
    always = state.filter(enrolled).crossJoin(calendar).select("*", F.inline("_slices")).drop("_slices")
    # Rows meet the students first: the choice of distinct ones shares that shuffle.
    activity = bronze_attendance.select(blank_to_null("student_id").alias("student_id"), *SLICE).dropna()
    sometimes = (by_shuffle(state.filter(~enrolled)).join(activity, "student_id").distinct()
                 .join(slices.select(*SLICE), list(SLICE), "left_semi"))
    members = exclude(always.unionByName(sometimes),
                      _rejected_keys(rejected, "bronze.students", "student_id"),
                      [*SLICE, "student_id"])
    return members.withColumn("validation_status", F.lit("Valid")).select(
        "reporting_month", "student_key", "school_key", "year_level", "gender", "student_status",
        "source_batch_id", "validation_status")


def merge_by_id(state: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Attendance and events: replace by id, insert the rest."""
    return upsert(state, rows.withColumn("validation_status", F.lit("Valid")).select(*state.columns),
                  [key])


def merge_assessment(state: DataFrame, rows: DataFrame) -> DataFrame:
    rows = materialise(rows)
    numbers = extend_surrogates(state.select("assessment_id", "assessment_result_key"),
                                rows.select("assessment_id"), "assessment_id",
                                "assessment_result_key")
    return merge_by_id(state, rows.join(by_shuffle(numbers), "assessment_id"), "assessment_id")


# ---------------------------------------------------------------- gold

def dim_month(slices: DataFrame) -> DataFrame:
    return month_dimension(slices)


def dim_school(schools: DataFrame) -> DataFrame:
    return schools.select("school_key", "school_id", "school_name", "region", "school_type",
                          "status", "open_date")


def dim_year_level(students: DataFrame) -> DataFrame:
    level = F.col("year_level")
    return (
        students.select(F.col("current_year_level").alias("year_level")).dropna().distinct()
        .select(level.alias("year_level_key"), "year_level",
                labels.year_level_label(level).alias("year_level_label"),
                labels.cohort_group(level).alias("cohort_group"), level.alias("sort_order"))
    )


def dim_attendance_band(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(ATTENDANCE_BANDS),
                                 "attendance_band_key int, attendance_band string, lower_bound string, "
                                 "upper_bound string, band_sort_order int")
    return rows.withColumns({c: F.col(c).cast("decimal(6,4)") for c in ("lower_bound", "upper_bound")})


def dim_assessment_domain(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ASSESSMENT_DOMAINS),
                                 "assessment_domain_key int, domain string, domain_sort_order int")


def require_month(months: DataFrame, month: str) -> None:
    if not months.filter(F.col("reporting_month") == month).take(1):
        raise RuntimeError("Gold month dimension is missing for this reporting month. "
                           "Fact refresh stopped.")


def fact_student_snapshot(status: DataFrame) -> DataFrame:
    return status.select(
        dates.month_key("reporting_month").alias("month_key"), "student_key", "school_key",
        F.col("year_level").alias("year_level_key"),
        checks.flag(checks.status_in("student_status", labels.ENROLLED_STATUSES))
        .alias("is_active_student"), "source_batch_id")


def fact_attendance_monthly(attendance: DataFrame, status: DataFrame, bands: DataFrame) -> DataFrame:
    """Year level as of the month; absent days are computed at write time."""
    level = status.select("reporting_month", "source_batch_id", "student_key",
                          F.col("year_level").alias("year_level_key"))
    return (
        attendance.join(by_shuffle(level), ["reporting_month", "source_batch_id", "student_key"], "left")
        .join(bands.select("attendance_band", "attendance_band_key"), "attendance_band", "left")
        .select(dates.month_key("reporting_month").alias("month_key"), "student_key", "school_key",
                "year_level_key", "attendance_band_key", "possible_days", "attended_days",
                (F.col("possible_days") - F.col("attended_days")).alias("absent_days"),
                "attendance_rate", "source_batch_id")
    )


def fact_assessment_result(results: DataFrame, domains: DataFrame, students: DataFrame,
                           attendance: DataFrame, bands: DataFrame) -> DataFrame:
    """Scores with the band of the student's latest attendance in the same year."""
    level = students.select("student_key", F.col("current_year_level").alias("year_level_key"))
    history = attendance.withColumn("assessment_year", dates.year_of_month_id("reporting_month"))
    rows = (results.join(domains.select("domain", "assessment_domain_key"), "domain")
            .join(level, "student_key", "left"))
    found = latest_lookup(rows, history, ["student_key", "assessment_year"], "attendance_band",
                          ["reporting_month", "attendance_id"], "attendance_band")
    return (
        found.join(bands.select("attendance_band", "attendance_band_key"), "attendance_band", "left")
        .select("assessment_result_key", "assessment_year", "student_key", "school_key",
                "year_level_key", "assessment_domain_key", "attendance_band_key", "score",
                "source_batch_id")
    )


def fact_data_quality_caveat(caveat_rows: DataFrame, results: DataFrame) -> DataFrame:
    counts = results.select(*SLICE, F.col("rule_id").alias("caveat_code"), "failed_record_count")
    return caveat_rows.join(counts, [*SLICE, "caveat_code"], "left").select(
        dates.month_key("reporting_month").alias("month_key"), "caveat_code", "severity",
        "affected_area", F.coalesce("failed_record_count", F.lit(0)).alias("failed_record_count"),
        "source_batch_id")


# ---------------------------------------------------------------- report views

MONTH = ("reporting_month", "calendar_year", "calendar_month_number", "calendar_month_name",
         "school_term", "season")


def view_monthly_attendance(fact: DataFrame, months: DataFrame, schools: DataFrame) -> DataFrame:
    """Facts shrink to one row per (month, school, student) before the dimension
    attributes and the two distinct counts come in."""
    sums = summed_days(fact, ["month_key", "school_key", "student_key"],
                       F.count(F.lit(1)).alias("_records"), F.sum("absent_days").alias("absent_days"))
    by = [*MONTH, "is_winter_month", "region", "school_type", "school_status"]
    school = schools.select("school_key", "region", "school_type",
                            F.col("status").alias("school_status"))
    return (
        sums.join(months, "month_key").join(school, "school_key").groupBy(*by)
        .agg(F.sum("_records").alias("attendance_record_count"),
             F.countDistinct("school_key").alias("school_count"),
             F.countDistinct("student_key").alias("student_count"),
             F.sum("possible_days").alias("possible_days"),
             F.sum("attended_days").alias("attended_days"), F.sum("absent_days").alias("absent_days"))
        .withColumn("attendance_rate", ratio_decimal("attended_days", "possible_days"))
    )


def view_year_level_patterns(fact: DataFrame, months: DataFrame, schools: DataFrame,
                             levels: DataFrame) -> DataFrame:
    """Students are counted by keys; the names of months and levels come to the groups after that, so that they don't
    travel with every student. A level the dimension lacks counts as none."""
    names = ["year_level_label", "cohort_group", "year_level_sort_order"]
    rows = (
        fact.join(schools.select("school_key", "region", "school_type"), "school_key")
        .join(levels.select("year_level_key", "year_level"), "year_level_key", "left")
    )
    sums = summed_days(rows, ["month_key", "region", "school_type", "year_level"],
                       F.count(F.lit(1)).alias("attendance_record_count"),
                       F.countDistinct("student_key").alias("student_count"))
    labelled = levels.withColumnRenamed("sort_order", "year_level_sort_order").select("year_level", *names)
    return (
        sums.join(months.select("month_key", *MONTH), "month_key").join(labelled, "year_level", "left")
        .select(*MONTH, "region", "school_type", "year_level", *names, "possible_days", "attended_days",
                "attendance_record_count", "student_count")
        .withColumn("attendance_rate", ratio_decimal("attended_days", "possible_days"))
    )


# ---------------------------------------------------------------- summaries

def student_months(fact: DataFrame) -> DataFrame:
    """Attendance facts per month, school, year level and student. Store it: the summaries read nothing else."""
    return summed_days(fact, ["month_key", "school_key", "year_level_key", "student_key"],
                       F.sum("absent_days").alias("absent_days"), F.count(F.lit(1)).alias("attendance_record_count"))


def summary_monthly_attendance(base: DataFrame) -> DataFrame:
    """Month, school and year level."""
    sums = summed_days(base, ["month_key", "school_key", "year_level_key"], F.sum("absent_days").alias("absent_days"),
                       F.sum("attendance_record_count").alias("attendance_record_count"),
                       F.count(F.lit(1)).alias("student_count"))
    return sums.withColumn("attendance_rate", ratio_decimal("attended_days", "possible_days"))


def summary_year_level_pattern(base: DataFrame, monthly: DataFrame) -> DataFrame:
    """Month and year level: sums merged from the finer summary, students (who may change school within a month) counted
    by bitmaps."""
    by = ["month_key", "year_level_key"]
    sums = summed_days(monthly, by, F.sum("absent_days").alias("absent_days"),
                       F.sum("attendance_record_count").alias("attendance_record_count"),
                       F.count(F.lit(1)).alias("school_count"))
    students = distinct_numbers(base, by, "student_key", "student_count")
    on = sums["month_key"].eqNullSafe(students["month_key"]) & sums["year_level_key"].eqNullSafe(students["year_level_key"])
    return sums.join(students, on).select(sums["*"], "student_count").withColumn(
        "attendance_rate", ratio_decimal("attended_days", "possible_days"))


def summary_attendance_assessment(fact: DataFrame, domains: DataFrame, bands: DataFrame) -> DataFrame:
    """Attendance band, year level and domain: results, students and scores."""
    by = ["attendance_band_key", "year_level_key", "assessment_domain_key"]
    sums = fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("result_count"), F.sum("score").alias("_sum"), F.min("score").alias("lowest_score"),
        F.max("score").alias("highest_score"))
    students = distinct_numbers(fact, by, "student_key", "student_count").withColumnsRenamed({c: f"_{c}" for c in by})
    on = [sums[c].eqNullSafe(students[f"_{c}"]) for c in by]
    return (
        sums.join(students, on)
        .join(domains.select("assessment_domain_key", "domain"), "assessment_domain_key")
        .join(bands.select("attendance_band_key", "attendance_band"), "attendance_band_key", "left")
        .select("attendance_band", "year_level_key", "domain", "result_count", "student_count",
                F.round(F.col("_sum").cast("double") / F.col("result_count"), 4).alias("average_score"),
                "lowest_score", "highest_score")
    )


def view_relationship(fact: DataFrame, schools: DataFrame, levels: DataFrame, domains: DataFrame,
                      bands: DataFrame) -> DataFrame:
    """Scores with attendance bands, row by row and without person identifiers."""
    return (
        fact.join(schools.select("school_key", "region", "school_type"), "school_key")
        .join(levels, "year_level_key", "left").join(domains, "assessment_domain_key")
        .join(bands, "attendance_band_key", "left")
        .select("assessment_result_key", "assessment_year", "region", "school_type", "year_level",
                "year_level_label", "cohort_group", "domain", "domain_sort_order", "attendance_band",
                F.col("band_sort_order").alias("attendance_band_sort_order"), "score")
    )


def view_readiness(readiness_rows: DataFrame) -> DataFrame:
    return readiness_rows.select("reporting_month", "source_batch_id", "readiness_status",
                                 "blocker_count", "warning_count", "rejected_record_count",
                                 "readiness_summary")


def view_caveats(caveat_rows: DataFrame) -> DataFrame:
    return caveat_rows.select("reporting_month", "source_batch_id", "caveat_code", "caveat_title",
                              "caveat_description", "severity", "affected_area", "recommended_action")


# ---------------------------------------------------------------- reconciliation

def reconcile_bronze_silver(bronze: dict[str, DataFrame], silver: dict[str, DataFrame],
                            eligible: DataFrame, slices: DataFrame) -> DataFrame:
    """Five objects. ``eligible`` holds the students a snapshot should contain."""
    school = silver["school"].withColumn("reporting_month", F.col("last_seen_reporting_month"))
    return slice_counts(slices, SLICE, {
        "school": (bronze["schools"], school),
        "student_monthly_status": (eligible, silver["student_monthly_status"]),
        "attendance_monthly": (bronze["attendance"], silver["attendance_monthly"]),
        "assessment_result": (bronze["assessment_results"], silver["assessment_result"]),
        "school_event": (bronze["school_events"], silver["school_event"]),
    }, "bronze_to_silver")


def reconcile_silver_gold(silver: dict[str, DataFrame], gold: dict[str, DataFrame],
                          caveat_rows: DataFrame, slices: DataFrame) -> DataFrame:
    """Four objects; gold rows carry the month as an integer key."""
    by = ["source_batch_id", "month_key"]
    key = dates.month_key("reporting_month")

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("month_key", key)

    counted = slice_counts(keyed(slices), by, {
        "fact_student_snapshot": (keyed(silver["student_monthly_status"]), gold["fact_student_snapshot"]),
        "fact_attendance_monthly": (keyed(silver["attendance_monthly"]), gold["fact_attendance_monthly"]),
        "fact_data_quality_caveat": (keyed(caveat_rows), gold["fact_data_quality_caveat"]),
    }, "silver_to_gold")
    scores = slice_counts(slices.select("source_batch_id").distinct(), ["source_batch_id"], {
        "fact_assessment_result": (silver["assessment_result"], gold["fact_assessment_result"]),
    }, "silver_to_gold")
    months = keyed(slices).select(*SLICE, "month_key")
    return counted.join(months, by).drop("month_key").unionByName(
        scores.join(slices.select(*SLICE), "source_batch_id"))
