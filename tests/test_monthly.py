"""The conformed tables of the monthly pipeline in one pass against those that exclude captured records."""

from __future__ import annotations

import pytest

from strataline.operators import rows as r
from strataline.plans import monthly
from strataline.session import materialise

A, B = ("2024_01", "2024-01"), ("2024_02", "2024-02")
ATTENDANCE = "source_batch_id string, reporting_month string, " + ", ".join(
    f"{c} string" for c in ("attendance_id", "student_id", "school_id", "attendance_month", "possible_days", "attended_days",
                            "absence_reason", "source_file_name", "raw_row_number"))
RECORDS = [
    (*A, "A1", "S1", "C1", "2024-01-01", "20", "18", "Illness", "f", "1"),   # good
    (*A, "A2", "S1", "C1", "2024-01-01", "20", "17", "", "f", "2"),          # surplus copy of A1's key
    (*A, " A3 ", " S2 ", " C1", "2024-01-01", " 20 ", "20", "Family", "f", "3"),  # blanks around
    (*A, "A3", "S2", "C2", "2024-01-01", "10", "5", None, "f", "4"),         # later row of the record
    (*A, "A4", "S9", "C1", "2024-01-01", "20", "18", "", "f", "5"),          # unknown student rejects A4
    (*A, "A4", "S2", "C1", "bad day", "20", "18", "", "f", "6"),             # so this row goes too
    (*B, "A4", "S2", "C1", "2024-02-01", "20", "18", "", "f", "6"),          # but not that of another slice
    (*A, "A5", "S1", "C1", "x", "20", "21", "", "f", "7"),                   # more days than possible
    (*A, "A6", "", "C1", "2024-01-01", "20", "2", "", "f", "8"),             # no student
    (*A, "A7", "S2", "C9", "2024-01-01", "20", "2", "", "f", "9"),           # no such school
    (*A, None, "S9", "C1", "2024-01-01", "20", "2", "", "f", "10"),          # no id
    (None, None, "A8", "S1", "C1", "2024-01-01", "20", "n/a", "", "f", "11"),  # a slice of nulls rejects nothing
    (None, None, "A8", "S1", "C1", "2024-01-01", "0", "0", "", "f", "12"),
    (*B, "A9", "S3", "C2", "2024-02-01", "0", "0", "", "f", None),           # known from its own slice
]


@pytest.fixture
def month(spark):
    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    sliced = "source_batch_id string, reporting_month string, "
    bronze = {
        "attendance": frame(RECORDS, ATTENDANCE),
        "students": frame([(*B, "S3", "C1", "3", "x", "", "Active", "f", "1")],
                          sliced + "student_id string, school_id string, year_level string, gender string, "
                          "enrolment_date string, status string, source_file_name string, raw_row_number string"),
        "schools": frame([(*A, "C1", "n", "r", "t", "", "Active", "f", "1")],
                         sliced + "school_id string, school_name string, region string, school_type string, open_date string, "
                         "status string, source_file_name string, raw_row_number string"),
        "assessment_results": frame(
            [(*A, "X1", "S1", "C1", "2024", "Reading", "300", "Low", "f", "1"), (*A, "X1", "S1", "C1", "2024", "Reading", "310", "", "f", "2"),
             (*A, "X2", "S1", "C1", "2024", "Reading", "abc", "Low", "f", "3"), (*A, "X2", "S2", "C2", "2024", "Reading", "400", "Low", "f", "4"),
             (*B, "X2", "S2", "C2", "2024", "Reading", "400", "Low", "f", "4"), (*A, "X3", "S8", "C1", "2024", "Reading", "400", "Low", "f", "5"),
             (*A, "", "S1", "C1", "2024", "Reading", "900", "Low", "f", "6"), (*A, "X4", None, "C1", "2024", "Reading", "900", "Low", "f", "7"),
             (*A, "X4", "S1", "C1", "2024", "Reading", "500", "Low", "f", "8"), (*A, "X5", "S1", None, "2024", "Reading", "500", "Low", "f", "9")],
            sliced + "assessment_id string, student_id string, school_id string, assessment_year string, domain string, "
            "score string, proficiency_band string, source_file_name string, raw_row_number string"),
        "school_events": frame([], sliced + "event_id string, school_id string, event_type string, event_date string, "
                               "description string, source_file_name string, raw_row_number string"),
    }
    known = frame([("S1",), ("S2",)], "student_id string")
    students = frame([("S1", 1), ("S2", 2), ("S3", 3)], "student_id string, student_key bigint")
    schools = frame([("C1", 1), ("C2", 2)], "school_id string, school_key bigint")
    slices = frame([A, B], "source_batch_id string, reporting_month string")
    quality = monthly.assess(bronze, bronze["schools"], known, slices, minimum_rows=1, snapshot_month="2024-01")
    return bronze, known, students, schools, quality


def test_conformed_attendance_in_one_pass_equals_the_exclusion(spark, rows, month):
    bronze, known, students, schools, quality = month
    want = monthly.conformed_attendance(bronze["attendance"], students, schools, quality.rejected)
    assert sorted((t[0], t[2]) for t in rows(want) if t[2]) == [("A1", "2024-01"), ("A3", "2024-01"), ("A4", "2024-02"), ("A9", "2024-02")]
    assert [t[2] for t in rows(want) if t[0] == "A8"] == [None]
    got = monthly.conformed_attendance_in_one_pass(bronze["attendance"], bronze["students"], known, students, schools)
    assert got.schema == want.schema and rows(got) == rows(want)
    whole = quality.numbered_attendance(students)
    assert rows(monthly.conformed_attendance_of_screened(whole, schools)) == rows(want)


def test_rows_without_a_load_order_tie_and_their_content_decides(spark, rows, month):
    bronze, known, students, schools, quality = month
    tied = [(*A, "T1", "S1", "C1", f"2024-0{i + 1}-01", str(days), "4", "", "f", None) for i, days in enumerate((20, 30, 10))]
    for order in (tied, tied[::-1]):
        one = spark.createDataFrame(order, ATTENDANCE)
        got = monthly.conformed_attendance_in_one_pass(one, bronze["students"], known, students, schools)
        assert rows(got, "attendance_id", "possible_days") == [("T1", 30)]
        slices = spark.createDataFrame([A, B], "source_batch_id string, reporting_month string")
        checked = monthly.assess({**bronze, "attendance": one}, bronze["schools"], known, slices)
        whole = checked.numbered_attendance(students)
        assert rows(monthly.conformed_attendance_of_screened(whole, schools), "attendance_id", "possible_days") == [("T1", 30)]


def test_outputs_of_the_rules_after_every_row_was_stored(spark, rows, month):
    bronze, known, students, _, quality = month
    other = monthly.assess(bronze, bronze["schools"], known, spark.createDataFrame([A, B], "source_batch_id string, reporting_month string"),
                           minimum_rows=1, snapshot_month="2024-01")
    other.numbered_attendance(students)
    assert rows(other.results) == rows(quality.results) and rows(other.readiness) == rows(quality.readiness)
    assert rows(other.rejected) == rows(quality.rejected) and rows(other.caveats) == rows(quality.caveats)


def test_conformed_assessment_in_one_pass_equals_the_exclusion(spark, rows, month):
    bronze, _, students, schools, quality = month
    want = monthly.conformed_assessment(bronze["assessment_results"], students, schools, quality.rejected)
    got = monthly.conformed_assessment_in_one_pass(bronze["assessment_results"], students, schools)
    assert got.schema == want.schema and rows(got) == rows(want)
    assert [(t[0], t[2], t[7]) for t in rows(want)] == [("X1", "2024-01", want.filter("assessment_id = 'X1'").first().score),
                                                       ("X2", "2024-02", want.filter("assessment_id = 'X2'").first().score)]


def test_attendance_travels_once_by_student_and_once_by_record(spark, month):
    bronze, known, students, schools, _ = month
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = monthly.conformed_attendance_in_one_pass(bronze["attendance"], bronze["students"], known, students,
                                                       schools.hint("broadcast"))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Attendance twice; known students and surrogate keys once each, the choice of known ones by its own partial aggregate.
    assert plan.count("Exchange hashpartitioning(") == 4, plan


def test_rejected_students_leave_the_other_tables_alone(spark, month):
    bronze, known, _, _, _ = month
    stored = []

    def store(df):
        stored.append(df.columns)
        return df

    quality = monthly.QualityRun(bronze, monthly.mark(bronze, bronze["schools"], known), None, store, {})
    quality.rejected_of("bronze.students")
    assert len(stored) == 1 and "student_id" in stored[0] and "attendance_id" not in stored[0]


def test_a_record_with_a_rejected_row_falls_out_with_its_later_rows(spark, rows):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, False), ("b", 1, True), ("b", 2, False), (None, 1, False), (None, 2, False),
                                ("c", None, False)], "k string, n int, bad boolean")
    from pyspark.sql import functions as F

    got = r.latest_unless_rejected(df, ["k"], [F.desc("n")], "bad")
    assert rows(got) == sorted([("a", 2), (None, 2), ("c", None)], key=str)


def test_level_view_sends_no_names_with_the_students(spark):
    fact = spark.createDataFrame(
        [(202401, 1, 7, 7, 20, 18), (202401, 1, 8, 7, 10, 9), (202401, 2, 7, 7, 5, 5),  # a student at two schools
         (202401, 1, 9, 99, 20, 10), (202401, 1, 9, None, 10, 10),  # levels that the dimension lacks are one group
         (202402, 1, 7, 7, 20, 20), (202403, 1, 7, 7, 20, 20), (None, 1, 7, 7, 1, 1), (202401, 9, 7, 7, 1, 1)],
        "month_key int, school_key bigint, student_key bigint, year_level_key int, possible_days int, attended_days int")
    months = monthly.dim_month(spark.createDataFrame([("2024-01",), ("2024-02",)], "reporting_month string"))
    schools = spark.createDataFrame([(1, "North", "Primary"), (2, "North", "Primary")],
                                    "school_key bigint, region string, school_type string")
    levels = monthly.dim_year_level(spark.createDataFrame([(7,), (8,), (None,)], "current_year_level int"))
    view = monthly.view_year_level_patterns(fact, months, schools, levels)
    got = {(r.reporting_month, r.year_level, r.year_level_sort_order, r.possible_days, r.attended_days,
            r.attendance_record_count, r.student_count) for r in view.collect()}
    assert got == {("2024-01", 7, 7, 35, 32, 3, 2), ("2024-01", None, None, 30, 20, 2, 1), ("2024-02", 7, 7, 20, 20, 1, 1)}
    shuffles = [line for line in view._jdf.queryExecution().executedPlan().toString().splitlines()
                if "Exchange hashpartitioning" in line and "student_key" in line]
    assert shuffles and not any("calendar_month_name" in line or "year_level_label" in line for line in shuffles)


def test_a_side_that_grows_with_the_students_is_never_broadcast(spark, month):
    """The snapshots of all months compress to a file that looks small enough to broadcast."""
    bronze, known, students, schools, _ = month
    months = spark.createDataFrame([(f"{y}_{m:02}", f"{y}-{m:02}") for y in range(2000, 2010) for m in range(1, 13)],
                                   "source_batch_id string, reporting_month string")
    status = materialise(spark.range(2000).selectExpr("id as student_key", "cast(id % 13 as int) as year_level").crossJoin(months))
    attendance = spark.range(50).selectExpr("id as student_key", "'2000_01' as source_batch_id", "'2000-01' as reporting_month",
                                            "'Low' as attendance_band", "20 as possible_days", "10 as attended_days",
                                            "cast(0.5 as decimal(6,4)) as attendance_rate", "id as school_key")
    bands = monthly.dim_attendance_band(spark).limit(0)  # its own join is as it was
    state = students.selectExpr("*", "1L as current_school_key", "7 as current_year_level", "'x' as gender", "'Left' as status")
    marked = monthly.mark_attendance(monthly._attendance_rows(bronze["attendance"]), bronze["students"], known)
    facts = monthly.fact_attendance_monthly(attendance, status, bands)
    assert sorted((r.student_key, r.year_level_key) for r in facts.collect()) == [(i, i % 13) for i in range(50)]
    for df, key in ((facts, "student_key"), (monthly.with_student_keys(marked, materialise(students)), "_student"),
                    (monthly.conformed_assessment_in_one_pass(bronze["assessment_results"], materialise(students), schools), "student_id"),
                    (monthly.snapshot_students(materialise(state), bronze["attendance"], monthly.rejected_records(
                        {"bronze.students": monthly.mark(bronze, bronze["schools"], known)["bronze.students"]}), months), "student_id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert any("SortMergeJoin" in line and key in line for line in plan.splitlines()), plan
