from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures
from strataline.plans import jobs, monthly
from strataline.sources.model import text_schema
from strataline.sources import readers, writers

B1, B2 = "2025-01-15", "2026-01-15"


def day(text):
    return F.lit(text).cast("date")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two batches, the second one loaded twice."""
    root = tmp_path_factory.mktemp("assured")
    raw, out = root / "raw", str(root / "lake")
    fixtures.write_batch(raw, B1, fixtures.with_defects())
    second = {"schools": fixtures.schools(4, closed=(4,), extra=[("SCH005", "School 5", "Woden", "College", "2025-01-01", "Active")]),
              "students": fixtures.students(), "attendance": fixtures.attendance(month="2025-02-01", start=100),
              "assessment_results": fixtures.scores(year="2025", start=100),
              "school_events": fixtures.events(4, "2025-02-10")}
    fixtures.write_batch(raw, B2, second)
    jobs.run_batch(spark, str(raw), out, B1, "initial", job_run_id="1", as_of=day("2025-12-31"))
    for _ in range(2):
        jobs.run_batch(spark, str(raw), out, B2, "incremental", job_run_id="2", as_of=day("2025-12-31"))
    return jobs.Lake(spark, out)


def test_rule_counts_of_the_known_defects(lake, rows):
    results = lake.read("qa", "dq_validation_results")
    first = dict(rows(results.filter(F.col("batch_id") == B1), "rule_id", "failed_record_count"))
    assert [first[f"DQ{i:03d}"] for i in range(1, 11)] == [1, 1, 1, 4, 1, 0, 1, 0, 0, 0]
    second = dict(rows(results.filter(F.col("batch_id") == B2), "rule_id", "failed_record_count"))
    assert len(second) == 11 and second["DQ011"] == 1 and sum(second.values()) == 1
    assert results.filter("rule_id = 'DQ011'").filter(F.col("batch_id") == B2).first().status == "WARN"


def test_facts_exclude_the_quarantined_records(lake, rows):
    facts = lake.read("gold", "fact_attendance")
    assert rows(facts.groupBy("batch_id").count()) == [(B1, 15 - 5), (B2, 12)]
    assert rows(lake.read("gold", "fact_assessment_result").groupBy("batch_id").count()) == [(B1, 12), (B2, 12)]
    assert facts.filter("school_scd_key is null or student_batch_key is null").count() == 0
    assert lake.read("gold", "fact_defect").filter(F.col("batch_id") == B1).count() == 6
    dates = lake.current("gold", "dim_date")
    assert dates.count() == dates.select("date_key").distinct().count()


def test_school_history(lake, rows):
    schools = lake.current("gold", "dim_school")
    assert schools.count() == 6
    assert rows(schools.filter("school_id = 'SCH004'"), "status", "effective_to_date", "is_current") == [
        ("Active", dt.date(2026, 1, 14), False), ("Closed", None, True)]


def test_rerun_changes_nothing_and_views_add_up(spark, lake, rows):
    views = jobs.batch_views(spark, lake.root)
    detail = views["vw_data_quality_rule_detail"]
    assert rows(detail.groupBy("batch_id").count()) == [(B1, 11), (B2, 11)]
    by_month = views["vw_attendance_by_school_month"]
    facts = lake.read("gold", "fact_attendance")
    assert by_month.agg(F.sum("possible_days")).first() == facts.agg(F.sum("possible_days")).first()
    assert by_month.filter("attendance_band is null").count() == 0
    assert views["vw_assessment_by_domain"].agg(F.sum("assessment_count")).first()[0] == 24
    assert rows(lake.read("bronze", "students").groupBy("batch_id").count()) == [(B1, 14), (B2, 12)]
    recon = lake.read("qa", "row_count_reconciliation")
    assert recon.count() == 10 and recon.filter("reconciliation_status <> 'PASS'").count() == 0


def test_initial_run_replaces_gold(spark, tmp_path, rows):
    raw, out = tmp_path / "raw", str(tmp_path / "lake")
    for batch in (B1, B2):
        fixtures.write_batch(raw, batch, fixtures.with_defects())
    jobs.run_batch(spark, str(raw), out, B1, "initial", job_run_id="1", as_of=day("2025-12-31"))
    jobs.run_batch(spark, str(raw), out, B2, "initial", job_run_id="2", as_of=day("2025-12-31"))
    lake = jobs.Lake(spark, out)
    for table in ("fact_attendance", "fact_assessment_result", "dim_student", "data_quality_summary"):
        assert rows(lake.read("gold", table).select("batch_id").distinct()) == [(B2,)]
    assert rows(lake.current("gold", "dim_batch"), "batch_id") == [(B2,)]


def test_baseline_pipeline(spark, tmp_path):
    raw = tmp_path / "raw"
    fixtures.write_batch(raw, B1, fixtures.with_defects())
    staging = {}
    for dataset, name in jobs.RAW_FILES.items():
        read = readers.read_json_array if name.endswith("json") else readers.read_csv_text
        staging[dataset] = read(spark, f"{raw}/{dataset}/batch_id={B1}/{name}", dataset)
    out = jobs.run_baseline(spark, staging, str(tmp_path / "lake"), day("2025-12-31"))
    counts = {r.validation_id: r.failed_record_count for r in out["dq_validation_results"].collect()}
    assert [counts[f"DQ{i:03d}"] for i in range(1, 12)] == [1, 1, 1, 4, 1, 0, 1, 0, 0, 0, 0]
    assert out["hub_student"].count() == 13 and out["fact_attendance"].count() == 14
    invalid = out["vw_attendance_by_school"].agg(F.sum("invalid_attendance_records")).first()[0]
    assert invalid == 1 and out["dim_assessment_domain"].count() == 3
    with pytest.raises(Exception):
        jobs.run_baseline(spark, staging, str(tmp_path / "lake"), day("2025-12-31"))


def month_data(month, **changes):
    base = {"attendance": fixtures.attendance(month=f"{month}-01", start=100 * int(month[-2:])), "school_events": fixtures.events(2, f"{month}-05")}
    return {**base, **changes}


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("monthly")
    raw, out = root / "raw", str(root / "lake")
    fixtures.write_month(raw, "2024-01", "INITIAL_SNAPSHOT",
                         month_data("2024-01", schools=fixtures.schools(), students=fixtures.students()))
    moved = ("STU00001", "SCH003", "1", "Male", "2020-02-01", "Transferred")
    left = ("STU00001", "SCH003", "1", "Male", "2020-02-01", "Left")
    no_school = ("STU00050", "", "1", "Male", "2020-02-01", "Active")
    without_student_1 = [r for r in fixtures.attendance(month="2024-02-01", start=200) if r[1] != "STU00001"]
    fixtures.write_month(raw, "2024-02", "MONTHLY_CHANGE",
                         month_data("2024-02", students=[moved, left, no_school], attendance=without_student_1))
    att = fixtures.attendance(month="2024-03-01", start=300)
    bad = list(att[0]); bad[0], bad[5] = "ATT99001", "30"
    orphan = list(att[2]); orphan[0], orphan[1] = "ATT99002", "STU999999"
    noted = list(att[5]); noted[5], noted[6] = "20", "Illness"
    att[5] = tuple(noted)
    correction = list(fixtures.attendance(month="2024-01-01", start=100)[3]); correction[5] = "10"
    wrong = list(fixtures.scores()[0]); wrong[0], wrong[5] = "ASM99001", "999"
    fixtures.write_month(raw, "2024-03", "MONTHLY_CHANGE", month_data(
        "2024-03", schools=[("SCH004", "School 4", "Belconnen", "Primary", "1990-01-15", "Closed")],
        attendance=att + [bad, orphan, correction], assessment_results=fixtures.scores() + [wrong]))
    fixtures.write_month(raw, "2024-04", "MONTHLY_CHANGE", {"school_events": fixtures.events(1, "2024-04-05")})
    status = {}
    for month, mode in (("2024-01", "INITIAL_SNAPSHOT"), ("2024-02", "MONTHLY_CHANGE"), ("2024-03", "MONTHLY_CHANGE"),
                        ("2024-03", "MONTHLY_CHANGE"), ("2024-04", "MONTHLY_CHANGE")):
        status[month] = jobs.run_month(spark, str(raw), out, month, mode, minimum_rows=5)
    return jobs.Lake(spark, out), status


def test_month_readiness_and_gate(months, rows):
    lake, status = months
    assert status == {"2024-01": "READY", "2024-02": "READY_WITH_CAVEATS", "2024-03": "READY_WITH_CAVEATS",
                      "2024-04": "NOT_READY"}
    log = lake.spark.read.parquet(lake.path("audit", "pipeline_run"))
    assert log.filter("reporting_month = '2024-04' and run_status = 'FAILED'").count() == 1
    assert lake.read("silver", "attendance_monthly").filter("reporting_month = '2024-04'").count() == 0


def test_month_rejections_are_record_by_rule(months, rows):
    lake, _ = months
    rejected = lake.read("quality", "rejected_record")
    assert rows(rejected, "reporting_month", "rule_id", "business_key") == [
        ("2024-02", "STU_MISSING_SCHOOL_ID", "STU00050"),
        ("2024-03", "ASM_INVALID_SCORE", "ASM99001"), ("2024-03", "ATT_DUPLICATE_BUSINESS_KEY", "ATT99001"),
        ("2024-03", "ATT_INVALID_DAYS", "ATT99001"), ("2024-03", "ATT_UNKNOWN_STUDENT", "ATT99002")]
    notes = lake.read("quality", "reporting_caveat").filter("reporting_month = '2024-03'")
    assert ("ATT_ABSENCE_REASON_NO_ABSENCE",) in rows(notes, "caveat_code")


def test_month_state_and_correction(months, rows):
    lake, _ = months
    student = lake.current("silver", "student")
    assert rows(student.filter("student_id = 'STU00001'"), "status", "effective_from_month", "last_seen_reporting_month") == [
        ("Left", "2024-01", "2024-02")]
    assert student.count() == 12 and student.select("student_key").distinct().count() == 12
    status = lake.read("silver", "student_monthly_status")
    assert rows(status.groupBy("reporting_month").count()) == [("2024-01", 12), ("2024-02", 11), ("2024-03", 12)]
    attendance = lake.read("silver", "attendance_monthly")
    assert attendance.count() == attendance.select("attendance_id").distinct().count() == 12 + 11 + 12 + 0
    moved = attendance.filter("attendance_id = 'ATT00103'").first()
    assert (moved.reporting_month, moved.attended_days) == ("2024-03", 10)
    assert rows(lake.current("silver", "school").filter("status = 'Closed'"), "school_id") == [("SCH004",)]


def test_month_gold_and_views(spark, months, rows):
    lake, _ = months
    scores = lake.read("gold", "fact_assessment_result")
    assert scores.count() == 12 and scores.filter("attendance_band_key is null").count() == 0
    views = jobs.month_views(spark, lake.root)
    summary = views["vw_monthly_attendance_summary"]
    # Gold refreshes the slice of the month that ran: January still shows the record
    # that March's delivery moved, until January is run again.
    assert summary.agg(F.sum("attendance_record_count")).first()[0] == 36
    assert views["vw_monthly_reporting_readiness"].count() == 4
    assert views["vw_attendance_assessment_relationship"].count() == 12


def test_month_audit_and_validation(spark, months, rows):
    lake, _ = months
    audit = lake.read("audit", "row_count_reconciliation").filter("reporting_month = '2024-03'")
    got = {(r.layer_name, r.object_name): (r.source_row_count, r.target_row_count, r.reconciliation_status)
           for r in audit.collect()}
    assert len(got) == 9
    assert got["bronze_to_silver", "attendance_monthly"] == (15, 13, "FAIL")
    assert got["bronze_to_silver", "student_monthly_status"] == (12, 12, "PASS")
    assert got["silver_to_gold", "fact_assessment_result"] == (12, 12, "PASS")
    files = lake.read("audit", "file_load").filter("reporting_month = '2024-03'")
    assert ("attendance.csv", 15, 13, 2, "PARTIAL") in rows(
        files, "source_file_name", "source_row_count", "loaded_row_count", "rejected_row_count", "load_status")
    month = jobs.validate_month(spark, lake.root, "2024-03", "MONTHLY_CHANGE")
    summary = month["summary"].first()
    assert summary.reconciliation_interpretation == "EXPLAINED_BY_REJECTED_RECORDS"
    assert summary.validation_status == "MONTH_VALIDATED_WITH_CAVEATS"
    assert jobs.validate_month(spark, lake.root, "2024-03", "INITIAL_SNAPSHOT")["summary"].first().validation_status == "CHECK_LOAD_MODE"
    assert jobs.validate_month(spark, lake.root, "2024-04", "MONTHLY_CHANGE")["summary"].first().validation_status == "CHECK_PIPELINE_RUN"
    assert rows(month["checks"], "check_status")[0] == ("INFO",) or month["checks"].count() == 8
    assert month["details"].filter("detail_type = 'rejected_record'").count() == 4
    assert month["views"].filter("check_status = 'CHECK'").count() == 0


def test_rerun_of_an_old_month_keeps_later_months(spark, tmp_path, rows):
    raw, out = tmp_path / "raw", str(tmp_path / "lake")
    fixtures.write_month(raw, "2024-01", "INITIAL_SNAPSHOT",
                         month_data("2024-01", schools=fixtures.schools(), students=fixtures.students()))
    other = ["status", "gender", "extra", "school_id", "student_id", "enrolment_date", "year_level"]
    for month, level, status in (("2024-02", "5", "Active"), ("2024-03", "6", "Left")):
        fixtures.write_month(raw, month, "MONTHLY_CHANGE", month_data(month))
        fixtures.write_csv(raw / f"month={month}" / "students_delta.csv", "students",
                           [("STU00001", "SCH003", level, "Male", "2020-02-01", status)], other)
    assert jobs.run_pending(spark, str(raw), out, minimum_rows=5) == dict.fromkeys(
        ("2024-01", "2024-02", "2024-03"), "READY")
    assert jobs.run_pending(spark, str(raw), out, minimum_rows=5) == {}
    lake = jobs.Lake(spark, out)

    def state():
        status = lake.read("silver", "student_monthly_status").drop("validation_status")
        student = lake.current("silver", "student").drop("validation_status", "record_hash")
        return rows(status, *sorted(status.columns)), rows(student, *sorted(student.columns))

    before = state()
    key = lake.current("silver", "student").filter("student_id = 'STU00001'").first().student_key
    levels = rows(lake.read("silver", "student_monthly_status").filter(F.col("student_key") == key),
                  "reporting_month", "year_level", "student_status")
    assert levels == [("2024-01", 1, "Active"), ("2024-02", 5, "Active"), ("2024-03", 6, "Left")]
    jobs.run_month(spark, str(raw), out, "2024-02", "MONTHLY_CHANGE", minimum_rows=5)
    assert state() == before


def test_month_dimension_must_hold_the_month(spark):
    months = spark.createDataFrame([("2024-01",)], "reporting_month string")
    monthly.require_month(months, "2024-01")
    with pytest.raises(RuntimeError, match="month dimension is missing"):
        monthly.require_month(months, "2024-02")


def test_missing_file_stops_the_month(spark, tmp_path):
    fixtures.write_month(tmp_path / "raw", "2024-01", "INITIAL_SNAPSHOT", {})
    (tmp_path / "raw" / "month=2024-01" / "students.csv").unlink()
    with pytest.raises(FileNotFoundError, match="students.csv"):
        jobs.run_month(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), "2024-01", "INITIAL_SNAPSHOT")
