"""Datasets, their columns and keys, shared by the pipelines."""

from __future__ import annotations

# Source columns, all read as text.
SOURCE_COLUMNS = {
    "schools": ("school_id", "school_name", "region", "school_type", "open_date", "status"),
    "students": ("student_id", "school_id", "year_level", "gender", "enrolment_date", "status"),
    "attendance": ("attendance_id", "student_id", "school_id", "attendance_month", "possible_days",
                   "attended_days", "absence_reason"),
    "assessment_results": ("assessment_id", "student_id", "school_id", "assessment_year", "domain",
                           "score", "proficiency_band"),
    "school_events": ("event_id", "school_id", "event_type", "event_date", "description"),
}

RECORD_KEY = {
    "schools": "school_id",
    "students": "student_id",
    "attendance": "attendance_id",
    "assessment_results": "assessment_id",
    "school_events": "event_id",
}

INT_COLUMNS = {"year_level", "possible_days", "attended_days", "assessment_year", "score"}
DATE_COLUMNS = {"open_date", "enrolment_date", "attendance_month", "event_date"}

LINEAGE = ("batch_id", "run_id", "load_timestamp", "source_file_name", "bronze_record_id")

SCORE_RANGE = (250, 700)
ATTENDANCE_KEY = ("student_id", "school_id", "attendance_month")


def text_schema(dataset: str) -> str:
    return ", ".join(f"{c} string" for c in SOURCE_COLUMNS[dataset])
