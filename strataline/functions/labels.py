"""Vocabularies and the labels, sort orders and texts derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, col

# Vocabularies of the source data.
SCHOOL_TYPES = ("Primary", "High School", "College", "Specialist")
SCHOOL_STATUSES = ("Active", "Closed")
STUDENT_STATUSES = ("Active", "Transferred", "Left")
ENROLLED_STATUSES = ("ACTIVE", "ENROLLED")
GENDERS = ("Female", "Male", "Non-specified")
DOMAINS = ("Reading", "Numeracy", "Writing")
BANDS = ("Low", "Medium", "High")
EVENT_TYPES = ("Attendance campaign", "Wellbeing program", "Assessment intervention")

# Display orders. Two reports order the domains differently.
DOMAIN_ORDER = ("Reading", "Writing", "Numeracy")
MONTHLY_DOMAIN_ORDER = DOMAINS
SEVERITY_ORDER = ("High", "Medium", "Low")
RESULT_STATUS_ORDER = ("FAIL", "WARN", "PASS")
DEFECT_STATUS_ORDER = ("Open", "In Progress", "Resolved", "Closed")

# Score range labels of the proficiency bands.
SCORE_RANGES = {"Low": "250 to 399", "Medium": "400 to 549", "High": "550 and above"}

# Table name patterns of affected areas, first match wins.
AREA_PATTERNS = (("%attendance%", "Attendance"), ("%assessment%", "Assessment"),
                 ("%student%", "Student reference"), ("%school_events%", "School events"))
AREA_DEFAULT = "School reference"

# Recommended action by severity.
ACTIONS = {
    "BLOCKER": "Stop reporting for this month until required data is loaded or corrected.",
    "ERROR": "Review source records and exclude invalid rows from trusted reporting.",
}
ACTION_DEFAULT = "Review caveat and decide whether dashboard users need a note."


def sort_order(c: ColumnOrName, vocabulary: Sequence[str], other: int = 99) -> Column:
    """1-based place in a vocabulary; ``other`` for anything else and null."""
    place = F.array_position(F.array(*[F.lit(v) for v in vocabulary]), col(c))
    return F.coalesce(F.nullif(place, F.lit(0).cast("bigint")), F.lit(other)).cast("int")


def lookup(c: ColumnOrName, table: dict[str, str], default: str | None = None) -> Column:
    """Value by key from a small constant table."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def year_level_label(level: ColumnOrName) -> Column:
    level = col(level)
    return F.when(level == 0, "Kindergarten").when(
        level.isNotNull(), F.concat(F.lit("Year "), level.cast("string")))


def cohort_group(level: ColumnOrName) -> Column:
    """Primary to 6, the year 7 transition, 8-10, senior above; null stays null."""
    level = col(level)
    return (F.when(level < 7, "Primary").when(level == 7, "Year 7 transition")
            .when(level < 11, "Years 8-10").when(level >= 11, "Senior secondary"))


def score_range_label(band: ColumnOrName) -> Column:
    return lookup(band, SCORE_RANGES, "Unknown")


def affected_area(table_name: ColumnOrName) -> Column:
    """Area of the first pattern that matches; the order of the patterns matters."""
    name = col(table_name)
    hits = [F.when(name.like(pattern), F.lit(area)) for pattern, area in AREA_PATTERNS]
    return F.coalesce(*hits, F.lit(AREA_DEFAULT))


def recommended_action(severity: ColumnOrName) -> Column:
    return lookup(severity, ACTIONS, ACTION_DEFAULT)


def caveat_text(description: ColumnOrName, count: ColumnOrName) -> Column:
    return F.concat(col(description), F.lit(" Failed record count: "),
                    col(count).cast("string"), F.lit("."))


def title_text(title: ColumnOrName, description: ColumnOrName) -> Column:
    return F.concat_ws(": ", col(title), col(description))
