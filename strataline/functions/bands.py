"""Threshold scales: ordered (upper bound, label) steps with a label above the last."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .ratios import ratio_exact
from .text import ColumnOrName, col


@dataclass(frozen=True)
class Scale:
    steps: tuple[tuple[float, str], ...]
    top: str

    def label(self, value: ColumnOrName) -> Column:
        """Label of the step the value falls under; null stays null."""
        value = col(value)
        out = None
        for bound, name in self.steps:
            out = F.when(value < bound, name) if out is None else out.when(value < bound, name)
        return F.when(value.isNotNull(), out.otherwise(self.top))

    def position(self, value: ColumnOrName) -> Column:
        """1-based position on the scale; null stays null."""
        value = col(value)
        above = sum(((value >= bound).cast("int") for bound, _ in self.steps), F.lit(1))
        return above.cast("int")


# The thresholds and labels of the reports.
MONTHLY_ATTENDANCE = Scale(((0.82, "Low"), (0.90, "Medium")), "High")
REPORT_ATTENDANCE = Scale(
    ((0.80, "Below 80%"), (0.85, "80% to below 85%"), (0.90, "85% to below 90%")),
    "90% and above",
)
SCORE = Scale(((400, "Low"), (550, "Medium")), "High")
AVERAGE_SCORE = Scale(((400, "Below 400"), (550, "400 to below 550")), "550 and above")
NO_POSSIBLE_DAYS = "No possible days"
CHRONIC_ABSENCE_BELOW = 0.9
AT_RISK_BELOW = 0.80


def monthly_attendance_band(attended: ColumnOrName, possible: ColumnOrName) -> Column:
    """Low / Medium / High of one record; null without possible days."""
    return MONTHLY_ATTENDANCE.label(ratio_exact(attended, possible))


def report_attendance_band(attended: ColumnOrName, possible: ColumnOrName) -> Column:
    """Band of summed days. Zero possible days have a band of their own and
    unknown days have none (a null sum is not "90% and above")."""
    return F.when(col(possible) == 0, NO_POSSIBLE_DAYS).otherwise(
        REPORT_ATTENDANCE.label(ratio_exact(attended, possible)))


def report_attendance_band_order(attended: ColumnOrName, possible: ColumnOrName) -> Column:
    return F.when(col(possible) == 0, F.lit(0)).otherwise(
        REPORT_ATTENDANCE.position(ratio_exact(attended, possible)))
