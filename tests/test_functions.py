from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strataline.functions import bands, checks, dates, labels, ratios, text
from strataline.functions.keys import hash_key


def one(spark, *columns, row=(None,), schema="x string"):
    return tuple(spark.createDataFrame([row], schema).select(*columns).first())


def test_text(spark):
    got = one(spark, text.clean("x"), text.blank_to_null("x"), text.or_default("x", "d"), text.is_blank("x"),
              row=("  ",))
    assert got == ("", None, "d", True)
    assert one(spark, text.is_blank("x"), row=(None,)) == (True,)
    assert one(spark, text.to_int("x"), row=(" 12 ",)) == (12,)
    for bad in ("12.0", "", "x", None):
        assert one(spark, text.to_int("x"), row=(bad,)) == (None,)
    assert one(spark, text.to_decimal("x", 6, 2), row=("12.345",)) == (Decimal("12.35"),)
    assert one(spark, text.to_day("x"), text.to_day_any("x"), row=("2024-02-30",)) == (None, None)
    assert one(spark, text.to_day("x"), row=("2024-02-29",)) == (dt.date(2024, 2, 29),)


def test_checks_never_null(spark):
    df = spark.createDataFrame([(None, 1), (-1, -1), (5, 6), (5, 5), (0, 0)], "p int, a int")
    assert [r[0] for r in df.select(checks.bad_day_counts("p", "a")).collect()] == [True, True, True, False, False]
    assert one(spark, checks.outside_vocabulary("x", ("a",)), row=(None,)) == (True,)
    assert one(spark, checks.outside_vocabulary("x", ("a",)), row=("a",)) == (False,)
    assert one(spark, checks.missing_or_outside("x", 250, 700), row=(None,), schema="x int") == (True,)
    assert one(spark, checks.after_day("x", F.lit("2024-01-01").cast("date")),
               checks.after_day("x", F.lit("2024-01-01").cast("date"), null_fails=True),
               row=(None,), schema="x date") == (False, True)
    assert one(spark, checks.status_in("x", ("ACTIVE",)), row=("active",)) == (True,)


def test_ratios_guard_zero(spark):
    df = spark.createDataFrame([(2, 3), (1, 0), (None, 4)], "n int, d int")
    assert [r[0] for r in df.select(ratios.ratio_double("n", "d")).collect()] == [0.6667, None, None]
    assert [r[0] for r in df.select(ratios.ratio_decimal("n", "d")).collect()] == [Decimal("0.6667"), None, None]
    assert [r[0] for r in df.select(ratios.complement_decimal("n", "d")).collect()][0] == Decimal("0.3333")
    assert [r[0] for r in df.select(ratios.percent("n", "d")).collect()][0] == 66.67


def test_bands_keep_unknown_apart(spark):
    df = spark.createDataFrame([(81, 100), (82, 100), (90, 100), (0, 0), (None, None)], "a int, p int")
    assert [r[0] for r in df.select(bands.monthly_attendance_band("a", "p")).collect()] == [
        "Low", "Medium", "High", None, None]
    assert [tuple(r) for r in df.select(bands.report_attendance_band("a", "p"),
                                        bands.report_attendance_band_order("a", "p")).collect()] == [
        ("80% to below 85%", 2), ("80% to below 85%", 2), ("90% and above", 4), ("No possible days", 0), (None, None)]
    assert one(spark, bands.SCORE.label("x"), row=(400,), schema="x int") == ("Medium",)


def test_dates(spark):
    day = (dt.date(2024, 1, 31),)
    got = one(spark, dates.date_key("d"), dates.prior_month_key("d"), dates.school_term("d"), dates.season("d"),
              dates.is_winter("d"), dates.month_name("d"), dates.month_short_name("d"), row=day, schema="d date")
    assert got == (20240131, 202312, "Summer break", "Summer", False, "January", "Jan")
    assert one(spark, dates.month_key("x"), dates.month_start("x"), row=("2024-02",)) == (
        202402, dt.date(2024, 2, 1))


def test_labels(spark):
    got = one(spark, labels.sort_order("x", labels.DOMAIN_ORDER), labels.score_range_label("x"), row=("Writing",))
    assert got == (2, "Unknown")
    assert one(spark, labels.sort_order("x", labels.DOMAIN_ORDER), row=(None,)) == (99,)
    assert one(spark, labels.affected_area("x"), row=("bronze.student_attendance",)) == ("Attendance",)
    levels = spark.createDataFrame([(0,), (6,), (7,), (10,), (11,), (None,)], "l int")
    assert [r[0] for r in levels.select(labels.cohort_group("l")).collect()] == [
        "Primary", "Primary", "Year 7 transition", "Years 8-10", "Senior secondary", None]


def test_hash_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    hashes = [r[0] for r in df.select(hash_key("x", "y", "z")).collect()]
    assert hashes[0] != hashes[1]
