"""Completeness of a monthly delivery: expected files against the files present."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Files a month must bring, by load mode.
EXPECTED_FILES = {
    "INITIAL_SNAPSHOT": ("schools.csv", "students.csv", "attendance.csv", "assessment_results.csv",
                         "school_events.json"),
    "MONTHLY_CHANGE": ("schools_delta.csv", "students_delta.csv", "attendance.csv",
                       "assessment_results_delta.csv", "school_events.json"),
}
READY_MARKER = "_READY.json"


def list_files(spark: SparkSession, root: str, month: str | None = None) -> DataFrame:
    """(reporting_month, file_name, file_size) below ``month=`` folders, or below that
    of one month. Only the listing is read: the content column is pruned."""
    folder = root if month is None else f"{root}/month={month}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "reporting_month string, file_name string, file_size bigint")
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
             .select("path", F.col("length").alias("file_size")))
    return found.select(
        F.regexp_extract("path", r"month=([^/]+)/", 1).alias("reporting_month"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "file_size")


def ready_months(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(month, load mode) of every delivery whose ready marker is there, in order.

    File sources skip names that start with an underscore, so the markers are
    listed through the file system: one small file per month.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/month=*/{READY_MARKER}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in fs.globStatus(pattern) or []:
        stream = fs.open(status.getPath())
        try:
            marker = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if marker["load_mode"] not in EXPECTED_FILES:
            raise ValueError(f"Unsupported load_mode: {marker['load_mode']}")
        out.append((marker["reporting_month"], marker["load_mode"]))
    return sorted(out)


def expected_files(spark: SparkSession, months: Sequence[tuple[str, str]]) -> DataFrame:
    """(reporting_month, load_mode, file_name) from (month, mode) pairs."""
    rows = [(month, mode, name) for month, mode in months for name in EXPECTED_FILES[mode]]
    return spark.createDataFrame(rows, "reporting_month string, load_mode string, file_name string")


def missing_files(expected: DataFrame, present: DataFrame) -> DataFrame:
    return expected.join(present.select("reporting_month", "file_name"),
                         ["reporting_month", "file_name"], "left_anti")


def month_completeness(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected and present counts per month with COMPLETE or INCOMPLETE."""
    seen = present.select("reporting_month", "file_name").distinct().withColumn("_seen", F.lit(1))
    return (
        expected.join(seen, ["reporting_month", "file_name"], "left")
        .groupBy("reporting_month", "load_mode")
        .agg(F.count(F.lit(1)).alias("expected_count"), F.count("_seen").alias("present_count"))
        .withColumn("manifest_status",
                    F.when(F.col("expected_count") == F.col("present_count"), "COMPLETE")
                    .otherwise("INCOMPLETE"))
    )
