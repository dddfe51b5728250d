"""The test tables dressed as the source datasets, and the same in SQL.

supplier stands in for schools, customer for students, lineitem for attendance,
orders for assessment results, events for school events. Every row of a table
becomes a row of its dataset. Defects are injected by key: missing ids, unknown
parents, bad text, values outside their vocabulary. ``ctes`` states the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans import assured, baseline
from ..sources import model
from ..session import apply_settings, materialise

AS_OF = "2001-06-30"  # the injected "today": some months lie after it
BATCH_1, BATCH_2 = "2025-01-15", "2026-01-15"
CUT_DAY = "1998-06-01"  # ship and order days before it are batch 1
EVENT_CUT = "2024-01-16"
RUN_ID = "dev_batch_run"


class Frames(Mapping):
    """Frames by name, each one declared when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._frames = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name]()
        return self._frames[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


def stored(frames: Frames, *names: str) -> Frames:
    """The layer with its large tables materialised on first use: the pipelines store
    a layer before they read it several times. Made anew for every query."""
    def build(name: str) -> DataFrame:
        return materialise(frames[name]) if name in names else frames[name]

    return Frames({name: lambda name=name: build(name) for name in frames})


# ``cache`` below keeps declared plans per session, not data: queries of one
# session share the declaration of a layer and each of them still runs it.

@cache
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _text(c: Column) -> Column:
    return c.cast("string")


def _every(c: str, n: int, at: int) -> Column:
    return F.col(c) % n == at


def line_order(*first: tuple[str, int]) -> Column:
    """Every column of a lineitem as one sortable text: the load order of a table
    without a row number. Lines can share their keys, so all columns take part."""
    def padded(c: Column, width: int) -> Column:
        return F.lpad(_text(c), width, "0")

    def hundredths(c: str, width: int) -> Column:
        return padded(F.round(F.col(c) * 100).cast("bigint"), width)

    return F.concat(
        *[padded(F.col(c), width) for c, width in first], _text(F.col("l_shipdate").cast("date")),
        hundredths("l_quantity", 6), hundredths("l_extendedprice", 12), hundredths("l_discount", 3),
        hundredths("l_tax", 3), "l_returnflag", "l_linestatus")


def _prefixed(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), _text(c))


def _school_fields() -> dict[str, Column]:
    kind = F.col("s_nationkey") % 4
    return {
        "school_id": _prefixed("SCH", F.col("s_suppkey")),
        "school_name": F.col("s_name"),
        "region": F.col("r_name"),
        "school_type": (F.when(kind == 0, "Primary").when(kind == 1, "High School")
                        .when(kind == 2, "College").otherwise("Specialist")),
        "open_date": F.concat(_text(1980 + F.col("s_suppkey") % 20), F.lit("-0"),
                              _text(1 + F.col("s_suppkey") % 9), F.lit("-15")),
        "status": (F.when(F.col("s_acctbal") < 0, "Closed").when(_every("s_suppkey", 97, 5), "Paused")
                   .otherwise("Active")),
    }


def _located(supplier: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(*[c.alias(n) for n, c in _school_fields().items()])
    )


@cache
def schools(spark: SparkSession, folder: str) -> DataFrame:
    return _located(table(spark, folder, "supplier"), spark, folder)


@cache
def schools_second(spark: SparkSession, folder: str) -> DataFrame:
    """The next delivery: suppliers with a balance under 1000 are closed now."""
    later = F.when(F.col("s_acctbal") < 1000, -1.0).otherwise(F.col("s_acctbal"))
    return _located(table(spark, folder, "supplier").withColumn("s_acctbal", later), spark, folder)


def _students_of(customer: DataFrame, *extra: Column) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return customer.select(
        F.when(key % 97 == 13, "").otherwise(_prefixed("STU", key)).alias("student_id"),
        F.when(key % 101 == 7, " ").when(key % 103 == 11, "SCH999999999")
        .otherwise(_prefixed("SCH", key % 50)).alias("school_id"),
        F.when(key % 89 == 3, "x").otherwise(_text(key % 13)).alias("year_level"),
        F.when(nation % 3 == 0, "Female").when(nation % 3 == 1, " Male ")
        .otherwise("Non-specified").alias("gender"),
        F.when(key % 83 == 2, "not a date").otherwise(
            F.concat(_text(2010 + key % 10), F.lit("-02-0"), _text(1 + key % 9)))
        .alias("enrolment_date"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Left")
        .when(F.col("c_mktsegment") == "MACHINERY", "Transferred").otherwise("Active").alias("status"),
        *extra)


@cache
def students(spark: SparkSession, folder: str) -> DataFrame:
    return _students_of(table(spark, folder, "customer"))


@cache
def attendance_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Attendance with its batch and month id, from every lineitem."""
    possible = F.when(F.month("l_shipdate") == 1, F.lit(0)).otherwise(F.col("l_quantity").cast("int"))
    flag = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("ATT"), _text(F.col("l_orderkey")), F.lit("-"), _text(F.col("l_linenumber")))
        .alias("attendance_id"),
        F.when(_every("l_orderkey", 113, 5), "").otherwise(_prefixed("STU", F.col("l_partkey")))
        .alias("student_id"),
        _prefixed("SCH", F.col("l_suppkey")).alias("school_id"),
        F.when(_every("l_orderkey", 127, 9), "unknown")
        .otherwise(F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd")).alias("attendance_month"),
        F.when(_every("l_orderkey", 97, 4), "n/a").otherwise(_text(possible)).alias("possible_days"),
        _text(possible - F.col("l_linenumber") % 4).alias("attended_days"),
        F.when(flag == "A", "Illness").when(flag == "R", "Family").otherwise("").alias("absence_reason"),
        F.when(F.col("l_shipdate") < CUT_DAY, BATCH_1).otherwise(BATCH_2).alias("batch_id"),
        F.date_format("l_shipdate", "yyyy-MM").alias("reporting_month"),
        line_order(("l_orderkey", 12), ("l_linenumber", 2), ("l_partkey", 12), ("l_suppkey", 12))
        .alias("raw_row_number"),
    )


@cache
def attendance(spark: SparkSession, folder: str) -> DataFrame:
    return attendance_rows(spark, folder).drop("batch_id", "reporting_month", "raw_row_number")


@cache
def assessment_rows(spark: SparkSession, folder: str) -> DataFrame:
    key, priority, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.when(key % 109 == 8, "").otherwise(_prefixed("ASM", key)).alias("assessment_id"),
        F.when(key % 97 == 6, "STU999999999").otherwise(_prefixed("STU", F.col("o_custkey")))
        .alias("student_id"),
        _prefixed("SCH", F.col("o_custkey") % 50).alias("school_id"),
        _text(F.year("o_orderdate")).alias("assessment_year"),
        F.when(priority.isin("1-URGENT", "4-NOT SPECIFIED"), "Reading")
        .when(priority == "2-HIGH", "Numeracy").when(priority == "3-MEDIUM", "Writing")
        .otherwise("Science").alias("domain"),
        F.when(key % 89 == 1, "abc").otherwise(_text(250 + key % 500)).alias("score"),
        F.when(key % 83 == 0, "Unknown").when(status == "F", "Low").when(status == "O", "Medium")
        .otherwise("High").alias("proficiency_band"),
        F.when(F.col("o_orderdate") < CUT_DAY, BATCH_1).otherwise(BATCH_2).alias("batch_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("reporting_month"),
        key.alias("raw_row_number"),
    )


@cache
def assessment_results(spark: SparkSession, folder: str) -> DataFrame:
    return assessment_rows(spark, folder).drop("batch_id", "reporting_month", "raw_row_number")


@cache
def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        _prefixed("EVT", F.col("event_id")).alias("event_id"),
        _prefixed("SCH", F.col("user_id")).alias("school_id"),
        F.when(kind == "view", "Attendance campaign").when(kind == "click", "Wellbeing program")
        .when(kind == "purchase", "Assessment intervention").otherwise(kind).alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"),
        F.col("props").alias("description"),
        F.when(F.col("ts") < EVENT_CUT, BATCH_1).otherwise(BATCH_2).alias("batch_id"),
        F.date_format("ts", "yyyy-MM").alias("reporting_month"),
        F.col("event_id").alias("raw_row_number"),
    )


@cache
def school_events(spark: SparkSession, folder: str) -> DataFrame:
    return event_rows(spark, folder).drop("batch_id", "reporting_month", "raw_row_number")


@cache
def batched_students(spark: SparkSession, folder: str) -> DataFrame:
    """Both batches: the first lists customers in credit, the second everyone."""
    customer = table(spark, folder, "customer")
    first = _students_of(customer.filter("c_acctbal >= 0")).withColumn("batch_id", F.lit(BATCH_1))
    return first.unionByName(_students_of(customer).withColumn("batch_id", F.lit(BATCH_2)))


@cache
def batched_schools(spark: SparkSession, folder: str) -> DataFrame:
    first = schools(spark, folder).withColumn("batch_id", F.lit(BATCH_1))
    return first.unionByName(schools_second(spark, folder).withColumn("batch_id", F.lit(BATCH_2)))


# ---------------------------------------------------------------- pipelines over the bound tables

@cache
def staged(spark: SparkSession, folder: str) -> Frames:
    """The baseline pipeline's typed staging."""
    raw = {"schools": schools, "students": students, "attendance": attendance,
           "assessment_results": assessment_results, "school_events": school_events}
    return Frames({
        name: lambda name=name, build=build: baseline.stage(build(spark, folder), name, f"{name}.csv")
        for name, build in raw.items()})


@cache
def bronze(spark: SparkSession, folder: str) -> Frames:
    """The assured pipeline's bronze, both batches, with a fixed load time."""
    raw = {"schools": batched_schools, "students": batched_students, "attendance": attendance_rows,
           "assessment_results": assessment_rows, "school_events": event_rows}

    def stamped(name: str) -> DataFrame:
        return assured.stamp(raw[name](spark, folder), name, F.col("batch_id"), F.lit(RUN_ID),
                             F.lit(f"{name}.csv"), F.lit("2026-01-15 00:00:00").cast("timestamp"))

    return Frames({name: lambda name=name: stamped(name) for name in raw})


@cache
def silver(spark: SparkSession, folder: str) -> Frames:
    source = bronze(spark, folder)
    return Frames({name: lambda name=name: assured.conform(source[name], name) for name in source})


def _sliced(df: DataFrame, dataset: str, month: Column, row: Column) -> DataFrame:
    return df.select(
        *model.SOURCE_COLUMNS[dataset], month.alias("reporting_month"),
        F.replace(month, F.lit("-"), F.lit("_")).alias("source_batch_id"),
        F.lit(f"{dataset}.csv").alias("source_file_name"), _text(row).alias("raw_row_number"))


SNAPSHOT_MONTH = "1995-01"


def _monthly_schools(spark: SparkSession, folder: str) -> DataFrame:
    number = F.regexp_extract("school_name", "([0-9]+)$", 1).cast("bigint")
    return _sliced(schools(spark, folder), "schools", F.lit(SNAPSHOT_MONTH), number)


def _monthly_students(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    month = F.concat(_text(1995 + key % 7), F.lit("-"), F.lpad(_text(1 + key % 12), 2, "0"))
    rows = _students_of(table(spark, folder, "customer"), key.alias("_key"), month.alias("_month"))
    return _sliced(rows, "students", F.col("_month"), F.col("_key"))


@cache
def monthly_bronze(spark: SparkSession, folder: str) -> Frames:
    """Monthly slices. Schools arrive in the snapshot month, students spread over
    seven years, the others in the month of their date."""
    def dated(rows: Callable, name: str) -> Callable[[], DataFrame]:
        return lambda: _sliced(rows(spark, folder), name, F.col("reporting_month"), F.col("raw_row_number"))

    return Frames({
        "schools": lambda: _monthly_schools(spark, folder),
        "students": lambda: _monthly_students(spark, folder),
        "attendance": dated(attendance_rows, "attendance"),
        "assessment_results": dated(assessment_rows, "assessment_results"),
        "school_events": dated(event_rows, "school_events"),
    })


@cache
def slices(spark: SparkSession, folder: str) -> DataFrame:
    """Every calendar month from the first to the last ship date, and those of events."""
    span = table(spark, folder, "lineitem").agg(
        F.trunc(F.min("l_shipdate"), "month").alias("a"), F.trunc(F.max("l_shipdate"), "month").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("d"))
    months = months.union(table(spark, folder, "events").select(F.trunc("ts", "month"))).distinct()
    return months.select(F.date_format("d", "yyyy-MM").alias("reporting_month"),
                         F.date_format("d", "yyyy_MM").alias("source_batch_id"))


@cache
def known_students(spark: SparkSession, folder: str) -> DataFrame:
    """The conformed students before these slices: customers in credit."""
    return table(spark, folder, "customer").filter("c_acctbal >= 0").select(
        _prefixed("STU", F.col("c_custkey")).alias("student_id"))
