"""Staging, lineage, keys, deduplication, vault."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..functions.text import blank_to_null, clean, or_default, to_day, to_decimal, to_int
from ..operators import numbering, rows
from ..operators.quality import union_all
from ..operators.reconcile import require_no_identifiers
from ..plans import assured, baseline
from ..sources.readers import json_field
from . import bindings as b
from .ctes import LINE_TAIL
from .registry import register


@register("typed_staging", "stg_attendance", "SELECT * FROM stg_attendance")
def typed_staging(spark, folder):
    return b.staged(spark, folder)["attendance"].drop("source_file_name")


@register("typed_text", "raw_students", """
SELECT trim(student_id) AS student_id, NULLIF(trim(student_id), '') AS id_or_null,
       coalesce(NULLIF(trim(school_id), ''), 'Unknown school') AS school_or_default,
       TRY_CAST(trim(year_level) AS INTEGER) AS year_level,
       CAST(TRY_CAST(trim(year_level) AS INTEGER) AS DECIMAL(6,2)) AS year_level_decimal,
       TRY_CAST(enrolment_date AS DATE) AS enrolment_date FROM raw_students""")
def typed_text(spark, folder):
    return b.students(spark, folder).select(
        clean("student_id").alias("student_id"), blank_to_null("student_id").alias("id_or_null"),
        or_default("school_id", "Unknown school").alias("school_or_default"),
        to_int("year_level").alias("year_level"),
        to_decimal("year_level", 6, 2).alias("year_level_decimal"),
        to_day("enrolment_date").alias("enrolment_date"))


@register("json_extract", "", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_extract(spark, folder):
    return b.table(spark, folder, "events").select("event_id", to_int(json_field("props", "k")).alias("k"))


@register("lineage_stamp", "raw_attendance", """
SELECT attendance_id, batch_id, 'dev_batch_run' AS run_id, 'attendance.csv' AS source_file_name,
       sha256(attendance_id || '||attendance.csv||' || batch_id || '||dev_batch_run') AS bronze_record_id
FROM raw_attendance""")
def lineage_stamp(spark, folder):
    return b.bronze(spark, folder)["attendance"].select(
        "attendance_id", "batch_id", "run_id", "source_file_name", "bronze_record_id")


@register("hash_keys", "", """
SELECT c_custkey, sha256(c_name) AS natural_key,
       sha256(coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END, '') || '||' || c_nationkey) AS composite_key,
       sha256(c_name || '||' || c_mktsegment || '||' || c_nationkey) AS attribute_hash
FROM customer""")
def hash_keys(spark, folder):
    return b.table(spark, folder, "customer").select(
        "c_custkey", hash_key("c_name").alias("natural_key"),
        hash_key(F.when(F.col("c_acctbal") >= 0, F.col("c_name")), "c_nationkey").alias("composite_key"),
        hash_key("c_name", "c_mktsegment", "c_nationkey").alias("attribute_hash"))


def _customer_keys(spark, folder):
    customer = b.table(spark, folder, "customer")
    held = customer.filter("c_acctbal >= 5000").select(
        "c_name", (F.col("c_custkey") + 1).alias("customer_key"))
    return numbering.extend_surrogates(held, customer, "c_name", "customer_key")


_CUSTOMER_KEYS = """
SELECT c_name, c_custkey + 1 AS customer_key FROM customer WHERE c_acctbal >= 5000
UNION ALL
SELECT c_name, (SELECT max(c_custkey + 1) FROM customer WHERE c_acctbal >= 5000)
       + row_number() OVER (ORDER BY substr(sha256(c_name), 1, 3), c_name)
FROM customer WHERE c_acctbal < 5000"""


@register("stable_surrogate", "", _CUSTOMER_KEYS)
def stable_surrogate(spark, folder):
    return _customer_keys(spark, folder)


@register("key_map", "", f"""
WITH k AS ({_CUSTOMER_KEYS})
SELECT k.customer_key, o.o_orderkey, o.o_totalprice, m.first_day AS effective_from_date, m.last_day AS last_seen_date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN k ON k.c_name = c.c_name
JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day
      FROM orders GROUP BY 1) m ON m.o_custkey = o.o_custkey""")
def key_map(spark, folder):
    customer = b.table(spark, folder, "customer").select("c_custkey", "c_name")
    orders = b.table(spark, folder, "orders").join(
        customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "day", F.col("o_orderdate").cast("date")).select("c_name", "o_orderkey", "o_totalprice", "day")
    dated = numbering.key_map_with_dates(_customer_keys(spark, folder), orders, "c_name", "day")
    replaced = orders.drop("day").join(dated, "c_name", "left").select(
        "customer_key", "o_orderkey", "o_totalprice", "effective_from_date", "last_seen_date")
    return require_no_identifiers(replaced, "key_map", ("c_name", "c_custkey", "o_custkey"))


@register("ordered_surrogate", "", """
SELECT row_number() OVER (ORDER BY c_mktsegment, c_nationkey) AS group_key, c_mktsegment, c_nationkey, n AS members
FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2)""")
def ordered_surrogate(spark, folder):
    groups = b.table(spark, folder, "customer").groupBy("c_mktsegment", "c_nationkey").agg(
        F.count(F.lit(1)).alias("members"))
    return numbering.dense_order_numbers(groups, ["c_mktsegment", "c_nationkey"], "group_key")


@register("dedupe_latest", "b_attendance", "SELECT * FROM b_attendance")
def dedupe_latest(spark, folder):
    return b.silver(spark, folder)["attendance"].drop("run_id", "load_timestamp", "source_file_name")


@register("dedupe_latest_students", "b_students", "SELECT * FROM b_students")
def dedupe_latest_students(spark, folder):
    return b.silver(spark, folder)["students"].drop("run_id", "load_timestamp", "source_file_name")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"
_LINE_ROW = ("lpad(CAST(l_partkey AS VARCHAR), 12, '0') || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') || "
             + LINE_TAIL)


def _lines(spark, folder):
    return b.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        b.line_order(("l_partkey", 12), ("l_suppkey", 12)).alias("row_order"))


@register("dup_all_members", "", f"""
SELECT {_LINE} FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
WHERE n > 1""")
def dup_all_members(spark, folder):
    return rows.duplicate_members(_lines(spark, folder), ["l_orderkey", "l_linenumber"]).drop("row_order")


@register("dup_surplus", "", f"""
SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ROW}) AS n
                     FROM lineitem) WHERE n > 1""")
def dup_surplus(spark, folder):
    return rows.surplus_rows(_lines(spark, folder), ["l_orderkey", "l_linenumber"], "row_order").drop("row_order")


@register("dup_keys", "", """
SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_keys(spark, folder):
    return rows.duplicated_keys(_lines(spark, folder), ["l_orderkey", "l_linenumber"])


@register("vault_hub", "raw_schools raw_students raw_scores raw_events", """
SELECT DISTINCT 'hub_school' AS hub, school_id AS business_key, 'schools.csv' AS record_source FROM raw_schools
UNION ALL SELECT DISTINCT 'hub_student', student_id, 'students.csv' FROM raw_students WHERE trim(student_id) <> ''
UNION ALL SELECT DISTINCT 'hub_assessment', assessment_id, 'assessment_results.csv' FROM raw_scores
WHERE trim(assessment_id) <> ''
UNION ALL SELECT DISTINCT 'hub_event', event_id, 'school_events.csv' FROM raw_events""")
def vault_hub(spark, folder):
    vault = baseline.build_vault(b.staged(spark, folder))
    keys = {"hub_school": "school_id", "hub_student": "student_id", "hub_assessment": "assessment_id",
            "hub_event": "event_id"}
    return union_all([
        vault[name].select(F.lit(name).alias("hub"), F.col(key).alias("business_key"), "record_source")
        for name, key in keys.items()])


@register("vault_link", "raw_schools raw_students raw_scores raw_events", """
SELECT DISTINCT 'link_student_school' AS link, student_id AS first_key, school_id AS second_key FROM raw_students
WHERE trim(student_id) <> '' AND trim(school_id) <> '' AND school_id IN (SELECT school_id FROM raw_schools)
UNION ALL SELECT DISTINCT 'link_student_assessment', student_id, assessment_id FROM raw_scores
WHERE trim(assessment_id) <> '' AND student_id IN (SELECT student_id FROM raw_students WHERE trim(student_id) <> '')
UNION ALL SELECT DISTINCT 'link_school_event', school_id, event_id FROM raw_events
WHERE school_id IN (SELECT school_id FROM raw_schools)""")
def vault_link(spark, folder):
    vault = baseline.build_vault(b.staged(spark, folder))
    keys = {"link_student_school": ("student_id", "school_id"),
            "link_student_assessment": ("student_id", "assessment_id"),
            "link_school_event": ("school_id", "event_id")}
    return union_all([
        vault[name].select(F.lit(name).alias("link"), F.col(x).alias("first_key"), F.col(y).alias("second_key"))
        for name, (x, y) in keys.items()])


@register("vault_satellite_details", "a_student", "SELECT *, 'students.csv' AS record_source FROM a_student")
def vault_satellite_details(spark, folder):
    return baseline.build_vault(b.staged(spark, folder))["sat_student_details"]


@register("vault_satellite_schools", "stg_schools",
          "SELECT DISTINCT *, 'schools.csv' AS record_source FROM stg_schools")
def vault_satellite_schools(spark, folder):
    return baseline.build_vault(b.staged(spark, folder))["sat_school_details"]


@register("vault_satellite_records", "stg_attendance stg_scores stg_events", """
SELECT 'sat_attendance_record' AS satellite, attendance_id AS record_id, student_id AS owner_id, school_id,
       possible_days AS measure FROM stg_attendance WHERE trim(attendance_id) <> ''
UNION ALL SELECT 'sat_assessment_result', assessment_id, student_id, school_id, score FROM stg_scores
WHERE trim(assessment_id) <> ''
UNION ALL SELECT 'sat_event_details', event_id, NULL, school_id, NULL FROM stg_events WHERE trim(event_id) <> ''""")
def vault_satellite_records(spark, folder):
    vault = baseline.build_vault(b.staged(spark, folder))

    def shape(name, key, owner, measure):
        return vault[name].select(
            F.lit(name).alias("satellite"), F.col(key).alias("record_id"), owner.alias("owner_id"),
            "school_id", measure.alias("measure"))

    none = F.lit(None)
    return union_all([
        shape("sat_attendance_record", "attendance_id", F.col("student_id"), F.col("possible_days")),
        shape("sat_assessment_result", "assessment_id", F.col("student_id"), F.col("score")),
        shape("sat_event_details", "event_id", none.cast("string"), none.cast("int"))])
