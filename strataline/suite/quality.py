"""The three rule packs and what follows from their results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels
from ..functions.text import json_payload
from ..operators import matching, quality
from ..operators.quality import union_all
from ..plans import assured, baseline, monthly
from ..sources import model
from . import bindings as b
from .registry import register

MINIMUM_ROWS = 700  # the volume threshold, scaled to the stand-in months


class Assured:
    """Silver tables, marks, results and failed records of the assured pipeline."""

    def __init__(self, spark, folder, stored=("attendance", "assessment_results")):
        """``stored``: the silver tables the query reads more than once."""
        self.silver = b.stored(b.silver(spark, folder), *stored)
        self.rules = assured.quality_rules(b.as_of())
        self.marked = assured.mark(self.silver)

    @property
    def results(self):
        return assured.validation_results(self.marked, self.rules, F.lit(b.RUN_ID))

    @property
    def failed(self):
        return assured.failed_record_rows(self.marked, self.rules, F.lit(b.RUN_ID))


def monthly_run(spark, folder, bronze=None, store=b.materialise):
    """``store=None`` where a query reads one output only."""
    return monthly.assess(
        bronze or b.monthly_bronze(spark, folder), b.schools(spark, folder), b.known_students(spark, folder),
        b.slices(spark, folder), store, minimum_rows=MINIMUM_ROWS, snapshot_month=b.SNAPSHOT_MONTH)


_RESULT = "batch_id, rule_id, rule_name, target_table, severity, failed_record_count, status, run_id"


@register("dq_predicates", "b_results", f"""
SELECT {_RESULT} FROM b_results WHERE rule_id IN ('DQ001', 'DQ002', 'DQ003', 'DQ007', 'DQ008', 'DQ009', 'DQ010')""")
def dq_predicates(spark, folder):
    silver = b.silver(spark, folder)
    rules = [r for r in assured.quality_rules(b.as_of())
             if r.rule_id in ("DQ001", "DQ002", "DQ003", "DQ007", "DQ008", "DQ009", "DQ010")]
    tables = {f"silver.{n}": df for n, df in silver.items() if n != "school_events"}
    return assured.validation_results(tables, rules, F.lit(b.RUN_ID))


@register("dq_results", "b_results", f"SELECT {_RESULT} FROM b_results")
def dq_results(spark, folder):
    return Assured(spark, folder).results


# Runs of the rules: (batch, run, time). Batch 1 has two at the same time.
_RUNS = [(b.BATCH_1, b.RUN_ID, 1), (b.BATCH_1, f"{b.RUN_ID}_again", 1), (b.BATCH_2, b.RUN_ID, 1),
         (b.BATCH_2, f"{b.RUN_ID}_late", 2)]


@register("quality_latest_run", "b_results", f"""
SELECT r.batch_id, rule_id, rule_name, target_table, severity, failed_record_count, status, l.run_id
FROM b_results r JOIN (
  SELECT batch_id, run_id, row_number() OVER (PARTITION BY batch_id ORDER BY run_at DESC, run_id DESC) AS n
  FROM (VALUES {', '.join(map(str, _RUNS))}) AS v(batch_id, run_id, run_at)) l ON r.batch_id = l.batch_id AND l.n = 1""")
def quality_latest_run(spark, folder):
    """Several quality runs of a batch: gold reads the latest one only."""
    runs = spark.createDataFrame(_RUNS, "batch_id string, run_id string, at int")
    results = b.materialise(Assured(spark, folder).results.drop("run_id").join(runs, "batch_id"))
    results = results.withColumn("run_timestamp", F.timestamp_seconds("at")).drop("at")
    return assured.of_latest_run(results, results).drop("run_timestamp")


@register("dq_baseline_summary", "stg_schools stg_students stg_attendance stg_scores stg_events", """
SELECT *, CASE WHEN failed_record_count = 0 THEN 'Passed' ELSE 'Failed' END AS validation_status FROM (
SELECT 'DQ001' AS validation_id, 'Missing student_id in students' AS check_name, 'stg_students' AS table_name,
       count(*) AS failed_record_count, 'High' AS severity FROM stg_students WHERE trim(student_id) = ''
UNION ALL SELECT 'DQ002', 'Missing school_id in students', 'stg_students', count(*), 'High'
FROM stg_students WHERE trim(school_id) = ''
UNION ALL SELECT 'DQ003', 'Invalid attendance days', 'stg_attendance', count(*), 'High' FROM stg_attendance
WHERE possible_days IS NULL OR attended_days IS NULL OR possible_days < 0 OR attended_days < 0
   OR attended_days > possible_days
UNION ALL SELECT 'DQ004', 'Duplicate attendance business records', 'stg_attendance', count(*), 'Medium'
FROM stg_attendance a JOIN (SELECT student_id, school_id, attendance_month FROM stg_attendance
  GROUP BY ALL HAVING count(*) > 1) d ON a.student_id = d.student_id AND a.school_id = d.school_id
  AND a.attendance_month = d.attendance_month
UNION ALL SELECT 'DQ005', 'Attendance references missing student', 'stg_attendance', count(*), 'High'
FROM stg_attendance WHERE trim(student_id) <> '' AND student_id NOT IN (SELECT student_id FROM stg_students)
UNION ALL SELECT 'DQ006', 'Assessment references missing student', 'stg_assessment_results', count(*), 'High'
FROM stg_scores WHERE trim(student_id) <> '' AND student_id NOT IN (SELECT student_id FROM stg_students)
UNION ALL SELECT 'DQ007', 'Invalid assessment score', 'stg_assessment_results', count(*), 'High'
FROM stg_scores WHERE score IS NULL OR score < 250 OR score > 700
UNION ALL SELECT 'DQ008', 'Invalid proficiency band', 'stg_assessment_results', count(*), 'Medium'
FROM stg_scores WHERE proficiency_band NOT IN ('Low', 'Medium', 'High')
UNION ALL SELECT 'DQ009', 'Invalid school status', 'stg_schools', count(*), 'Medium'
FROM stg_schools WHERE status NOT IN ('Active', 'Closed')
UNION ALL SELECT 'DQ010', 'Future attendance month', 'stg_attendance', count(*), 'Medium'
FROM stg_attendance WHERE attendance_month > DATE '2001-06-30'
UNION ALL SELECT 'DQ011', 'Activity linked to inactive school', 'multiple staging views', count(*), 'Low'
FROM (SELECT school_id FROM stg_attendance UNION ALL SELECT school_id FROM stg_scores
      UNION ALL SELECT school_id FROM stg_events) x JOIN stg_schools s USING (school_id) WHERE s.status = 'Closed')""")
def dq_baseline_summary(spark, folder):
    return baseline.quality_summary(b.staged(spark, folder), b.as_of())


@register("dq_orphans", "b_students b_attendance b_scores", """
SELECT 'strict' AS mode, batch_id, attendance_id AS record_id, student_id FROM b_attendance a
WHERE NOT EXISTS (SELECT 1 FROM b_students s WHERE s.batch_id = a.batch_id AND s.student_id = a.student_id)
UNION ALL
SELECT 'skip_blank', batch_id, attendance_id, student_id FROM b_attendance a WHERE student_id <> ''
  AND NOT EXISTS (SELECT 1 FROM b_students s WHERE s.batch_id = a.batch_id AND s.student_id = a.student_id)
UNION ALL
SELECT 'assessment', batch_id, assessment_id, student_id FROM b_scores a
WHERE NOT EXISTS (SELECT 1 FROM b_students s WHERE s.batch_id = a.batch_id AND s.student_id = a.student_id)""")
def dq_orphans(spark, folder):
    silver, keys = b.silver(spark, folder), ["batch_id", "student_id"]
    found = {
        "strict": (matching.orphans(silver["attendance"], silver["students"], keys), "attendance_id"),
        "skip_blank": (matching.orphans(silver["attendance"], silver["students"], keys, False), "attendance_id"),
        "assessment": (matching.orphans(silver["assessment_results"], silver["students"], keys), "assessment_id"),
    }
    return union_all([
        df.select(F.lit(mode).alias("mode"), "batch_id", F.col(key).alias("record_id"), "student_id")
        for mode, (df, key) in found.items()])


@register("dq_unknown_everywhere", "", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
  AND l_partkey NOT IN (SELECT o_custkey FROM orders)""")
def dq_unknown_everywhere(spark, folder):
    """Part keys that are neither a customer in credit nor one with orders."""
    customers = b.table(spark, folder, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("l_partkey"))
    buyers = b.table(spark, folder, "orders").select(F.col("o_custkey").alias("l_partkey"))
    lines = b.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return matching.unknown_to_all(lines, [customers, buyers], ["l_partkey"]).select(*lines.columns)


@register("dq_parent_state", "b_schools b_events", """
SELECT batch_id, event_id, school_id FROM b_events e WHERE NOT EXISTS (
  SELECT 1 FROM b_schools s WHERE s.batch_id = e.batch_id AND s.school_id = e.school_id AND s.status = 'Active')""")
def dq_parent_state(spark, folder):
    silver = b.silver(spark, folder)
    return matching.not_allowed_parent(
        silver["school_events"], silver["schools"], F.col("status") == "Active",
        ["batch_id", "school_id"]).select("batch_id", "event_id", "school_id")


@register("dq_volume", "c_volume", "SELECT * FROM c_volume")
def dq_volume(spark, folder):
    bronze, slices = b.monthly_bronze(spark, folder), b.slices(spark, folder)
    rules = [r for r in monthly.quality_rules(MINIMUM_ROWS, b.SNAPSHOT_MONTH) if r.volume is not None]
    return union_all([
        quality.slice_failures(slices, bronze[t], [r for r in rules if r.target_table == f"bronze.{t}"],
                               monthly.SLICE)
        for t in ("attendance", "students", "schools")])


@register("dq_failed_records", "b_failures b_rules b_payloads", """
SELECT f.batch_id, f.rule_id, r.target_table, f.business_key, f.bronze_record_id, 'dev_batch_run' AS run_id,
       r.failure_reason, p.payload AS failed_record_json
FROM b_failures f JOIN b_rules r ON f.rule_id = r.rule_id
JOIN b_payloads p ON p.target_table = r.target_table AND p.bronze_record_id = f.bronze_record_id AND p.batch_id = f.batch_id""")
def dq_failed_records(spark, folder):
    return Assured(spark, folder, stored=()).failed


@register("dq_failed_payload", "b_failures b_rules b_payloads", """
SELECT f.batch_id, r.target_table, f.bronze_record_id, string_agg(f.rule_id, ',' ORDER BY f.rule_id) AS broken_rules,
       any_value(p.payload) AS failed_record_json
FROM b_failures f JOIN b_rules r ON f.rule_id = r.rule_id
JOIN b_payloads p ON p.target_table = r.target_table AND p.bronze_record_id = f.bronze_record_id AND p.batch_id = f.batch_id
GROUP BY 1, 2, 3""")
def dq_failed_payload(spark, folder):
    """Every rejected row once, as JSON text with nulls left out, and the rules it breaks: from the rule bits, which
    are read once and so not stored."""
    run = Assured(spark, folder, stored=())
    screened = assured.screened_tables(run.silver, run.marked, run.rules, lambda failing: failing)
    return union_all([
        s.failing.select(
            "batch_id", F.lit(s.table).alias("target_table"), "bronze_record_id",
            F.array_join(F.array_sort(F.array_compact(F.array(*[F.when(s.bit(r), r.rule_id) for r in s.rules]))), ",")
            .alias("broken_rules"),
            json_payload([*model.SOURCE_COLUMNS[s.table.split(".")[1]], *model.LINEAGE]).alias("failed_record_json"))
        for s in screened])


@register("dq_defects", "b_defects", "SELECT * FROM b_defects")
def dq_defects(spark, folder):
    run = Assured(spark, folder)
    return assured.defect_rows(run.results, run.rules)


@register("dq_summaries", "b_results", """
SELECT 'severity' AS summary, severity AS group_value, status, count(DISTINCT rule_id) AS rule_count,
       CAST(sum(failed_record_count) AS BIGINT) AS failed_record_count FROM b_results GROUP BY severity, status
UNION ALL
SELECT 'batch', batch_id, status, count(DISTINCT rule_id), CAST(sum(failed_record_count) AS BIGINT)
FROM b_results GROUP BY batch_id, status""")
def dq_summaries(spark, folder):
    results = Assured(spark, folder).results
    return union_all([
        quality.summarise(results, [column, "status"]).select(
            F.lit(name).alias("summary"), F.col(column).alias("group_value"), "status", "rule_count",
            "failed_record_count")
        for name, column in (("severity", "severity"), ("batch", "batch_id"))])


@register("dq_monthly_results", "c_results", "SELECT * FROM c_results")
def dq_monthly_results(spark, folder):
    return monthly_run(spark, folder, store=None).results


@register("dq_monthly_rejected", "c_rejected c_payloads", """
SELECT j.source_batch_id, j.reporting_month, j.rule_id, j.target_table, j.business_key, j.failure_reason, j.raw_row_number,
       substr(j.target_table, 8) || '.csv' AS source_file_name, p.payload AS failed_record_json
FROM c_rejected j JOIN c_payloads p
  ON p.target_table = j.target_table AND p.reporting_month = j.reporting_month AND p.raw_row_number = j.raw_row_number""")
def dq_monthly_rejected(spark, folder):
    return monthly_run(spark, folder, store=None).rejected


@register("dq_caveats", "c_caveats", "SELECT * FROM c_caveats")
def dq_caveats(spark, folder):
    return monthly_run(spark, folder, store=None).caveats


@register("dq_readiness", "c_readiness", "SELECT * FROM c_readiness")
def dq_readiness(spark, folder):
    return monthly_run(spark, folder).readiness


@register("dq_gate", "c_attendance c_readiness", """
SELECT a.reporting_month, count(*) AS row_count FROM c_attendance a
WHERE a.reporting_month IN (SELECT reporting_month FROM c_readiness WHERE readiness_status <> 'NOT_READY')
GROUP BY 1""")
def dq_gate(spark, folder):
    rows = b.monthly_bronze(spark, folder)["attendance"]
    ready = quality.only_ready(rows, monthly_run(spark, folder).readiness, monthly.SLICE)
    return ready.groupBy("reporting_month").agg(F.count(F.lit(1)).alias("row_count"))


@register("caveat_text", "", """
SELECT o_orderkey, o_orderpriority || ' Failed record count: ' || o_custkey || '.' AS caveat_description,
       CASE o_orderstatus WHEN 'F' THEN 'Attendance' WHEN 'O' THEN 'Student reference' ELSE 'School reference' END
         AS affected_area,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Stop reporting for this month until required data is loaded or corrected.'
            WHEN '2-HIGH' THEN 'Review source records and exclude invalid rows from trusted reporting.'
            ELSE 'Review caveat and decide whether dashboard users need a note.' END AS recommended_action
FROM orders""")
def caveat_text(spark, folder):
    name = (F.when(F.col("o_orderstatus") == "F", "bronze.student_attendance")
            .when(F.col("o_orderstatus") == "O", "bronze.students_of_school_events").otherwise("bronze.schools"))
    severity = (F.when(F.col("o_orderpriority") == "1-URGENT", "BLOCKER")
                .when(F.col("o_orderpriority") == "2-HIGH", "ERROR").otherwise("WARNING"))
    return b.table(spark, folder, "orders").select(
        "o_orderkey", labels.caveat_text("o_orderpriority", "o_custkey").alias("caveat_description"),
        labels.affected_area(name).alias("affected_area"),
        labels.recommended_action(severity).alias("recommended_action"))


@register("volume_movement", "", """
WITH n AS (SELECT strftime(o_orderdate, '%Y-%m') AS reporting_month, date_trunc('month', o_orderdate) AS d,
                  count(*) AS row_count FROM orders GROUP BY ALL)
SELECT n.reporting_month, n.row_count, p.row_count AS prior_row_count,
       round(n.row_count::DOUBLE / p.row_count, 4) AS movement_ratio,
       CASE WHEN p.row_count IS NULL THEN 'NO_PRIOR' WHEN n.row_count = 0 THEN 'BLOCKER'
            WHEN n.row_count::DOUBLE / p.row_count NOT BETWEEN 0.9 AND 1.1 THEN 'WARNING' ELSE 'OK' END AS movement_status
FROM n LEFT JOIN n p ON p.d = n.d - INTERVAL 1 MONTH""")
def volume_movement(spark, folder):
    month = F.trunc("o_orderdate", "month")
    counts = b.table(spark, folder, "orders").groupBy(month.alias("_m")).agg(F.count(F.lit(1)).alias("row_count"))
    current = counts.select(F.date_format("_m", "yyyy-MM").alias("reporting_month"), "row_count")
    prior = counts.select(F.date_format(F.add_months("_m", 1), "yyyy-MM").alias("reporting_month"),
                          F.col("row_count").alias("prior_row_count"))
    return quality.volume_movement(current, prior, 0.9, 1.1)
