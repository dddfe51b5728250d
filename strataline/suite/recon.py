"""Reconciliation, profiles, counts and month validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands, dates
from ..operators import profile, quality, reconcile, rows, upsert
from ..operators.quality import union_all
from ..plans import monthly
from . import bindings as b
from .history import Monthly
from .quality import Assured, monthly_run
from .registry import register
from .star import AssuredStar


@register("recon_layers", "raw_schools raw_students raw_attendance raw_scores raw_events b_schools b_students b_attendance b_scores b_events", """
WITH raw AS (
  SELECT 'schools' AS object_name, b AS batch_id FROM raw_schools CROSS JOIN (VALUES ('2025-01-15'), ('2026-01-15')) v(b)
  UNION ALL SELECT 'students', '2026-01-15' FROM raw_students
  UNION ALL SELECT 'students', '2025-01-15' FROM raw_students WHERE c_acctbal >= 0
  UNION ALL SELECT 'attendance', batch_id FROM raw_attendance UNION ALL SELECT 'assessment_results', batch_id FROM raw_scores
  UNION ALL SELECT 'school_events', batch_id FROM raw_events),
kept AS (
  SELECT 'schools' AS object_name, batch_id FROM b_schools UNION ALL SELECT 'students', batch_id FROM b_students
  UNION ALL SELECT 'attendance', batch_id FROM b_attendance UNION ALL SELECT 'assessment_results', batch_id FROM b_scores
  UNION ALL SELECT 'school_events', batch_id FROM b_events)
SELECT 'bronze_to_silver' AS layer_name, r.object_name, r.batch_id, r.n AS source_row_count, k.n AS target_row_count,
       k.n - r.n AS difference_count, CASE WHEN k.n = r.n THEN 'PASS' ELSE 'FAIL' END AS reconciliation_status
FROM (SELECT object_name, batch_id, count(*) AS n FROM raw GROUP BY ALL) r
JOIN (SELECT object_name, batch_id, count(*) AS n FROM kept GROUP BY ALL) k
  ON r.object_name = k.object_name AND r.batch_id = k.batch_id""")
def recon_layers(spark, folder):
    bronze, silver = b.bronze(spark, folder), b.silver(spark, folder)
    return reconcile.layer_reconciliation(
        "bronze_to_silver", {n: (bronze[n], silver[n]) for n in bronze}, ["batch_id"], reconcile.two_state)


@register("recon_three_state", "", """
SELECT coalesce(o.k, e.k) AS entity_id, coalesce(o.d, e.d) AS day, o.n AS source_row_count, e.n AS target_row_count,
       e.n - o.n AS difference_count,
       CASE WHEN o.n IS NULL OR e.n IS NULL THEN 'WARNING' WHEN o.n = e.n THEN 'PASS' ELSE 'FAIL' END AS reconciliation_status
FROM (SELECT o_custkey AS k, day(o_orderdate) AS d, count(*) AS n FROM orders GROUP BY ALL) o
FULL JOIN (SELECT user_id AS k, day(ts) AS d, count(*) AS n FROM events GROUP BY ALL) e ON o.k = e.k AND o.d = e.d""")
def recon_three_state(spark, folder):
    """Orders and events of each customer by day of the month: all three states occur."""
    def keyed(table, entity, day):
        return b.table(spark, folder, table).select(
            F.col(entity).cast("bigint").alias("entity_id"), F.dayofmonth(day).cast("bigint").alias("day"))

    return reconcile.compare_counts(
        keyed("orders", "o_custkey", "o_orderdate"), keyed("events", "user_id", "ts"), ["entity_id", "day"])


@register("recon_monthly", "c_slices c_attendance c_scores c_events c_school c_conformed_attendance c_conformed_scores c_status c_released", """
WITH s AS (SELECT * FROM c_slices),
src AS (SELECT 'school' AS o, '1995-01' AS m, count(*) AS n FROM c_school
  UNION ALL SELECT 'attendance_monthly', reporting_month, count(*) FROM c_attendance GROUP BY 2
  UNION ALL SELECT 'assessment_result', reporting_month, count(*) FROM c_scores GROUP BY 2
  UNION ALL SELECT 'school_event', reporting_month, count(*) FROM c_events GROUP BY 2
  UNION ALL SELECT 'student_monthly_status', reporting_month, count(*) FROM c_status GROUP BY 2),
tgt AS (SELECT 'school' AS o, '1995-01' AS m, count(*) AS n FROM c_school
  UNION ALL SELECT 'attendance_monthly', reporting_month, count(*) FROM c_conformed_attendance GROUP BY 2
  UNION ALL SELECT 'assessment_result', reporting_month, count(*) FROM c_conformed_scores GROUP BY 2
  UNION ALL SELECT 'school_event', reporting_month, count(*) FROM c_events JOIN c_school USING (school_id) GROUP BY 2
  UNION ALL SELECT 'student_monthly_status', reporting_month, count(*) FROM c_status JOIN c_released USING (reporting_month) GROUP BY 2)
SELECT s.source_batch_id, s.reporting_month, 'bronze_to_silver' AS layer_name, v.o AS object_name,
       coalesce(src.n, 0) AS source_row_count, coalesce(tgt.n, 0) AS target_row_count,
       coalesce(tgt.n, 0) - coalesce(src.n, 0) AS difference_count,
       CASE WHEN coalesce(tgt.n, 0) = coalesce(src.n, 0) THEN 'PASS' ELSE 'FAIL' END AS reconciliation_status
FROM s CROSS JOIN (VALUES ('school'), ('student_monthly_status'), ('attendance_monthly'), ('assessment_result'), ('school_event')) v(o)
LEFT JOIN src ON src.o = v.o AND src.m = s.reporting_month LEFT JOIN tgt ON tgt.o = v.o AND tgt.m = s.reporting_month""")
def recon_monthly(spark, folder):
    """The students a snapshot should hold against the snapshots of the months that passed the gate."""
    run = Monthly(spark, folder, stored=True)
    status = run.status
    kept = quality.only_ready(status, run.quality.readiness, monthly.SLICE)
    silver = {"school": run.schools, "student_monthly_status": kept, "attendance_monthly": run.attendance,
              "assessment_result": run.scores,
              "school_event": monthly.conformed_events(run.bronze["school_events"], run.schools)}
    return monthly.reconcile_bronze_silver(run.bronze, silver, status, run.slices)


_GOLD_COUNTS = """
src AS (SELECT 'fact_student_snapshot' AS o, reporting_month AS m, count(*) AS n FROM c_status GROUP BY 2
  UNION ALL SELECT 'fact_attendance_monthly', reporting_month, count(*) FROM c_conformed_attendance GROUP BY 2
  UNION ALL SELECT 'fact_assessment_result', reporting_month, count(*) FROM c_conformed_scores GROUP BY 2
  UNION ALL SELECT 'fact_data_quality_caveat', reporting_month, count(*) FROM c_caveats GROUP BY 2),
tgt AS (SELECT 'fact_student_snapshot' AS o, reporting_month AS m, count(*) AS n FROM c_status GROUP BY 2
  UNION ALL SELECT 'fact_attendance_monthly', replace(source_batch_id, '_', '-'), count(*) FROM c_fact_attendance GROUP BY 2
  UNION ALL SELECT 'fact_assessment_result', replace(source_batch_id, '_', '-'), count(*) FROM c_fact_score JOIN c_domain USING (domain) GROUP BY 2
  UNION ALL SELECT 'fact_data_quality_caveat', reporting_month, count(*) FROM c_caveats GROUP BY 2)"""
_GOLD_NEEDS = "c_slices c_status c_conformed_attendance c_conformed_scores c_fact_attendance c_fact_score c_domain c_caveats c_released"


def released(run: Monthly) -> dict:
    """The gold slices of the months whose quality run lets them pass, as the pipeline loads them: a month that is not
    ready has none, and scores of domains that gold doesn't know are lost."""
    def ready(df):
        return quality.only_ready(df, run.quality.readiness, monthly.SLICE)

    status, attendance = ready(run.status), run.attendance
    return {
        "fact_student_snapshot": monthly.fact_student_snapshot(status),
        "fact_attendance_monthly": monthly.fact_attendance_monthly(ready(attendance), run.status, run.bands),
        "fact_assessment_result": monthly.fact_assessment_result(
            monthly.merge_assessment(monthly.empty_state(run.spark)["assessment_result"], ready(run.scores)),
            run.domains, run.students, attendance, run.bands),
        "fact_data_quality_caveat": monthly.fact_data_quality_caveat(ready(run.quality.caveats), run.quality.results),
    }


@register("recon_monthly_gold", _GOLD_NEEDS, f"""
WITH {_GOLD_COUNTS.strip()}
SELECT s.source_batch_id, s.reporting_month, 'silver_to_gold' AS layer_name, v.o AS object_name,
       coalesce(src.n, 0) AS source_row_count, CASE WHEN r.reporting_month IS NULL THEN 0 ELSE coalesce(tgt.n, 0) END AS target_row_count,
       CASE WHEN r.reporting_month IS NULL THEN 0 ELSE coalesce(tgt.n, 0) END - coalesce(src.n, 0) AS difference_count,
       CASE WHEN CASE WHEN r.reporting_month IS NULL THEN 0 ELSE coalesce(tgt.n, 0) END = coalesce(src.n, 0) THEN 'PASS' ELSE 'FAIL' END
         AS reconciliation_status
FROM c_slices s CROSS JOIN (VALUES ('fact_student_snapshot'), ('fact_attendance_monthly'), ('fact_assessment_result'), ('fact_data_quality_caveat')) v(o)
LEFT JOIN c_released r ON r.reporting_month = s.reporting_month
LEFT JOIN src ON src.o = v.o AND src.m = s.reporting_month LEFT JOIN tgt ON tgt.o = v.o AND tgt.m = s.reporting_month""")
def recon_monthly_gold(spark, folder):
    """All silver rows against the gold slices that were released."""
    run = Monthly(spark, folder, stored=True)
    silver = {"student_monthly_status": run.status, "attendance_monthly": run.attendance, "assessment_result": run.scores}
    return monthly.reconcile_silver_gold(silver, released(run), run.quality.caveats, run.slices)


@register("recon_conservation", "raw_attendance b_attendance b_good_attendance", """
SELECT r.batch_id, r.n AS total_count, g.n AS kept_count, k.n - g.n AS rejected_count, r.n - k.n AS surplus_count,
       'PASS' AS reconciliation_status
FROM (SELECT batch_id, count(*) AS n FROM raw_attendance GROUP BY 1) r
JOIN (SELECT batch_id, count(*) AS n FROM b_attendance GROUP BY 1) k USING (batch_id)
JOIN (SELECT batch_id, count(*) AS n FROM b_good_attendance GROUP BY 1) g USING (batch_id)""")
def recon_conservation(spark, folder):
    """raw = trusted + rejected + surplus copies, each part computed on its own."""
    run = AssuredStar(spark, folder)
    marked = run.marked["silver.attendance"]
    rules = [r for r in run.rules if r.rule_id in ("DQ003", "DQ004", "DQ005")]
    failing = marked.filter(rules[0].fails() | rules[1].fails() | rules[2].fails())
    bronze = b.bronze(spark, folder)["attendance"]
    keys = ["batch_id", "attendance_id"]
    copies = bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    surplus = copies.filter("n > 1").select("batch_id", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))))
    return reconcile.conservation(bronze, {"kept": run.attendance, "rejected": failing, "surplus": surplus},
                                  ["batch_id"])


@register("profile_nulls", "stg_students", """
SELECT count(*) AS total_records, count(*) FILTER (year_level IS NULL) AS missing_year_level,
       count(*) FILTER (enrolment_date IS NULL) AS missing_enrolment_date,
       count(*) FILTER (gender IS NULL) AS missing_gender, count(DISTINCT student_id) AS distinct_student_ids
FROM stg_students""")
def profile_nulls(spark, folder):
    return profile.null_profile(b.staged(spark, folder)["students"],
                                ["year_level", "enrolment_date", "gender"], distinct="student_id")


@register("profile_lineage", "raw_attendance", """
SELECT 'attendance' AS table_name, count(*) AS total_records, 0::BIGINT AS missing_batch_id, 0::BIGINT AS missing_run_id,
       0::BIGINT AS missing_bronze_record_id,
       count(DISTINCT attendance_id || '|' || batch_id) AS distinct_bronze_record_ids FROM raw_attendance""")
def profile_lineage(spark, folder):
    return profile.null_profile(
        b.bronze(spark, folder)["attendance"], ["batch_id", "run_id", "bronze_record_id"],
        distinct="bronze_record_id").withColumn("table_name", F.lit("attendance"))


@register("profile_types", "b_students b_attendance b_scores", """
WITH p AS (
SELECT 'students' AS table_name, batch_id, count(*) AS total_records, 'invalid_or_missing_year_level' AS metric,
       count(*) FILTER (year_level IS NULL) AS failed_count FROM b_students GROUP BY batch_id
UNION ALL SELECT 'students', batch_id, count(*), 'invalid_or_missing_enrolment_date',
       count(*) FILTER (enrolment_date IS NULL) FROM b_students GROUP BY batch_id
UNION ALL SELECT 'attendance', batch_id, count(*), 'invalid_or_missing_attendance_month',
       count(*) FILTER (attendance_month IS NULL) FROM b_attendance GROUP BY batch_id
UNION ALL SELECT 'attendance', batch_id, count(*), 'invalid_or_missing_possible_days',
       count(*) FILTER (possible_days IS NULL) FROM b_attendance GROUP BY batch_id
UNION ALL SELECT 'assessment_results', batch_id, count(*), 'invalid_or_missing_score',
       count(*) FILTER (score IS NULL) FROM b_scores GROUP BY batch_id) SELECT * FROM p""")
def profile_types(spark, folder):
    silver = b.silver(spark, folder)
    return profile.null_profile_long({
        "students": (silver["students"], ["year_level", "enrolment_date"]),
        "attendance": (silver["attendance"], ["attendance_month", "possible_days"]),
        "assessment_results": (silver["assessment_results"], ["score"])}, ["batch_id"])


@register("profile_grain", "b_fact_attendance", """
SELECT batch_id, count(*) AS total_records, count(*) FILTER (school_scd_key IS NULL) AS missing_school_scd_key,
       count(*) FILTER (student_batch_key IS NULL) AS missing_student_batch_key,
       count(DISTINCT attendance_fact_key) AS distinct_attendance_fact_keys
FROM b_fact_attendance GROUP BY 1""")
def profile_grain(spark, folder):
    return profile.grain_profile(AssuredStar(spark, folder).fact_attendance, "attendance_fact_key",
                                 ["school_scd_key", "student_batch_key"], ["batch_id"])


@register("counts_by_batch", "", """
SELECT 'orders' AS table_name, CAST(year(o_orderdate) AS INTEGER) AS year_number, NULL AS event_type, count(*) AS row_count
FROM orders GROUP BY 2
UNION ALL SELECT 'lineitem', CAST(year(l_shipdate) AS INTEGER), NULL, count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'events', CAST(year(ts) AS INTEGER), event_type, count(*) FROM events GROUP BY 2, 3""")
def counts_by_batch(spark, folder):
    """Counts per table; only events have a type, the others get a null."""
    return profile.counts_by({
        "orders": b.table(spark, folder, "orders").select(F.year("o_orderdate").alias("year_number")),
        "lineitem": b.table(spark, folder, "lineitem").select(F.year("l_shipdate").alias("year_number")),
        "events": b.table(spark, folder, "events").select(F.year("ts").alias("year_number"), "event_type"),
    }, ["year_number", "event_type"])


@register("global_bounds", "", """
SELECT l_returnflag, count(*) AS row_count, min(l_shipdate) AS min_l_shipdate, max(l_shipdate) AS max_l_shipdate
FROM lineitem GROUP BY 1""")
def global_bounds(spark, folder):
    return profile.bounds(b.table(spark, folder, "lineitem"), "l_shipdate", ["l_returnflag"])


@register("top_preview", "", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_preview(spark, folder):
    return rows.top_rows(b.table(spark, folder, "orders"), 100, F.desc("o_totalprice"), F.asc("o_orderkey")).select(
        "o_orderkey", "o_totalprice", "o_orderdate")


@register("output_ranges", "b_fact_attendance", """
SELECT batch_id, min(attendance_rate) AS min_value, max(attendance_rate) AS max_value,
       count(*) FILTER (attendance_rate NOT BETWEEN 0 AND 1) AS out_of_range_count,
       CASE WHEN count(*) FILTER (attendance_rate NOT BETWEEN 0 AND 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS check_status
FROM b_fact_attendance GROUP BY 1""")
def output_ranges(spark, folder):
    return profile.range_check(AssuredStar(spark, folder).fact_attendance, "attendance_rate", 0, 1, ["batch_id"])


@register("file_ledger", "c_slices c_attendance c_rejected", """
SELECT 'attendance.csv' AS source_file_name, (SELECT count(*) FROM c_attendance) AS source_row_count,
       (SELECT count(*) FROM c_attendance) - n AS loaded_row_count, n AS rejected_row_count, 'PARTIAL' AS load_status
FROM (SELECT count(DISTINCT raw_row_number) AS n FROM c_rejected WHERE target_table = 'bronze.attendance')""")
def file_ledger(spark, folder):
    """Loaded and rejected rows of the attendance file; a row is rejected once."""
    rejected = monthly_run(spark, folder, store=None).rejected.filter(F.col("target_table") == "bronze.attendance")
    return reconcile.file_ledger(b.monthly_bronze(spark, folder)["attendance"],
                                 rejected.select("source_file_name", "raw_row_number").distinct())


@register("quality_details", "c_results c_caveats c_rejected", """
SELECT source_batch_id, reporting_month, 'failed_rule' AS detail_type, target_table AS affected_object,
       rule_id AS rule_code, severity, failed_record_count AS record_count, NULL AS business_key, NULL AS detail_message
FROM c_results WHERE status <> 'PASS'
UNION ALL SELECT c.source_batch_id, c.reporting_month, 'caveat', c.affected_area, c.caveat_code, c.severity,
       r.failed_record_count, NULL, c.caveat_title || ': ' || c.caveat_description
FROM c_caveats c JOIN c_results r ON r.reporting_month = c.reporting_month AND r.rule_id = c.caveat_code
UNION ALL SELECT source_batch_id, reporting_month, 'rejected_record', target_table, rule_id, 'ERROR', 1, business_key,
       failure_reason FROM c_rejected""")
def quality_details(spark, folder):
    run = monthly_run(spark, folder)
    return reconcile.quality_details(run.results, run.caveats, run.rejected, monthly.SLICE)


@register("month_checks", _GOLD_NEEDS + " c_attendance c_students c_scores c_events c_schools", f"""
WITH {_GOLD_COUNTS.strip()},
bronze AS (SELECT 'bronze.attendance' AS o, reporting_month AS m, count(*) AS n FROM c_attendance GROUP BY 2
  UNION ALL SELECT 'bronze.students', reporting_month, count(*) FROM c_students GROUP BY 2
  UNION ALL SELECT 'bronze.assessment_results', reporting_month, count(*) FROM c_scores GROUP BY 2
  UNION ALL SELECT 'bronze.school_events', reporting_month, count(*) FROM c_events GROUP BY 2
  UNION ALL SELECT 'bronze.schools', reporting_month, count(*) FROM c_schools GROUP BY 2),
n AS (SELECT 'audit.file_load' AS o, m, count(*) AS n FROM bronze GROUP BY 2 UNION ALL SELECT * FROM bronze
  UNION ALL SELECT CASE o WHEN 'fact_student_snapshot' THEN 'student snapshot' WHEN 'fact_attendance_monthly' THEN 'attendance facts'
                          ELSE 'quality caveats' END, m, n FROM src WHERE o <> 'fact_assessment_result'),
g AS (SELECT CASE o WHEN 'fact_student_snapshot' THEN 'student snapshot' WHEN 'fact_attendance_monthly' THEN 'attendance facts'
                    ELSE 'quality caveats' END AS o, m, n FROM tgt JOIN c_released r ON r.reporting_month = m
      WHERE o <> 'fact_assessment_result')
SELECT s.source_batch_id, s.reporting_month, v.g AS check_group, v.o AS object_name, coalesce(n.n, 0) AS row_count,
       CASE WHEN v.k = 'compare' THEN coalesce(g.n, 0) END AS expected_or_comparison_count,
       CASE WHEN v.k = 'compare' THEN coalesce(g.n, 0) - coalesce(n.n, 0) END AS difference_count,
       CASE v.k WHEN 'info' THEN 'INFO' WHEN 'required' THEN CASE WHEN coalesce(n.n, 0) = 0 THEN 'CHECK' ELSE 'OK' END
            ELSE CASE WHEN coalesce(n.n, 0) = coalesce(g.n, 0) THEN 'OK' ELSE 'CHECK' END END AS check_status
FROM c_slices s CROSS JOIN (VALUES ('file_loads', 'audit.file_load', 'required'), ('bronze', 'bronze.attendance', 'required'),
  ('bronze', 'bronze.students', 'required'), ('bronze', 'bronze.assessment_results', 'info'), ('bronze', 'bronze.school_events', 'info'),
  ('silver_to_gold', 'student snapshot', 'compare'), ('silver_to_gold', 'attendance facts', 'compare'),
  ('quality_to_gold', 'quality caveats', 'compare')) v(g, o, k)
LEFT JOIN n ON n.o = v.o AND n.m = s.reporting_month LEFT JOIN g ON g.o = v.o AND g.m = s.reporting_month""")
def month_checks(spark, folder):
    """The eight essential checks of every month."""
    run = Monthly(spark, folder, stored=True)
    gold, bronze = released(run), run.bronze
    files = union_all([df.select(*monthly.SLICE, "source_file_name").distinct() for df in bronze.values()])

    def month_of(name):
        return gold[name].select("source_batch_id", F.replace("source_batch_id", F.lit("_"), F.lit("-")).alias("reporting_month"))

    checks = reconcile.check_rows([
        ("file_loads", "audit.file_load", files, None, True),
        ("bronze", "bronze.attendance", bronze["attendance"], None, True),
        ("bronze", "bronze.students", bronze["students"], None, True),
        ("bronze", "bronze.assessment_results", bronze["assessment_results"], None, False),
        ("bronze", "bronze.school_events", bronze["school_events"], None, False),
        ("silver_to_gold", "student snapshot", run.status, month_of("fact_student_snapshot"), False),
        ("silver_to_gold", "attendance facts", run.attendance, month_of("fact_attendance_monthly"), False),
        ("quality_to_gold", "quality caveats", run.quality.caveats, month_of("fact_data_quality_caveat"), False),
    ], monthly.SLICE, run.slices)
    return reconcile.in_check_order(checks)


@register("month_validation", "c_slices c_attendance c_students c_scores c_rejected c_conformed_attendance c_readiness c_fact_attendance", """
WITH r AS (SELECT s.source_batch_id AS k, CASE WHEN coalesce(a.n, 0) <> coalesce(c.n, 0) THEN 1 ELSE 0 END AS f
  FROM c_slices s LEFT JOIN (SELECT source_batch_id, count(*) AS n FROM c_attendance GROUP BY 1) a USING (source_batch_id)
  LEFT JOIN (SELECT source_batch_id, count(*) AS n FROM c_conformed_attendance GROUP BY 1) c USING (source_batch_id)),
x AS (SELECT source_batch_id, count(*) AS rows_, count(*) FILTER (year_level_key IS NULL) AS l,
             count(*) FILTER (attendance_band_key IS NULL) AS b FROM c_fact_attendance GROUP BY 1),
loaded AS (SELECT 'bronze.attendance' AS t, source_batch_id AS k, count(*) AS n FROM c_attendance GROUP BY 2
  UNION ALL SELECT 'bronze.students', source_batch_id, count(*) FROM c_students GROUP BY 2
  UNION ALL SELECT 'bronze.assessment_results', source_batch_id, count(*) FROM c_scores GROUP BY 2),
refused AS (SELECT target_table AS t, source_batch_id AS k, count(DISTINCT raw_row_number) AS n FROM c_rejected GROUP BY 1, 2),
f AS (SELECT k, count(*) AS n, count(*) FILTER (loaded.n = coalesce(refused.n, 0)) AS failed
      FROM loaded LEFT JOIN refused USING (t, k) GROUP BY 1),
u AS (SELECT source_batch_id AS k, reporting_month AS m, CAST(right(reporting_month, 2) AS INTEGER) AS month_no FROM c_slices
      WHERE right(reporting_month, 2) <> '12'),
j AS (SELECT s.source_batch_id, s.reporting_month, CASE WHEN u.k IS NOT NULL THEN s.source_batch_id || '_r2' END AS pipeline_run_id,
             CASE WHEN u.month_no = 7 THEN 'FAILED' WHEN u.k IS NOT NULL THEN 'SUCCEEDED' END AS run_status,
             CASE WHEN s.reporting_month = '1995-01' THEN 'INITIAL_SNAPSHOT' WHEN u.k IS NOT NULL THEN 'MONTHLY_CHANGE' END AS load_mode,
             coalesce(f.n, 0) AS file_load_count, coalesce(f.failed, 0) AS failed_file_load_count,
             q.readiness_status, q.rejected_record_count, 1::BIGINT AS reconciliation_check_count,
             r.f::BIGINT AS failed_reconciliation_count, coalesce(x.rows_, 0) AS attendance_fact_rows,
             coalesce(x.l, 0) AS missing_year_level_rows, coalesce(x.b, 0) AS missing_attendance_band_rows
      FROM c_slices s JOIN c_readiness q USING (source_batch_id) JOIN r ON r.k = s.source_batch_id
      LEFT JOIN u ON u.k = s.source_batch_id LEFT JOIN f ON f.k = s.source_batch_id
      LEFT JOIN x USING (source_batch_id))
SELECT *, CASE WHEN failed_reconciliation_count > 0 AND rejected_record_count > 0 THEN 'EXPLAINED_BY_REJECTED_RECORDS'
               WHEN failed_reconciliation_count > 0 THEN 'CHECK_RECONCILIATION' ELSE 'PASS' END AS reconciliation_interpretation,
       CASE WHEN pipeline_run_id IS NULL OR run_status <> 'SUCCEEDED' THEN 'CHECK_PIPELINE_RUN'
            WHEN load_mode <> 'MONTHLY_CHANGE' THEN 'CHECK_LOAD_MODE'
            WHEN failed_file_load_count > 0 OR file_load_count = 0 THEN 'CHECK_FILE_LOADS' WHEN readiness_status = 'NOT_READY' THEN 'NOT_READY'
            WHEN failed_reconciliation_count > 0 AND rejected_record_count = 0 THEN 'CHECK_RECONCILIATION'
            WHEN missing_year_level_rows > 0 OR missing_attendance_band_rows > 0 THEN 'CHECK_ATTENDANCE_KEYS'
            WHEN readiness_status = 'READY_WITH_CAVEATS' THEN 'MONTH_VALIDATED_WITH_CAVEATS'
            ELSE 'MONTH_VALIDATED' END AS validation_status FROM j""")
def month_validation(spark, folder):
    """One row per month from run log, file ledger, readiness, reconciliation and key summaries.

    The run log is kept per month: a first run that failed and a second one that ended well, in July failed again; in
    December nobody ran. The month of the snapshot was loaded as one.
    """
    run = Monthly(spark, folder, stored=True)  # attendance is counted, and read by the fact
    key = ["source_batch_id"]
    attendance = run.attendance
    fact = run.fact_attendance
    number = F.substring("reporting_month", 6, 2)
    mode = F.when(F.col("reporting_month") == b.SNAPSHOT_MONTH, "INITIAL_SNAPSHOT").otherwise("MONTHLY_CHANGE")
    last = F.when(number == "07", "FAILED").otherwise("SUCCEEDED")
    log = run.slices.where(number != "12").select(*key, mode.alias("load_mode"), F.inline(F.array(*[
        F.struct(F.lit(at).alias("logged_at"), F.concat("source_batch_id", F.lit(f"_r{no}")).alias("pipeline_run_id"),
                 state.alias("run_status"))
        for at, no, state in ((1, 1, F.lit("STARTED")), (2, 1, F.lit("FAILED")), (3, 2, F.lit("STARTED")), (4, 2, last))])))
    runs = upsert.latest_run_state(log, "source_batch_id", ["logged_at"], ["pipeline_run_id", "run_status", "load_mode"])
    rejected = run.quality.rejected
    files = union_all([
        reconcile.file_ledger(
            run.bronze[name].withColumn("file", F.struct(*key, F.lit(name).alias("name"))),
            rejected.filter(F.col("target_table") == f"bronze.{name}").select(
                F.struct(*key, F.lit(name).alias("name")).alias("file"), "raw_row_number").distinct(), "file")
        for name in ("attendance", "students", "assessment_results")])
    files = files.groupBy(F.col("file.source_batch_id").alias("source_batch_id")).agg(
        F.count(F.lit(1)).alias("file_load_count"),
        F.count_if(F.col("load_status") == "FAILED").alias("failed_file_load_count"))
    ready = run.quality.readiness.select("source_batch_id", "readiness_status", "rejected_record_count")
    recon = reconcile.slice_counts(run.slices, key, {"attendance": (run.bronze["attendance"], attendance)}, "l")
    recon = recon.groupBy(*key).agg(
        F.count(F.lit(1)).alias("reconciliation_check_count"),
        F.count_if(F.col("reconciliation_status") != "PASS").alias("failed_reconciliation_count"))
    keys = fact.groupBy(*key).agg(
        F.count(F.lit(1)).alias("attendance_fact_rows"),
        F.count_if(F.col("year_level_key").isNull()).alias("missing_year_level_rows"),
        F.count_if(F.col("attendance_band_key").isNull()).alias("missing_attendance_band_rows"))
    return reconcile.month_validation(
        run.slices, key, [runs, files, ready, recon, keys], F.lit("MONTHLY_CHANGE"),
        ["file_load_count", "failed_file_load_count", "attendance_fact_rows", "missing_year_level_rows",
         "missing_attendance_band_rows"])


@register("view_row_counts", "c_fact_attendance c_fact_score c_domain c_month c_school c_level c_readiness c_caveats", """
SELECT view_name, row_count, CASE WHEN row_count = 0 AND view_name IN ('vw_monthly_attendance_summary',
         'vw_year_level_attendance_patterns', 'vw_monthly_reporting_readiness') THEN 'CHECK' ELSE 'OK' END AS check_status FROM (
SELECT 'vw_monthly_attendance_summary' AS view_name, (SELECT count(*) FROM (
  SELECT DISTINCT m.reporting_month, s.region, s.school_type, s.status FROM c_fact_attendance f
  JOIN c_month m ON f.month_key = m.month_key JOIN c_school s ON s.school_key = f.school_key)) AS row_count
UNION ALL SELECT 'vw_year_level_attendance_patterns', (SELECT count(*) FROM (
  SELECT DISTINCT m.reporting_month, s.region, s.school_type, y.year_level FROM c_fact_attendance f
  JOIN c_month m ON f.month_key = m.month_key JOIN c_school s ON s.school_key = f.school_key
  LEFT JOIN c_level y ON y.year_level_key = f.year_level_key))
UNION ALL SELECT 'vw_attendance_assessment_relationship', (
  SELECT count(*) FROM c_fact_score f JOIN c_domain USING (domain) JOIN c_school s ON s.school_key = f.school_key)
UNION ALL SELECT 'vw_monthly_reporting_readiness', (SELECT count(*) FROM c_readiness)
UNION ALL SELECT 'vw_data_quality_caveats', (SELECT count(*) FROM c_caveats))""")
def view_row_counts(spark, folder):
    """The five report views."""
    run = Monthly(spark, folder, stored=True)  # attendance is read by both facts
    months, schools, levels = monthly.dim_month(run.slices), monthly.dim_school(run.schools), monthly.dim_year_level(run.students)
    fact = b.materialise(run.fact_attendance)
    views = {
        "vw_monthly_attendance_summary": monthly.view_monthly_attendance(fact, months, schools),
        "vw_year_level_attendance_patterns": monthly.view_year_level_patterns(fact, months, schools, levels),
        "vw_attendance_assessment_relationship": monthly.view_relationship(run.fact_scores, schools, levels, run.domains, run.bands),
        "vw_monthly_reporting_readiness": monthly.view_readiness(run.quality.readiness),
        "vw_data_quality_caveats": monthly.view_caveats(run.quality.caveats),
    }
    for name, view in views.items():
        reconcile.require_no_identifiers(view, name)
    return reconcile.view_row_counts(views, (
        "vw_monthly_attendance_summary", "vw_year_level_attendance_patterns", "vw_monthly_reporting_readiness"))


@register("scalar_labels", "", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 15 = 0 THEN 'Kindergarten' ELSE 'Year ' || (o_orderkey % 15) END AS year_level_label,
       CASE WHEN o_orderkey % 15 <= 6 THEN 'Primary' WHEN o_orderkey % 15 = 7 THEN 'Year 7 transition'
            WHEN o_orderkey % 15 <= 10 THEN 'Years 8-10' ELSE 'Senior secondary' END AS cohort_group,
       CASE WHEN o_totalprice < 100000 THEN 'Low' WHEN o_totalprice < 300000 THEN 'Medium' ELSE 'High' END AS price_band,
       CASE WHEN month(o_orderdate) = 1 THEN 'Summer break' WHEN month(o_orderdate) <= 4 THEN 'Term 1'
            WHEN month(o_orderdate) <= 7 THEN 'Term 2' WHEN month(o_orderdate) <= 9 THEN 'Term 3' ELSE 'Term 4' END AS school_term,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(strftime(o_orderdate - INTERVAL 1 MONTH, '%Y%m') AS INTEGER) AS prior_month_key,
       CAST(o_orderdate AS DATE) - 1 AS day_before, monthname(o_orderdate) AS month_name
FROM orders""")
def scalar_labels(spark, folder):
    from ..functions import labels

    level = (F.col("o_orderkey") % 15).cast("int")
    price = bands.Scale(((100000, "Low"), (300000, "Medium")), "High")
    day = F.col("o_orderdate").cast("date")
    return b.table(spark, folder, "orders").select(
        "o_orderkey", labels.year_level_label(level).alias("year_level_label"),
        labels.cohort_group(level).alias("cohort_group"), price.label("o_totalprice").alias("price_band"),
        dates.school_term(day).alias("school_term"), dates.date_key(day).alias("date_key"),
        dates.prior_month_key(day).alias("prior_month_key"), dates.day_before(day).alias("day_before"),
        dates.month_name(day).alias("month_name"))
