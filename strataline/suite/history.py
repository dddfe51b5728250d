"""Upserts, versions, replay, lookups, run log."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..functions import checks
from ..functions.keys import hash_key
from ..operators import history, matching, rows, upsert
from ..plans import assured, monthly
from ..session import materialise
from . import bindings as b
from .quality import monthly_run
from .registry import register


@register("upsert_all", "", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderdate < DATE '2000-01-01' AND o_orderpriority <> '1-URGENT'
UNION ALL
SELECT o_orderkey, o_custkey, 'X', o_totalprice FROM orders
WHERE o_orderdate >= DATE '2000-01-01' OR o_orderpriority = '1-URGENT'""")
def upsert_all(spark, folder):
    """Base: orders before 2000. Delta: urgent orders and those from 2000 on."""
    orders = b.table(spark, folder, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    base = orders.filter("o_orderdate < DATE '2000-01-01'").select(*columns)
    delta = orders.filter("o_orderdate >= DATE '2000-01-01' OR o_orderpriority = '1-URGENT'").select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), "o_totalprice")
    return upsert.upsert(base, delta, ["o_orderkey"])


_HASH = "sha256(o_orderkey || '||' || {status} || '||' || o_custkey)"


@register("upsert_hash", "", f"""
WITH base AS (SELECT o_orderkey, o_custkey, o_orderstatus AS status,
                     {_HASH.format(status='o_orderstatus')} AS record_hash, '2000-01' AS month
              FROM orders WHERE o_orderdate < DATE '2000-01-01'),
delta AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS status,
                 CASE WHEN o_orderpriority = '5-LOW' THEN '2000-01' ELSE '2000-02' END AS month
          FROM orders WHERE o_orderdate >= DATE '1999-01-01' OR o_orderpriority = '1-URGENT'),
d AS (SELECT *, {_HASH.format(status='status')} AS record_hash FROM delta)
SELECT coalesce(d.o_orderkey, base.o_orderkey) AS o_orderkey, coalesce(base.o_custkey, d.o_custkey) AS o_custkey,
       CASE WHEN u THEN d.status ELSE base.status END AS status,
       CASE WHEN u THEN d.record_hash ELSE base.record_hash END AS record_hash,
       coalesce(base.month, d.month) AS first_month, CASE WHEN u THEN d.month ELSE base.month END AS last_month
FROM (SELECT b.o_orderkey AS k1, e.o_orderkey AS k2,
             e.o_orderkey IS NOT NULL AND (b.o_orderkey IS NULL OR b.record_hash <> e.record_hash
                                           OR b.month <> e.month) AS u
      FROM base b FULL JOIN d e ON b.o_orderkey = e.o_orderkey) k
LEFT JOIN base ON base.o_orderkey = k.k1 LEFT JOIN d ON d.o_orderkey = k.k2""")
def upsert_hash(spark, folder):
    orders = b.table(spark, folder, "orders")

    def state(df, status, month):
        return df.select("o_orderkey", "o_custkey", status.alias("status"), month.alias("last_month")).select(
            "o_orderkey", "o_custkey", "status",
            hash_key("o_orderkey", "status", "o_custkey").alias("record_hash"),
            F.col("last_month").alias("first_month"), "last_month")

    urgent = F.col("o_orderpriority") == "1-URGENT"
    base = state(orders.filter("o_orderdate < DATE '2000-01-01'"), F.col("o_orderstatus"), F.lit("2000-01"))
    delta = state(
        orders.filter((F.col("o_orderdate") >= "1999-01-01") | urgent),
        F.when(urgent, "X").otherwise(F.col("o_orderstatus")),
        F.when(F.col("o_orderpriority") == "5-LOW", "2000-01").otherwise("2000-02"))
    return upsert.upsert_changed(base, delta, ["o_orderkey"], "record_hash", "last_month",
                                 keep=["o_custkey", "first_month"])


def school_versions(spark, folder):
    """Both school deliveries merged into one history."""
    first = history.first_versions(b.schools(spark, folder), "school_id", assured.SCHOOL_ATTRIBUTES, b.BATCH_1)
    second = history.first_versions(b.schools_second(spark, folder), "school_id",
                                    assured.SCHOOL_ATTRIBUTES, b.BATCH_2)
    return history.scd2_merge(first, second)


_VERSION = """SELECT school_id, school_name, region, school_type, CAST(open_date AS VARCHAR) AS open_date, status,
       school_key AS entity_key, school_scd_key AS version_key, attribute_hash, effective_from_batch_id,
       effective_from_date, effective_to_date, is_current FROM b_dim_school"""


@register("scd2_build", "b_dim_school", _VERSION)
def scd2_build(spark, folder):
    return school_versions(spark, folder)


@register("scd2_from_history", "", """
WITH s AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_orderstatus) AS status FROM orders GROUP BY 1, 2),
c AS (SELECT * FROM (SELECT *, lag(status) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM s)
      WHERE before IS NULL OR before <> status)
SELECT o_custkey, status, sha256(status) AS attribute_hash, day AS effective_from_date,
       lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - 1 AS effective_to_date,
       lead(day) OVER (PARTITION BY o_custkey ORDER BY day) IS NULL AS is_current
FROM c""")
def scd2_from_history(spark, folder):
    """A customer's daily state is the highest status among the day's orders."""
    states = b.table(spark, folder, "orders").groupBy(
        "o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(F.max("o_orderstatus").alias("status"))
    return history.scd2_from_history(states, "o_custkey", ["status"], "day")


@register("scd2_asof_join", "b_attendance b_dim_school", """
SELECT a.batch_id, a.attendance_id, v.school_scd_key AS version_key, v.status
FROM b_attendance a LEFT JOIN b_dim_school v ON v.school_id = a.school_id
 AND CAST(a.batch_id AS DATE) >= v.effective_from_date
 AND (v.effective_to_date IS NULL OR CAST(a.batch_id AS DATE) <= v.effective_to_date)""")
def scd2_asof_join(spark, folder):
    facts = b.silver(spark, folder)["attendance"].withColumn("day", F.col("batch_id").cast("date"))
    joined = matching.as_of_join(facts, school_versions(spark, folder), ["school_id"], "day",
                                 take=["version_key", "status"])
    return joined.select("batch_id", "attendance_id", "version_key", "status")


def _order_changes(spark, folder):
    """Every order is a change of its customer's status and level."""
    return b.table(spark, folder, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey",
        "o_orderstatus", (F.col("o_orderkey") % 13).cast("int").alias("level"))


_CHANGES = """SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, o_orderstatus,
       CAST(o_orderkey % 13 AS INTEGER) AS level FROM orders"""


@register("replay_state", "", f"""
SELECT o_custkey, month, o_orderkey, o_orderstatus, level FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY month DESC, o_orderkey DESC) AS rn
  FROM ({_CHANGES}) WHERE month <= '1999-06') WHERE rn = 1""")
def replay_state(spark, folder):
    return history.replay_state(_order_changes(spark, folder), ["o_custkey"], "month",
                                [F.desc("o_orderkey")], "1999-06")


@register("replay_months", "c_slices", f"""
SELECT o_custkey, state_month, o_orderstatus, level FROM (
  SELECT c.*, m.reporting_month AS state_month,
         row_number() OVER (PARTITION BY c.o_custkey, m.reporting_month ORDER BY c.month DESC, c.o_orderkey DESC) AS rn
  FROM ({_CHANGES}) c JOIN c_slices m ON m.reporting_month >= c.month) WHERE rn = 1""")
def replay_months(spark, folder):
    """State of every customer at every month from the first change on."""
    months = b.slices(spark, folder).withColumnRenamed("reporting_month", "month")
    return history.replay_all_months(_order_changes(spark, folder), months, ["o_custkey"], "month",
                                     ["o_orderkey"], ["o_orderstatus", "level"])


@register("monthly_snapshot", "", """
SELECT c_custkey, c_mktsegment FROM customer c
WHERE (upper(c_mktsegment) IN ('BUILDING', 'FURNITURE')
       OR EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderdate >= DATE '2001-06-01'))
  AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'error')""")
def monthly_snapshot(spark, folder):
    customer = b.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    active = b.table(spark, folder, "orders").filter("o_orderdate >= DATE '2001-06-01'").select(
        F.col("o_custkey").alias("c_custkey"))
    refused = b.table(spark, folder, "events").filter("event_type = 'error'").select(
        F.col("user_id").alias("c_custkey"))
    return history.monthly_snapshot(customer, checks.status_in("c_mktsegment", ["building", "furniture"]),
                                    active, refused, ["c_custkey"])


@register("latest_lookup", "", """
SELECT o.o_orderkey, year(o.o_orderdate) AS order_year, l.l_returnflag
FROM orders o LEFT JOIN (
  SELECT l_orderkey, year(l_shipdate) AS y, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey, year(l_shipdate)
           ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_returnflag DESC) AS rn
  FROM lineitem) l ON l.l_orderkey = o.o_orderkey AND l.y = year(o.o_orderdate) AND l.rn = 1""")
def latest_lookup(spark, folder):
    """Flag of the last line shipped in the year of the order."""
    orders = b.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), F.year("o_orderdate").alias("order_year"))
    lines = b.table(spark, folder, "lineitem").withColumns(
        {"key": F.col("l_orderkey"), "order_year": F.year("l_shipdate")})
    found = matching.latest_lookup(orders, lines, ["key", "order_year"], "l_returnflag",
                                   ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"],
                                   "l_returnflag")
    return found.select(F.col("key").alias("o_orderkey"), F.col("order_year").cast("bigint").alias("order_year"),
                        "l_returnflag")


@register("run_ledger", "", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def run_ledger(spark, folder):
    """Events as an append-only log: the last state of each user."""
    return upsert.latest_run_state(b.table(spark, folder, "events"), "user_id", ["ts", "event_id"],
                                   ["event_id", "event_type", "value"])


@register("latest_overall", "", """
SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def latest_overall(spark, folder):
    return rows.latest_overall(b.table(spark, folder, "events"), F.desc("ts"), F.desc("event_id")).select(
        "event_id", "user_id", "event_type")


class Monthly:
    """Conformed state, dimensions and facts of the monthly pipeline over all slices.
    The two state tables are materialised, as the pipeline stores them; with ``stored`` so are the conformed attendance,
    scores and snapshots, for queries that read them more than once, and attendance after its rules, for what these found."""

    def __init__(self, spark, folder, stored=False):
        self._keep = materialise if stored else lambda df: df
        self.bronze, self.slices = b.monthly_bronze(spark, folder), b.slices(spark, folder)
        self.quality = monthly_run(spark, folder, self.bronze)
        state = monthly.empty_state(spark)
        self.schools = materialise(monthly.merge_schools(state["school"], self.bronze["schools"]))
        self.students = materialise(monthly.merge_students(
            state["student"], self.bronze["students"], self.quality.rejected_of("bronze.students"), self.schools))
        self._state, self._known = state, b.known_students(spark, folder)
        self._screened = self.quality.numbered_attendance(self.students) if stored else None
        self.spark = spark

    @cached_property
    def attendance(self):
        if self._screened is not None:
            return self._keep(monthly.conformed_attendance_of_screened(self._screened, self.schools))
        return monthly.conformed_attendance_in_one_pass(
            self.bronze["attendance"], self.bronze["students"], self._known, self.students, self.schools)

    @cached_property
    def scores(self):
        return self._keep(monthly.conformed_assessment_in_one_pass(
            self.bronze["assessment_results"], self.students, self.schools))

    @property
    def score_state(self):
        return monthly.merge_assessment(self._state["assessment_result"], self.scores)

    @cached_property
    def status(self):
        return self._keep(monthly.snapshot_students(self.students, self.bronze["attendance"],
                                                    self.quality.rejected_of("bronze.students"), self.slices))

    @property
    def bands(self):
        return monthly.dim_attendance_band(self.spark)

    @property
    def domains(self):
        return monthly.dim_assessment_domain(self.spark)

    @property
    def fact_attendance(self):
        return monthly.fact_attendance_monthly(self.attendance, self.status, self.bands)

    @property
    def fact_scores(self):
        return monthly.fact_assessment_result(self.score_state, self.domains, self.students,
                                              self.attendance, self.bands)


@register("conformed_school", "c_school", """
SELECT school_key, school_id, school_name, region, school_type, open_date, status,
       '1995_01' AS source_batch_id, '1995-01' AS effective_from_month, '1995-01' AS last_seen_reporting_month,
       sha256(school_id || '||' || school_name || '||' || region || '||' || school_type || '||'
              || coalesce(CAST(open_date AS VARCHAR), '') || '||' || status) AS record_hash,
       'Valid' AS validation_status FROM c_school""")
def conformed_school(spark, folder):
    return Monthly(spark, folder).schools


@register("conformed_person", "c_student c_school", """
SELECT s.student_key, s.student_id, c.school_key AS current_school_key, s.current_school_id, s.current_year_level,
       s.gender, s.enrolment_date, s.status, s.source_batch_id, s.reporting_month AS effective_from_month,
       s.reporting_month AS last_seen_reporting_month, 'Valid' AS validation_status
FROM c_student s LEFT JOIN c_school c ON c.school_id = s.current_school_id""")
def conformed_person(spark, folder):
    return Monthly(spark, folder).students.drop("record_hash")


@register("conformed_activity", "c_conformed_attendance", "SELECT * FROM c_conformed_attendance")
def conformed_activity(spark, folder):
    return Monthly(spark, folder).attendance


@register("conformed_score", "c_conformed_scores", "SELECT * FROM c_conformed_scores")
def conformed_score(spark, folder):
    return Monthly(spark, folder).scores


@register("conformed_event", "c_events c_school", """
SELECT e.event_id, e.source_batch_id, e.reporting_month, c.school_key, e.event_type,
       CAST(e.event_date AS DATE) AS event_date, e.description
FROM c_events e JOIN c_school c ON c.school_id = e.school_id""")
def conformed_event(spark, folder):
    run = Monthly(spark, folder)
    return monthly.conformed_events(run.bronze["school_events"], run.schools)


@register("student_status", "c_status", "SELECT *, 'Valid' AS validation_status FROM c_status")
def student_status(spark, folder):
    return Monthly(spark, folder).status


@register("fact_snapshot", "c_status", """
SELECT CAST(replace(reporting_month, '-', '') AS INTEGER) AS month_key, student_key, school_key,
       year_level AS year_level_key, CASE WHEN upper(student_status) IN ('ACTIVE', 'ENROLLED') THEN 1 ELSE 0 END
         AS is_active_student, source_batch_id FROM c_status""")
def fact_snapshot(spark, folder):
    return monthly.fact_student_snapshot(Monthly(spark, folder).status)


@register("fact_monthly_activity", "c_fact_attendance", "SELECT * FROM c_fact_attendance")
def fact_monthly_activity(spark, folder):
    return Monthly(spark, folder).fact_attendance


@register("fact_monthly_score", "c_fact_score c_domain c_band", """
SELECT f.assessment_result_key, f.assessment_year, f.student_key, f.school_key, f.year_level_key,
       d.assessment_domain_key, b.attendance_band_key, f.score, f.source_batch_id
FROM c_fact_score f JOIN c_domain d ON d.domain = f.domain LEFT JOIN c_band b ON b.attendance_band = f.attendance_band""")
def fact_monthly_score(spark, folder):
    return Monthly(spark, folder).fact_scores


@register("fact_caveats", "c_caveats c_results", """
SELECT CAST(replace(c.reporting_month, '-', '') AS INTEGER) AS month_key, c.caveat_code, c.severity,
       c.affected_area, r.failed_record_count, c.source_batch_id
FROM c_caveats c JOIN c_results r ON r.reporting_month = c.reporting_month AND r.rule_id = c.caveat_code""")
def fact_caveats(spark, folder):
    quality = monthly_run(spark, folder)
    return monthly.fact_data_quality_caveat(quality.caveats, quality.results)
