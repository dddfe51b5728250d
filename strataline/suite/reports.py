"""Report measures over the trusted facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands, dates, labels
from ..operators import measures
from ..operators.quality import union_all
from . import bindings as b
from .quality import monthly_run
from .registry import register

_REGION = "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
# One record per lineitem: possible and attended days, month, region, level, person.
_LINES = f"""
SELECT l_partkey AS person, l_suppkey AS school, CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS month_key,
       CAST(month(l_shipdate) AS INTEGER) AS month_number, CAST(year(l_shipdate) AS INTEGER) AS year_number,
       r_name AS region, CAST(l_partkey % 13 AS INTEGER) AS year_level,
       CASE WHEN month(l_shipdate) = 1 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS possible_days,
       CASE WHEN month(l_shipdate) = 1 THEN 0
            ELSE greatest(CAST(l_quantity AS INTEGER) - l_linenumber % 4, 0) END AS attended_days
FROM lineitem {_REGION}"""
_RATE = "CASE WHEN sum(possible_days) > 0 THEN round(sum(attended_days)::DOUBLE / sum(possible_days), 4) END"
_SUMS = "CAST(sum(possible_days) AS BIGINT) AS possible_days, CAST(sum(attended_days) AS BIGINT) AS attended_days"
_PRIOR = "CASE WHEN month_key % 100 = 1 THEN month_key - 89 ELSE month_key - 1 END"


def lines(spark, folder):
    supplier, nation, region = (b.table(spark, folder, t) for t in ("supplier", "nation", "region"))
    places = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("region")))
    january = F.month("l_shipdate") == 1
    quantity = F.col("l_quantity").cast("int")
    return b.table(spark, folder, "lineitem").join(places, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").alias("person"), F.col("l_suppkey").alias("school"),
        F.date_format("l_shipdate", "yyyyMM").cast("int").alias("month_key"),
        F.month("l_shipdate").alias("month_number"), F.year("l_shipdate").alias("year_number"), "region",
        (F.col("l_partkey") % 13).cast("int").alias("year_level"),
        F.when(january, 0).otherwise(quantity).alias("possible_days"),
        F.when(january, 0).otherwise(F.greatest(quantity - F.col("l_linenumber") % 4, F.lit(0)))
        .alias("attended_days"))


def _prior_key():
    day = F.to_date(F.col("month_key").cast("string"), "yyyyMM")
    return dates.prior_month_key(day)


@register("kpi_movement", "", f"""
WITH r AS (SELECT region, month_key, {_SUMS}, {_RATE} AS attendance_rate FROM ({_LINES}) GROUP BY 1, 2)
SELECT r.*, p.attendance_rate AS prior_attendance_rate,
       round(r.attendance_rate - p.attendance_rate, 4) AS change
FROM r LEFT JOIN r p ON p.region = r.region
 AND p.month_key = CASE WHEN r.month_key % 100 = 1 THEN r.month_key - 89 ELSE r.month_key - 1 END""")
def kpi_movement(spark, folder):
    rates = measures.attendance_rate(lines(spark, folder), ["region", "month_key"])
    return measures.movement(rates, "month_key", _prior_key(), ["region"])


@register("kpi_yoy", "", f"""
WITH r AS (SELECT region, month_key, {_SUMS}, {_RATE} AS attendance_rate FROM ({_LINES}) GROUP BY 1, 2)
SELECT r.*, p.attendance_rate AS prior_year_attendance_rate,
       round(r.attendance_rate - p.attendance_rate, 4) AS change
FROM r LEFT JOIN r p ON p.region = r.region AND p.month_key = r.month_key - 100""")
def kpi_yoy(spark, folder):
    rates = measures.attendance_rate(lines(spark, folder), ["region", "month_key"])
    return measures.year_on_year(rates, "month_key", ["region"])


@register("kpi_counts", "", f"""
SELECT month_key, count(DISTINCT person) AS student_count,
       count(DISTINCT CASE WHEN attended_days > 0 THEN person END) AS students_with_attendance,
       count(*) AS student_month_count FROM ({_LINES}) GROUP BY 1""")
def kpi_counts(spark, folder):
    """Records shrink to one per (month, person) before people are counted."""
    people = lines(spark, folder).groupBy("month_key", "person").agg(
        F.count(F.lit(1)).alias("records"), F.max(F.col("attended_days") > 0).alias("attended"))
    return people.groupBy("month_key").agg(
        F.count(F.lit(1)).alias("student_count"),
        F.count_if("attended").alias("students_with_attendance"),
        F.sum("records").alias("student_month_count"))


_IF_RATE = """CASE WHEN sum(CASE WHEN {0} THEN possible_days END) > 0 THEN
round(sum(CASE WHEN {0} THEN attended_days END)::DOUBLE / sum(CASE WHEN {0} THEN possible_days END), 4) END"""
_WINTER = "month_number IN (6, 7, 8)"


@register("kpi_season", "", f"""
SELECT *, round(winter_rate - other_rate, 4) AS winter_gap FROM (
SELECT coalesce(region, 'All') AS region, {_IF_RATE.format(_WINTER)} AS winter_rate,
       {_IF_RATE.format('NOT ' + _WINTER)} AS other_rate FROM ({_LINES}) GROUP BY GROUPING SETS ((region), ()))""")
def kpi_season(spark, folder):
    rows = lines(spark, folder)
    winter = F.col("month_number").isin(*dates.SEASON_MONTHS["Winter"])
    conditions = {"winter_rate": winter, "other_rate": ~winter}
    rates = measures.with_overall(rows, "region", [measures.rate_where(c, n) for n, c in conditions.items()])
    return measures.with_gap(rates, "winter_rate", "other_rate", "winter_gap")


@register("kpi_groups", "", f"""
SELECT month_key, {_IF_RATE.format('year_level = 7')} AS year_7_rate,
       {_IF_RATE.format('year_level BETWEEN 8 AND 10')} AS years_8_10_rate,
       {_IF_RATE.format('year_level > 10')} AS senior_rate FROM ({_LINES}) GROUP BY 1""")
def kpi_groups(spark, folder):
    cohort = labels.cohort_group("year_level")
    return measures.conditional_rates(lines(spark, folder), ["month_key"], {
        "year_7_rate": cohort == "Year 7 transition", "years_8_10_rate": cohort == "Years 8-10",
        "senior_rate": cohort == "Senior secondary"})


@register("kpi_at_risk", "", f"""
SELECT *, CASE WHEN rated_count > 0 THEN round(at_risk_count::DOUBLE / rated_count, 4) END AS at_risk_share FROM (
SELECT region, month_key, count(CASE WHEN possible_days > 0 THEN 1 END) AS rated_count,
       count(CASE WHEN possible_days > 0 AND attended_days::DOUBLE / possible_days < 0.80 THEN 1 END) AS at_risk_count
FROM ({_LINES}) GROUP BY 1, 2)""")
def kpi_at_risk(spark, folder):
    return measures.at_risk(lines(spark, folder), ["region", "month_key"])


_BAND = """CASE WHEN possible_days <= 0 THEN NULL WHEN attended_days::DOUBLE / possible_days < 0.82 THEN 'Low'
WHEN attended_days::DOUBLE / possible_days < 0.90 THEN 'Medium' ELSE 'High' END"""


@register("kpi_distribution", "", f"""
SELECT year_level, count(*) FILTER (band = 'Low') AS "Low", count(*) FILTER (band = 'Medium') AS "Medium",
       count(*) FILTER (band = 'High') AS "High"
FROM (SELECT *, {_BAND} AS band FROM ({_LINES})) GROUP BY 1""")
def kpi_distribution(spark, folder):
    banded = lines(spark, folder).withColumn(
        "band", bands.monthly_attendance_band("attended_days", "possible_days"))
    return measures.distribution(banded, ["year_level"], "band", labels.BANDS)


@register("kpi_cohort", "", f"""
WITH a AS ({_LINES}), base AS (
  SELECT person, max(year_level) AS base_cohort FROM a WHERE month_key = 199802 GROUP BY 1)
SELECT base_cohort, month_key, {_SUMS}, {_RATE} AS attendance_rate
FROM a JOIN base USING (person) GROUP BY 1, 2""")
def kpi_cohort(spark, folder):
    """People seen in February 1998, tracked through every month by their level then."""
    rows = lines(spark, folder)
    seen = rows.groupBy("person", "month_key").agg(F.max("year_level").alias("year_level"))
    cohort = measures.base_cohort(seen, F.col("month_key") == 199802, "person", "year_level")
    return measures.track_cohort(rows, cohort, "person", ["month_key"])


@register("kpi_gap", "raw_scores", """
WITH s AS (SELECT domain, proficiency_band AS band, TRY_CAST(score AS INTEGER) AS score FROM raw_scores)
SELECT coalesce(domain, 'All') AS domain, count(*) AS record_count, round(avg(score), 2) AS average_score,
       round(avg(CASE WHEN band = 'High' THEN score END), 2) AS high_average,
       round(avg(CASE WHEN band = 'Low' THEN score END), 2) AS low_average,
       round(avg(CASE WHEN band = 'High' THEN score END) - avg(CASE WHEN band = 'Low' THEN score END), 2) AS score_gap
FROM s GROUP BY GROUPING SETS ((domain), ())""")
def kpi_gap(spark, folder):
    scores = b.assessment_rows(spark, folder).withColumn("score", F.col("score").try_cast("int"))
    return measures.with_overall(scores, "domain", measures.high_low_gap("proficiency_band"))


@register("kpi_heatmap", "", f"""
SELECT month_key, {', '.join(_IF_RATE.format(f'year_level = {v}') + f' AS level_{v}' for v in range(13))}
FROM ({_LINES}) GROUP BY 1""")
def kpi_heatmap(spark, folder):
    return measures.heatmap(lines(spark, folder), "month_key", "year_level", list(range(13)), "level_")


@register("kpi_seasonal_pattern", "", f"""
SELECT month_number, CASE WHEN year_level <= 6 THEN 'Primary' WHEN year_level = 7 THEN 'Year 7 transition'
       WHEN year_level <= 10 THEN 'Years 8-10' ELSE 'Senior secondary' END AS cohort_group,
       {_SUMS}, {_RATE} AS attendance_rate FROM ({_LINES}) GROUP BY 1, 2""")
def kpi_seasonal_pattern(spark, folder):
    rows = lines(spark, folder).withColumn("cohort_group", labels.cohort_group("year_level"))
    return measures.attendance_rate(rows, ["month_number", "cohort_group"])


@register("kpi_caveats", "c_caveats", """
SELECT reporting_month, severity, affected_area, count(*) AS caveat_count FROM c_caveats GROUP BY 1, 2, 3""")
def kpi_caveats(spark, folder):
    return monthly_run(spark, folder, store=None).caveats.groupBy("reporting_month", "severity", "affected_area").agg(
        F.count(F.lit(1)).alias("caveat_count"))


@register("kpi_mean_ratio", "", f"""
SELECT month_key, round(round(avg(CASE WHEN possible_days > 0 THEN attended_days::DOUBLE / possible_days END), 10), 4) AS mean_rate,
       {_RATE} AS ratio_of_sums FROM ({_LINES}) GROUP BY 1""")
def kpi_mean_ratio(spark, folder):
    """The mean of the records' rates next to the ratio of their sums."""
    rates = measures.attendance_rate(lines(spark, folder), ["month_key"], measures.mean_of_ratios())
    return rates.select("month_key", "mean_rate", F.col("attendance_rate").alias("ratio_of_sums"))


@register("kpi_mean_band", "", f"""
SELECT person, year_number, round(round(m, 10), 4) AS mean_rate,
       CASE WHEN round(m, 10) < 0.82 THEN 'Low' WHEN round(m, 10) < 0.90 THEN 'Medium' WHEN m IS NOT NULL THEN 'High' END AS mean_band
FROM (SELECT person, year_number, avg(CASE WHEN possible_days > 0 THEN attended_days::DOUBLE / possible_days END) AS m
      FROM ({_LINES}) GROUP BY 1, 2)""")
def kpi_mean_band(spark, folder):
    return measures.mean_rate_to_date(lines(spark, folder), ["person", "year_number"], bands.MONTHLY_ATTENDANCE)


@register("kpi_quartiles", "raw_scores", """
SELECT domain, count(score) AS record_count, quantile_cont(score, 0.25) AS p25, quantile_cont(score, 0.5) AS median,
       quantile_cont(score, 0.75) AS p75
FROM (SELECT domain, TRY_CAST(score AS INTEGER) AS score FROM raw_scores) WHERE score IS NOT NULL GROUP BY 1""")
def kpi_quartiles(spark, folder):
    scores = b.assessment_rows(spark, folder).withColumn("score", F.col("score").try_cast("int"))
    return measures.quartiles(scores.dropna(subset=["score"]), ["domain"], "score")


@register("kpi_volatility", "", f"""
WITH r AS (SELECT region, month_key, {_RATE} AS rate FROM ({_LINES}) GROUP BY 1, 2)
SELECT region, count(d) AS change_count, round(stddev_samp(d), 6) AS rate_volatility
FROM (SELECT region, rate - lag(rate) OVER (PARTITION BY region ORDER BY month_key) AS d FROM r) GROUP BY 1""")
def kpi_volatility(spark, folder):
    rates = measures.attendance_rate(lines(spark, folder), ["region", "month_key"])
    return measures.volatility(rates, ["region"], "month_key")


@register("lowest_group", "", f"""
WITH r AS (SELECT region, month_key, {_RATE} AS rate FROM ({_LINES}) GROUP BY 1, 2)
SELECT month_key, region AS lowest_region, rate AS lowest_attendance_rate FROM (
  SELECT *, row_number() OVER (PARTITION BY month_key ORDER BY rate, region) AS rn FROM r WHERE rate IS NOT NULL)
WHERE rn = 1""")
def lowest_group(spark, folder):
    rates = measures.attendance_rate(lines(spark, folder), ["region", "month_key"])
    return measures.lowest_group(rates, ["month_key"], "region")


@register("monthly_brief", "", f"""
WITH r AS (SELECT month_key, {_RATE} AS attendance_rate, count(DISTINCT person) AS student_count
           FROM ({_LINES}) GROUP BY 1),
j AS (SELECT r.*, p.attendance_rate AS pr, p.student_count AS ps FROM r LEFT JOIN r p
      ON p.month_key = CASE WHEN r.month_key % 100 = 1 THEN r.month_key - 89 ELSE r.month_key - 1 END)
SELECT month_key, 'attendance_rate' AS metric, attendance_rate AS current_value, pr AS prior_value,
       round(attendance_rate - pr, 4) AS movement FROM j
UNION ALL SELECT month_key, 'student_count', student_count::DOUBLE, ps::DOUBLE, round(student_count::DOUBLE - ps, 4) FROM j""")
def monthly_brief(spark, folder):
    from ..operators.matching import prior_period

    current = measures.attendance_rate(lines(spark, folder), ["month_key"],
                                       F.countDistinct("person").alias("student_count"))
    joined = prior_period(current, "month_key", _prior_key(), [],
                          {"attendance_rate": "prior_attendance_rate", "student_count": "prior_student_count"})
    return measures.brief(joined, ["month_key"], ["attendance_rate", "student_count"])


@register("raw_caveat_counts", "c_attendance c_students c_scores", """
SELECT reporting_month, count(*) AS caveat_count FROM (
  SELECT reporting_month FROM c_attendance WHERE p IS NULL OR t IS NULL OR p < 0 OR t < 0 OR t > p
  UNION ALL SELECT reporting_month FROM c_students WHERE trim(school_id) = ''
  UNION ALL SELECT reporting_month FROM c_scores WHERE value IS NULL OR value < 250 OR value > 700) GROUP BY 1""")
def raw_caveat_counts(spark, folder):
    """Caveats per month straight from the delivered rows."""
    from ..functions import checks
    from ..functions.text import is_blank, to_decimal, to_int

    bronze = b.monthly_bronze(spark, folder)
    bad = {
        "attendance": checks.bad_day_counts(to_int("possible_days"), to_int("attended_days")),
        "students": is_blank("school_id"),
        "assessment_results": checks.missing_or_outside(to_decimal("score", 6, 2), 250, 700),
    }
    counted = [bronze[t].filter(c).groupBy("reporting_month").agg(F.count(F.lit(1)).alias("n"))
               for t, c in bad.items()]
    return union_all(counted).groupBy("reporting_month").agg(F.sum("n").alias("caveat_count"))


@register("mart_level_pattern", "", f"""
SELECT month_key, school, year_level, {_SUMS}, count(DISTINCT person) AS student_count, {_RATE} AS attendance_rate
FROM ({_LINES}) GROUP BY 1, 2, 3""")
def mart_level_pattern(spark, folder):
    return measures.attendance_rate(lines(spark, folder), ["month_key", "school", "year_level"],
                                    F.countDistinct("person").alias("student_count"))
