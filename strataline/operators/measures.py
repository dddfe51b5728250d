"""Report measures. Days are summed before they are divided unless a name says
otherwise; every measure is one aggregate (plus a join to an earlier period)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bands import AT_RISK_BELOW, Scale
from ..functions.ratios import ratio_decimal, ratio_double, ratio_exact, steady_round
from ..session import materialise
from .matching import prior_period


def summed_days(df: DataFrame, by: Sequence[str], *extra: Column,
                possible: str = "possible_days", attended: str = "attended_days") -> DataFrame:
    """Possible and attended days per group with any further aggregates."""
    return df.groupBy(*by).agg(F.sum(possible).alias("possible_days"),
                               F.sum(attended).alias("attended_days"), *extra)


def distinct_numbers(df: DataFrame, by: Sequence[str], key: str, name: str) -> DataFrame:
    """Exact distinct count of an integer key per group from bitmaps of 32,768 keys each: combined before the shuffle, and
    mergeable, since the bitmaps of two periods or partitions can be joined by OR. For coarse groups, where a bitmap
    holds many keys."""
    bits = df.groupBy(*by, F.bitmap_bucket_number(key).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits"))
    return bits.groupBy(*by).agg(F.sum(F.bitmap_count("_bits")).alias(name))


def attendance_rate(df: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """Ratio of sums, rounded to four digits."""
    return summed_days(df, by, *extra).withColumn(
        "attendance_rate", ratio_double("attended_days", "possible_days"))


def attendance_rate_decimal(df: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    return summed_days(df, by, *extra).withColumn(
        "attendance_rate", ratio_decimal("attended_days", "possible_days"))


def mean_of_ratios(name: str = "mean_rate") -> Column:
    """Aggregate: unweighted mean of each record's own rate; differs from the ratio of sums."""
    return steady_round(F.avg(ratio_exact("attended_days", "possible_days")), 4).alias(name)


def rate_where(condition: Column, name: str) -> Column:
    """Conditional ratio of sums as an aggregate expression."""
    return ratio_double(F.sum(F.when(condition, F.col("attended_days"))),
                        F.sum(F.when(condition, F.col("possible_days")))).alias(name)


def conditional_rates(df: DataFrame, by: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Several conditional rates in one pass (season, cohort group, ...)."""
    return df.groupBy(*by).agg(*[rate_where(c, name) for name, c in conditions.items()])


def with_overall(df: DataFrame, key: str, aggregates: Sequence[Column], overall: str = "All") -> DataFrame:
    """Aggregates by ``key`` and over everything in one pass (grouping sets)."""
    total = F.grouping(key) == 1
    grouped = df.rollup(key).agg(total.alias("_total"), *aggregates)
    return grouped.withColumn(key, F.when(F.col("_total"), F.lit(overall)).otherwise(F.col(key))).drop("_total")


def with_gap(df: DataFrame, high: str, low: str, name: str, digits: int = 4) -> DataFrame:
    return df.withColumn(name, F.round(F.col(high) - F.col(low), digits))


def movement(rates: DataFrame, month_key: str, prior_key: Column, keys: Sequence[str] = (),
             value: str = "attendance_rate") -> DataFrame:
    """Value of the prior month (by key, so gaps stay gaps) and the change."""
    joined = prior_period(rates, month_key, prior_key, keys, {value: f"prior_{value}"})
    return joined.withColumn("change", F.round(F.col(value) - F.col(f"prior_{value}"), 4))


def year_on_year(rates: DataFrame, month_key: str, keys: Sequence[str] = (),
                 value: str = "attendance_rate") -> DataFrame:
    """Same month one year before (yyyymm - 100) and the change."""
    joined = prior_period(rates, month_key, F.col(month_key) - 100, keys, {value: f"prior_year_{value}"})
    return joined.withColumn("change", F.round(F.col(value) - F.col(f"prior_year_{value}"), 4))


def volatility(rates: DataFrame, keys: Sequence[str], month_key: str,
               value: str = "attendance_rate") -> DataFrame:
    """Sample deviation of the month-to-month changes of a group. Runs on monthly
    rates, so a group has at most one row per month."""
    order = Window.partitionBy(*keys).orderBy(month_key)
    change = F.col(value) - F.lag(value).over(order)
    return rates.withColumn("_change", change).groupBy(*keys).agg(
        F.count("_change").alias("change_count"),
        F.round(F.stddev_samp("_change"), 6).alias("rate_volatility"))


def at_risk(df: DataFrame, by: Sequence[str], below: float = AT_RISK_BELOW) -> DataFrame:
    """Records with a rate under the threshold: count and share of records with a rate."""
    rate = ratio_exact("attended_days", "possible_days")
    rated = F.count(rate)
    risky = F.count_if(F.coalesce(rate < below, F.lit(False)))
    return df.groupBy(*by).agg(
        rated.alias("rated_count"), risky.alias("at_risk_count"),
        ratio_double(risky, rated).alias("at_risk_share"))


def distribution(df: DataFrame, by: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Record counts of a known vocabulary as columns."""
    counts = df.groupBy(*by).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return counts.fillna(0, subset=list(values))


def heatmap(df: DataFrame, row: str, column: str, values: Sequence[int | str],
            prefix: str = "") -> DataFrame:
    """Rates by row x column: sums are pivoted, then divided."""
    wide = df.groupBy(row).agg(*[
        ratio_double(F.sum(F.when(F.col(column) == v, F.col("attended_days"))),
                     F.sum(F.when(F.col(column) == v, F.col("possible_days")))).alias(f"{prefix}{v}")
        for v in values
    ])
    return wide


def base_cohort(snapshot: DataFrame, base: Column, key: str, group: str) -> DataFrame:
    """(key, cohort) as of a base period."""
    return snapshot.filter(base).select(key, F.col(group).alias("base_cohort"))


def track_cohort(df: DataFrame, cohort: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Rates of later periods for the members of a base cohort."""
    return attendance_rate(df.join(cohort, key), ["base_cohort", *by])


def score_summary(df: DataFrame, by: Sequence[str], *extra: Column, score: str = "score") -> DataFrame:
    """Average, median, minimum and maximum score of a group.

    The median is a mergeable quantile sketch: fixed memory per group.
    """
    return df.groupBy(*by).agg(
        F.round(F.avg(score), 2).alias("average_score"),
        F.percentile_approx(score, 0.5).alias("median_score"),
        F.min(score).alias("min_score"), F.max(score).alias("max_score"), *extra)


def quartiles(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Exact interpolated quartiles by rank selection; nothing holds a group's values together.

    Equal values are counted first. The counts are range-partitioned by group and value, and a table of one row per group
    and range carries how many rows lie before, so every value knows its ranks. Of each group only the values at the six
    ranks that the quartiles interpolate between are picked.
    """
    counted = materialise(
        df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")).repartitionByRange(*by, value)
        .withColumn("_range", F.spark_partition_id()))
    sizes = counted.groupBy(*by, "_range").agg(F.sum("_n").alias("_in_range"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_range").alias("_k_range"),
                          F.coalesce(F.sum("_in_range").over(before), F.lit(0)).alias("_before"),
                          F.sum("_in_range").over(group).alias("record_count"))
    running = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    on = [F.col("_range") == F.col("_k_range")] + [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    ranked = counted.withColumn("_earlier", F.coalesce(F.sum("_n").over(running), F.lit(0))).join(ranges, on).withColumn(
        "_first", F.col("_before") + F.col("_earlier"))

    def at(rank: Column) -> Column:
        held = (F.col("_first") <= rank) & (rank < F.col("_first") + F.col("_n"))
        return F.max(F.when(held, F.col(value)))

    last = F.col("record_count") - 1
    places = {name: last * F.lit(q) for name, q in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))}
    wanted = [edge(place) for place in places.values() for edge in (F.floor, F.ceil)]
    near = reduce(lambda a, b: a | b, [(F.col("_first") <= r) & (r < F.col("_first") + F.col("_n")) for r in wanted])
    picked = ranked.filter(near).groupBy(*by, "record_count").agg(*[
        at(edge(place)).alias(f"_{name}_{side}")
        for name, place in places.items() for side, edge in (("low", F.floor), ("high", F.ceil))])

    def between(name: str, place: Column) -> Column:
        low, high = F.col(f"_{name}_low").cast("double"), F.col(f"_{name}_high").cast("double")
        share = place - F.floor(place)
        return F.when(share == 0, low).otherwise((1 - share) * low + share * high).alias(name)

    return picked.select(*by, "record_count", *[between(name, place) for name, place in places.items()])


def high_low_gap(band: str, score: str = "score") -> list[Column]:
    """Aggregates: average score of the high and low band and their difference."""
    high = F.avg(F.when(F.col(band) == "High", F.col(score)))
    low = F.avg(F.when(F.col(band) == "Low", F.col(score)))
    return [
        F.count(F.lit(1)).alias("record_count"), F.round(F.avg(score), 2).alias("average_score"),
        F.round(high, 2).alias("high_average"), F.round(low, 2).alias("low_average"),
        F.round(high - low, 2).alias("score_gap")]


def lowest_group(rates: DataFrame, by: Sequence[str], group: str,
                 value: str = "attendance_rate") -> DataFrame:
    """Group with the lowest value per period; ties go to the first name."""
    ranked = rates.filter(F.col(value).isNotNull())
    return ranked.groupBy(*by).agg(
        F.min_by(group, F.struct(value, group)).alias(f"lowest_{group}"),
        F.min(value).alias(f"lowest_{value}"))


def mean_rate_to_date(records: DataFrame, keys: Sequence[str], scale: Scale) -> DataFrame:
    """Mean of a key's monthly rates in a year and the band of that mean."""
    mean = F.avg(ratio_exact("attended_days", "possible_days"))
    return (
        records.groupBy(*keys).agg(mean.alias("_mean"))
        .select(*keys, steady_round("_mean", 4).alias("mean_rate"),
                scale.label(F.round("_mean", 10)).alias("mean_band"))
    )


def brief(current: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide (metric, prior_metric) columns as rows: metric, current, prior, movement."""
    rows = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("current_value"),
                 F.col(f"prior_{m}").cast("double").alias("prior_value"))
        for m in metrics
    ])
    return current.select(*keys, F.inline(rows)).withColumn(
        "movement", F.round(F.col("current_value") - F.col("prior_value"), 4))
