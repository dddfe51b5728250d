"""Rule engine: one pass per table for all of its rules.

A rule is a boolean over a row. Rules over sets (duplicates, orphans, parent
state) first add a boolean column (``mark_duplicates``, ``mark_present``), after
which they are row rules too. Counting is a single aggregate with one
conditional count per rule, so batches without failures get their zero rows for
free; capturing failures is one projection that explodes the failed rules of a
row. Nothing is collected and no rule scans its table alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.labels import affected_area, caveat_text, recommended_action
from ..functions.text import json_payload


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_name: str
    target_table: str
    severity: str
    fails: Callable[[], Column] | None  # over a row of the marked frame
    business_key: str = ""
    failure_reason: str = ""
    recommended_action: str = ""
    business_rule: str = ""
    expected_outcome: str = ""
    rejects: bool = True  # failing rows are captured one by one
    volume: Callable[[Column], Column] | None = None  # over a slice, given its row count


CATALOGUE_COLUMNS = ("rule_id", "rule_name", "target_table", "severity", "business_rule",
                     "expected_outcome")


def catalogue(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as a table."""
    rows = [tuple(getattr(rule, c) for c in CATALOGUE_COLUMNS) for rule in rules]
    return spark.createDataFrame(rows, ", ".join(f"{c} string not null" for c in CATALOGUE_COLUMNS))


def rules_of(rules: Sequence[Rule], table: str) -> list[Rule]:
    return [r for r in rules if r.target_table == table and r.fails is not None]


def failure_counts(marked: DataFrame, rules: Sequence[Rule], by: Sequence[str]) -> DataFrame:
    """(by..., rule_id, failed_record_count), zeros included. Without ``by`` there
    is one group, also for an empty table."""
    counted = marked.groupBy(*by).agg(*[F.count_if(r.fails()).alias(r.rule_id) for r in rules])
    pairs = F.array(*[
        F.struct(F.lit(r.rule_id).alias("rule_id"), F.col(r.rule_id).alias("failed_record_count"))
        for r in rules
    ])
    return counted.select(*by, F.inline(pairs))


def result_status(count: Column, severity: Column) -> Column:
    """PASS without failures; failures warn at low severity and fail otherwise."""
    return (F.when(count == 0, "PASS").when(F.lower(severity) == "low", "WARN")
            .otherwise("FAIL"))


def pass_or_fail(count: Column) -> Column:
    return F.when(count == 0, "PASS").otherwise("FAIL")


def describe(counts: DataFrame, rules: Sequence[Rule], status: Column) -> DataFrame:
    """Add name, table, severity and status to failure counts. The rule
    attributes are literals, so no join is needed."""
    table = F.create_map(*[
        x for r in rules
        for x in (F.lit(r.rule_id), F.struct(F.lit(r.rule_name).alias("rule_name"),
                                             F.lit(r.target_table).alias("target_table"),
                                             F.lit(r.severity).alias("severity")))
    ])
    return (
        counts.withColumn("_rule", F.element_at(table, F.col("rule_id")))
        .select(*[c for c in counts.columns if c != "failed_record_count"], "_rule.*",
                "failed_record_count")
        .withColumn("status", status)
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def failed_records(marked: DataFrame, rules: Sequence[Rule], by: Sequence[str],
                   carry: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per record and failed rule of one table, with the record as JSON.

    ``carry`` names lineage columns to keep. Rows that fail nothing are dropped
    before the JSON is built. The table name is a literal, so a filter on it
    removes the other tables' branches from a union at planning time.
    """
    rules = [r for r in rules if r.rejects]
    (target_table,) = {r.target_table for r in rules}
    failures = F.array_compact(F.array(*[
        F.when(r.fails(), F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.col(r.business_key).cast("string").alias("business_key"),
            F.lit(r.failure_reason).alias("failure_reason")))
        for r in rules
    ]))
    return (
        marked.withColumn("_failures", failures).filter(F.size("_failures") > 0)
        .select(*by, *carry, F.lit(target_table).alias("target_table"),
                json_payload(list(payload)).alias("failed_record_json"), F.inline("_failures"))
    )


MASK = "_broken"


@dataclass(frozen=True)
class Screened:
    """A table after its rules: the number of rows per slice, and its failing rows with ``MASK``, a long that has one bit
    for each rule a row breaks. The marks are evaluated in one pass; all outputs read what it left. ``whole`` has the rows
    that break nothing, too, where they were kept."""

    table: str
    rules: Sequence[Rule]
    rows: DataFrame
    failing: DataFrame
    whole: DataFrame | None = None

    def bit(self, rule: Rule) -> Column:
        at = [r.rule_id for r in self.rules if r.fails is not None].index(rule.rule_id)
        return F.col(MASK).bitwiseAND(F.lit(1 << at)) != 0

    def rejected(self) -> Column:
        """True where a row breaks a rule that rejects."""
        return reduce(lambda a, b: a | b, [self.bit(r) for r in self.rules if r.rejects and r.fails is not None], F.lit(False))


def screen(table: str, marked: DataFrame, rules: Sequence[Rule], by: Sequence[str], keep: Sequence[str],
           store: Callable[[DataFrame], DataFrame], rows: DataFrame | None = None,
           carry: Sequence[str] | None = None) -> Screened:
    """Evaluate the rules of one table once; ``store`` writes the few failing rows with the columns ``keep``. With
    ``carry`` it writes every row, with these columns as well, for what goes on from the marked table.

    ``rows`` is the table before marking (the same rows): its slices are counted from their columns alone, without the
    joins the marks need.
    """
    row_rules = rules_of(rules, table)
    if len(row_rules) > 62:
        raise ValueError("a table has at most 62 row rules")
    bits = [F.when(r.fails(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(row_rules)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    columns = list(dict.fromkeys([*by, *keep, *[r.business_key for r in row_rules if r.rejects and r.business_key]]))
    kept, failed = marked.select(*columns, *(carry or ()), mask.alias(MASK)), F.col(MASK) != 0
    whole = None if carry is None else store(kept)
    failing = store(kept.filter(failed)) if whole is None else whole.filter(failed)
    counted = (marked if rows is None else rows).groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    return Screened(table, [r for r in rules if r.target_table == table], counted, failing, whole)


def screened_counts(screened: Screened, by: Sequence[str], slices: DataFrame | None = None) -> DataFrame:
    """(by..., rule_id, failed_record_count) of every rule, for the given slices or those the table has rows of."""
    row_rules = [r for r in screened.rules if r.fails is not None]
    broken = screened.failing.groupBy(*by).agg(*[F.count_if(screened.bit(r)).alias(r.rule_id) for r in row_rules])
    base = screened.rows if slices is None else slices.select(*by).join(screened.rows, list(by), "left")
    rows = F.coalesce("_rows", F.lit(0))

    def failures(rule: Rule) -> Column:
        if rule.volume is not None:
            return rule.volume(rows).cast("bigint")
        return F.coalesce(rule.rule_id, F.lit(0))

    pairs = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), failures(r).alias("failed_record_count"))
                      for r in screened.rules])
    return base.join(broken, list(by), "left").select(*by, F.inline(pairs))


def screened_records(screened: Screened, by: Sequence[str], carry: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per failing record and broken rule that rejects, with the record as JSON."""
    rejecting = [r for r in screened.rules if r.fails is not None and r.rejects]
    failures = F.array_compact(F.array(*[
        F.when(screened.bit(r), F.struct(
            F.lit(r.rule_id).alias("rule_id"), F.col(r.business_key).cast("string").alias("business_key"),
            F.lit(r.failure_reason).alias("failure_reason")))
        for r in rejecting
    ]))
    return (
        screened.failing.withColumn("_failures", failures).filter(F.size("_failures") > 0)
        .select(*by, *carry, F.lit(screened.table).alias("target_table"),
                json_payload(list(payload)).alias("failed_record_json"), F.inline("_failures"))
    )


def passing(marked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fail none of the rules: quarantine in the pass that marks, with
    no join back from captured failures."""
    failed = reduce(lambda a, b: a | b, [r.fails() for r in rules])
    return marked.filter(~failed)


def rejected(rules: Sequence[Rule]) -> Column:
    """True where a row of the marked frame breaks a rule that rejects."""
    return reduce(lambda a, b: a | b, [r.fails() for r in rules if r.rejects and r.fails is not None], F.lit(False))


def quarantine_keys(failed: DataFrame, table: str, rule_ids: Sequence[str], key: str) -> DataFrame:
    """Distinct record ids that disqualify a row of ``table`` from the facts."""
    return (
        failed.filter((F.col("target_table") == table) & F.col("rule_id").isin(*rule_ids))
        .select(key).distinct()
    )


def defects(results: DataFrame, rules: Sequence[Rule], run_id: Column, by: str) -> DataFrame:
    """One open defect per rule and batch with failures."""
    actions = F.create_map(*[F.lit(x) for r in rules for x in (r.rule_id, r.recommended_action)])
    return results.filter("failed_record_count > 0").select(
        F.concat_ws("_", "rule_id", by, run_id).alias("defect_id"),
        run_id.alias("run_id"), by, "rule_id", "severity", "target_table",
        F.col("rule_name").alias("defect_title"), F.lit("Open").alias("defect_status"),
        "failed_record_count",
        F.element_at(actions, F.col("rule_id")).alias("recommended_action"),
    )


def caveats(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Reporting notes from failed rules; ``rule_name`` holds the description."""
    return results.filter("failed_record_count > 0").select(
        *by, F.col("rule_id").alias("caveat_code"), F.col("rule_id").alias("caveat_title"),
        caveat_text("rule_name", "failed_record_count").alias("caveat_description"),
        "severity", affected_area("target_table").alias("affected_area"),
        recommended_action("severity").alias("recommended_action"),
    )


# Readiness texts.
READINESS_TEXT = {
    "BLOCKER": "Blocker checks failed. This reporting month should not be released until required data is loaded or corrected.",
    "ERROR": "Quality checks found error-level issues. Invalid rows should be excluded from trusted reporting.",
    "WARNING": "Quality checks found warning-level caveats. Reporting can proceed with notes.",
    "NONE": "Quality checks passed for this reporting month.",
}


def readiness(results: DataFrame, rejected: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per slice: only a failed blocker stops it; errors and warnings
    leave it ready with caveats."""
    def failed(severity: str) -> Column:
        return F.count_if((F.col("severity") == severity) & (F.col("failed_record_count") > 0))

    counts = results.groupBy(*by).agg(
        failed("BLOCKER").alias("blocker_count"), failed("ERROR").alias("error_count"),
        failed("WARNING").alias("warning_count"))
    rejects = rejected.groupBy(*by).agg(F.count(F.lit(1)).alias("_rejects"))
    worst = (F.when(F.col("blocker_count") > 0, "BLOCKER").when(F.col("error_count") > 0, "ERROR")
             .when(F.col("warning_count") > 0, "WARNING").otherwise("NONE"))
    status = (F.when(F.col("_worst") == "BLOCKER", "NOT_READY")
              .when(F.col("_worst") == "NONE", "READY").otherwise("READY_WITH_CAVEATS"))
    texts = F.create_map(*[F.lit(x) for pair in READINESS_TEXT.items() for x in pair])
    return (
        counts.join(rejects, list(by), "left").withColumn("_worst", worst)
        .select(*by, status.alias("readiness_status"), "blocker_count", "error_count",
                "warning_count", F.coalesce("_rejects", F.lit(0)).alias("rejected_record_count"),
                F.element_at(texts, F.col("_worst")).alias("readiness_summary"))
    )


READY = ("READY", "READY_WITH_CAVEATS")


def require_ready(readiness_rows: DataFrame, slice_filter: Column) -> None:
    """Raise unless the slice has been checked and is ready."""
    if not readiness_rows.filter(slice_filter & F.col("readiness_status").isin(*READY)).take(1):
        raise RuntimeError("Quality checks are not ready for this batch. Merge stopped.")


def only_ready(df: DataFrame, readiness_rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ready slices (the gate as a semi join, for many slices at once)."""
    ready = readiness_rows.filter(F.col("readiness_status").isin(*READY)).select(*by)
    return df.join(ready, list(by), "left_semi")


def slice_failures(slices: DataFrame, marked: DataFrame, rules: Sequence[Rule],
                   by: Sequence[str]) -> DataFrame:
    """(by..., rule_id, failed_record_count) of one table for every given slice,
    also for slices no row has reached. Row rules and the row count that volume
    rules look at come from one aggregate over the table."""
    row_rules = [r for r in rules if r.fails is not None]
    counted = marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(r.fails()).alias(r.rule_id) for r in row_rules])
    joined = slices.select(*by).join(counted, list(by), "left")
    rows = F.coalesce("_rows", F.lit(0))

    def failures(rule: Rule) -> Column:
        if rule.volume is not None:
            return rule.volume(rows).cast("bigint")
        return F.coalesce(rule.rule_id, F.lit(0))

    pairs = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"),
                               failures(r).alias("failed_record_count")) for r in rules])
    return joined.select(*by, F.inline(pairs))


def volume_movement(counts: DataFrame, prior: DataFrame, low: float, high: float) -> DataFrame:
    """Row count against the prior period: blocker at zero rows, warning outside
    the range, no verdict without a prior period."""
    ratio = F.col("row_count") / F.col("prior_row_count")
    return (
        counts.join(prior, [c for c in counts.columns if c in prior.columns], "left")
        .withColumn("movement_ratio", F.round(ratio, 4))
        .withColumn("movement_status",
                    F.when(F.col("prior_row_count").isNull(), "NO_PRIOR")
                    .when(F.col("row_count") == 0, "BLOCKER")
                    .when(~ratio.between(low, high), "WARNING").otherwise("OK"))
    )


def summarise(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rule and failure counts by any of severity, status, batch."""
    return results.groupBy(*by).agg(
        F.countDistinct("rule_id").alias("rule_count"),
        F.sum("failed_record_count").alias("failed_record_count"))
