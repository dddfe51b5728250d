"""Layer-to-layer counts and the month validation built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.labels import sort_order, title_text
from .matching import attach_one_row
from .quality import union_all

# Load status vocabulary of the file ledger.
LOAD_STATUSES = ("LOADED", "PARTIAL", "FAILED", "SKIPPED")


def difference(source: Column, target: Column) -> Column:
    """Target minus source; null when a side is missing."""
    return target - source


def three_state(source: Column, target: Column) -> Column:
    """WARNING when a side is missing, else PASS or FAIL."""
    return (F.when(source.isNull() | target.isNull(), "WARNING")
            .when(source == target, "PASS").otherwise("FAIL"))


def two_state(source: Column, target: Column) -> Column:
    """PASS only for equal counts; a missing side fails."""
    return F.when(source == target, "PASS").otherwise("FAIL")


def compare_counts(source: DataFrame, target: DataFrame, by: Sequence[str],
                   status: Callable[[Column, Column], Column] = three_state,
                   names: tuple[str, str] = ("source_row_count", "target_row_count")) -> DataFrame:
    """Full outer join of grouped counts, with difference and status."""
    left = source.groupBy(*by).agg(F.count(F.lit(1)).alias(names[0]))
    right = target.groupBy(*by).agg(F.count(F.lit(1)).alias(names[1]))
    s, t = F.col(names[0]), F.col(names[1])
    return left.join(right, list(by), "full").select(
        *by, *names, difference(s, t).alias("difference_count"),
        status(s, t).alias("reconciliation_status"))


def layer_reconciliation(layer: str, pairs: Mapping[str, tuple[DataFrame, DataFrame]],
                         by: Sequence[str],
                         status: Callable[[Column, Column], Column] = three_state) -> DataFrame:
    """``compare_counts`` for every object of a layer."""
    return union_all([
        compare_counts(source, target, by, status)
        .select(F.lit(layer).alias("layer_name"), F.lit(name).alias("object_name"), "*")
        for name, (source, target) in pairs.items()
    ])


def slice_counts(slices: DataFrame, by: Sequence[str],
                 pairs: Mapping[str, tuple[DataFrame, DataFrame]], layer: str) -> DataFrame:
    """Like ``layer_reconciliation`` but for given slices: no rows count as zero."""
    out = []
    for name, (source, target) in pairs.items():
        a = source.groupBy(*by).agg(F.count(F.lit(1)).alias("_s"))
        b = target.groupBy(*by).agg(F.count(F.lit(1)).alias("_t"))
        s, t = F.coalesce("_s", F.lit(0)), F.coalesce("_t", F.lit(0))
        out.append(
            slices.select(*by).join(a, list(by), "left").join(b, list(by), "left").select(
                *by, F.lit(layer).alias("layer_name"), F.lit(name).alias("object_name"),
                s.alias("source_row_count"), t.alias("target_row_count"),
                difference(s, t).alias("difference_count"),
                three_state(s, t).alias("reconciliation_status")))
    return union_all(out)


def conservation(total: DataFrame, parts: Mapping[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """Every row of a layer is accounted for: total = sum of the parts, per slice."""
    out = total.groupBy(*by).agg(F.count(F.lit(1)).alias("total_count"))
    for name, part in parts.items():
        counted = part.groupBy(*by).agg(F.count(F.lit(1)).alias(f"_{name}"))
        out = out.join(counted, list(by), "left").withColumn(
            f"{name}_count", F.coalesce(f"_{name}", F.lit(0))).drop(f"_{name}")
    accounted = sum((F.col(f"{n}_count") for n in parts), F.lit(0))
    return out.withColumn("reconciliation_status", two_state(F.col("total_count"), accounted))


def file_ledger(loaded: DataFrame, rejected: DataFrame, file_column: str = "source_file_name") -> DataFrame:
    """Source, loaded and rejected counts per file with a status of the vocabulary."""
    source = loaded.groupBy(file_column).agg(F.count(F.lit(1)).alias("source_row_count"))
    rejects = rejected.groupBy(file_column).agg(F.count(F.lit(1)).alias("rejected_row_count"))
    rejected_rows = F.coalesce("rejected_row_count", F.lit(0))
    return (
        source.join(rejects, file_column, "left")
        .withColumn("rejected_row_count", rejected_rows)
        .withColumn("loaded_row_count", F.col("source_row_count") - F.col("rejected_row_count"))
        .withColumn("load_status",
                    F.when(F.col("rejected_row_count") == 0, "LOADED")
                    .when(F.col("loaded_row_count") > 0, "PARTIAL").otherwise("FAILED"))
    )


def require_load_status(ledger: DataFrame) -> None:
    if ledger.filter(~F.coalesce(F.col("load_status").isin(*LOAD_STATUSES), F.lit(False))).take(1):
        raise ValueError("load_status must be " + ", ".join(LOAD_STATUSES) + ".")


def check_rows(groups: Iterable[tuple[str, str, DataFrame, DataFrame | None, bool]],
               by: Sequence[str], slices: DataFrame) -> DataFrame:
    """Essential counts: (group, object, rows, compared rows or None, must have rows).

    With a comparison the status is OK or CHECK by equality; otherwise CHECK for
    zero rows where rows are required and INFO where they are not.
    """
    out = []
    for group, name, rows, compared, required in groups:
        counted = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        frame = slices.select(*by).join(counted, list(by), "left")
        n = F.coalesce("_n", F.lit(0))
        if compared is None:
            other = F.lit(None).cast("bigint")
            status = F.when(n == 0, "CHECK").otherwise("OK") if required else F.lit("INFO")
        else:
            against = compared.groupBy(*by).agg(F.count(F.lit(1)).alias("_m"))
            frame = frame.join(against, list(by), "left")
            other = F.coalesce("_m", F.lit(0))
            status = F.when(n == other, "OK").otherwise("CHECK")
        out.append(frame.select(
            *by, F.lit(group).alias("check_group"), F.lit(name).alias("object_name"),
            n.alias("row_count"), other.alias("expected_or_comparison_count"),
            (other - n).alias("difference_count"), status.alias("check_status")))
    return union_all(out)


CHECK_GROUP_ORDER = ("file_loads", "bronze", "silver_to_gold", "quality_to_gold")
DETAIL_ORDER = ("failed_rule", "caveat", "rejected_record")


def in_check_order(checks: DataFrame) -> DataFrame:
    return checks.orderBy(sort_order("check_group", CHECK_GROUP_ORDER, 5), "object_name")


def quality_details(results: DataFrame, caveat_rows: DataFrame, rejected: DataFrame,
                    by: Sequence[str]) -> DataFrame:
    """Failed rules, caveats and rejected records in one list."""
    failed = results.filter("failed_record_count > 0")
    none = F.lit(None).cast("string")
    rule_rows = failed.select(
        *by, F.lit("failed_rule").alias("detail_type"), F.col("target_table").alias("affected_object"),
        F.col("rule_id").alias("rule_code"), "severity",
        F.col("failed_record_count").alias("record_count"), none.alias("business_key"),
        none.alias("detail_message"))
    counts = results.select(*by, F.col("rule_id").alias("caveat_code"), "failed_record_count")
    notes = caveat_rows.join(counts, [*by, "caveat_code"], "left").select(
        *by, F.lit("caveat").alias("detail_type"), F.col("affected_area").alias("affected_object"),
        F.col("caveat_code").alias("rule_code"), "severity",
        F.col("failed_record_count").alias("record_count"), none.alias("business_key"),
        title_text("caveat_title", "caveat_description").alias("detail_message"))
    records = rejected.select(
        *by, F.lit("rejected_record").alias("detail_type"),
        F.col("target_table").alias("affected_object"), F.col("rule_id").alias("rule_code"),
        F.lit("ERROR").alias("severity"), F.lit(1).cast("bigint").alias("record_count"),
        "business_key", F.col("failure_reason").alias("detail_message"))
    return rule_rows.unionByName(notes).unionByName(records)


def in_detail_order(details: DataFrame) -> DataFrame:
    return details.orderBy(sort_order("detail_type", DETAIL_ORDER, 4), "rule_code", "business_key")


def reconciliation_interpretation() -> Column:
    return (
        F.when((F.col("failed_reconciliation_count") > 0) & (F.col("rejected_record_count") > 0),
               "EXPLAINED_BY_REJECTED_RECORDS")
        .when(F.col("failed_reconciliation_count") > 0, "CHECK_RECONCILIATION").otherwise("PASS"))


def month_status(expected_mode: Column) -> Column:
    """Status of a month; the first condition that holds decides."""
    c = F.col
    failed_reconciliation = c("failed_reconciliation_count") > 0
    unexplained = F.coalesce(c("rejected_record_count"), F.lit(0)) == 0
    return (
        F.when(c("pipeline_run_id").isNull() | (c("run_status") != "SUCCEEDED"), "CHECK_PIPELINE_RUN")
        .when(c("load_mode") != expected_mode, "CHECK_LOAD_MODE")
        .when((c("failed_file_load_count") > 0) | (c("file_load_count") == 0), "CHECK_FILE_LOADS")
        .when(c("readiness_status").isNull(), "CHECK_QUALITY_READINESS")
        .when(c("readiness_status") == "NOT_READY", "NOT_READY")
        .when(c("reconciliation_check_count") == 0, "CHECK_RECONCILIATION")
        .when(failed_reconciliation & unexplained, "CHECK_RECONCILIATION")
        .when((c("missing_year_level_rows") > 0) | (c("missing_attendance_band_rows") > 0),
              "CHECK_ATTENDANCE_KEYS")
        .when(c("readiness_status") == "READY_WITH_CAVEATS", "MONTH_VALIDATED_WITH_CAVEATS")
        .otherwise("MONTH_VALIDATED"))


def month_validation(slices: DataFrame, by: Sequence[str], summaries: Sequence[DataFrame],
                     expected_mode: Column, zero_if_missing: Sequence[str] = ()) -> DataFrame:
    """One row per slice from per-slice summaries, with interpretation and status."""
    out = slices
    for summary in summaries:
        out = out.join(summary, list(by), "left")
    return (
        out.fillna(0, subset=list(zero_if_missing))
        .withColumn("reconciliation_interpretation", reconciliation_interpretation())
        .withColumn("validation_status", month_status(expected_mode))
    )


def one_slice_validation(spark: SparkSession, summaries: Sequence[DataFrame],
                         expected_mode: str) -> DataFrame:
    """The same for a single slice, from one-row or empty summaries."""
    out = spark.range(1).select(F.lit(expected_mode).alias("expected_load_mode"))
    for summary in summaries:
        out = attach_one_row(out, summary)
    return (
        out.withColumn("reconciliation_interpretation", reconciliation_interpretation())
        .withColumn("validation_status", month_status(F.col("expected_load_mode")))
    )


def probe_views(spark: SparkSession, views: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Row count per view; a view that cannot be read becomes a FAIL row.

    One count job per view runs here, because a failure must be caught where the
    view is evaluated. Only one number per view reaches the driver.
    """
    rows = []
    for name, build in views.items():
        try:
            rows.append((name, "PASS", build().count(), "View queried successfully."))
        except Exception as error:  # any failure of the view is the finding
            rows.append((name, "FAIL", None, str(error)))
    return spark.createDataFrame(
        rows, "view_name string, validation_status string, row_count bigint, validation_message string")


def view_row_counts(views: Mapping[str, DataFrame], must_have_rows: Sequence[str]) -> DataFrame:
    """Rows per view in one plan, with CHECK for required views that are empty."""
    counted = union_all([
        df.groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("view_name"), "row_count")
        for name, df in views.items()
    ])
    empty = F.col("view_name").isin(*must_have_rows) & (F.col("row_count") == 0)
    return counted.withColumn("check_status", F.when(empty, "CHECK").otherwise("OK"))


# Columns that identify a person.
PERSON_COLUMNS = ("student_id", "student_key", "student_batch_key", "business_key",
                  "failed_record_json")


def identifying_columns(df: DataFrame, names: Sequence[str] = PERSON_COLUMNS) -> list[str]:
    return [c for c in df.columns if c.lower() in names]


def require_no_identifiers(df: DataFrame, what: str, names: Sequence[str] = PERSON_COLUMNS) -> DataFrame:
    found = identifying_columns(df, names)
    if found:
        raise ValueError(f"{what} exposes person identifiers: {', '.join(found)}")
    return df
