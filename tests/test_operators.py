from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataline.operators import history, matching, measures, numbering, quality, reconcile, rows as r, upsert
from strataline.plans import assured
from strataline.session import apply_settings


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ------------------------------------------------------------- rows per key

def test_duplicates_and_surplus(spark, rows):
    df = frame(spark, [("a", 1), ("a", 2), ("a", 3), ("b", 4), (None, 5), (None, 6)], "k string, n int")
    assert rows(r.duplicate_members(df, ["k"]), "n") == [(1,), (2,), (3,)]
    assert rows(r.surplus_rows(df, ["k"], "n"), "n") == [(2,), (3,)]
    assert rows(r.mark_duplicates(df, ["k"], "d").filter("d"), "n") == [(1,), (2,), (3,)]
    assert rows(r.mark_duplicates(df, ["k"], "d", "n").filter("d"), "n") == [(2,), (3,)]
    assert r.mark_duplicates(df, ["k"], "d", "n").count() == 6


def test_duplicate_sets_are_joined_without_a_hint(spark, rows):
    df = frame(spark, [("a", 1), ("a", 2), ("b", 4)], "k string, n int")
    surplus = r.surplus_rows(df, ["k"], "n")
    assert rows(surplus, "n") == [(2,)]
    assert "hint" not in surplus._jdf.queryExecution().analyzed().toString().lower()


def test_materialised_layers_prune_columns(spark, rows):
    from strataline.session import materialise

    layer = materialise(frame(spark, [("a", 1), ("b", 2)], "k string, n int"))
    assert rows(layer, "k") == [("a",), ("b",)]
    assert "ReadSchema: struct<n:int>" in layer.select("n")._jdf.queryExecution().executedPlan().toString()


def test_probe_keeps_the_whole_failure_text(spark):
    from strataline.operators.reconcile import probe_views

    def broken():
        raise ValueError("x" * 5000)

    assert probe_views(spark, {"v": broken}).first()["validation_message"] == "x" * 5000


def test_latest_per_key_prunes_before_the_shuffle(spark, rows):
    df = frame(spark, [("a", 1), ("a", 3), ("b", 2)], "k string, n int").repartition(3)
    latest = r.latest_per_key(df, ["k"], [F.desc("n")])
    assert rows(latest) == [("a", 3), ("b", 2)]
    assert latest._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


# ------------------------------------------------------------- joins

def test_orphan_modes(spark, rows):
    child = frame(spark, [("a", 1), ("x", 2), ("", 3), (None, 4)], "k string, n int")
    parent = frame(spark, [("a",), ("a",), (None,)], "k string")
    assert rows(matching.orphans(child, parent, ["k"]), "n") == [(2,), (3,), (4,)]
    assert rows(matching.orphans(child, parent, ["k"], blank_is_orphan=False), "n") == [(2,)]
    assert rows(matching.exclude(child, parent, ["k"]), "n") == [(2,), (3,), (4,)]
    assert matching.mark_present(child, parent, ["k"], "p").count() == 4


def test_mark_duplicates_odd_keys_and_one_shuffle(spark, rows):
    """Null keys and orders never count, ties of the lowest order are no surplus; marks by student take one shuffle."""
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 1), ("a", 1, 2), (None, 1, 3), (None, 1, 4), ("b", None, 5),
                                ("b", None, 6), ("c", 1, None), ("c", 1, 7), ("d", 1, 8)], "k string, m int, n int")
    assert sorted(rows(r.mark_duplicates(df, ["k", "m"], "d", "n").filter("d"), "n")) == [(2,)]
    assert r.mark_duplicates(df, ["k", "m"], "d").filter("d").count() == 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        known = matching.mark_present(df, df.select("k"), ["k"], "p", [r.SPREAD])
        plan = r.mark_duplicates(known, ["k", "m"], "d", "n")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == 2  # the rows once, the parents once
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_exclude_in_place_and_narrow_ids(spark, rows):
    from strataline.functions.keys import hash_key, narrow_id, wide_id

    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "n int, k string")
    bad = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(rows(matching.exclude_in_place(df, bad, ["k"]), "n")) == [(2,), (2,), (3,)]
    ids = spark.createDataFrame([("00616263",), ("abc",), ("ABCD",), ("",), (None,), ("é",)], "i string").select("i")
    ids = ids.union(df.select(hash_key("k")))
    assert ids.filter(~wide_id(narrow_id("i")).eqNullSafe(ids["i"])).count() == 0
    assert ids.select(narrow_id("i").alias("b")).distinct().count() == ids.distinct().count()


def test_mark_known(spark, rows):
    child = frame(spark, [("a", 1), ("b", 1), ("b", 2), ("c", 1), (None, 1)], "k string, m int")
    past, batch = frame(spark, [("a",)], "k string"), frame(spark, [("b", 1), ("b", 1)], "k string, m int")
    got = matching.mark_known(child, past, batch, "k", ["m"], "h", "b")
    assert rows(got) == sorted([("a", 1, True, False), ("b", 1, False, True), ("b", 2, False, False),
                                ("c", 1, False, False), (None, 1, False, False)], key=str)


def test_as_of_join(spark, rows):
    d = dt.date
    facts = frame(spark, [(1, "a", d(2024, 1, 5)), (2, "a", d(2024, 3, 1)), (3, "a", d(2023, 1, 1)), (4, "z", d(2024, 1, 1))],
                  "n int, k string, day date")
    versions = frame(spark, [("a", d(2024, 1, 1), d(2024, 2, 29), "v1"), ("a", d(2024, 3, 1), None, "v2")],
                     "k string, effective_from_date date, effective_to_date date, v string")
    got = matching.as_of_join(facts, versions, ["k"], "day", take=["v"])
    assert rows(got, "n", "v") == [(1, "v1"), (2, "v2"), (3, None), (4, None)]


def test_prior_period_keeps_gaps(spark, rows):
    rates = frame(spark, [(202401, 0.5), (202403, 0.7), (202404, 0.8)], "month_key int, attendance_rate double")
    got = measures.movement(rates, "month_key", F.col("month_key") - 1)
    assert rows(got, "month_key", "prior_attendance_rate", "change") == [
        (202401, None, None), (202403, None, None), (202404, 0.7, 0.1)]


# ------------------------------------------------------------- numbering

def test_dense_numbers_follow_the_order(spark):
    df = spark.range(2000).select(((F.col("id") * 7919) % 2000).alias("v")).repartition(5)
    got = numbering.dense_order_numbers(df, ["v"], "n").orderBy("n").collect()
    assert [row.n for row in got] == list(range(1, 2001)) and [row.v for row in got] == list(range(2000))


def test_surrogates_are_kept_and_extended(spark, rows):
    keys = frame(spark, [(k,) for k in "abcde"], "k string")
    first = numbering.extend_surrogates(frame(spark, [], "k string, n bigint"), keys, "k", "n")
    more = numbering.extend_surrogates(first, frame(spark, [("a",), ("x",), ("y",), (None,)], "k string"), "k", "n")
    assert sorted(x[1] for x in rows(first)) == [1, 2, 3, 4, 5]
    assert set(rows(first)) < set(rows(more)) and sorted(x[1] for x in rows(more)) == [1, 2, 3, 4, 5, 6, 7]


# ------------------------------------------------------------- upserts, history

def test_upsert_is_idempotent_with_null_keys(spark, rows):
    base, delta = frame(spark, [(None, 1), (1, 1)], "k int, v int"), frame(spark, [(None, 2), (2, 2)], "k int, v int")
    once = upsert.upsert(base, delta, ["k"])
    assert rows(once) == rows(upsert.upsert(once, delta, ["k"])) == sorted([(None, 2), (1, 1), (2, 2)], key=str)


def test_touched_partitions(spark):
    target = frame(spark, [("a", "m1"), ("b", "m2"), ("c", "m3")], "k string, m string")
    source = frame(spark, [("a", "m4")], "k string, m string")
    assert sorted(upsert.touched_partitions(target, source, ["k"], "m")) == ["m1", "m4"]


def versions_of(spark, data, batch):
    return history.first_versions(frame(spark, data, "school_id string, status string"), "school_id", ["status"], batch)


def test_scd2_change_insert_rerun_and_correction(spark, rows):
    shape = ("school_id", "status", "effective_from_date", "effective_to_date", "is_current")
    first = versions_of(spark, [("s1", "Active"), ("s2", "Active")], "2025-01-15")
    second = versions_of(spark, [("s1", "Closed"), ("s2", "Active"), ("s3", "Active")], "2026-01-15")
    merged = history.scd2_merge(first, second)
    a, z, b = dt.date(2025, 1, 15), dt.date(2026, 1, 14), dt.date(2026, 1, 15)
    expected = sorted([("s1", "Active", a, z, False), ("s1", "Closed", b, None, True),
                       ("s2", "Active", a, None, True), ("s3", "Active", b, None, True)], key=str)
    assert rows(merged, *shape) == expected
    assert rows(history.scd2_merge(merged, second), *shape) == expected
    corrected = history.scd2_merge(merged, versions_of(spark, [("s1", "Paused")], "2026-01-15"))
    assert ("s1", "Paused", b, None, True) in rows(corrected, *shape)
    assert history.overlapping_versions(corrected).count() == 0
    with pytest.raises(ValueError):
        history.require_unique(first.unionByName(first), ["school_id"], "the batch")


def test_replay_last_row_of_the_month_wins(spark, rows):
    changes = frame(spark, [("s", "2024-01", 1, "Active"), ("s", "2024-03", 1, "Transferred"), ("s", "2024-03", 2, "Left")],
                    "k string, m string, n int, status string")
    assert rows(history.replay_state(changes, ["k"], "m", [F.desc("n")], "2024-02"), "status") == [("Active",)]
    months = frame(spark, [("2024-01",), ("2024-02",), ("2024-03",), ("2024-04",)], "m string")
    got = history.replay_all_months(changes, months, ["k"], "m", ["n"], ["status"])
    assert rows(got, "state_month", "status") == [("2024-01", "Active"), ("2024-02", "Active"),
                                                  ("2024-03", "Left"), ("2024-04", "Left")]


# ------------------------------------------------------------- rules

def test_rule_engine_counts_zeros_and_overlaps(spark, rows):
    rules = [quality.Rule("R1", "one", "t", "Low", lambda: F.col("a") < 0, "k", "negative"),
             quality.Rule("R2", "two", "t", "High", lambda: F.col("a") < -5, "k", "very negative")]
    df = frame(spark, [("x", 1, "b1"), ("y", -9, "b1"), ("z", 2, "b2")], "k string, a int, batch_id string")
    counts = quality.failure_counts(df, rules, ["batch_id"])
    assert rows(counts) == [("b1", "R1", 1), ("b1", "R2", 1), ("b2", "R1", 0), ("b2", "R2", 0)]
    status = quality.result_status(F.col("failed_record_count"), F.col("severity"))
    assert ("b1", "R1", "WARN") in rows(quality.describe(counts, rules, status), "batch_id", "rule_id", "status")
    failed = quality.failed_records(df, rules, ["batch_id"], [], ["k", "a"])
    assert rows(failed, "rule_id", "business_key", "failed_record_json") == [
        ("R1", "y", '{"k":"y","a":-9}'), ("R2", "y", '{"k":"y","a":-9}')]
    assert rows(quality.passing(df, rules), "k") == [("x",), ("z",)]
    assert quality.failure_counts(df.limit(0), rules, []).count() == 2


def test_readiness_precedence(spark, rows):
    schema = "m string, rule_id string, severity string, failed_record_count bigint"
    data = [("m1", "A", "BLOCKER", 1), ("m1", "B", "ERROR", 1), ("m2", "A", "BLOCKER", 0), ("m2", "B", "ERROR", 1),
            ("m3", "C", "WARNING", 1), ("m4", "C", "WARNING", 0)]
    ready = quality.readiness(frame(spark, data, schema), frame(spark, [("m2",), ("m2",)], "m string"), ["m"])
    assert rows(ready, "m", "readiness_status", "rejected_record_count") == [
        ("m1", "NOT_READY", 0), ("m2", "READY_WITH_CAVEATS", 2), ("m3", "READY_WITH_CAVEATS", 0), ("m4", "READY", 0)]
    with pytest.raises(RuntimeError):
        quality.require_ready(ready, F.col("m") == "m1")
    with pytest.raises(RuntimeError):
        quality.require_ready(ready, F.col("m") == "never checked")


# ------------------------------------------------------------- measures, reconciliation

def test_mean_of_ratios_is_not_ratio_of_sums(spark):
    df = frame(spark, [("g", 10, 10), ("g", 100, 50), ("g", 0, 0)], "g string, possible_days int, attended_days int")
    assert df.groupBy("g").agg(measures.mean_of_ratios()).first().mean_rate == 0.75
    assert measures.attendance_rate(df, ["g"]).first().attendance_rate == 0.5455


def test_hot_group_quartiles_match_unweighted(spark):
    df = spark.range(3000).select(F.lit("hot").alias("g"), (F.col("id") % 451 + 250).alias("score"))
    got = measures.quartiles(df, ["g"], "score").first()
    plain = df.groupBy("g").agg(F.percentile("score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")).first()
    assert [got.p25, got.median, got.p75] == plain.q


def test_three_states_and_view_probe(spark, rows):
    left, right = frame(spark, [("a",), ("b",)], "k string"), frame(spark, [("a",), ("c",), ("c",)], "k string")
    got = reconcile.compare_counts(left, right, ["k"])
    assert rows(got, "k", "reconciliation_status") == [("a", "PASS"), ("b", "WARNING"), ("c", "WARNING")]
    probe = reconcile.probe_views(spark, {"good": lambda: left, "bad": lambda: spark.table("no_such_view")})
    assert rows(probe, "view_name", "validation_status", "row_count") == [("bad", "FAIL", None), ("good", "PASS", 2)]
    with pytest.raises(ValueError):
        reconcile.require_no_identifiers(frame(spark, [("x",)], "student_id string"), "view")
    with pytest.raises(ValueError):
        reconcile.require_load_status(frame(spark, [("ODD",)], "load_status string"))


def test_single_slice_validation_without_any_rows(spark):
    empty = spark.createDataFrame([], "pipeline_run_id bigint, run_status string, load_mode string")
    files = spark.createDataFrame([(0, 0)], "file_load_count bigint, failed_file_load_count bigint")
    rest = spark.createDataFrame([("READY", 0, 0, 0, 0, 0)], "readiness_status string, rejected_record_count bigint, "
                                 "reconciliation_check_count bigint, failed_reconciliation_count bigint, "
                                 "missing_year_level_rows bigint, missing_attendance_band_rows bigint")
    row = reconcile.one_slice_validation(spark, [empty, files, rest], "MONTHLY_CHANGE").first()
    assert row.validation_status == "CHECK_PIPELINE_RUN"


def test_one_pass_quarantine_equals_the_join(spark, rows):
    rules = assured.quality_rules(F.lit("2024-12-31").cast("date"))
    base = [("A1", "S1", "C1", dt.date(2024, 2, 1), 20, 25, "", "b", "r", None, "f", "id1"),
            ("A2", "S1", "C1", dt.date(2024, 2, 1), 20, 19, "", "b", "r", None, "f", "id2"),
            ("A3", "S2", "C1", dt.date(2024, 2, 1), 20, 19, "", "b", "r", None, "f", "id3"),
            ("A4", "S9", "C1", dt.date(2024, 2, 1), 20, 19, "", "b", "r", None, "f", "id4")]
    att = frame(spark, base, "attendance_id string, student_id string, school_id string, attendance_month date, "
                "possible_days int, attended_days int, absence_reason string, batch_id string, run_id string, "
                "load_timestamp timestamp, source_file_name string, bronze_record_id string")
    stu = frame(spark, [("S1", "b"), ("S2", "b")], "student_id string, batch_id string")
    marked = assured.mark({"attendance": att, "students": stu})["silver.attendance"]
    failed = assured.failed_record_rows({"silver.attendance": marked}, rules, F.lit("r"))
    joined = assured.trusted(att, failed, "silver.attendance", assured.ATTENDANCE_QUARANTINE)
    passed = assured.trusted_in_one_pass(marked, rules, "silver.attendance", assured.ATTENDANCE_QUARANTINE)
    assert rows(joined, "attendance_id") == rows(passed, "attendance_id") == [("A3",)]


def test_screened_rules_equal_direct_passes(spark, rows):
    """Results and records from the stored rule bits against a pass over the marks for each."""
    from strataline.operators import quality

    rules = [
        quality.Rule("R1", "first", "silver.t", "High", lambda: F.col("v") > 1, "k", "v is large"),
        quality.Rule("R2", "second", "silver.t", "Low", lambda: F.col("w").isNull(), "k", "w is missing"),
        quality.Rule("R3", "counts only", "silver.t", "Low", lambda: F.col("v") == 0, "k", "zero", rejects=False),
        quality.Rule("R4", "volume", "silver.t", "High", None, volume=lambda n: n < 3),
    ]
    df = spark.createDataFrame([("b1", "a", 2, None, 9), ("b1", "b", 0, "x", 9), ("b1", "c", None, "x", 9), ("b2", "d", 5, "x", 9)],
                               "batch_id string, k string, v int, w string, _extra int")
    stored = []

    def store(frame):
        stored.append(frame.count())
        return frame

    screened = quality.screen("silver.t", df, rules, ["batch_id"], ["v", "w"], store, df.select("batch_id"))
    slices = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "batch_id string")
    want = quality.slice_failures(slices, df, rules, ["batch_id"])
    assert rows(quality.screened_counts(screened, ["batch_id"], slices)) == rows(want)
    direct = quality.failed_records(df, quality.rules_of(rules, "silver.t"), ["batch_id"], [], ["k", "v", "w"])
    got = quality.screened_records(screened, ["batch_id"], [], ["k", "v", "w"])
    assert rows(got, *direct.columns) == rows(direct) and got.count() == 3
    assert stored == [3]


def test_quartiles_of_many_values_and_nulls(spark, rows):
    import statistics

    values = {"a": list(range(0, 4000, 3)) * 2 + [7] * 500, "b": [5], None: [1, 2, 2, 10], "c": [3, 4]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "g string, v int").repartition(7)
    got = {r.g: (r.record_count, r.p25, r.median, r.p75) for r in measures.quartiles(df, ["g"], "v").collect()}
    for k, vs in values.items():
        want = statistics.quantiles(vs, n=4, method="inclusive") if len(vs) > 1 else vs * 3
        assert got[k] == (len(vs), *map(pytest.approx, want))
    assert measures.quartiles(df.where("false"), ["g"], "v").count() == 0


def test_rows_without_a_key_are_dealt_out(spark):
    """Three in ten rows have no student: no task of the membership joins gets them all."""
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        child = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 10 >= 3, F.col("id") % 500).alias("k"), F.lit("m").alias("slice"))
        parent = spark.range(250).select(F.col("id").alias("k"), F.lit("m").alias("slice"))
        marked = matching.mark_present(child, parent, ["k"], "known")
        known = matching.mark_known(child, parent.select("k"), parent, "k", ["slice"], "ever", "now")
        for df, flag in ((marked, "known"), (known, "ever")):
            assert df.where(flag).count() == 7000 and df.count() == 20_000
            parts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert max(parts) < 1.5 * 20_000 / 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_map_tasks_write_shuffles_without_gathering_their_rows(spark):
    shuffles = int(apply_settings(spark).conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    assert shuffles <= int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"


def test_marks_and_the_join_after_them_sort_the_rows_once(spark, rows):
    """One shuffle and one sort by student and duplicate key serve duplicates, the look-up of students and a further join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        student = ["batch_id", "student_id"]
        facts = spark.createDataFrame(
            [(1, "b", "s1", "c"), (2, "b", "s1", "c"), (3, "b", "s1", "d"), (4, "b", "s9", "c"), (5, "b", None, "c"), (6, "b", None, "c"),
             (7, None, "s1", "c"), (8, "b", "", "c"), (9, "b", "", "c")], "id int, batch_id string, student_id string, school_id string")
        students = spark.createDataFrame([("b", "s1", 10), ("b", "", 11), ("b", None, 12), (None, "s1", 13), ("b2", "s9", 14)],
                                         "batch_id string, student_id string, n int")
        twice = r.mark_duplicates(matching.deal_by(facts, student), [*student, "school_id"], "twice")
        known = matching.mark_present(twice, students, student, "known", [r.SPREAD])
        joined = known.join(students.withColumn(r.SPREAD, r.whole_spread(student)), [r.SPREAD, *student], "left").select(
            "id", "twice", "known", "n")
        assert rows(joined) == sorted([(1, True, True, 10), (2, True, True, 10), (3, False, True, 10), (4, False, False, None),
                                       (5, False, False, None), (6, False, False, None), (7, False, False, None),
                                       (8, True, True, 11), (9, True, True, 11)], key=str)
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        of_facts = [line for line in plan if "school_id" in line and ("Sort [" in line or "Exchange hashpartitioning" in line)]
        assert sum("Sort [" in line for line in of_facts) == 1 and sum("SortMergeJoin" in line for line in plan) == 2, "\n".join(plan)
        assert sum("REPARTITION" in line for line in plan) == 1 and sum("Exchange hashpartitioning" in line for line in plan) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_task_reads_few_enough_rows_to_sort_them_in_memory(spark, tmp_path):
    """A file below 32 MB is not one task's: narrow rows of such a part are millions."""
    apply_settings(spark)
    path = str(tmp_path / "rows")
    spark.range(3_000_000).select("id", F.xxhash64("id").alias("h"), F.xxhash64("id", F.lit(1)).alias("g")).coalesce(1).write.option(
        "parquet.block.size", 1 << 20).parquet(path)
    assert spark.read.parquet(path).rdd.getNumPartitions() >= 12  # 60 MB: 4 MB a part; by 32 MB and 8 cores 8
