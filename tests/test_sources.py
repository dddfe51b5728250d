from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import fixtures
from strataline.operators.rows import latest_overall
from strataline.sources.model import SOURCE_COLUMNS, text_schema
from strataline.sources import manifest, readers, writers
from strataline.streaming import incremental


def test_csv_is_text_with_lineage_and_row_numbers(spark, tmp_path, rows):
    path = tmp_path / "schools.csv"
    fixtures.write_csv(path, "schools", fixtures.schools(5))
    df = readers.read_csv_text(spark, str(path), "schools")
    assert {t for _, t in df.dtypes} == {"string"} and df.count() == 5
    assert df.select("source_file_name").first()[0].endswith("schools.csv")
    raw = spark.read.schema(text_schema("schools")).option("header", True).csv(str(path))
    assert rows(readers.with_row_numbers(raw), "raw_row_number", "school_id") == [
        (i, f"SCH{i:03d}") for i in range(1, 6)]


SHUFFLED = ["status", "note", "school_type", "school_name", "school_id", "open_date", "region"]


def test_csv_goes_by_header_names(spark, tmp_path, rows):
    data = fixtures.schools(3)
    for batch, header in (("b1", None), ("b2", SHUFFLED)):
        fixtures.write_csv(tmp_path / "schools" / f"batch_id={batch}" / "schools.csv", "schools", data, header)
    root = tmp_path / "schools"
    files = [str(root / f"batch_id={batch}" / "schools.csv") for batch in ("b1", "b2")]
    for frame in (readers.read_csv_text(spark, files[1], "schools"), readers.read_csv_text(spark, files, "schools"),
                  readers.read_folders(spark, str(root), "schools", "batch_id")):
        assert set(rows(frame, *SOURCE_COLUMNS["schools"])) == set(data)
    assert readers.read_folders(spark, str(root), "schools", "batch_id", ["none"]).count() == 0
    fixtures.write_csv(tmp_path / "short.csv", "schools", data, ["school_id", "status"])
    with pytest.raises(ValueError, match="school_name"):
        readers.read_csv_text(spark, str(tmp_path / "short.csv"), "schools")


def test_row_numbers_across_splits_of_a_file(spark, tmp_path):
    path = tmp_path / "students.csv"
    fixtures.write_csv(path, "students", [(f"STU{i}", "", "", "", "", "") for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        raw = spark.read.schema(text_schema("students")).option("header", True).csv(str(path))
        assert raw.rdd.getNumPartitions() > 4
        numbered = readers.with_row_numbers(raw)
        wrong = numbered.filter(F.concat(F.lit("STU"), (F.col("raw_row_number") - 1).cast("string")) != F.col("student_id"))
        assert numbered.count() == 3000 and wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_of_one_folder_may_differ_in_layout(spark, tmp_path, rows):
    data = fixtures.schools()
    fixtures.write_csv(tmp_path / "schools" / "batch_id=b1" / "one.csv", "schools", data[:2])
    fixtures.write_csv(tmp_path / "schools" / "batch_id=b1" / "two.csv", "schools", data[2:], SHUFFLED)
    got = readers.read_folders(spark, str(tmp_path / "schools"), "schools", "batch_id")
    assert rows(got, *SOURCE_COLUMNS["schools"]) == sorted(map(tuple, data), key=str)
    both = readers.read_csv_text(spark, str(tmp_path / "schools" / "batch_id=b1"), "schools")
    assert rows(both, *SOURCE_COLUMNS["schools"]) == sorted(map(tuple, data), key=str)


def test_header_only_file_is_a_valid_input(spark, tmp_path):
    path = tmp_path / "schools_delta.csv"
    fixtures.write_csv(path, "schools", [])
    df = readers.read_csv_text(spark, str(path), "schools")
    assert df.count() == 0 and df.columns[0] == "school_id"


def test_json_array_both_ways(spark, tmp_path, rows):
    path = tmp_path / "school_events.json"
    fixtures.write_json(path, fixtures.events(3))
    direct = readers.read_json_array(spark, str(path))
    split = readers.read_json_document(spark, str(path))
    assert rows(direct, "event_id", "event_date") == rows(split, "event_id", "event_date") and direct.count() == 3


def test_partition_folders_are_pruned(spark, tmp_path):
    for batch in ("2025-01-15", "2026-01-15"):
        fixtures.write_csv(tmp_path / "schools" / f"batch_id={batch}" / "schools.csv", "schools", fixtures.schools(2))
    df = readers.read_folders(spark, str(tmp_path / "schools"), "schools", "batch_id", ["2026-01-15"])
    assert df.count() == 2 and df.select("batch_id").distinct().first()[0] == "2026-01-15"
    assert "PartitionFilters: [isnotnull" in df._jdf.queryExecution().executedPlan().toString()


def test_manifest(spark, tmp_path, rows):
    fixtures.write_month(tmp_path, "2024-02", "MONTHLY_CHANGE", {})
    (tmp_path / "month=2024-02" / "attendance.csv").unlink()
    expected = manifest.expected_files(spark, [("2024-02", "MONTHLY_CHANGE")])
    present = manifest.list_files(spark, str(tmp_path))
    assert rows(manifest.missing_files(expected, present), "file_name") == [("attendance.csv",)]
    got = manifest.month_completeness(expected, present).first()
    assert (got.expected_count, got.present_count, got.manifest_status) == (5, 4, "INCOMPLETE")


def test_write_new_refuses_an_existing_folder(spark, tmp_path):
    writers.write_new(spark.range(2), str(tmp_path / "t"))
    with pytest.raises(Exception):
        writers.write_new(spark.range(2), str(tmp_path / "t"))


def test_slices_are_replaced_and_others_kept(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("b1", 1), ("b2", 2)], "batch_id string, v int")
    writers.write_partitioned(both, path, "batch_id", "initial")
    for _ in range(2):
        writers.replace_slices(spark.createDataFrame([("b2", 7), ("b2", 8)], both.schema), path, "batch_id")
    assert rows(spark.read.parquet(path), "batch_id", "v") == [("b1", 1), ("b2", 7), ("b2", 8)]
    writers.write_partitioned(spark.createDataFrame([("b3", 3)], both.schema), path, "batch_id", "incremental")
    writers.clear_slice(spark, path, batch_id="b2")
    assert rows(spark.read.parquet(path), "batch_id", "v") == [("b1", 1), ("b3", 3)]
    with pytest.raises(ValueError):
        writers.write_partitioned(both, path, "batch_id", "sometimes")


def test_versions_only_count_when_complete(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert writers.read_current(spark, path, "id bigint").count() == 0
    writers.write_version(spark.range(1), path)
    writers.write_version(writers.read_current(spark, path).union(spark.range(1)), path)
    (tmp_path / "dim" / "v=000003").mkdir()  # a write that never finished
    assert writers.read_current(spark, path).count() == 2 and writers.versions(spark, path) == [1, 2]


def test_copies_map_and_quote(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "old string, n int")
    writers.copy_csv(df, str(tmp_path / "csv"), {"old": "new", "n": "n"})
    lines = {line for part in (tmp_path / "csv").glob("*.csv") for line in part.read_text().splitlines()}
    assert lines == {'"new","n"', '"a","1"'}
    writers.copy_json(df, str(tmp_path / "json"), {"old": "new"})
    texts = [part.read_text() for part in (tmp_path / "json").glob("*.json")]
    assert [json.loads(t) for t in texts if t] == [{"new": "a"}]


def test_views_and_empty_tables(spark):
    writers.define_views({"vw_test": writers.constant_table(spark, [(1,)], "a int")})
    assert spark.table("vw_test").count() == 1
    assert writers.empty_table(spark, "a int, b string").columns == ["a", "b"]


def test_stream_upserts_deltas_once(spark, tmp_path, rows):
    raw, state = tmp_path / "raw", str(tmp_path / "state")
    schema = "school_id string, status string"
    handle = incremental.upsert_into(
        state, ["school_id"], [F.desc("source_file_name")], schema, lambda df: df.select("school_id", "status"))

    def run():
        incremental.run_available(incremental.delta_stream(spark, str(raw)), incremental.rows_of("schools", handle),
                                  str(tmp_path / "ckpt"))

    fixtures.write_csv(raw / "a.csv", "schools", fixtures.schools(2))
    run()
    fixtures.write_csv(raw / "b.csv", "schools", fixtures.schools(3, closed=(1,)), SHUFFLED)
    run()
    run()  # nothing new arrived
    current = writers.read_current(spark, state)
    assert rows(current) == [("SCH001", "Closed"), ("SCH002", "Active"), ("SCH003", "Active")]
    assert writers.versions(spark, state) == [1, 2]


def test_ready_markers_announce_months(spark, tmp_path):
    fixtures.write_month(tmp_path, "2024-02", "MONTHLY_CHANGE", {})
    fixtures.write_month(tmp_path, "2024-01", "INITIAL_SNAPSHOT", {})
    fixtures.write_month(tmp_path, "2024-03", "MONTHLY_CHANGE", {})
    (tmp_path / "month=2024-03" / "_READY.json").unlink()
    assert manifest.ready_months(spark, str(tmp_path)) == [
        ("2024-01", "INITIAL_SNAPSHOT"), ("2024-02", "MONTHLY_CHANGE")]


def test_latest_overall(spark):
    assert latest_overall(spark.range(10), F.desc("id")).first()[0] == 9
