"""Reading raw files with fixed text schemas and their lineage."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .model import SOURCE_COLUMNS, text_schema


HEADER_THREADS = 16


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file_name"))


def files_below(spark: SparkSession, path: str) -> list[str]:
    """The data files at a path, of a folder those in it and below: names only."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(top, True)
    found = []
    while listed.hasNext():
        name = listed.next().getPath()
        if name.getName()[0] not in "_.":
            found.append(name.toString())
    return sorted(found)


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file; no other block of it is read. Compressed files by their suffix."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    stream = where.getFileSystem(conf).open(where)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names in the header of a CSV file, or of a folder's first file."""
    files = files_below(spark, path)
    return next(csv.reader([_first_line(spark, files[0])]), []) if files else []


def by_header(spark: SparkSession, path: str | Sequence[str], dataset: str, header: Sequence[str],
              partition: str | None = None, base: str | None = None) -> DataFrame:
    """CSV files that share a header, every column text. Their columns may come in
    any order and with others among them; a column of the dataset that is missing
    is an error, as is a file whose header differs from the one given."""
    missing = [c for c in SOURCE_COLUMNS[dataset] if c not in header]
    if missing:
        raise ValueError(f"{dataset}: no column {', '.join(missing)} in {path}")
    fields = [f"`{c.replace('`', '``')}` string" for c in header]
    if partition:
        fields.append(f"{partition} string")
    reader = spark.read.schema(", ".join(fields)).option("header", True).option("enforceSchema", False)
    return (reader.option("basePath", base) if base else reader).csv(path)


def _headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header: one reader then serves all files of the same layout, also within a folder. First lines are read
    by several threads, without a Spark job for each."""
    files = [f for path in paths for f in files_below(spark, path)]
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        groups.setdefault(tuple(next(csv.reader([line]), [])), []).append(file)
    return groups


def read_csv_text(spark: SparkSession, path: str | Sequence[str], dataset: str) -> DataFrame:
    """CSV read by the names in its header, every column text. Header-only files
    are zero rows of the right shape and nothing is inferred. Paths may differ in
    the order of their columns."""
    paths = [path] if isinstance(path, str) else list(path)
    parts = [with_file_lineage(by_header(spark, same, dataset, header).select(*SOURCE_COLUMNS[dataset]))
             for header, same in _headers(spark, paths).items()]
    return reduce(DataFrame.unionByName, parts)


def read_json_array(spark: SparkSession, path: str | Sequence[str],
                    dataset: str = "school_events") -> DataFrame:
    """Files that each hold one JSON array of records."""
    reader = spark.read.schema(text_schema(dataset)).option("multiLine", True)
    return with_file_lineage(reader.json(path))


def explode_json_array(df: DataFrame, text: str, dataset: str) -> DataFrame:
    """Rows of a JSON array held in a text column; fields by name, missing ones null."""
    fields = ", ".join(f"{c}: string" for c in SOURCE_COLUMNS[dataset])
    items = F.from_json(F.col(text), f"array<struct<{fields}>>")
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.inline(items))


def read_json_document(spark: SparkSession, path: str, dataset: str = "school_events") -> DataFrame:
    """The same file read as one text value and split into rows."""
    return explode_json_array(with_file_lineage(spark.read.text(path, wholetext=True)), "value", dataset)


def json_field(text: str, name: str) -> Column:
    """One field of a JSON object by path, as text."""
    return F.get_json_object(F.col(text), f"$.{name}")


def partition_folders(spark: SparkSession, root: str, partition: str) -> list[tuple[str, str]]:
    """(value, path) of every ``<partition>=<value>`` folder of a dataset: names only."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{root}/{partition}=*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = [status.getPath() for status in found]
    return sorted((path.getName().split("=", 1)[1], path.toString()) for path in paths)


def read_folders(spark: SparkSession, root: str, dataset: str, partition: str,
                 only: Sequence[str] | None = None, file_format: str = "csv") -> DataFrame:
    """All ``<partition>=<value>`` folders below a dataset root. The folder value
    becomes a text column, and ``only`` prunes folders before any file is opened."""
    if file_format == "csv":
        folders = [f for value, f in partition_folders(spark, root, partition) if only is None or value in only]
        if not folders:
            empty = spark.createDataFrame([], f"{text_schema(dataset)}, {partition} string")
            return empty.withColumn("source_file_name", F.lit(None).cast("string"))
        columns = [*SOURCE_COLUMNS[dataset], partition]
        found = reduce(DataFrame.unionByName, [
            with_file_lineage(by_header(spark, same, dataset, header, partition, root).select(*columns))
            for header, same in _headers(spark, folders).items()])
    else:
        schema = f"{text_schema(dataset)}, {partition} string"
        found = with_file_lineage(spark.read.schema(schema).option("multiLine", True).json(root))
    return found if only is None else found.filter(F.col(partition).isin(*only))


def with_row_numbers(df: DataFrame, name: str = "raw_row_number") -> DataFrame:
    """Position of each row in its file, from 1, right after a scan.

    A scan reads a file split in order and ``monotonically_increasing_id`` rises
    within it. Splits of one file are put in order by their start offset: rows
    before a split are counted per split (a small table), so no file is gathered
    in one task. Must be applied to the frame of a reader.
    """
    split = ["_path", "_start"]
    located = df.select(
        "*", F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"))
    sizes = located.groupBy(*split).agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*split, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        located.join(offsets, split)
        .withColumn(name, F.col("_id") - F.col("_first") + F.col("_before") + 1)
        .drop("_path", "_start", "_id", "_first", "_before")
    )
