"""File streams that run to the end of what is there (``availableNow``) and hand
each micro-batch to a batch function. The stream's checkpoint remembers the files
done; the functions are idempotent, so a retried micro-batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.rows import latest_per_key
from ..operators.upsert import upsert
from ..session import materialise
from ..sources.published import BucketedState
from ..sources.readers import read_csv_text
from ..sources.writers import read_current, write_version

FILE_ROW = "path string, modificationTime timestamp, length bigint, content binary"


def delta_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the paths of new CSV files. A streaming CSV source goes by column
    position; the names travel instead and ``rows_of`` reads each file by header.
    The content column is pruned, so no file is opened for the listing."""
    return (spark.readStream.format("binaryFile").schema(FILE_ROW).option("pathGlobFilter", "*.csv")
            .option("maxFilesPerTrigger", files_per_batch).load(root).select("path"))


def rows_of(dataset: str, handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A micro-batch function over paths that hands the rows of their files on."""
    def read(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(row.path for row in batch.collect())  # at most files_per_batch names
        if paths:
            handle(read_csv_text(batch.sparkSession, paths, dataset), batch_id)

    return read


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything that has arrived, then stop."""
    (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def upsert_into(path: str, keys: Sequence[str], order: Sequence[Column], schema: str,
                shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A micro-batch function: the latest row per key goes into a versioned table."""
    def handle(batch: DataFrame, _batch_id: int) -> None:
        source = shape(latest_per_key(batch, keys, order))
        write_version(upsert(read_current(batch.sparkSession, path, schema), source, keys), path)

    return handle


def publish_into(path: str, stream: str, key: str, order: Sequence[str], schema: str, buckets: int = 64,
                 shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """A micro-batch function: the latest row per key goes into a bucketed state. The batch's number is committed in the
    same step as its rows, so a batch that is run again, whatever it holds then, is not taken twice, and only the buckets
    of its keys are rewritten."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        state = BucketedState(batch.sparkSession, path, key, buckets)
        if state.manifest().batches.get(stream, -1) < batch_id:
            source = materialise(shape(latest_per_key(batch, [key], [F.desc(c) for c in order])))
            state.change(source, lambda held, _: upsert(held, source, [key]), schema, batch=(stream, batch_id))

    return handle
