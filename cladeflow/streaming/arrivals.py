"""Result files as a stream: what arrived when, and the current version of each file kept up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.operators.compaction import current_files

SCHEMA = (
    "file_id long, file_path string, dataset string, kind string, file_name string, file_text string, n_bytes long, modified_at timestamp"
)


def file_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New Parquet files of the result_files layout in a folder, as they appear."""
    return spark.readStream.schema(SCHEMA).parquet(folder)


def arrival_counts(stream: DataFrame, window: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """start, kind, n_files, n_bytes per window of modified_at; a file listed twice counts once.

    Rows later than the watermark are dropped, as are rows without a time or an id; a window comes out
    once the watermark has passed its end.
    """
    known = stream.where("modified_at is not null and file_id is not null")
    once = known.withWatermark("modified_at", lateness).dropDuplicatesWithinWatermark(["file_id"])
    counted = once.groupBy(F.window("modified_at", window).alias("w"), "kind").agg(F.count("*").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))
    return counted.select(F.col("w.start").alias("start"), "kind", "n_files", "n_bytes")


def keep_current(kinds: list[str], read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges a batch's current files into a table.

    read gives the table so far (None at first), write replaces it. Merging a batch twice changes nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        old = read()
        every = batch if old is None else old.select(*batch.columns).unionByName(batch)
        write(current_files(every.dropDuplicates(["file_id"]), kinds))

    return merge
