"""Many tiny files into few well-sized ones, committed only after a checksum over all rows agrees."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cladeflow.session import fresh_path, remove, rename

#: Up to CORRECTIONS further passes correct the partition size if mean file size is off the target by more than this factor.
TOLERANCE = 1.5
CORRECTIONS = 1


def current_files(df: DataFrame, kinds: list[str]) -> DataFrame:
    """The current version of each valid file: of each dataset, kind and file_name, among the rows of the
    kinds whose file_name ends in `.fasta` and whose text holds a FASTA record, the one modified last.

    Of rows modified at the same time the one with the largest file_id is current; a null modified_at is
    older than any other. Rows whose dataset, kind or file_name is null are no valid files.
    """
    valid = df.where(
        F.col("kind").isin(kinds)
        & F.col("dataset").isNotNull()
        & F.endswith(F.col("file_name"), F.lit(".fasta"))
        & F.regexp_like(F.col("file_text"), F.lit(r"(?m)^>"))
    )
    key = ["dataset", "kind", "file_name"]
    latest = valid.groupBy(*key).agg(F.max(F.struct("modified_at", "file_id")).alias("_latest"))
    ids = latest.select(F.col("_latest.file_id").alias("file_id"))
    return valid.join(ids, "file_id", "left_semi")


def multiset_checksum(df: DataFrame) -> tuple:
    """Row count and two sums over row hashes: equal multisets agree in any order and partitioning."""
    return tuple(df.agg(*_sums(df)).first())


def _sums(df: DataFrame) -> list:
    values = F.struct(*[F.col(c) for c in sorted(df.columns)])
    number = lambda seed: F.xxhash64(values, F.lit(seed)).cast("decimal(38,0)")
    return [F.count("*").alias("n"), F.sum(number(1)).alias("first"), F.sum(number(2)).alias("second")]


def compact(df: DataFrame, target_bytes: int, name: str = "compacted") -> tuple[DataFrame, DataFrame]:
    """Write the rows of df into Parquet files near target_bytes; return them read back, and the list of files.

    The rows pass one shuffle under a REBALANCE hint, whose partitions runtime statistics merge or split.
    The advisory size holds for shuffled bytes; if the files' mean size misses the target, the advisory
    size is scaled by that ratio and written again; if that doesn't help either, a warning says so. The result is moved to its final place only
    if its multiset checksum equals the input's; else the staged files are removed and an error is raised.
    The input's checksum is taken on the way, as the rows go into the shuffle; a task that ran twice counts
    twice there, so a difference is settled by a pass of its own.
    An empty df gives no rows. Null and very long texts are kept as they are.
    """
    spark = df.sparkSession
    seen = Observation()
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    floor = "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor"
    before, before_floor = spark.conf.get(setting), spark.conf.get(floor)
    size, source, staged = target_bytes, df.observe(seen, *_sums(df)), None
    try:
        spark.conf.set(floor, "0.5")
        for attempt in range(1 + CORRECTIONS):
            spark.conf.set(setting, str(max(1, int(size))))
            path = fresh_path(spark, f"_staged-{name}")
            source.hint("rebalance").write.option("compression", "zstd").parquet(path)
            if staged:
                remove(spark, staged)
            staged = path
            n, total = _size(spark, staged)
            wanted = max(1, round(total / target_bytes))
            if n == 0 or 1 / TOLERANCE <= n / wanted <= TOLERANCE:
                break
            if attempt == CORRECTIONS:
                warnings.warn(f"{n} files where {wanted} were wanted: no partition size comes near {target_bytes} bytes a file", stacklevel=2)
            size = size * n / wanted
            source = spark.read.schema(df.schema).parquet(staged)
    finally:
        spark.conf.set(setting, before)
        spark.conf.set(floor, before_floor)
    found = multiset_checksum(spark.read.schema(df.schema).parquet(staged))
    expected = tuple(seen.get[c] for c in ("n", "first", "second"))
    if found != expected:
        expected = multiset_checksum(df)
    if found != expected:
        remove(spark, staged)
        raise RuntimeError(f"compaction lost or repeated rows: {expected} became {found}")
    final = fresh_path(spark, name)
    rename(spark, staged, final)
    back = spark.read.schema(df.schema).parquet(final)
    listing = (
        back.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("n_bytes"))
        .groupBy("path", "n_bytes")
        .agg(F.count("*").alias("n_records"))
    )
    return back, listing


def _size(spark, path: str) -> tuple[int, int]:
    """Number and bytes of the data files, as the file system sums them up (one more is the success mark)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    summary = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p)
    return summary.getFileCount() - 1, summary.getLength()
