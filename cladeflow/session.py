"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and bench.py use."""
    return (
        SparkSession.builder.master(master)
        .appName("cladeflow")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset a temporary one, but only if all tasks run in this
    process: on a cluster a folder of one machine would lose the intermediate tables."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/cladeflow-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application wrote into the shared folder, once no result is read any more."""
    remove(spark, _own_dir(spark))


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that this package wrote into the shared folder."""
    hadoop = spark._jsc.hadoopConfiguration()
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(hadoop).delete(path, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    hadoop = spark._jsc.hadoopConfiguration()  # a folder's move is one step on the file systems that clusters share
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    if not a.getFileSystem(hadoop).rename(a, b):
        raise OSError(f"could not move {source} to {target}")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """df in spark.sql.shuffle.partitions parts by hash, which runtime merging leaves alone: for rows that are
    small to store and costly to work on."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as a table into the shared folder and read it back.

    Unlike a cached or locally checkpointed plan the result survives the loss of executors.
    """
    return written_at(df, fresh_path(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables that a loop writes one after another into the shared folder, each deleted once its slot is written again."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.n, self.held = spark, fresh_path(spark, name), 0, {}

    def put(self, slot: str, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{slot}-{self.n}"
        result = written_at(df, path)
        if slot in self.held:
            remove(self.spark, self.held[slot])
        self.held[slot] = path
        return result

    def measured(self, slot: str, df: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
        """put(), and aggregates over the rows taken while they are written, without a job of their own.

        A task that ran twice may count twice: good for telling none from some, or for a guess that is checked.
        """
        seen = Observation()
        result = self.put(slot, df.observe(seen, *(c.alias(n) for n, c in counts.items())))
        return result, seen.get
