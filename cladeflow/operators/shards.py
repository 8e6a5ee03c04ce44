"""Deterministic shuffles, samples and shards of fixed size."""

from __future__ import annotations

import io
import tarfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.operators.dense_ids import ordinals
from cladeflow.session import written

SHARD_SIZE = 10_000


def shuffled(df: DataFrame, group: list[str], item: str, seed: int) -> DataFrame:
    """group, item, place (from 0), n: the distinct items in the order of md5(seed:item), the same wherever it runs."""
    keyed = df.select(*group, F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(item))).alias("_lot"), item)
    return ordinals(keyed, group, ["_lot", item], "place").drop("_lot")


def shard_assignment(files: DataFrame, seed: int = 42, shard_size: int = SHARD_SIZE, flat: bool = False) -> DataFrame:
    """dataset, kind, file_name, shard: `{kind}-{number}.tar.zst`, numbers by place in the shuffled order.

    flat names them `trajectories-{number}.tar.zst`, for a dataset whose files aren't split by kind.
    """
    if shard_size < 1:
        raise ValueError("shard_size must be at least 1")
    placed = shuffled(files.select("dataset", "kind", "file_name"), ["dataset", "kind"], "file_name", seed)
    number = F.floor(F.col("place") / shard_size)
    return placed.select("dataset", "kind", "file_name", F.format_string("%s-%03d.tar.zst", F.lit("trajectories") if flat else F.col("kind"), number).alias("shard"))


def fraction_sample(df: DataFrame, group: list[str], item: str, fraction: float, seed: int = 42) -> DataFrame:
    """max(1, int(n * fraction)) of each group's n distinct items, chosen by hash."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be above 0 and at most 1")
    placed = written(shuffled(df, group, item, seed), "sample")
    return placed.where(F.col("place") < F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(fraction)))).select(*group, item)


def shard_payloads(files: DataFrame, assigned: DataFrame) -> DataFrame:
    """dataset, shard, n_files, n_raw, payload: a zstd-compressed tar of each shard's files, in their names' order.

    A task holds one shard, of at most shard_size files.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        raw = io.BytesIO()
        with tarfile.open(fileobj=raw, mode="w", format=tarfile.GNU_FORMAT) as tar:
            for name, text in sorted(zip(pdf.file_name, pdf.file_text)):
                data = (text or "").encode()
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        whole = raw.getvalue()
        packed = zstandard.ZstdCompressor().compress(whole)
        return pd.DataFrame(
            {"dataset": [pdf.dataset.iloc[0]], "shard": [pdf.shard.iloc[0]], "n_files": [len(pdf)], "n_raw": [len(whole)], "payload": [packed]}
        )

    rows = files.select("dataset", "kind", "file_name", "file_text").join(assigned, ["dataset", "kind", "file_name"])
    return rows.groupBy("dataset", "shard").applyInPandas(run, "dataset string, shard string, n_files long, n_raw long, payload binary")


def shard_totals(payloads: DataFrame) -> DataFrame:
    """dataset, n_shards, n_files, raw_bytes, packed_bytes, ratio of shard_payloads(); the ratio is 0 where nothing was packed."""
    sums = payloads.groupBy("dataset").agg(
        F.count("*").alias("n_shards"), F.sum("n_files").alias("n_files"), F.sum("n_raw").alias("raw_bytes"), F.sum(F.length("payload")).cast("long").alias("packed_bytes")
    )
    ratio = F.when(F.col("packed_bytes") > 0, F.col("raw_bytes") / F.col("packed_bytes")).otherwise(F.lit(0.0))
    return sums.withColumn("ratio", ratio)
